"""Helpers shared by the operators of this subpackage.

* ``worker_cache``: a dictionary that lives as long as the Python worker. The
  functions of this package travel to executors by value, so a module global
  would be fresh in every task.
* ``learnable`` / ``held_out``: the split of the learning contracts.
* ``text_chunks`` / ``numbered_words``: texts cut into words by Arrow, a few
  megabytes at once.
* ``hash_bitmap``: a fixed-size bitmap of 64-bit keys, built on Spark. Its size
  does not depend on the data, so it may be sent to every task; a false
  positive only costs work, never a result.
* ``connected_components``: alternating large-star / small-star rounds, each
  written to the shared checkpoint folder.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F

from sifter.session import materialise

#: ASCII blanks, the separators of the contracts' words.
BLANKS = " \t\n\x0b\x0c\r"
BITMAP_LOG2 = 24


def worker_cache(name: str) -> dict:
    """The worker-lifetime dictionary ``name`` (the same object in every task
    that one Python worker runs). A worker keeps one at a time: it goes on to
    another operator's stage with an empty hand."""
    home = sys.modules.setdefault("_sifter_llm_worker", types.ModuleType("_sifter_llm_worker"))
    others = [k for k in vars(home) if k.startswith("cache_") and k != f"cache_{name}"]
    for other in others:
        delattr(home, other)
    if others:
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
        if trim:
            trim(0)
    return vars(home).setdefault(f"cache_{name}", {})


def text_chunks(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """``(first, rows)`` of runs of at most ``most`` bytes of text, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield first, last - first
        first = last


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of ``texts`` with A-Z in lower case (binary, as they first
    come), the number among these of each word of the texts, and the count of
    words up to the end of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends = split.offsets.to_numpy().astype(np.int64)
    ends = ends[1:] - ends[0]
    coded = split.flatten().dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy()
    blank = pc.index(words, "").as_py()  # before and behind the blanks at a text's ends
    if blank >= 0:
        word = at != blank
        ends = np.concatenate(([0], np.cumsum(word)))[ends]
        at = at[word]
        at = at - (at > blank)
        words = pa.concat_arrays([words.slice(0, blank), words.slice(blank + 1)])
    return words.cast(pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()), at, ends


def crc_mod4(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(4)


def held_out(id_col: Column) -> Column:
    """True where the remainder is 2; a null id is not held out."""
    return F.coalesce(crc_mod4(id_col) == 2, F.lit(False))


def learnable(id_col: Column) -> Column:
    """True where the contract allows learning; a null id is never learned from."""
    return F.coalesce(crc_mod4(id_col) != 2, F.lit(False))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named ``c0``, ``c1``, ... and {old name: new name},
    so that no name of the caller meets one of an operator."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def hash_bitmap(keys: DataFrame, col: str, log2: int = BITMAP_LOG2) -> bytes:
    """Bitmap with bit ``key & (2**log2 - 1)`` set for every long in ``col``.

    The words are or-ed on Spark; at most ``2**log2 / 64`` rows reach the
    driver (4 MB for the default), whatever the size of ``keys``."""
    pos = F.col(col).bitwiseAND(F.lit((1 << log2) - 1))
    words = (keys.select(F.shiftright(pos, 6).alias("w"), F.expr(f"shiftleft(1L, cast({col} & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(1 << (log2 - 6), np.int64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("b").to_numpy()
    return out.tobytes()


def bitmap_hits(bitmap: np.ndarray, keys: np.ndarray, log2: int = BITMAP_LOG2) -> np.ndarray:
    """Boolean per key: may be in the set. ``bitmap`` is the int64 view."""
    k = keys.view(np.uint64) if keys.dtype == np.int64 else keys
    pos = (k & np.uint64((1 << log2) - 1)).astype(np.int64)
    return ((bitmap[pos >> 6] >> (pos & 63)) & 1).astype(bool)


def _edge_state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return (r.n, int(r.s or 0))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    low = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    hung = down.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return hung.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: root is the smallest
    node of the component (the root's own row is not included).

    Large-star and small-star rounds: every round is two aggregations on node
    keys (combined map-side) and two equi joins that AQE can split on a hot
    node; the number of rounds grows with the logarithm of the longest path.
    Each round is written to the shared folder, so a lost executor costs one
    round at most and lineage stays short."""
    cur = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "cc")
    state = _edge_state(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        cur = materialise(_small_star(_large_star(cur)), "cc")
        new = _edge_state(cur)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
