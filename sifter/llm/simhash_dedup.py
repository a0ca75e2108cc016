"""SimHash near-dedup by meet-in-the-middle ball hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles. Two fingerprints link when they differ in at most ``radius``
bits. Every distinct fingerprint emits all variants within half the radius;
two fingerprints within the radius then share a variant:

* radius ``2r``: the ball of ``r`` flips is enough, and any two fingerprints
  that share a variant link.
* radius ``2r + 1``: the odd bit is met by erasing one of four 16-bit blocks.
  The shuffle key is a variant with that block blanked, so both sides of a
  pair with one difference in the block and ``2r`` outside meet. In a bucket,
  members whose blanked parts are equal or one flip apart link. For radius 3
  the one case left, three differences inside one block, shares the
  unflipped key and is looked up there by the 560 three-flip masks.

Buckets never emit pairs of all members: members with the same blanked part are
chained, parts one flip apart are linked between representatives, every link
is verified by its bit distance, and a task passes on a spanning forest of its
links only. Exact copies collapse to one fingerprint before the shuffle.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; repeated rows and repeated ids keep
one row each; a null id never names a component unless no id of it is
non-null; empty tables give no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.llm._common import connected_components, read_table, worker_cache, numbered_columns
from sifter.session import materialise

SEED = 42
#: Rows of variants that one task sorts in memory (24 bytes each).
VARIANT_ROWS_PER_TASK = 1_500_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANE = (np.arange(8, dtype=np.int64) * 256)[None, :]


def majority(hashes: np.ndarray) -> int:
    """64-bit fingerprint: bit set where over half of the hashes have it."""
    n = len(hashes)
    if n == 0:
        return 0
    hist = np.zeros(2048, np.int64)
    for i in range(0, n, 1 << 16):
        lanes = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8) + _LANE
        hist += np.bincount(lanes.ravel(), minlength=2048)
    counts = (hist.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of one UTF-8 text (A-Z lower-cased, words on ASCII blanks)."""
    import xxhash

    words = text.lower().split()
    n = len(words)
    if n == 0:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return majority(np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64))


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, th, fp)``: one row per input row; ``th`` is a hash of the text
    that tells rows of one id apart, ``fp`` the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("simhash")  # lets go of another operator's cache
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "th", "fp"])

    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("t"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, th bigint, fp bigint")


def _block_variants(fp: np.ndarray, block: int, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of the variants with ``block`` blanked: the fingerprint
    turned so that the block comes lowest, up to ``flips`` of the other 48 bits
    flipped, the block number in the blanked place."""
    s = np.uint64(16 * block)
    turned = (fp >> s) | (fp << np.uint64((64 - 16 * block) % 64)) if block else fp
    masks = [0] + [sum(1 << (16 + j) for j in c) for r in range(1, flips + 1) for c in combinations(range(48), r)]
    m = np.array(masks, np.uint64)
    base = (turned & ~np.uint64(0xFFFF)) | np.uint64(block)
    return (base[:, None] ^ m[None, :]).ravel(), np.repeat(fp, len(m))


def _variants(radius: int):
    flips, odd = radius // 2, radius % 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_fp = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(all_fp), 2048):
                fp = all_fp[i:i + 2048]
                if odd:
                    parts = [_block_variants(fp, k, flips) for k in range(4)]
                    key, own = (np.concatenate(x) for x in zip(*parts))
                else:
                    masks = [sum(1 << j for j in c) for r in range(flips + 1) for c in combinations(range(64), r)]
                    m = np.array(masks, np.uint64)
                    key, own = (fp[:, None] ^ m[None, :]).ravel(), np.repeat(fp, len(m))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(own.view(np.int64))], names=["k", "fp"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links: (node, root) for nodes that aren't roots."""
    if len(a) == 0:
        return a, b
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    nodes, idx = np.unique(pairs, return_inverse=True)
    idx = idx.reshape(pairs.shape)
    parent = list(range(len(nodes)))
    for x, y in idx.tolist():
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array(parent)
    while True:
        up = root[root]
        if (up == root).all():
            break
        root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _pairs_in_buckets(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the rows of whole buckets (unsigned arrays)."""
    odd = radius % 2
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    same = np.concatenate((key[1:] == key[:-1], [False]))
    many = same | np.concatenate(([False], same[:-1]))
    key, fp = key[many], fp[many]
    if len(key) == 0:
        return key, key
    if not odd:
        prev = key[1:] == key[:-1]
        a, b = fp[1:][prev], fp[:-1][prev]
    else:
        block = (key & np.uint64(0xFFFF)).astype(np.uint64)
        s = np.uint64(16) * block
        part = (fp >> s) & np.uint64(0xFFFF)
        order = np.lexsort((fp, part, key))
        key, fp, part = key[order], fp[order], part[order]
        chained = (key[1:] == key[:-1]) & (part[1:] == part[:-1])
        out_a, out_b = [fp[1:][chained]], [fp[:-1][chained]]
        first = np.concatenate(([True], ~chained))
        ckey, cpart, cfp = key[first], part[first], fp[first]
        bucket = np.cumsum(np.concatenate(([0], (ckey[1:] != ckey[:-1]).astype(np.int64))))
        code = bucket * 65536 + cpart.astype(np.int64)  # ascending: rows are sorted by bucket, then part

        def look(rows: np.ndarray, codes: np.ndarray, owners: np.ndarray, masks: list[int]) -> None:
            for m in masks:
                want = codes[rows] ^ m
                up = want > codes[rows]
                at = np.minimum(np.searchsorted(codes, want[up]), len(codes) - 1)
                hit = codes[at] == want[up]
                out_a.append(owners[rows][up][hit])
                out_b.append(owners[at[hit]])

        sizes = np.bincount(bucket)
        look(np.flatnonzero(sizes[bucket] > 1), code, cfp, [1 << j for j in range(16)])
        if radius == 3:
            # members that have the bucket's key unflipped: equal outside the block
            s0 = np.uint64(16) * (key & np.uint64(0xFFFF))
            back = np.where(s0 > 0, (fp >> s0) | (fp << ((np.uint64(64) - s0) & np.uint64(63))), fp)
            own = (back & ~np.uint64(0xFFFF)) == (key & ~np.uint64(0xFFFF))
            okey, opart, ofp = key[own], part[own], fp[own]
            if len(okey):
                obucket = np.cumsum(np.concatenate(([0], (okey[1:] != okey[:-1]).astype(np.int64))))
                osizes = np.bincount(obucket)
                rows = np.flatnonzero(osizes[obucket] > 1)
                if len(rows):
                    look(rows, obucket * 65536 + opart.astype(np.int64), ofp,
                         [sum(1 << j for j in c) for c in combinations(range(16), 3)])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
    ok = np.bitwise_count(a ^ b) <= radius
    return a[ok], b[ok]


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []
        for b in batches:
            keys.append(b.column(0).to_numpy().view(np.uint64))
            fps.append(b.column(1).to_numpy().view(np.uint64))
        if not keys:
            return
        a, b = _forest(*_pairs_in_buckets(np.concatenate(keys), np.concatenate(fps), radius))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)`` links whose closure equals that of all pairs of distinct
    ``fp`` values at most ``radius`` bits apart. ``fps`` must be durable (it is
    read twice); radius 0 to 4."""
    if not 0 <= radius <= 4:
        raise ValueError("radius must be 0 to 4")
    if radius == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    per = {1: 4, 2: 65, 3: 196, 4: 2081}[radius]
    tasks = max(1, -(-fps.count() * per // VARIANT_ROWS_PER_TASK))
    shuffled = fps.select("fp").mapInArrow(_variants(radius), "k bigint, fp bigint").repartition(tasks, "k")
    return shuffled.mapInArrow(_link(radius), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 3) -> DataFrame:
    """``(id, th, fp, root, component)`` per input row; root is the smallest
    fingerprint (signed) of the component, component the smallest id reachable."""
    base = materialise(with_fingerprint(docs, id_col, text_col, shingle), "fp")
    distinct = materialise(base.groupBy("fp").agg(F.min("id").alias("low")), "fp1")
    roots = connected_components(fingerprint_links(distinct, radius))
    known = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = known.groupBy("root").agg(F.min("low").alias("component"))
    named = known.join(lows, "root").select(F.col("fp").alias("fp_"), "root", "component")
    return base.join(named, F.col("fp") == F.col("fp_")).select("id", "th", "fp", "root", "component")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  radius: int = 3) -> DataFrame:
    """Rows of ``docs`` with one row of every component left: that with the
    smallest id (ids that are null come last, then the smallest text hash; of
    rows that repeat id and text, the one with the smallest row hash). All
    columns of ``docs`` are returned, whatever their names."""
    comp = simhash_components(docs, id_col, text_col, shingle, radius)
    each = comp.groupBy("root", "id", "th").agg(F.count("*").alias("n"))
    won = each.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "th", "n")).alias("w"))
    won = materialise(won.select(F.col("w.id").alias("__id"), F.col("w.th").alias("__th"), F.col("w.n").alias("__n")), "won")
    rows, at = numbered_columns(docs)
    cols = [F.col(n) for n in at.values()]
    kept = rows.join(won, F.col(at[id_col]).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(at[text_col]).cast("string")) == F.col("__th")))
    order = Window.partitionBy("__id", "__th").orderBy(F.xxhash64(*cols))
    again = kept.where("__n > 1").withColumn("__rn", F.row_number().over(order)).where("__rn = 1")
    return kept.where("__n = 1").select(*cols).unionByName(again.select(*cols)).toDF(*at)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: doc_id, fingerprint (16 hex digits), component_id."""
    got = simhash_components(read_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
