"""Line dedup by content-defined chunks of lines.

A text is split on ``\\n`` and every line hashed. A rolling hash over each
neighbouring pair of line hashes decides whether a chunk ends between them, so
boundaries depend on content alone and move with it: a passage that other
documents share is cut alike inside, wherever it stands. Four chunkings on other
bits of the hash keep short passages from being missed. A line that has
``min_words`` words alone is a chunk of its own, wherever the cuts fall. A chunk is named by its
sequence of line hashes. Chunks that occur again anywhere in the corpus are
candidates; the first occurrence (smallest id, text hash and place) stays.

From each repeated chunk the match grows over neighbouring lines as long as the
pair of lines is itself a repeat of an earlier one (the edge of a passage is
chunked together with its surroundings, so it needs this step). The whole run
is removed if it has ``min_words`` words; a run of one line counts only through
its words, so short licence or navigation lines alone always stay.

Byte comparison: every line whose hash occurs twice or more in the corpus is
grouped by hash and by its bytes; a hash that stands for two different lines is
taken out of the matching, so equal sequences of hashes are equal bytes.

The text crosses the network once, in the last join; statistics move hashes. A line, chunk or pair that a third of
all rows share is combined map-side; the joins that bring first occurrences
back are equi joins that AQE splits.

Defined results: null text stays null and takes no part; rows that repeat both
id and text are one document and get the same result; null ids sort before
others; empty tables give no rows; extra columns pass through unchanged. A
document can end up empty; it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm._common import bitmap_hits, hash_bitmap, read_table, worker_cache, numbered_columns
from sifter.session import materialise

#: A boundary falls between two lines if their rolling hash is below CUT of OF.
CUT, OF = 3, 4
#: Independent chunkings of every document.
WAYS = 4
MIN_WORDS = 50
_MIX = np.uint64(0x9E3779B97F4A7C15)


def rolling(h: np.ndarray) -> np.ndarray:
    """Rolling hash of each neighbouring pair of line hashes (window two)."""
    x = (h[:-1] * _MIX) ^ (h[1:] + (h[:-1] >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(30))


def line_hashes(lines: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))


def chunks_of(h: np.ndarray, cut: int = CUT, of: int = OF, ways: int = WAYS) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of every chunk, each once, over ``ways``
    chunkings that use other bits of the rolling hash: a short passage that one
    of them cuts only at its edges has a whole chunk in another."""
    r = rolling(h) if len(h) > 1 else np.zeros(0, np.uint64)
    found = []
    for w in range(ways):
        s = np.concatenate(([0], np.flatnonzero((r >> np.uint64(13 * w)) % np.uint64(of) < np.uint64(cut)) + 1))
        found.append(s * (1 << 32) + np.diff(np.append(s, len(h))))
    both = np.unique(np.concatenate(found))
    return both >> 32, both & 0xFFFFFFFF


def _line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, th, lines array<bigint>, words array<int>)`` for texts that aren't null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("line_dedup")  # lets go of another operator's cache
        for b in batches:
            hs, ws, off = [], [], [0]
            for t in b.column(2).cast(pa.binary()):
                lines = t.as_py().split(b"\n")
                hs.append(line_hashes(lines).view(np.int64))
                ws.append(np.fromiter((len(x.split()) for x in lines), np.int32, len(lines)))
                off.append(off[-1] + len(lines))
            cat = lambda x, k: np.concatenate(x) if x else np.zeros(0, k)
            o = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(o, pa.array(cat(hs, np.int64))), pa.ListArray.from_arrays(o, pa.array(cat(ws, np.int32)))],
                names=["id", "th", "lines", "words"])

    slim = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("t"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, th bigint, lines array<bigint>, words array<int>")


def _colliding(docs: DataFrame, text_col: str, bitmap: bytes) -> DataFrame:
    """``h`` of repeated line hashes that stand for lines of different bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.int64)
        for b in batches:
            seen: dict[tuple[int, bytes], None] = {}
            for t in b.column(0).cast(pa.binary()):
                lines = t.as_py().split(b"\n")
                h = line_hashes(lines)
                for i in np.flatnonzero(bitmap_hits(bits, h)).tolist():
                    seen[(int(h[i].view(np.int64)), lines[i])] = None
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary())], names=["h", "line"])

    lines = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("t")).mapInArrow(run, "h bigint, line binary")
    return lines.groupBy("h", "line").count().groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")


def _units(table: DataFrame, cut: int, of: int, bitmap: bytes, min_words: int = MIN_WORDS) -> DataFrame:
    """Chunks, long lines and neighbouring pairs of every document:
    ``(key array<bigint>, kind, id, th, at, n)``; kind 0 is a chunk or a line of
    ``min_words`` words, each once, 1 a pair.
    A unit with a line that occurs once in the corpus can't repeat: the bitmap
    of repeated lines drops it here."""

    def may_repeat(b: pa.RecordBatch) -> pa.RecordBatch:
        key = b.column(0)
        o = key.offsets.to_numpy().astype(np.int64)
        once = ~bitmap_hits(np.frombuffer(bitmap, np.int64), key.values.to_numpy())
        return b.filter(pa.array(np.add.reduceat(once, o[:-1]) == 0)) if b.num_rows else b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, at, n, kind, keys, off = [], [], [], [], [], [0]
            lines = b.column(2)
            o, v = lines.offsets.to_numpy(), lines.values.to_numpy()
            ow, long = b.column(3).offsets.to_numpy(), b.column(3).values.to_numpy() >= min_words
            for r in range(b.num_rows):
                h = v[o[r]:o[r + 1]]
                s, size = chunks_of(h.view(np.uint64), cut, of)
                alone = np.setdiff1d(np.flatnonzero(long[ow[r]:ow[r + 1]]), s[size == 1])
                s, size = np.concatenate((s, alone)), np.concatenate((size, np.ones(len(alone), size.dtype)))
                pairs = len(h) - 1
                own.append(np.full(len(s) + max(pairs, 0), r))
                at.append(np.concatenate((s, np.arange(max(pairs, 0)))))
                n.append(np.concatenate((size, np.full(max(pairs, 0), 2))))
                kind.append(np.concatenate((np.zeros(len(s), np.int32), np.ones(max(pairs, 0), np.int32))))
                keys += [h[a:a + k] for a, k in zip(s.tolist(), size.tolist())]
                if pairs > 0:
                    keys.append(np.stack([h[:-1], h[1:]], 1).ravel())
            if not own:
                continue
            size = np.concatenate(n)
            off = np.concatenate(([0], np.cumsum(size)))
            take = pa.array(np.concatenate(own))
            yield may_repeat(pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(keys))), pa.array(np.concatenate(kind), pa.int32()),
                 b.column(0).take(take), b.column(1).take(take), pa.array(np.concatenate(at), pa.int32()), pa.array(size, pa.int32())],
                names=["key", "kind", "id", "th", "at", "n"]))

    kind = table.schema["id"].dataType.simpleString()
    return table.select("id", "th", "lines", "words").mapInArrow(run, f"key array<bigint>, kind int, id {kind}, th bigint, at int, n int")


def runs_to_remove(n_lines: int, words: np.ndarray, chunks: list[tuple[int, int]], pairs: set[int], min_words: int) -> list[tuple[int, int]]:
    """``(first, last + 1)`` of the runs that go: each repeated chunk grown over
    repeated pairs; kept unless it has ``min_words`` words."""
    mark = np.zeros(n_lines, bool)
    for at, n in chunks:
        lo, hi = at, at + n
        while lo > 0 and lo - 1 in pairs and not mark[lo - 1]:
            lo -= 1
        while hi < n_lines and hi - 1 in pairs and not mark[hi]:
            hi += 1
        mark[lo:hi] = True
    edge = np.diff(np.concatenate(([0], mark.astype(np.int8), [0])))
    return [(int(a), int(z)) for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)) if words[a:z].sum() >= min_words]


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  cut: int = CUT, of: int = OF) -> DataFrame:
    """``(id, th, n_lines, firsts array<int>, stops array<int>)`` for every
    document (id, text hash) that loses lines."""
    table = materialise(_line_table(docs, id_col, text_col).dropDuplicates(["id", "th"]), "lines")
    counts = table.select(F.explode("lines").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = hash_bitmap(counts, "h")
    bad = materialise(_colliding(docs, text_col, bitmap), "colliding")

    units = materialise(_units(table, cut, of, bitmap, min_words), "units")
    if bad.limit(1).count():
        hurt = units.withColumn("h", F.explode("key")).join(bad, "h", "left_semi").select("key").distinct()
        units = units.join(hurt, "key", "left_anti")
    place = F.struct("id", "th", "at")
    # written first: the join then has two plain exchanges, and AQE can split the one of a hot unit
    firsts = materialise(units.groupBy("key", "kind").agg(F.min(place).alias("p"), F.count("*").alias("c")).where("c > 1")
                         .select(F.col("key").alias("key_"), F.col("kind").alias("kind_"), "p"), "firsts")
    again = (units.join(firsts, (F.col("key") == F.col("key_")) & (F.col("kind") == F.col("kind_")))
             .where(~place.eqNullSafe(F.col("p"))))
    per = again.groupBy("id", "th").agg(
        F.collect_list(F.when(F.col("kind") == 0, F.struct("at", "n"))).alias("chunks"),
        F.collect_list(F.when(F.col("kind") == 1, F.col("at"))).alias("pairs")).where(F.size("chunks") > 0)
    per = per.select(F.col("id").alias("id_"), F.col("th").alias("th_"), "chunks", "pairs")
    got = table.join(per, F.col("id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_"))).select("id", "th", "words", "chunks", "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for words, chunks, pairs in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                spans = runs_to_remove(len(words), np.array(words), [(c["at"], c["n"]) for c in chunks], set(pairs), min_words)
                out.append((len(words), [s[0] for s in spans], [s[1] for s in spans]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.list_(pa.int32())), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
                names=["id", "th", "n_lines", "firsts", "stops"])

    kind = table.schema["id"].dataType.simpleString()
    return got.mapInArrow(run, f"id {kind}, th bigint, n_lines int, firsts array<int>, stops array<int>").where(F.size("firsts") > 0)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs taken out of the text (all columns, same
    rows), plus ``__removed_lines`` and ``__removed_runs`` (columns of these names
    are replaced; all others pass, whatever their names)."""
    runs = materialise(repeated_runs(docs, id_col, text_col, min_words), "runs")
    # the same plan at every size: the runs grow with the corpus, so they are never broadcast
    runs = runs.select(F.col("id").alias("__id"), F.col("th").alias("__th"), "firsts", "stops").hint("merge")
    rows, at = numbered_columns(docs)
    text = F.col(at[text_col])
    on = F.col(at[id_col]).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__th"))
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.exists(F.sequence(F.lit(0), F.size("firsts") - 1),
                                                  lambda k: (i >= F.col("firsts")[k]) & (i < F.col("stops")[k])))
    gone = F.aggregate(F.zip_with("stops", "firsts", lambda a, b: a - b), F.lit(0), lambda a, x: a + x)
    hit = F.col("firsts").isNotNull()
    return rows.join(runs, on, "left").select(
        *[(F.when(hit, F.array_join(kept, "\n")).otherwise(text) if c == text_col else F.col(n)).alias(c)
          for c, n in at.items() if c not in ("__removed_lines", "__removed_runs")],
        F.when(hit, gone).otherwise(0).alias("__removed_lines"), F.when(hit, F.size("firsts")).otherwise(0).alias("__removed_runs"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, removed_runs, removed_lines, the cleaned text."""
    got = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.col("__removed_runs").alias("removed_runs"), F.col("__removed_lines").alias("removed_lines"), "text")
