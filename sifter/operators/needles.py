"""F2 for many needles at once: one scan of the pages, whatever the number of needles.

The needles are a query set. Up to ``DEFAULT_BROADCAST_ROWS`` rows and
``DEFAULT_BROADCAST_BYTES`` of text they are sent to the tasks, cut into blocks of
about ``BLOCK_BYTES``; a task builds one automaton (Aho-Corasick) a block and runs
its pages through it, so its memory is one automaton and ``PAGES_BYTES`` of pages.
A page is read once: its group of pages meets every block before the next group.
No page token is shuffled, and needles that lie in each other, share a beginning
or have one letter cost no more than their matches. Beyond the bound the equi
joins of ``context.containing`` give the same rows.

Null needles and null pages match nothing, an empty needle matches every page with
a text, repeated needles and repeated query ids keep one row per (row of needles,
page); matching ignores case as ``fold_case`` does."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_case
from ..session import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS
from .context import containing

#: Text of the needles in one automaton.
BLOCK_BYTES = 1 << 20
#: Text of the pages that meet all blocks before the next are read.
PAGES_BYTES = 32 << 20


def needle_blocks(needles: Sequence[str], block_bytes: int = BLOCK_BYTES) -> list[list[tuple[int, str]]]:
    """Numbered needles in blocks of about ``block_bytes``; a longer needle is a
    block of its own."""
    blocks: list[list[tuple[int, str]]] = []
    size = 0
    for number, needle in enumerate(needles):
        length = len(needle.encode())
        if not blocks or size + length > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((number, needle))
        size += length
    return blocks


def _automaton(block: list[tuple[int, str]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, needle in block:
        found.add_word(needle, number)
    found.make_automaton()
    return found


def containing_any(needles: DataFrame, pages: DataFrame, passage_col: str, order: Sequence[str] = ("doc_id", "page_no"),
                   block_bytes: int = BLOCK_BYTES, pages_bytes: int = PAGES_BYTES, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``(query_id, order...)``: every page whose ``page_lc`` contains the
    needle, as ``context.containing`` gives them. ``order`` names a page."""
    spark, order = pages.sparkSession, list(order)
    folded = needles.select("query_id", fold_case(F.col(passage_col)).alias("needle")).where(F.col("needle").isNotNull())
    size = folded.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("needle")), F.lit(0)).alias("bytes")).first()
    if size["n"] > max_rows or size["bytes"] > max_bytes:
        return containing(needles, pages, passage_col, order, max_broadcast_rows=max_rows)
    rows = folded.collect()  # within the bound
    texts = sorted({r["needle"] for r in rows} - {""})
    number = {needle: i for i, needle in enumerate(texts)} | {"": -1}
    wanted = spark.createDataFrame([(r["query_id"], number[r["needle"]]) for r in rows],
                                   T.StructType([T.StructField("query_id", needles.schema["query_id"].dataType), T.StructField("_needle", T.IntegerType())]))
    blocks = spark.sparkContext.broadcast(needle_blocks(texts, block_bytes))
    empty = any(r["needle"] == "" for r in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _automaton(blocks.value[0]) if len(blocks.value) == 1 else None

        def hits(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks.value:
                found = only or _automaton(block)
                for b in group:
                    at, which = [], []
                    for i, text in enumerate(b.column(len(order)).to_pylist()):
                        got = {n for _, n in found.iter(text)}
                        at += [i] * len(got)
                        which += got
                    yield made(b, at, which)
            if empty:
                for b in group:
                    yield made(b, list(range(b.num_rows)), [-1] * b.num_rows)

        def made(b: pa.RecordBatch, at: list[int], which: list[int]) -> pa.RecordBatch:
            at = pa.array(at, pa.int64())
            return pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[:len(order)]), pa.array(which, pa.int32())], names=[*names, "_needle"])

        group: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            group.append(b)
            held += b.nbytes
            if held >= pages_bytes:
                yield from hits(group)
                group, held = [], 0
        yield from hits(group)

    names = [f"c{i}" for i in range(len(order))]
    sent = pages.where(F.col("page_lc").isNotNull()).select(*[F.col(c).alias(n) for c, n in zip(order, names)], "page_lc")
    schema = T.StructType([T.StructField(n, pages.schema[c].dataType) for c, n in zip(order, names)] + [T.StructField("_needle", T.IntegerType())])
    found = sent.mapInArrow(run, schema)
    return found.join(F.broadcast(wanted), "_needle").select("query_id", *[F.col(n).alias(c) for c, n in zip(order, names)])
