"""V2/V3 sparse, exact and bounded: top-k without scoring every candidate.

The brute-force form scores each passage that shares any word with a query. Here
passages are dealt to blocks by a hash of their key, and each (block, term) has its
greatest weight. The sum of query weight times greatest weight bounds the score of
every passage in a block from above, so

1. the bound of every (query, block) comes from the table of greatest weights,
   which is smaller than the postings;
2. the few blocks with the highest bounds are scored; the k-th score is a
   threshold that the final k-th score can't fall below;
3. only blocks whose bound reaches the threshold are scored.

Bounds get a little slack for the order of additions and are rounded as scores
are, and a block that can tie with the threshold is read; so the rows equal those
of ``topk(sparse_scores(...))``, ties included. A query with fewer than k
candidates has no threshold and reads all its blocks. Small blocks have sharper
bounds and a larger table of greatest weights.

A block lies in one bucket of the postings, so these are neither copied nor moved:
the greatest weights are taken where the postings stand, and written in buckets that
hold whole blocks. Bounds and scores are summed inside a bucket. Queries that can be
broadcast are scored in arrays: there the passages of a block that stand together give
its bounds once more, which spares a table of (query, block) pairs, and only a query's
best rows of each task move. Other query sets take joins, with a row a (query, block)
pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import SCORE_DIGITS, round_score
from ..session import bounded_broadcast, materialise, materialise_bucketed
from .search import DEFAULT_K, PAIRS_AT_ONCE, QueryBlocks, TfidfIndex, _any_of, _scored_rows, query_blocks, topk

#: Passages of one block, about: a bucket has a power of two of blocks.
BLOCK_PASSAGES = 16
#: Least number of blocks scored for a query's threshold; at least k, since a
#: block with a bound holds a candidate.
FIRST_BLOCKS = 4
#: Most block numbers that stand in a filter.
MAX_PUSHED_BLOCKS = 64
#: Postings of which the greatest weights are taken at once, and rows of a batch of these.
ROWS_AT_ONCE, ROWS_OUT = 500_000, 10_000
_SLACK = 1e-9


@dataclass
class BlockIndex:
    """``postings (block, keys..., term, nweight)``, those of the index with the
    block of their key, and ``greatest (part, block, term, top)``, bucketed on the
    part: a part has all rows of its blocks. A ``top`` may be more than the greatest
    weight, by the rounding to a float, but not less."""

    postings: DataFrame
    greatest: DataFrame
    keys: tuple[str, ...]


@dataclass
class BoundedHits:
    """Hits as ``topk`` gives them; the (query, block) pairs that share a term,
    and those of them that were scored for the hits."""

    hits: DataFrame
    pairs: int
    pairs_read: int


def _part_numbers(index: TfidfIndex, buckets: int) -> list[int]:
    """For each bucket a number that Spark deals to it."""
    of = F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")
    n = {r["bucket"]: r["id"] for r in index.postings.sparkSession.range(64 * buckets).select(F.col("id").cast("int")).groupBy(of).agg(F.min("id").alias("id")).collect()}
    return [n.get(b, b) for b in range(buckets)]  # a bucket without one shares another's: no row is lost


def _greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(block, term, top)`` of postings in term order. (Elsewhere the rows of a
    term may be cut in two, and a bound then counts it twice: still a bound.)"""
    def taken(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        got = rows.group_by(["block", "term"], use_threads=False).aggregate([("nweight", "max")])
        top = np.nextafter(got["nweight_max"].to_numpy().astype(np.float32), np.float32(np.inf))
        yield from pa.table({"block": got["block"], "term": got["term"], "top": pa.array(top, pa.float32())}).to_batches(max_chunksize=ROWS_OUT)

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < ROWS_AT_ONCE:
            continue
        rows = pa.Table.from_batches(held)
        last = pc.index(rows["term"], rows["term"][-1]).as_py()  # the last term may go on
        if last:
            yield from taken(rows.slice(0, last))
        held = rows.slice(last).combine_chunks().to_batches()
        n = 0  # a term of more rows than that is not looked through with each batch
    if held:
        yield from taken(pa.Table.from_batches(held))


def block_index(index: TfidfIndex, size: int = BLOCK_PASSAGES) -> BlockIndex:
    """Deal an index into blocks of about ``size`` passages. Built once per
    corpus; no posting is shuffled or copied."""
    buckets = int(index.postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # as in ``tfidf_index``: modulo the number of buckets, a block's number is its bucket's
    of_bucket = 2 ** round(np.log2(max(1, index.n_docs / (size * buckets))))
    block = F.pmod(F.hash(*index.keys), F.lit(buckets * of_bucket)).cast("bigint").alias("block")
    postings = index.postings.select(block, *index.keys, "term", "nweight")
    numbers = F.array(*map(F.lit, _part_numbers(index, buckets)))
    part = F.get(numbers, (F.col("block") % buckets).cast("int")).alias("part")
    rows = postings.select("block", "term", "nweight").mapInArrow(_greatest, "block bigint, term string, top float")
    greatest = materialise_bucketed(rows.select(part, "block", "term", "top"), "part", buckets, name="blockgreatest", clustered=True, sort="term")
    return BlockIndex(postings, greatest, tuple(index.keys))


def _pair_scores(index: BlockIndex, pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """Scores of the passages of the (query, block) pairs given. Postings meet
    the weights on their term before the pairs: on the block alone each would
    meet every query of its block."""
    blocks = pairs.select("block").distinct()
    few = [r["block"] for r in blocks.limit(MAX_PUSHED_BLOCKS + 1).collect()]
    postings = index.postings
    if 0 < len(few) <= MAX_PUSHED_BLOCKS:
        postings = postings.where(_any_of([F.col("block") == F.lit(b) for b in sorted(few)]))
    else:
        postings = postings.join(bounded_broadcast(blocks), "block", "left_semi")
    return (postings.join(weights, "term").join(bounded_broadcast(pairs.select("query_id", "block")), ["query_id", "block"])
            .groupBy("query_id", "block", *index.keys).agg(F.sum(F.col("nqweight") * F.col("nweight")).alias("score")).drop("block"))


def _can_reach(bound: Column, threshold: Column) -> Column:
    return threshold.isNull() | (round_score(bound * (1 + _SLACK) + _SLACK) >= threshold)


def bounded_topk(index: BlockIndex, query_weights: DataFrame, k: int = DEFAULT_K, first: int = FIRST_BLOCKS) -> BoundedHits:
    """The rows of ``topk(sparse_scores(...), k)`` from the blocks that can
    hold them; ``query_weights`` as ``TfidfIndex.query_weights`` gives them."""
    weights = materialise(query_weights.select("query_id", "term", "nqweight").where("query_id is not null"), "query-weights")
    blocks = query_blocks(weights)
    if blocks is not None:
        return _bounded_by_arrays(index, weights, blocks, k, first)
    weights = bounded_broadcast(weights)
    bounds = materialise(index.greatest.join(weights, "term").groupBy("query_id", "part", "block")
                         .agg(F.sum(F.col("nqweight") * F.col("top")).alias("bound")).drop("part"), "block-bounds")
    best = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    start = materialise(bounds.withColumn("n", F.row_number().over(best)).where(F.col("n") <= max(first, k)), "first-blocks")
    reached = topk(_pair_scores(index, start, weights), k, index.keys).where(F.col("rank") == k)
    reached = bounded_broadcast(materialise(reached.select("query_id", F.col("score").alias("threshold")), "thresholds"))
    left = materialise(bounds.join(reached, "query_id", "left").where(_can_reach(F.col("bound"), F.col("threshold"))), "blocks-left")
    return BoundedHits(topk(_pair_scores(index, left, weights), k, index.keys), bounds.count(), left.count())


def _bounded_by_arrays(index: BlockIndex, weights: DataFrame, blocks: QueryBlocks, k: int, first: int) -> BoundedHits:
    """``bounded_topk`` of queries that can be broadcast, without a row a
    (query, block) pair."""
    keys = list(index.keys)
    greatest = blocks.numbered(index.greatest, ["part", "block"], "top")
    id_field = weights.schema["query_id"]
    best = T.StructType([id_field, T.StructField("block", T.LongType()), T.StructField("score", T.DoubleType())])
    start = materialise(topk(greatest.mapInArrow(blocks.scorer(["block"], max(first, k)), best), max(first, k), ["block"]), "first-blocks")
    reached = topk(_pair_scores(index, start, bounded_broadcast(weights)), k, keys).where(F.col("rank") == k)
    known = {r["query_id"]: r["score"] for r in reached.select("query_id", "score").collect()}  # a row a query at most
    threshold = np.array([known.get(q, -np.inf) for q in blocks.ids.to_pylist()])
    shared = blocks.shared
    step = max(1, PAIRS_AT_ONCE // len(threshold))

    def reach(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of blocks, by their term numbers and greatest weights: the queries
        that each can serve, and the number of those that share a term with it."""
        scale = 10.0 ** SCORE_DIGITS
        take, pairs = np.zeros((len(lists), len(threshold)), bool), np.zeros(len(lists), np.int64)
        for _, lo, at, s in _scored_rows(lists, shared.value[1]):
            bound = np.floor((s * (1 + _SLACK) + _SLACK) * scale + 0.5) / scale
            take[at, lo:lo + s.shape[1]] = (s > 0) & (bound >= threshold[lo:lo + s.shape[1]])
            pairs[at] += (s > 0).sum(1)
        return take, pairs

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                take, pairs = reach(batch.column("_p"))
                yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(pairs), pa.array(take.sum(1).astype(np.int64))], names=["block", "pairs", "taken"])

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Passages in block order with a bit for each query that their block can
        serve. A block cut in two has, in each piece, the bounds of its passages there."""
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                number = batch.column("block").to_numpy()
                run = np.cumsum(np.r_[False, number[1:] != number[:-1]])
                take = reach(_greatest_lists(batch.column("_p"), run))[0]
                bits = [x.tobytes() for x in np.packbits(take, axis=1)]
                wanted = np.flatnonzero(take.any(axis=1)[run])
                if len(wanted):
                    queries = pa.array(bits, pa.binary()).take(pa.array(run[wanted]))
                    rows = batch.select([*keys, "_p"]).take(pa.array(wanted))
                    yield pa.RecordBatch.from_arrays([*rows.columns, queries], names=[*keys, "_p", "queries"])

    scorer = blocks.scorer(keys, k, "queries")
    about = materialise(greatest.mapInArrow(counted, "block bigint, pairs bigint, taken bigint"), "blocks-left")
    passages = blocks.numbered(index.postings, ["block", *keys], "nweight").sortWithinPartitions("block")
    schema = T.StructType([id_field] + [index.postings.schema[c] for c in keys] + [T.StructField("score", T.DoubleType())])
    hits = topk(passages.mapInArrow(lambda batches: scorer(masked(batches)), schema), k, keys)
    n = about.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("taken"), F.lit(0)).alias("taken")).first()
    return BoundedHits(hits, n["pairs"], n["taken"])


def _greatest_lists(lists: pa.Array, run: np.ndarray) -> pa.Array:
    """Term numbers with the greatest weight of each, a list for each run of rows."""
    flat = lists.flatten()
    no, w = flat.field("_no").to_numpy(), flat.field("nweight").to_numpy()
    of = run[pc.list_parent_indices(lists).to_numpy()]
    order = np.lexsort((no, of))
    starts = np.flatnonzero(np.r_[True, (of[order][1:] != of[order][:-1]) | (no[order][1:] != no[order][:-1])])
    first = order[starts]
    offsets = np.searchsorted(of[first], np.arange(run[-1] + 2))
    values = pa.StructArray.from_arrays([pa.array(no[first]), pa.array(np.maximum.reduceat(w[order], starts))], names=["_no", "nweight"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
