"""V2/V3 dense, exact and bounded: top-k without scoring every vector.

The vectors stand in cells, each with a centre and the widest angle between the
centre and a member. A query at angle ``a`` from a centre is at least ``a - width``
from each member, so ``cos(a - width)`` bounds the cell's scores from above. A query
scores its best cells until these hold k vectors; its k-th score is a threshold that
the final k-th score can't fall below; then it scores the other cells whose bound
reaches the threshold, ties and rounding included. The rows equal those of
``topk(dense_scores(...))``.

Centres are a sample of the vectors, bounded by ``MAX_CENTRES`` and chosen by a hash
of the key; every vector is in a cell. Zero vectors (score 0) have a cell of their
own, as have vectors with a component that is no number, which every query reads.
A cell is cut into parts of about ``PART_ROWS`` by a hash of the key, and the queries
that read a part into groups, so a cell with a third of all vectors is many tasks.
Bounds never leave the task of their query: only the (query, cell) pairs to be
scored do."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import SCORE_DIGITS
from ..session import materialise, materialise_bucketed
from .search import CORPUS_BLOCK, DEFAULT_K, MAX_QUERY_BLOCK, _score_block, _unit_rows, topk

#: Most centres; fewer where the corpus has under their square of vectors.
MAX_CENTRES = 2048
PART_ROWS = CORPUS_BLOCK
#: Cells of vectors without a direction.
ZERO, NO_NUMBER = -1, -2
#: Vectors, or queries, that meet all centres at once.
ROWS_AT_ONCE = 512
#: Angles and bounds are widened by this much for rounding.
_SLACK = 1e-6


@dataclass
class CellIndex:
    """``vectors (cell, part, keys..., vec)``, bucketed on the cell and part, and
    what a task needs of the cells: at most ``MAX_CENTRES + 2`` of each."""

    vectors: DataFrame
    keys: tuple[str, ...]
    centres: np.ndarray
    width: dict[int, float]
    rows: dict[int, int]

    def sizes(self) -> DataFrame:
        """``(cell, n, parts)``, a row a cell, to be broadcast."""
        rows = [(c, n, -(-n // PART_ROWS)) for c, n in self.rows.items()]
        return F.broadcast(self.vectors.sparkSession.createDataFrame(rows, "cell int, n bigint, parts int"))


@dataclass
class CellHits:
    """Hits as ``topk`` gives them; (query, vector) pairs in all, and scored."""

    hits: DataFrame
    pairs: int
    pairs_read: int


def _units(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of length one, which are zero, and which are no numbers."""
    raw = np.vstack(vectors.to_numpy()).astype(np.float64)
    odd = ~np.isfinite(raw).all(1)
    raw[odd] = 0
    units = _unit_rows(pd.Series(list(raw)))
    return units, ~units.any(1) & ~odd, odd


def cell_index(corpus: DataFrame, key_col: str | Sequence[str] = "vec_id", vec_col: str = "embedding", max_centres: int = MAX_CENTRES) -> CellIndex:
    """Deal the vectors to cells, once per corpus. Null vectors have no score
    and are left out."""
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    c = corpus.where(F.col(vec_col).isNotNull()).select(*keys, F.col(vec_col).cast("array<double>").alias("vec"))
    wanted = min(max_centres, max(1, int(np.ceil(np.sqrt(c.count())))))
    picked = c.orderBy(F.xxhash64(F.lit("centres"), *keys), *keys).select("vec").limit(wanted).collect()
    centres = np.zeros((0, 0))
    if picked:
        units, zero, odd = _units(pd.Series([r["vec"] for r in picked]))
        centres = np.unique(units[~zero & ~odd], axis=0)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), ROWS_AT_ONCE):
                pdf = whole.iloc[i:i + ROWS_AT_ONCE]
                units, zero, odd = _units(pdf["vec"])
                cell, near = np.zeros(len(pdf), np.int64), np.ones(len(pdf))
                if len(centres):
                    cos = units @ centres.T
                    cell, near = cos.argmax(1), cos.max(1)
                else:  # the sample has no direction: what has one is read by all
                    odd = ~zero
                cell = np.where(odd, NO_NUMBER, np.where(zero, ZERO, cell))
                yield pdf.assign(cell=cell.astype(np.int32), angle=np.where(cell >= 0, np.arccos(np.clip(near, -1, 1)), 0.0))

    schema = T.StructType(c.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    dealt = materialise(c.mapInPandas(assign, schema), "vectors-of-cells")
    about = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("width")).collect()
    index = CellIndex(dealt, tuple(keys), centres, {r["cell"]: r["width"] for r in about}, {r["cell"]: r["n"] for r in about})
    part = F.pmod(F.xxhash64(*keys, "vec"), F.col("parts")).cast("int").alias("part")
    index.vectors = materialise_bucketed(dealt.join(index.sizes(), "cell").select("cell", part, *keys, "vec"), ["cell", "part"], name="cells", sort="cell")
    return index


def _bounds(index: CellIndex, cells: np.ndarray, units: np.ndarray, zero: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Upper bounds of the rounded score of each query (row) in each cell; no
    number where the score may be none."""
    out = np.zeros((len(units), len(cells)))
    at = cells >= 0
    if at.any():
        a = np.arccos(np.clip(units @ index.centres[cells[at]].T, -1, 1))
        out[:, at] = np.cos(np.maximum(0.0, a - np.array([index.width[c] for c in cells[at].tolist()]) - _SLACK)) + _SLACK
    out[zero] = 0.0
    out[:, cells == NO_NUMBER] = np.nan
    out[odd] = np.nan
    scale = 10.0 ** SCORE_DIGITS
    return np.floor(out * scale + 0.5) / scale


def _first_cells(bounds: np.ndarray, rows: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the cells with the best bounds that together hold k rows."""
    order = np.argsort(-np.where(np.isnan(bounds), np.inf, bounds), axis=1, kind="stable")
    enough = np.cumsum(rows[order], axis=1) >= k
    last = np.where(enough.any(1), enough.argmax(1), bounds.shape[1] - 1)
    return [o[:n + 1] for o, n in zip(order, last)]


def _pairs(index: CellIndex, queries: DataFrame, k: int, rest: bool) -> DataFrame:
    """``(_qid, _qv, cells)``: each query's first cells or, with ``rest``, the
    others that can reach its ``threshold`` (all of them where it is null). A
    query stays one row, so its vector is not repeated for each of its cells."""
    cells = np.array(sorted(index.rows), np.int64)
    rows = np.array([index.rows[c] for c in cells.tolist()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), ROWS_AT_ONCE):
                pdf = whole.iloc[i:i + ROWS_AT_ONCE].reset_index(drop=True)
                bounds = _bounds(index_only, cells, *_units(pdf["_qv"]))
                first = _first_cells(bounds, rows, k)
                if rest:
                    threshold = pdf["threshold"].to_numpy(np.float64)[:, None]
                    none = pdf["none"].to_numpy(bool)[:, None]
                    take = none | np.isnan(bounds) | (bounds >= threshold)
                    for q, f in enumerate(first):
                        take[q, f] = False
                    first = [np.flatnonzero(t) for t in take]
                yield pdf[["_qid", "_qv"]].assign(cells=[cells[f].astype(np.int32) for f in first])

    index_only = CellIndex(None, index.keys, index.centres, index.width, index.rows)  # frames don't travel
    schema = T.StructType([queries.schema["_qid"], queries.schema["_qv"], T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return queries.mapInPandas(run, schema)


def _scored(index: CellIndex, pairs: DataFrame, groups: int, k: int) -> DataFrame:
    """Each query's best k rows of every part of its cells."""
    keys = list(index.keys)
    q = pairs.select("_qid", "_qv", F.explode("cells").alias("cell")).join(index.sizes(), "cell").select("_qid", "_qv", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    q = q.withColumn("group", F.pmod(F.xxhash64("_qid", "_qv"), F.lit(groups)).cast("int"))
    wanted = q.select("cell", "part", F.col("group").alias("to")).distinct()
    vectors = index.vectors.join(wanted, ["cell", "part"])  # a part goes to the query groups that read it
    schema = T.StructType([T.StructField("query_id", q.schema["_qid"].dataType)] + [index.vectors.schema[c] for c in keys] + [T.StructField("score", T.DoubleType())])

    def score(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        return pd.concat(_score_block(qs["_qid"].to_numpy(), _unit_rows(qs["_qv"]), cs[keys], _unit_rows(cs["vec"]), k), ignore_index=True)

    return q.groupBy("cell", "part", "group").cogroup(vectors.groupBy("cell", "part", "to")).applyInPandas(score, schema)


def bounded_dense_topk(index: CellIndex, queries: DataFrame, k: int = DEFAULT_K, query_id_col: str = "vec_id", query_vec_col: str = "embedding",
                       block: int = MAX_QUERY_BLOCK) -> CellHits:
    """The rows of ``topk(dense_scores(...), k)`` from the cells that can hold
    them. Queries are dealt into groups of about ``block`` by a hash."""
    keys = list(index.keys)
    q = materialise(queries.where(F.col(query_vec_col).isNotNull())
                    .select(F.col(query_id_col).alias("_qid"), F.col(query_vec_col).cast("array<double>").alias("_qv")), "dense-queries")
    n = q.count()
    rows = sum(index.rows.values())
    if not n or not rows:
        schema = T.StructType([T.StructField("query_id", q.schema["_qid"].dataType)] + [index.vectors.schema[c] for c in keys]
                              + [T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
        return CellHits(q.sparkSession.createDataFrame([], schema), 0, 0)
    groups = -(-n // block)
    start = materialise(_pairs(index, q, k, rest=False), "first-cells")
    found = materialise(topk(_scored(index, start, groups, k), k, keys), "first-hits")
    reached = found.where(F.col("rank") == k).select(F.col("query_id").alias("_id"), F.col("score").alias("threshold"))
    known = q.join(reached, q["_qid"].eqNullSafe(reached["_id"]), "left").select("_qid", "_qv", "threshold", F.col("threshold").isNull().alias("none"))
    left = materialise(_pairs(index, known, k, rest=True), "cells-left")
    more = topk(_scored(index, left, groups, k), k, keys)
    hits = topk(found.drop("rank").unionByName(more.drop("rank")), k, keys)
    read = start.select("cells").unionAll(left.select("cells")).select(F.explode("cells").alias("cell")).join(index.sizes(), "cell").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    return CellHits(hits, n * rows, read)
