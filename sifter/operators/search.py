"""Passage search: lexical TF-IDF weights, sparse and dense cosine scoring,
top-k per query, hit text, de-duplication and best match.

Scale notes
-----------
* The TF-IDF postings are bucketed by passage key. ``sparse_topk`` turns those
  of the query terms into a row a passage, without a shuffle, and scores them in
  arrays against all queries; few rows leave a task, and top-k runs a partial
  ``WindowGroupLimit`` before the only exchange. ``sparse_scores`` gives every
  pair that shares a term, also without a shuffle of the pairs.
* Dense scoring broadcasts a size-checked block of query vectors and scores
  each corpus batch with matrix products, keeping each query's best k rows,
  so no all-pairs rows are produced. Query sets above the bound meet the
  corpus in a grid of blocks, from one scan of each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WHITESPACE_CHARS, WS_CLASS, re2_class
from ..functions.vectors import SCORE_DIGITS, round_score
from ..session import (DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, bounded_broadcast, materialise,
                       materialise_bucketed, open_bucketed, row_count_at_most)

DEFAULT_K = 5
# Most query vectors broadcast to the dense scorer in one block.
MAX_QUERY_BLOCK = 4096
# Corpus vectors in one cell when the queries exceed a block.
CORPUS_BLOCK = 16_384
# Most query terms pushed to the scan of the postings.
MAX_PUSHED_TERMS = 64
# Vectors in one row where every pair is scored and the queries exceed a block.
PACK = 512
# Corpus vectors that meet the queries before the next ones do where every pair is
# returned: a query's id runs over them, their ids come again with each query, and
# so a writer of columns takes next to nothing for both.
PAIR_TILE = 256
# Text of the passages that are weighted at once.
CHUNK_BYTES = 8 << 20
# Most queries scored at once against a batch of passages.
QUERY_COLUMNS = 256
# Most scores held at once by a scoring task.
PAIRS_AT_ONCE = 1_000_000


# ---------------------------------------------------------------------------
# V9
# ---------------------------------------------------------------------------
def validate_passages(df: DataFrame, text_col: str = "passage") -> DataFrame:
    """The corpus must be a frame with a string passage column."""
    if not isinstance(df, DataFrame):
        raise TypeError("Corpus is not a DataFrame of passages")
    if text_col not in df.columns or not isinstance(df.schema[text_col].dataType, T.StringType):
        raise TypeError(f"Corpus column {text_col!r} is not a string column of passages")
    return df


# ---------------------------------------------------------------------------
# TF-IDF weights
# ---------------------------------------------------------------------------
def term_tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens, empty ones dropped."""
    return F.array_remove(F.split(F.lower(text), WS_CLASS, -1), "")


def idf(df_col: Column, n_docs: int) -> Column:
    """``ln((n + 1) / (df + 1))``."""
    return F.log((F.lit(float(n_docs)) + 1.0) / (df_col + 1.0))


def term_frequencies(df: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """``(keys..., term, tf)``: explode and group; the partial aggregate
    collapses each passage's tokens map-side, so the exchange carries one
    row per (passage, term)."""
    toks = df.select(*keys, F.explode(term_tokens(F.col(text_col))).alias("term"))
    return toks.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass
class TfidfIndex:
    """Postings ``(keys..., term, weight, nweight)`` with ``nweight`` the weight
    divided by the passage norm; ``doc_freq`` is ``(term, df)``."""

    postings: DataFrame
    doc_freq: DataFrame
    n_docs: int
    keys: tuple[str, ...]

    def save(self, path: str) -> None:
        """Write the index below ``path``, a folder that later applications
        reach too; ``load`` opens it again."""
        base, spark = path.rstrip("/"), self.postings.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.doc_freq.write.mode("overwrite").parquet(f"{base}/doc_freq")
        materialise_bucketed(self.postings, self.keys, buckets, "postings", sort="term", path=f"{base}/postings")
        # last: a folder without it is not a whole index
        spark.range(1).select(F.lit(self.n_docs).cast("bigint").alias("n_docs"), F.lit(buckets).alias("buckets"),
                              F.array(*map(F.lit, self.keys)).alias("keys")).write.mode("overwrite").parquet(f"{base}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TfidfIndex:
        """The index that ``save`` wrote, in this or another application."""
        base = path.rstrip("/")
        about = spark.read.parquet(f"{base}/about").first()
        keys = tuple(about["keys"])
        return cls(open_bucketed(spark, f"{base}/postings", keys, about["buckets"], "term", "postings"),
                   spark.read.parquet(f"{base}/doc_freq"), about["n_docs"], keys)

    def query_weights(self, queries: DataFrame, id_col: str = "query_id", text_col: str = "query",
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, small: bool | None = None) -> DataFrame:
        """``(query_id, term, qweight, nqweight)`` using corpus document
        frequencies; terms absent from the corpus count with ``df = 0``."""
        qtf = term_frequencies(queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("_q")),
                               ["query_id"], "_q")
        wanted = qtf.select("term").distinct()
        if small is None:
            small = row_count_at_most(wanted, max_broadcast_rows)
        # the corpus frequencies of the query terms: at most |wanted| rows
        df_q = self.doc_freq.join(F.broadcast(wanted) if small else wanted, "term", "left_semi")
        w = qtf.join(F.broadcast(df_q) if small else df_q, "term", "left").select(
            "query_id", "term",
            (F.col("tf") * idf(F.coalesce(F.col("df"), F.lit(0)), self.n_docs)).alias("qweight"),
        )
        qn = Window.partitionBy("query_id")
        return (w.withColumn("_qnorm", F.sqrt(F.sum(F.col("qweight") * F.col("qweight")).over(qn)))
                .filter(F.col("_qnorm") > 0)
                .select("query_id", "term", "qweight", (F.col("qweight") / F.col("_qnorm")).alias("nqweight")))


def tfidf_index(passages: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"), text_col: str = "passage",
                n_docs: int | None = None, checkpoint: bool = True) -> TfidfIndex:
    """Weight ``tf * ln((n + 1) / (df + 1))`` over lower-cased whitespace
    tokens; zero weights are dropped and zero-norm passages vanish.

    Passages are dealt by their key into chunks of about ``CHUNK_BYTES`` of
    text. Only texts and each chunk's distinct terms move: the terms are summed
    to the document frequencies and joined with them, and the frequencies meet
    their chunk again, where tokens are counted, weighted and normed as arrays.
    So no row a token is shuffled or sorted on the way. With ``checkpoint`` (default) ``doc_freq`` and
    the postings are written as Parquet under the session's checkpoint
    folder, so later query batches reuse them (lineage cut, survives executor
    loss); pass materialised passages for the same reason."""
    keys = tuple(keys)
    validate_passages(passages, text_col)
    words = F.lower(text_col).alias("_words")
    size = passages.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()
    n_docs = size["n"] if n_docs is None else n_docs
    # a chunk lies in one bucket of the postings: its number is that of the
    # bucket, modulo the number of buckets; a bucket has a power of two of them,
    # as it has of the blocks of ``bounded``, so that a block lies in one chunk
    buckets = int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.pmod(F.hash(*keys), F.lit(buckets << (max(1, -(-size["b"] // (CHUNK_BYTES * buckets))) - 1).bit_length())).alias("_chunk")
    vocabulary = passages.select(chunk, words).groupBy("_chunk").applyInArrow(_chunk_vocabulary, "_chunk int, term string, n bigint")
    if checkpoint:
        vocabulary = materialise(vocabulary, "chunk_terms")
    doc_freq = vocabulary.groupBy("term").agg(F.sum("n").alias("df"))
    if checkpoint:
        doc_freq = materialise(doc_freq, "doc_freq")
    weights = vocabulary.join(doc_freq, "term").select("_chunk", "term", idf(F.col("df"), n_docs).alias("idf"))
    # rows that repeat a key are one passage
    whole = passages.select(*keys, words).groupBy(*keys).agg(F.concat_ws(" ", F.collect_list("_words")).alias("_words"))
    schema = T.StructType([passages.schema[c] for c in keys] + [T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType()),
                                                                T.StructField("nweight", T.DoubleType())])
    postings = whole.select(*keys, "_words", chunk).groupBy("_chunk").cogroup(weights.groupBy("_chunk")).applyInArrow(_chunk_postings(keys), schema)
    if checkpoint:
        # bucketed on the whole passage key: scoring sums per (query, passage)
        # inside each bucket, so candidate pairs are never shuffled, and one
        # very large document still spreads over all buckets
        postings = materialise_bucketed(postings, keys, name="postings", clustered=True, sort="term")
    return TfidfIndex(postings=postings, doc_freq=doc_freq, n_docs=n_docs, keys=keys)


#: Whitespace but the blank.
_OTHER_WS = re2_class(WHITESPACE_CHARS.replace(" ", ""))


def _coded_terms(words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The row and the term number of every token (as ``term_tokens`` cuts them)
    of lower-cased texts, and the distinct terms in byte order."""
    words = pa.chunked_array([c.cast(pa.large_string()) for c in words.chunks], pa.large_string()).combine_chunks()
    odd = pc.match_substring_regex(words, _OTHER_WS)
    if pc.any(odd).as_py():
        words = pc.if_else(odd, pc.replace_substring_regex(words, _OTHER_WS, " "), words)
    cut = pc.split_pattern(words, " ")
    rows, flat = pc.list_parent_indices(cut).to_numpy(), cut.flatten()
    told = pc.not_equal(flat, "")
    coded = flat.filter(told).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rows[told.to_numpy(zero_copy_only=False)], rank[coded.indices.to_numpy()], coded.dictionary.take(order).cast(pa.string())


def _chunk_vocabulary(texts: pa.Table) -> pa.Table:
    """``(_chunk, term, n)``: the distinct terms of a chunk and how many of its
    rows hold each."""
    rows, codes, terms = _coded_terms(texts["_words"])
    codes = np.unique(codes * max(1, len(texts)) + rows, return_index=True)[0] // max(1, len(texts))  # by sorting: much faster than without the index
    n = np.bincount(codes, minlength=len(terms)).astype(np.int64)
    return pa.table({"_chunk": pa.array(np.full(len(terms), texts["_chunk"][0].as_py(), np.int32)), "term": terms, "n": n})


def _chunk_postings(keys: Sequence[str]):
    """``(keys..., term, weight, nweight)`` of a chunk of passages, in term
    order, from their tokens and the ``(term, idf)`` of the chunk."""
    def run(texts: pa.Table, weights: pa.Table) -> pa.Table:
        rows, codes, terms = _coded_terms(texts["_words"])
        pairs, tf = np.unique(codes * max(1, len(texts)) + rows, return_counts=True)
        codes, rows = pairs // max(1, len(texts)), pairs % max(1, len(texts))
        at = pc.index_in(terms, value_set=weights["term"].combine_chunks())
        of_term = weights["idf"].combine_chunks().take(at).to_numpy(zero_copy_only=False)
        weight = tf * of_term[codes]
        keep = weight > 0
        codes, rows, weight = codes[keep], rows[keep], weight[keep]
        norm = np.sqrt(np.bincount(rows, weights=weight * weight, minlength=len(texts)))
        return pa.table({**{c: texts[c].take(rows) for c in keys}, "term": terms.take(codes), "weight": weight, "nweight": weight / norm[rows]})

    return run


# ---------------------------------------------------------------------------
# V2: cosine scoring
# ---------------------------------------------------------------------------
def query_terms_at_most(queries: DataFrame, text_col: str = "query", bound: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when the queries have at most ``bound`` tokens in all; this bounds
    the query-weight rows and is counted on the query table alone."""
    return row_count_at_most(queries.select(F.explode(term_tokens(F.col(text_col)))), bound)


def few_query_terms(queries: DataFrame, text_col: str = "query") -> list[str] | None:
    """The distinct terms of a small query batch; none if they are more than
    ``MAX_PUSHED_TERMS``."""
    terms = queries.select(F.explode(term_tokens(F.col(text_col))).alias("t")).distinct().limit(MAX_PUSHED_TERMS + 1)
    got = [r["t"] for r in terms.collect()]
    return got if len(got) <= MAX_PUSHED_TERMS else None


def query_batch_size(queries: DataFrame, text_col: str = "query") -> tuple[int, int, bool]:
    """``(queries, tokens, small)`` of a query batch in one pass over it. The
    token total bounds the distinct query terms and the query-weight rows, the
    text their bytes, and the query count the hits (k per query); ``small`` says
    that the weights can be broadcast."""
    row = queries.agg(F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum(F.size(term_tokens(F.col(text_col)))), F.lit(0)).alias("t"),
                      F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()
    return row["n"], row["t"], row["t"] <= DEFAULT_BROADCAST_ROWS and row["b"] <= DEFAULT_BROADCAST_BYTES


def _any_of(conditions: list[Column]) -> Column:
    """``OR`` as a balanced tree. (An ``IN`` of more than ten values reaches
    Parquet only as its least and greatest value.)"""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any_of(conditions[:half]) | _any_of(conditions[half:])


def sparse_scores(index: TfidfIndex, query_weights: DataFrame, queries_small: bool | None = None,
                  query_terms: Sequence[str] | None = None) -> DataFrame:
    """``(query_id, keys..., score)`` for every passage sharing a weighted
    term with the query (exact cosine; other passages score 0).

    The query weights are broadcast when ``queries_small`` (see
    ``query_terms_at_most``); ``None`` counts them here, which runs the
    query weighting once more. Beyond the bound the join shuffles on term.
    ``query_terms``, if the caller holds them, are pushed to the scan when they
    are few: the postings of a bucket are in term order, so only the Parquet
    pages that hold these terms are read. The rows are the same without."""
    qw = query_weights.select("query_id", "term", "nqweight")
    if queries_small is None:
        queries_small = row_count_at_most(qw, DEFAULT_BROADCAST_ROWS)
    postings = index.postings.select(*index.keys, "term", "nweight")
    if query_terms is not None and 0 < len(query_terms) <= MAX_PUSHED_TERMS:
        postings = postings.filter(_any_of([F.col("term") == F.lit(t) for t in sorted(set(query_terms))]))
    qw = F.broadcast(qw) if queries_small else qw
    joined = postings.join(qw, "term")
    return joined.groupBy("query_id", *index.keys).agg(
        F.sum(F.col("nqweight") * F.col("nweight")).alias("score"))


def _best(q: np.ndarray, r: np.ndarray, keys: pa.Table, k: int) -> np.ndarray:
    """Places of each query's best ``k`` of the scored rows, as ``topk`` orders
    them; all of them where the keys are of a type that Arrow doesn't sort."""
    try:
        by = pa.table({"_q": q, "_r": -r, **{f"_{i}": keys.column(i) for i in range(keys.num_columns)}})
        order = pc.sort_indices(by, sort_keys=[(c, "ascending") for c in by.column_names], null_placement="at_start").to_numpy()
    except (pa.ArrowNotImplementedError, pa.ArrowInvalid, pa.ArrowTypeError):
        return np.arange(len(q))
    q = q[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return order[nth < k]


@dataclass
class QueryBlocks:
    """Weights of at most ``MAX_QUERY_BLOCK`` queries for the tasks: the query
    ids, the terms, and in ``shared`` the ids and the blocks of queries."""

    ids: pa.Array
    terms: pa.Array
    shared: Broadcast

    def numbered(self, postings: DataFrame, by: Sequence[str], value: str, query_terms: Sequence[str] | None = None) -> DataFrame:
        """``(by..., _p)``: the numbers of the query terms and the ``value`` of
        the postings that ``by`` has, one row for each ``by``."""
        terms = F.broadcast(postings.sparkSession.createDataFrame(list(enumerate(self.terms.to_pylist())), "_no int, term string"))
        postings = postings.select(*by, "term", F.col(value).alias("nweight"))
        if query_terms is not None and 0 < len(query_terms) <= MAX_PUSHED_TERMS:
            postings = postings.filter(_any_of([F.col("term") == F.lit(t) for t in sorted(set(query_terms))]))
        return postings.join(terms, "term").groupBy(*by).agg(F.collect_list(F.struct("_no", "nweight")).alias("_p"))

    def scorer(self, keys: Sequence[str], k: int, mask_col: str | None = None):
        """A map function over ``numbered`` rows: ``(query_id, keys..., score)``
        of the rows that can be among each query's best ``k`` of the task.
        ``mask_col`` has a bit for each query that may take the row."""
        shared, keys = self.shared, list(keys)

        def score(batches):
            dictionary, blocks = shared.value
            least = [np.full((k, m.shape[1]), -np.inf) for _, _, m in blocks]  # each query's best k scores so far
            for batch in batches:
                held = pa.Table.from_batches([batch.select(keys)])
                allowed = None if mask_col is None else _bits(batch.column(mask_col))
                for b, lo, at, s in _scored_rows(batch.column("_p"), blocks):
                    rounded = np.where(s > 0, np.floor(s * 10.0 ** SCORE_DIGITS + 0.5), -np.inf)
                    if allowed is not None:
                        rounded[np.unpackbits(allowed[at], axis=1)[:, lo:lo + s.shape[1]] == 0] = -np.inf
                    seen = np.concatenate([least[b], rounded])
                    least[b] = np.partition(seen, len(seen) - k, axis=0)[len(seen) - k:]
                    p, q = np.nonzero((rounded >= least[b].min(axis=0)) & (rounded > -np.inf))
                    if len(p):
                        of = held.take(at[p])
                        best = _best(q, rounded[p, q], of, k)
                        out = {"query_id": dictionary.take(pa.array(q[best] + lo)), **{c: of[c].take(best).combine_chunks() for c in keys},
                               "score": s[p, q][best]}
                        yield from pa.table(out).to_batches()

        return score


def query_blocks(weights: DataFrame, queries_small: bool | None = None) -> QueryBlocks | None:
    """``(query_id, term, nqweight)`` as blocks of queries; none if they are too
    large to be broadcast, or empty."""
    if queries_small is None:
        queries_small = row_count_at_most(weights, DEFAULT_BROADCAST_ROWS)
    got = weights.toArrow() if queries_small else None
    ids = got["query_id"].combine_chunks().dictionary_encode(null_encoding="encode") if queries_small and len(got) else None
    if ids is None or len(ids.dictionary) > MAX_QUERY_BLOCK:
        return None
    terms = got["term"].combine_chunks().dictionary_encode()
    query, term, weight = ids.indices.to_numpy(), terms.indices.to_numpy(), got["nqweight"].to_numpy()
    blocks = []  # the queries, the numbers of their terms in the block and their weights, a column a query
    step = max(1, min(QUERY_COLUMNS, PAIRS_AT_ONCE // max(1, int(np.bincount(query).max()))))
    for lo in range(0, len(ids.dictionary), step):
        at = (query >= lo) & (query < lo + step)
        used, row = np.unique(term[at], return_inverse=True)
        number = np.full(len(terms.dictionary), -1)
        number[used] = np.arange(len(used))
        matrix = np.zeros((len(used), min(step, len(ids.dictionary) - lo)))
        matrix[row, query[at] - lo] = weight[at]
        blocks.append((lo, number, matrix))
    return QueryBlocks(ids.dictionary, terms.dictionary, weights.sparkSession.sparkContext.broadcast((ids.dictionary, blocks)))


def _bits(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of bytes."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return flat.reshape(len(column), -1)


def _scored_rows(lists: pa.Array, blocks: list):
    """``(block, first query, rows, scores)`` of lists of term numbers and
    weights, a bounded number of scores at a time; rows that share no term with
    the block's queries are left out."""
    flat = lists.flatten()
    row, no, w = pc.list_parent_indices(lists).to_numpy(), flat.field("_no").to_numpy(), flat.field("nweight").to_numpy()
    for b, (lo, number, matrix) in enumerate(blocks):
        there = np.flatnonzero(number[no] >= 0)
        step = max(1, PAIRS_AT_ONCE // matrix.shape[1])
        first = 0
        while first < len(there):
            # whole rows, as many as fit
            last = len(there) if first + step >= len(there) else int(np.searchsorted(row[there], row[there[first + step]]))
            if last <= first:
                last = int(np.searchsorted(row[there], row[there[first]], side="right"))
            at, first = there[first:last], last
            starts = np.flatnonzero(np.r_[True, row[at][1:] != row[at][:-1]])
            part = matrix[number[no[at]]]
            part *= w[at][:, None]
            yield b, lo, row[at][starts], np.add.reduceat(part, starts, axis=0)


def sparse_topk(index: TfidfIndex, query_weights: DataFrame, k: int = DEFAULT_K, queries_small: bool | None = None,
                query_terms: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``topk(sparse_scores(...), k)``, without a row a (query,
    passage) pair.

    Small query weights are broadcast. A bucket's postings of their terms become
    one row a passage, without a shuffle; a batch of passages is scored against
    all queries by array sums, a bounded number of scores at a time, and only
    rows leave that can be among the best ``k`` of their task. More queries than
    ``MAX_QUERY_BLOCK``, or larger weights, take the join."""
    keys = list(index.keys)
    weights = query_weights.select("query_id", "term", "nqweight")
    blocks = query_blocks(weights, queries_small)
    if blocks is None:
        return topk(sparse_scores(index, query_weights, queries_small, query_terms), k, keys)
    passages = blocks.numbered(index.postings, keys, "nweight", query_terms)
    schema = T.StructType([T.StructField("query_id", weights.schema["query_id"].dataType)] + [index.postings.schema[c] for c in keys]
                          + [T.StructField("score", T.DoubleType())])

    return topk(passages.mapInArrow(blocks.scorer(keys, k), schema), k, keys)


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows of length one; a zero vector stays zero."""
    m = np.vstack(vectors.to_numpy()).astype(np.float64)
    norm = np.linalg.norm(m, axis=1)
    return m / np.where(norm == 0, 1.0, norm)[:, None]


def _unit_lists(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """``_unit_rows`` of a list array without nulls."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = np.unique(pc.list_value_length(vectors).to_numpy())
    if len(n) > 1:
        raise ValueError("vectors of different lengths")
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), int(n[0]) if len(n) else 0)
    norm = np.linalg.norm(m, axis=1)
    return m / np.where(norm == 0, 1.0, norm)[:, None]


def _scored_vectors(q_ids: pa.Array, q_mat: np.ndarray, keys: pa.Table, c_mat: np.ndarray, k: int | None = None, least: np.ndarray | None = None):
    """Batches ``(query_id, keys..., score)`` of all query rows against all
    corpus rows, a bounded number of pairs at a time. With ``k`` only rows that
    can be among each query's best ``k``, whose rounded scores so far ``least``
    keeps; rows equal in score are cut by key, as ``topk`` orders them. A score
    that is no number is null, and no row with ``k``."""
    n = len(c_mat)
    if k is None and n > PAIR_TILE:
        for at in range(0, n, PAIR_TILE):
            yield from _scored_vectors(q_ids, q_mat, keys.slice(at, PAIR_TILE), c_mat[at:at + PAIR_TILE])
        return
    step = max(1, PAIRS_AT_ONCE // max(1, n))
    for lo in range(0, len(q_mat), step):
        s = q_mat[lo:lo + step] @ c_mat.T
        if k is None:
            q, p = np.repeat(np.arange(len(s)), n), np.tile(np.arange(n), len(s))
        else:
            rounded = np.floor(s * 10.0 ** SCORE_DIGITS + 0.5)
            rounded[np.isnan(rounded)] = -np.inf  # no score: takes no hit's place
            own = least[lo:lo + step]  # a view
            better = np.flatnonzero((rounded > own.min(axis=1)[:, None]).any(axis=1))
            if len(better):
                seen = np.concatenate([own[better], rounded[better]], axis=1)
                own[better] = np.partition(seen, n, axis=1)[:, n:]
            q, p = np.nonzero((rounded >= own.min(axis=1)[:, None]) & (rounded > -np.inf))
            if not len(q):
                continue
            best = _best(q, rounded[q, p], keys.take(p), k)
            q, p = q[best], p[best]
        of = keys.take(p)
        yield from pa.table({"query_id": q_ids.take(pa.array(q + lo)), **{c: of[c].combine_chunks() for c in keys.column_names},
                             "score": pa.array(s[q, p], from_pandas=True)}).to_batches()  # no number: null


def _score_block(q_ids, q_mat: np.ndarray, keys: pd.DataFrame, c_mat: np.ndarray, k: int | None):
    """Frames of scores of all query rows against all corpus rows, a bounded
    number of pairs at a time. With ``k`` only each query's best ``k`` rows by
    rounded score, then key, as ``topk`` orders them."""
    by_key = None
    if k is not None and len(keys) > k:
        order = keys.reset_index(drop=True).sort_values(list(keys.columns), na_position="first", kind="stable").index
        by_key = np.empty(len(keys), dtype=np.int64)
        by_key[order.to_numpy()] = np.arange(len(keys))
    step = max(1, PAIRS_AT_ONCE // max(1, len(keys)))
    for lo in range(0, len(q_mat), step):
        s = q_mat[lo:lo + step] @ c_mat.T
        if by_key is None:
            rows = [np.arange(len(keys))] * len(s)
        else:
            rounded = np.floor(s * 10.0 ** SCORE_DIGITS + 0.5)
            rounded[np.isnan(rounded)] = np.inf  # Spark orders NaN above every number
            rows = []
            for r in rounded:
                cand = np.nonzero(r >= np.partition(r, len(r) - k)[len(r) - k])[0]
                rows.append(cand[np.lexsort((by_key[cand], -r[cand]))[:k]])
        pick = np.concatenate(rows)
        which = np.repeat(np.arange(len(s)), [len(r) for r in rows])
        out = {"query_id": q_ids[lo:lo + step][which]}
        out.update({c: keys[c].to_numpy()[pick] for c in keys.columns})
        out["score"] = s[which, pick]
        yield pd.DataFrame(out)


def _dealt(n: int) -> Column:
    return F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")


def _packed(df: DataFrame, name: str, size: int) -> DataFrame:
    """The rows of a written table, about ``size`` of them in one, as ``name``."""
    n = max(1, -(-df.count() // size))
    files = min(n, 4 * df.sparkSession.sparkContext.defaultParallelism)
    rows = df.withColumn("_b", _dealt(n)).repartition(files, "_b").groupBy("_b").agg(F.collect_list(F.struct(*df.columns)).alias(name))
    return materialise(rows.select(name), "dense-packed")


def dense_scores(corpus: DataFrame, queries: DataFrame, k: int | None = None,
                 key_col: str | Sequence[str] = "vec_id", vec_col: str = "embedding", query_id_col: str = "vec_id",
                 query_vec_col: str = "embedding", block: int | None = None,
                 corpus_block: int = CORPUS_BLOCK) -> DataFrame:
    """Exact cosine of every query against every corpus vector (0 if either is
    a zero vector; a null vector has no score).

    ``key_col`` names the corpus key: one or more columns of any type, as is
    the query id (a file path, say); queries that share an id are all scored.
    ``k=None`` returns every ``(query_id, keys..., score)``; with ``k`` each
    task returns only rows that can be among its best k per query, and ``topk``
    makes the final cut.

    Up to ``block`` queries (with ``k=None`` any number), and 64 MB of them, are
    broadcast and the corpus is scanned once without a shuffle. A larger query
    set is never collected. With ``k`` queries and corpus are cut into blocks of
    bounded size, and one grouped job scores every (query block, corpus block)
    cell, also from a single scan of each. Without, both are packed, some hundred
    vectors a row, and the packed rows meet in a cross join: no vector is
    copied to a cell, and scores leave the task as they are made."""
    spark = corpus.sparkSession
    key_cols = [key_col] if isinstance(key_col, str) else list(key_col)
    out_schema = T.StructType([T.StructField("query_id", queries.schema[query_id_col].dataType)]
                              + [T.StructField(c, corpus.schema[c].dataType) for c in key_cols]
                              + [T.StructField("score", T.DoubleType())])
    c = corpus.filter(F.col(vec_col).isNotNull()).select(*key_cols, F.col(vec_col).alias("_vec"))
    q = queries.filter(F.col(query_vec_col).isNotNull()).select(
        F.col(query_id_col).alias("_qid"), F.col(query_vec_col).cast("array<double>").alias("_qv"))
    widest = q.agg(F.max(F.size("_qv"))).first()[0] or 1
    most = DEFAULT_BROADCAST_BYTES // (8 * widest)
    block = max(1, min(block or (most if k is None else MAX_QUERY_BLOCK), most))  # by bytes too
    head = q.limit(block + 1).toArrow()
    if not len(head):
        return spark.createDataFrame([], out_schema)
    if len(head) <= block:
        bq = spark.sparkContext.broadcast((head["_qid"].combine_chunks(), _unit_lists(head["_qv"])))

        def score_part(batches):
            q_ids, q_mat = bq.value
            least = None if k is None else np.full((len(q_mat), k), -np.inf)
            for batch in batches:
                if batch.num_rows:
                    yield from _scored_vectors(q_ids, q_mat, pa.Table.from_batches([batch.select(key_cols)]), _unit_lists(batch.column("_vec")), k, least)

        return c.mapInArrow(score_part, out_schema)

    q, c = materialise(q, "dense-queries"), materialise(c, "dense-corpus")
    if k is None:
        def score_rows(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    qs, cs = (pa.Table.from_batches([pa.RecordBatch.from_struct_array(batch.column(x).slice(i, 1).flatten())]) for x in ("_q", "_c"))
                    yield from _scored_vectors(qs["_qid"].combine_chunks(), _unit_lists(qs["_qv"]), cs.select(key_cols), _unit_lists(cs["_vec"]))

        left = _packed(c, "_c", min(corpus_block, PACK))
        return left.hint("shuffle_replicate_nl").crossJoin(_packed(q, "_q", min(block, PACK))).mapInArrow(score_rows, out_schema)

    n_q, n_c = -(-q.count() // block), max(1, -(-c.count() // corpus_block))
    # dealt by position, so repeated ids or vectors do not pile up in a block; of
    # written tables, so that a task that runs again deals the same
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("_qb", _dealt(n_q)).select("*", every(n_c).alias("_cb"))
    c = c.withColumn("_cb", _dealt(n_c)).select("*", every(n_q).alias("_qb"))

    def score_cell(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or cs.empty:
            return pd.DataFrame({f.name: [] for f in out_schema})
        return pd.concat(_score_block(qs["_qid"].to_numpy(), _unit_rows(qs["_qv"]), cs[key_cols],
                                      _unit_rows(cs["_vec"]), k), ignore_index=True)

    return q.groupBy("_qb", "_cb").cogroup(c.groupBy("_qb", "_cb")).applyInPandas(score_cell, out_schema)


# ---------------------------------------------------------------------------
# V3, V5: top-k
# ---------------------------------------------------------------------------
def topk(scores: DataFrame, k: int = DEFAULT_K, keys: Sequence[str] = ("doc_id", "line_no"),
         group: str | None = "query_id") -> DataFrame:
    """Rows ranked by rounded score descending, then key; ``rank`` from 1.
    The score column is rounded. Fewer than k candidates give fewer rows.

    ``row_number() <= k`` plans a partial ``WindowGroupLimit`` before the
    exchange, so each partition sends at most k rows per query."""
    scored = scores.withColumn("score", round_score(F.col("score"))).filter(F.col("score").isNotNull())
    order = [F.col("score").desc()] + [F.col(c).asc() for c in keys]
    if group is None:
        # single query: TakeOrderedAndProject
        ranked = scored.orderBy(*order).limit(k)
        return ranked.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(group).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------------------
# V4, V6, V7
# ---------------------------------------------------------------------------
def attach_passages(hits: DataFrame, passages: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"),
                    text_col: str = "passage", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    hits_small: bool | None = None) -> DataFrame:
    """Join hits to their passage text on the passage key; the hits (k per
    query) are the broadcast side when they fit the bound. ``hits_small``
    passes a bound the caller already knows (queries x k), which spares
    counting the hits (a second run of the whole search)."""
    if hits_small is None:
        small = bounded_broadcast(hits, max_broadcast_rows)
    else:
        small = F.broadcast(hits) if hits_small else hits
    return passages.select(*keys, F.col(text_col).alias("corpus_passage")).join(small, list(keys))


def dedupe_hits(hits: DataFrame, text_col: str = "corpus_passage", group: str = "query_id") -> DataFrame:
    """Drop duplicate ``(query, passage, score)`` rows after top-k, so fewer
    than k rows may remain. The rank column cannot survive this."""
    return hits.select(group, text_col, "score").distinct()


def best_match(hits: DataFrame, text_col: str = "corpus_passage", group: str = "query_id") -> DataFrame:
    """The first hit of each query, ``(query_id, best_match, score)``."""
    return hits.filter(F.col("rank") == 1).select(group, F.col(text_col).alias("best_match"), "score")


def search_passages(passages: DataFrame, queries: DataFrame, k: int = DEFAULT_K,
                    keys: Sequence[str] = ("doc_id", "line_no"), text_col: str = "passage",
                    query_id_col: str = "query_id", query_text_col: str = "query",
                    index: TfidfIndex | None = None) -> tuple[DataFrame, TfidfIndex]:
    """Lexical search of many queries at once: top-k hits with passage text,
    ``(query_id, rank, keys..., corpus_passage, score)``."""
    index = index or tfidf_index(passages, keys, text_col)
    n_queries, n_tokens, small = query_batch_size(queries, query_text_col)
    qw = index.query_weights(queries, query_id_col, query_text_col, small=small)
    # a batch of few tokens may read few pages of the postings
    terms = few_query_terms(queries, query_text_col) if n_tokens <= 16 * MAX_PUSHED_TERMS else None
    hits = sparse_topk(index, qw, k, small, terms)
    # at most k hits per query: the query count bounds the hit count
    hits_small = n_queries <= max(1, DEFAULT_BROADCAST_ROWS // max(k, 1))
    return attach_passages(hits, passages, keys, text_col, hits_small=hits_small), index
