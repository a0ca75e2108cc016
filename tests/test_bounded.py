"""Bounded top-k against scoring every candidate."""

import random

import pytest
from pyspark.sql import functions as F

from sifter.operators import bounded, search
from sifter.sources import fixtures as fx


def same_rows(spark, passages, queries, k, size, first):
    index = search.tfidf_index(passages)
    weights = index.query_weights(queries)
    columns = ["query_id", "rank", "doc_id", "line_no", "score"]
    want = search.topk(search.sparse_scores(index, weights), k).select(columns).collect()
    got = bounded.bounded_topk(bounded.block_index(index, size), weights, k, first)
    assert sorted(map(tuple, got.hits.select(columns).collect())) == sorted(map(tuple, want))
    return got


def test_equal_rows_from_fewer_blocks(spark, small_dir):
    from sifter.session import materialise

    passages = materialise(fx.passages(fx.table(spark, small_dir, "documents")))
    queries = fx.table(spark, small_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    got = same_rows(spark, passages, queries, 5, 4, 4)
    assert got.pairs_read < 0.7 * got.pairs


@pytest.mark.parametrize("k,size,first", [(1, 1, 1), (3, 4, 1), (50, 8, 2)])
def test_ties_repeats_and_large_k(spark, k, size, first):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(40)]
    rows = [(d, n, rng.choice(texts)) for d in range(30) for n in range(4)] + [(99, 0, "alone"), (98, 0, "")]
    passages = spark.createDataFrame(rows, "doc_id long, line_no long, passage string").repartition(3)
    queries = spark.createDataFrame([(i, rng.choice(texts)) for i in range(12)] + [(50, "alone"), (51, "unknown words"), (52, ""), (53, "w0 alone")],
                                    "query_id long, query string")
    same_rows(spark, passages, queries, k, size, first)


def test_empty_sides(spark):
    passages = spark.createDataFrame([(1, 0, "a b"), (2, 0, "c")], "doc_id long, line_no long, passage string")
    queries = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert same_rows(spark, passages, queries.limit(0), 2, 1, 1).pairs == 0
    assert same_rows(spark, passages.limit(0), queries, 2, 1, 1).pairs == 0


@pytest.mark.parametrize("queries_at_once", [4096, 3])
def test_no_row_a_query_and_block(spark, monkeypatch, queries_at_once):
    """the bounds of the blocks are no table of (query, block) rows; more
    queries than are broadcast take the joins and give the same rows."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    passages = spark.createDataFrame([(d, 0, " ".join(rng.choices(words, k=5))) for d in range(300)], "doc_id long, line_no long, passage string").repartition(3)
    queries = spark.createDataFrame([(i, " ".join(rng.choices(words, k=6))) for i in range(20)], "query_id long, query string")
    written, plain = {}, bounded.materialise

    def noted(df, name="table"):
        out = plain(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(bounded, "materialise", noted)
    monkeypatch.setattr(search, "MAX_QUERY_BLOCK", queries_at_once)
    got = same_rows(spark, passages, queries, 2, 4, 2)
    assert 0 < got.pairs_read <= got.pairs
    if queries_at_once == 4096:
        assert written["blocks-left"] <= 80 and written["first-blocks"] <= 40 and "block-bounds" not in written and got.pairs > 600


@pytest.mark.parametrize("queries_at_once", [4096, 3])
def test_postings_are_neither_moved_nor_copied(spark, monkeypatch, queries_at_once):
    """the index of blocks writes its greatest weights alone and shuffles no
    posting, nor does a batch of queries; each (block, term) has one row, and none
    too small a weight."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    rows = [(d, n, " ".join(rng.choices(words, k=5))) for d in range(200) for n in range(3)] + [(None, 1, "w1 w2"), (None, 1, "w3"), (7, None, "w1")]
    index = search.tfidf_index(spark.createDataFrame(rows, "doc_id long, line_no long, passage string").repartition(3))
    written, plain = [], bounded.materialise_bucketed

    def noted(df, *args, **named):
        written.append((df._jdf.queryExecution().executedPlan().toString(), named["name"]))
        return plain(df, *args, **named)

    monkeypatch.setattr(bounded, "materialise_bucketed", noted)
    monkeypatch.setattr(bounded, "ROWS_AT_ONCE", 7)  # rows of a term come in many batches
    blocks = bounded.block_index(index, 4)
    assert [name for _, name in written] == ["blockgreatest"] and "Exchange" not in written[0][0]
    want = {(r.block, r.term): r.top for r in blocks.postings.groupBy("block", "term").agg(F.max("nweight").alias("top")).collect()}
    got = blocks.greatest.collect()
    assert len(got) == len(want) == len({(r.block, r.term) for r in got})
    assert all(want[r.block, r.term] <= r.top <= want[r.block, r.term] * (1 + 1e-6) for r in got)
    assert len({(r.part, r.block) for r in got}) == len({r.block for r in got})
    monkeypatch.setattr(search, "MAX_QUERY_BLOCK", queries_at_once)
    queries = spark.createDataFrame([(i, " ".join(rng.choices(words, k=6))) for i in range(20)], "query_id long, query string")
    weights = index.query_weights(queries)
    columns = ["query_id", "rank", "doc_id", "line_no", "score"]
    hits = bounded.bounded_topk(blocks, weights, 2).hits.select(columns)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, hits.collect())) == sorted(map(str, search.topk(search.sparse_scores(index, weights), 2).select(columns).collect()))
    if queries_at_once == 4096:
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(query_id") == plan.count("Exchange hashpartitioning") == 1
