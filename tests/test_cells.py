"""Dense top-k from cells against scoring every vector."""

import numpy as np
import pytest

from sifter.operators import cells, search

COLUMNS = ["query_id", "rank", "vec_id", "score"]


def rows(df):
    return sorted(map(str, map(tuple, df.select(COLUMNS).collect())))


def same(spark, vectors, queries, k, monkeypatch=None, **more):
    c = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame(queries, "vec_id long, embedding array<double>")
    got = cells.bounded_dense_topk(cells.cell_index(c), q, k, **more)
    assert rows(got.hits) == rows(search.topk(search.dense_scores(c, q, k), k, ["vec_id"]))
    return got


def grouped(rng, n, dim=8, groups=12, noise=0.05):
    centre = rng.normal(size=(groups, dim))
    return (centre[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dim))).tolist()


@pytest.mark.parametrize("k,block,part", [(1, 4096, 1 << 14), (5, 7, 10), (60, 4096, 16)])
def test_equal_rows_from_fewer_vectors(spark, monkeypatch, k, block, part):
    monkeypatch.setattr(cells, "PART_ROWS", part)
    v = grouped(np.random.default_rng(k), 400)
    vectors = list(enumerate(v))
    got = same(spark, vectors, vectors[::20], k, block=block)
    assert got.pairs == 400 * 20
    if k < 60:
        assert got.pairs_read < 0.6 * got.pairs


def test_ties_zero_null_and_no_numbers(spark):
    rng = np.random.default_rng(3)
    v = [[float(x) for x in rng.integers(-1, 2, 3)] for _ in range(120)]  # many equal directions
    v[5] = v[6] = [0.0, 0.0, 0.0]
    v[7] = [float("nan"), 1.0, 0.0]
    v[8] = [float("inf"), 1.0, 0.0]
    vectors = list(enumerate(v)) + [(500, None), (3, v[3]), (3, v[4])]
    queries = [(i, v[i]) for i in (0, 5, 7, 8, 10, 11, 40)] + [(10, v[12]), (None, v[13]), (600, None), (601, [1e-200, 0.0, 0.0])]
    same(spark, vectors, queries, 4)


def test_empty_sides_and_zeros_only(spark):
    some = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    assert same(spark, some, [], 2).pairs == 0
    c = spark.createDataFrame(some, "vec_id long, embedding array<double>")
    assert cells.bounded_dense_topk(cells.cell_index(c.limit(0)), c, 2).hits.count() == 0
    same(spark, [(1, [0.0, 0.0]), (2, [0.0, 0.0])], some, 1)


def test_a_query_is_one_row_whatever_it_reads(spark, monkeypatch):
    """a query's vector is not repeated for each cell that it reads."""
    monkeypatch.setattr(cells, "ROWS_AT_ONCE", 7)
    vectors = list(enumerate(np.random.default_rng(1).normal(size=(300, 3)).tolist()))
    c = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2)
    index = cells.cell_index(c)
    q = c.selectExpr("vec_id AS _qid", "embedding AS _qv")
    first = cells._pairs(index, q, 100, rest=False)
    rest = cells._pairs(index, q.selectExpr("*", "CAST(NULL AS DOUBLE) AS threshold", "TRUE AS none"), 100, rest=True)
    assert first.count() == rest.count() == 300
    both = first.unionByName(rest).selectExpr("_qid", "explode(cells) AS cell").groupBy("_qid").count().collect()
    assert {r["count"] for r in both} == {len(index.rows)}  # all cells, each once
    same(spark, vectors, vectors[::10], 5)
