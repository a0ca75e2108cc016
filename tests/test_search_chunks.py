"""The index built by chunks of passages, and top-k without a row a pair."""

import math
from collections import Counter

from pyspark.sql import functions as F

from sifter.operators import search


def passages(spark, texts):
    return spark.createDataFrame([(k, i, t) for k, i, t in texts], "doc_id string, line_no bigint, passage string")


TEXTS = [("a", 0, "The cat\u00a0sat  on the MAT"), ("a", 1, "cat\tcat\u2003dog"), ("b", 0, "the dog"), ("b", 0, "the end"), (None, 2, "dog cat"),
         ("c", None, None), ("c", 5, ""), ("\u00e9", 7, "\u00c9t\u00e9 the"), ("d", 1, "cat dog"), ("e", 1, "cat dog"), ("f", 1, "dog cat")]


def test_weights_equal_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_BYTES", 1)  # many chunks a bucket
    index = search.tfidf_index(passages(spark, TEXTS), checkpoint=False)
    tf, df = {}, Counter()
    for doc, line, text in TEXTS:
        words = (text or "").lower().split()
        tf.setdefault((doc, line), Counter()).update(words)
        df.update(set(words))
    want = {}
    for key, words in tf.items():
        w = {t: n * math.log((len(TEXTS) + 1) / (df[t] + 1)) for t, n in words.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(*key, t): (round(x, 9), round(x / norm, 9)) for t, x in w.items() if x > 0})
    got = {(r.doc_id, r.line_no, r.term): (round(r.weight, 9), round(r.nweight, 9)) for r in index.postings.collect()}
    assert got == want
    assert dict(index.doc_freq.collect()) == dict(df)
    plan = index.postings._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan  # no row a token is shuffled or sorted on the way


def test_topk_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(search, "PAIRS_AT_ONCE", 3)
    monkeypatch.setattr(search, "QUERY_COLUMNS", 2)
    index = search.tfidf_index(passages(spark, TEXTS * 3 + [(f"n{i}", i % 3, f"cat dog w{i % 4} w{i % 7}") for i in range(200)]))
    queries = spark.createDataFrame([("q1", "cat dog"), ("q2", "the w3 w5 w5"), ("q3", "nothing here"), (None, "dog"), ("q5", "\u00e9t\u00e9 w1")], "query_id string, query string")
    weights = index.query_weights(queries)
    columns = ["query_id", "rank", "doc_id", "line_no", "score"]
    for k in (1, 3, 50):
        want = search.topk(search.sparse_scores(index, weights), k).select(columns).collect()
        top = search.sparse_topk(index, weights, k).select(columns)
        assert sorted(map(str, top.collect())) == sorted(map(str, want))
    scored = search.sparse_topk(index, weights, 3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in scored and "query_id" not in scored[scored.index("MapInArrow") + 200:].split("ObjectHashAggregate")[-1]
    many = search.sparse_topk(index, weights, 3, queries_small=False).select(columns)
    assert sorted(map(str, many.collect())) == sorted(map(str, search.topk(search.sparse_scores(index, weights), 3).select(columns).collect()))
