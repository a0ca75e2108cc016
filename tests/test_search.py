"""Search, context and hooks against brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.operators import context as ctx
from sifter.operators import hooks, search
from sifter.session import materialise
from sifter.sources import fixtures as fx


def test_validate_passages(spark):
    with pytest.raises(TypeError):
        search.validate_passages(["not", "a", "frame"])
    with pytest.raises(TypeError):
        search.validate_passages(spark.createDataFrame([(1,)], "passage int"))


def test_topk_more_than_available(spark):
    s = spark.createDataFrame([(0, 1, 0, 0.5), (0, 2, 0, 0.7)], "query_id long, doc_id long, line_no long, score double")
    assert search.topk(s, 5).count() == 2


def test_dense_topk_equals_numpy(spark, small_dir):
    e = fx.table(spark, small_dir, "embeddings")
    corpus, qs = e.filter("vec_id >= 10"), e.filter("vec_id < 10")
    got = search.topk(search.dense_scores(corpus, qs, 3, block=4), 3, ["vec_id"]).collect()
    rows = e.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = set()
    for qi in np.nonzero(ids < 10)[0]:
        sc = m[ids >= 10] @ m[qi]
        order = sorted(zip(-np.round(sc, 6), ids[ids >= 10]))[:3]
        want |= {(int(ids[qi]), int(k)) for _, k in order}
    assert {(r.query_id, r.vec_id) for r in got} == want


def test_dense_grid_equals_broadcast_block(spark):
    """Queries above the block: repeated ids, zero and null vectors, many ties."""
    rng = np.random.default_rng(3)
    rows = [(i % 37, f"k{i}", [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)] + [(1, "n", None), (2, "z", [0.0] * 4)]
    rows += [(9, f"same{i}", [1.0, 2.0, 0.0, 1.0]) for i in range(150)]
    df = spark.createDataFrame(rows, "qid long, key string, v array<float>")
    args = dict(key_col=["key"], vec_col="v", query_id_col="qid", query_vec_col="v")
    for k in (None, 3):
        one = search.dense_scores(df, df, k, **args)
        grid = search.dense_scores(df, df, k, block=50, corpus_block=64, **args)
        if k is None:
            assert one.count() == grid.count() == 451 * 451
            assert one.filter("score = 0").count() >= 451
        as_rows = lambda d: sorted((r.query_id, r["rank"], r.key, r.score) for r in search.topk(d, 3, ["key"]).collect())
        got = as_rows(grid)
        assert as_rows(one) == got
        if k is None:
            full = got
    assert got == full


def test_saved_index_keeps_buckets_and_pushes_terms(spark, small_dir, tmp_path):
    psg = materialise(fx.passages(fx.table(spark, small_dir, "documents")), "passages")
    idx = search.tfidf_index(psg)
    idx.save(str(tmp_path / "it's saved"))
    back = search.TfidfIndex.load(spark, str(tmp_path / "it's saved"))
    assert (back.n_docs, back.keys) == (idx.n_docs, idx.keys)
    q = spark.createDataFrame([(1, psg.orderBy("doc_id", "line_no").first().passage)], "query_id long, query string")
    terms = search.few_query_terms(q)
    assert terms
    plain = search.sparse_scores(idx, idx.query_weights(q))
    pushed = search.sparse_scores(back, back.query_weights(q), True, terms)
    as_rows = lambda d: sorted((r.doc_id, r.line_no, round(r.score, 9)) for r in d.collect())
    assert as_rows(plain) == as_rows(pushed) != []
    plan = pushed._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = next(x for x in plan.split("\n\n") if "postings" in x and "PushedFilters" in x)
    assert "EqualTo(term," in scan and "Bucketed: true" in scan


def test_page_of_unhandled_elements_has_a_record(spark):
    from sifter.operators.layout import assemble_pages

    el = fx.elements(spark.createDataFrame([(7, "a curve only"), (6, "a b|| c")], "doc_id long, text string"))
    rows = {r.doc_id: r for r in assemble_pages(el).collect()}
    assert rows[7].page_content == [] and rows[7].page_no == 0
    assert rows[6].page_content == ["|a b|None| c|"]


def test_anchor_equals_nested_and_brute_force(spark, small_dir):
    docs = fx.table(spark, small_dir, "documents")
    psg = materialise(fx.passages(docs), "passages")
    # every passage's own text as a query: each must be found, at or before its own page
    best = materialise(psg.filter((F.col("line_no") % 7) == 0).select(
        F.monotonically_increasing_id().alias("query_id"), F.col("passage").alias("best_match"),
        "doc_id", "page_no"), "best")
    pages = materialise(ctx.prepare_pages(fx.doc_pages(docs)), "pages")
    a = ctx.find_context(best, pages, method="anchor").orderBy("query_id").collect()
    n = ctx.find_context(best, pages, method="nested").orderBy("query_id").collect()
    assert a == n
    indexed = ctx.find_context(best, pages, method="anchor", page_index=ctx.page_term_index(pages))
    assert indexed.orderBy("query_id").collect() == a
    own = {r.query_id: (r.doc_id, r.page_no) for r in best.collect()}
    page_rows = pages.collect()
    for r in a:
        assert r.doc_id is not None
        assert (r.doc_id, r.page_no) <= own[r.query_id]
    # brute force for a few
    for r in a[:20]:
        p = [x for x in best.collect() if x.query_id == r.query_id][0].best_match.lower()
        first = min((pg.doc_id, pg.page_no) for pg in page_rows if p in pg.page_lc)
        assert first == (r.doc_id, r.page_no)


def test_hooks(spark):
    df = spark.createDataFrame([(0, 1, "the cat", "a cat sat", "P\nQuery: why\nAnswer:")],
                               "query_id long, rank long, query string, corpus_passage string, prompt string")
    r = hooks.rerank(df, hooks.jaccard_scorer).collect()[0]
    assert r.cross_score == pytest.approx(1 / 4)
    e = hooks.embed(df, "corpus_passage", hooks.hashing_encoder).collect()[0]
    assert len(e.embedding) == 64 and abs(np.linalg.norm(e.embedding) - 1) < 1e-5
    g = hooks.generate(df, "prompt", hooks.echo_generator).collect()[0]
    assert g.answer == "why"



def test_retrieve_and_prompt_with_generator(spark, small_dir):
    from sifter.plans import jobs

    docs = fx.table(spark, small_dir, "documents")
    q = fx.table(spark, small_dir, "benchmark").select(F.col("item_id").alias("query_id"),
                                                       F.col("text").alias("query"))
    rows = jobs.retrieve_and_prompt(docs, q, generator_factory=hooks.echo_generator).collect()
    qtext = {r.query_id: r.query for r in q.collect()}
    assert len(rows) == len(qtext)
    for r in rows:
        if r.prompt is None:
            assert r.answer is None
        else:
            assert r.answer == qtext[r.query_id].split("\n")[0]


def test_corpus_cache_follows_input_version(spark, small_dir):
    import os
    import tempfile
    import time as _time

    from sifter.plans import catalog

    d = tempfile.mkdtemp(prefix="sifter-ver-")
    docs = fx.table(spark, small_dir, "documents")
    docs.filter("doc_id < 20").write.parquet(os.path.join(d, "documents.parquet"))
    first = catalog.corpus(spark, d)
    assert catalog.corpus(spark, d) is first  # same input: same corpus tables
    _time.sleep(1.1)
    docs.filter("doc_id < 30").write.mode("overwrite").parquet(os.path.join(d, "documents.parquet"))
    assert catalog.corpus(spark, d) is not first  # rewritten input: rebuilt


def test_semantic_search_passages_with_encoder(spark, small_dir):
    from sifter.plans import jobs

    docs = fx.table(spark, small_dir, "documents")
    psg = materialise(fx.passages(docs), "passages")
    q = fx.table(spark, small_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    got = jobs.semantic_search_passages(psg, q, hooks.hashing_encoder, k=3).collect()
    enc = hooks.hashing_encoder()
    prow = psg.orderBy("doc_id", "line_no").collect()
    pv = np.asarray(enc([r.passage for r in prow]), dtype=np.float32).astype(np.float64)
    pv = pv / np.where(np.linalg.norm(pv, axis=1) == 0, np.nan, np.linalg.norm(pv, axis=1))[:, None]
    want = set()
    for r in q.collect():
        qv = np.asarray(enc([r.query]), dtype=np.float32).astype(np.float64)[0]
        sc = pv @ (qv / np.linalg.norm(qv))
        order = sorted(((-np.floor(s * 1e6 + 0.5) / 1e6, (p.doc_id, p.line_no), p.passage) for s, p in zip(sc, prow)
                        if not np.isnan(s)))[:3]
        want |= {(r.query_id, text, -neg) for neg, _, text in order}
    assert {(g.query_id, g.corpus_passage, g.score) for g in got} == want


def test_short_odd_and_null_passages_anchor_equals_nested(spark):
    pages = ctx.prepare_pages(spark.createDataFrame(
        [("f:/b", 0, "one two three"), ("f:/a", 1, "xthree four"), ("f:/a", 0, "nothing\nhere"), ("f:/c", 0, ""),
         ("f:/c", 1, "\u039f\u0394\u039f\u03a3next \u03bf\u03b4\u03bf\u03c2"), ("f:/d", 0, None)],
        "doc_id string, page_no long, page_raw string"))
    best = spark.createDataFrame(
        [(1, "thre"), (2, "o three"), (3, "ne t"), (4, ""), (5, None), (6, "\u039f\u0394\u039f\u03a3"), (7, "absent"),
         (8, "one two three"), (9, "e"), (10, "two three four")], "query_id long, best_match string")
    want = {1: ("f:/a", 1), 2: ("f:/b", 0), 3: ("f:/b", 0), 4: ("f:/a", 0), 5: (None, None),
            6: ("f:/c", 1), 7: (None, None), 8: ("f:/b", 0), 9: ("f:/a", 0), 10: (None, None)}
    rows = lambda m, **k: {r.query_id: (r.doc_id, r.page_no) for r in ctx.find_context(best, pages, method=m, **k).collect()}
    nested = rows("nested")
    assert nested == want
    assert rows("anchor") == nested
    assert rows("anchor", max_broadcast_rows=0) == nested
    assert rows("anchor", page_index=ctx.page_term_index(pages)) == nested


def test_anchor_plan_has_no_nested_loop(spark):
    pages = ctx.prepare_pages(spark.createDataFrame([(1, 0, "a b c d")], "doc_id long, page_no long, page_raw string"))
    best = spark.createDataFrame([(1, "b c"), (2, "a b c d")], "query_id long, best_match string")
    for bound in (0, 1000):
        plan = ctx.find_context(best, pages, max_broadcast_rows=bound)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_string_keys_in_dense_search_and_prompt(spark):
    from sifter.plans import jobs

    docs = spark.createDataFrame([("file:/a.txt", "the red cat\nsat down here"), ("file:/b.txt", "a blue dog")],
                                 "doc_id string, text string")
    q = spark.createDataFrame([("q1", "red cat"), ("q2", "zzz")], "query_id string, query string")
    rows = {r.query_id: r for r in jobs.retrieve_and_prompt(docs, q, skip=0).collect()}
    assert rows["q1"].doc_id == "file:/a.txt" and rows["q2"].doc_id is None
    pages = spark.createDataFrame([("file:/a.txt", 7, "the red cat sat")], "doc_id string, page_no long, text string")
    rows = {r.query_id: r for r in jobs.retrieve_and_prompt(docs, q, skip=0, pages=pages).collect()}
    assert rows["q1"].page_no == 7
    hits = jobs.semantic_search_passages(jobs.make_passages(docs), q, hooks.hashing_encoder, k=1).collect()
    assert {(h.query_id, h.corpus_passage) for h in hits if h.query_id == "q1"} == {("q1", "the red cat")}


def test_one_model_per_worker_and_factory(spark):
    """Every Python worker process loads a factory's model once, however many
    batches and tasks it runs (Spark decides how many workers there are)."""
    def factory(tag):
        def make():
            import os
            import uuid

            me = f"{tag}-{os.getpid()}-{uuid.uuid4().hex}"
            return lambda prompts: [me] * len(prompts)
        return make

    df = spark.range(64).repartition(32).selectExpr("cast(id as string) AS prompt")
    for tag in ("a", "b"):
        answers = {r.answer for r in hooks.generate(df, "prompt", factory(tag)).collect()}
        assert all(a.startswith(tag + "-") for a in answers)
        assert len(answers) == len({a.split("-")[1] for a in answers})


def test_first_record_of_a_page_wins(spark):
    from sifter.operators.layout import nest_pages

    p = spark.createDataFrame([(1, 0, 5, "a second"), (1, 0, 2, "z first"), (1, 3, 9, "other")],
                              "doc_id long, page_no long, pos long, page_content string")
    got = nest_pages(p, value_cols=["page_content"], position_col="pos").collect()[0].pages
    assert {k: v.page_content for k, v in got.items()} == {"Page_0": "z first", "Page_3": "other"}


def test_every_pair_without_a_copy_a_cell(spark):
    """beyond a broadcast every pair comes from a cross join of packed rows."""
    import numpy as np

    rows = [(i if i % 9 else None, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(150, 5)).tolist())] + [(3, [0.0] * 5), (900, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = search.dense_scores(df, df)
    got = search.dense_scores(df, df, block=40, corpus_block=30)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan and "Explode" not in plan
    pairs = lambda d: sorted((r.query_id or -1, r.vec_id or -1, round(r.score, 9)) for r in d.collect())
    assert len(pairs(got)) == 151 * 151 and pairs(got) == pairs(want)


def test_best_rows_of_a_task_only(spark):
    """a task keeps each query's best scores over its batches and leaves out
    the rows below them; ties are cut by key."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    vectors = rng.integers(-2, 3, (90, 3)).astype(float)
    unit = search._unit_lists(pa.array(vectors.tolist()))
    least, got = np.full((4, 2), -np.inf), []
    for i in range(0, 90, 30):
        keys = pa.table({"k": pa.array(range(i, i + 30))})
        got += [b for b in search._scored_vectors(pa.array(range(4)), unit[:4], keys, unit[i:i + 30], 2, least)]
    rows = pa.Table.from_batches(got).to_pylist()
    assert len(rows) < 3 * 4 * 2
    scores = np.floor(unit[:4] @ unit.T * 1e6 + 0.5)
    for q in range(4):
        want = sorted(range(90), key=lambda j: (-scores[q, j], j))[:2]
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: (-np.floor(r["score"] * 1e6 + 0.5), r["k"]))[:2]
        assert [r["k"] for r in mine] == want


def test_ids_of_all_pairs_take_little_room(spark, tmp_path):
    """every pair is a row, so what the ids take counts; one scan, no shuffle, the same rows."""
    import glob

    import numpy as np
    import pyarrow.parquet as pq

    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 4))
    vectors[7] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(2)
    got = search.dense_scores(df, df.where("vec_id % 20 = 0"))
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    got.write.parquet(f"{tmp_path}/pairs")
    rows, ids = 0, 0
    for f in glob.glob(f"{tmp_path}/pairs/*.parquet"):
        about = pq.ParquetFile(f).metadata
        rows += about.num_rows
        ids += sum(about.row_group(g).column(c).total_compressed_size for g in range(about.num_row_groups) for c in (0, 1))
    assert rows == 3000 * 150 and ids < 0.6 * rows
    unit = vectors / np.where((n := np.linalg.norm(vectors, axis=1)) == 0, 1, n)[:, None]
    t = pq.read_table(f"{tmp_path}/pairs")
    q, v = t["query_id"].to_numpy(), t["vec_id"].to_numpy()
    assert len(np.unique(q * 3000 + v)) == rows
    assert np.allclose(t["score"].to_numpy(), (unit[q] * unit[v]).sum(1))
