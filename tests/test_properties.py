"""Properties from the survey's test strategy, checked with Spark over whole
tables (sf0.01)."""

from pyspark.sql import functions as F

from sifter.functions import text as tx
from sifter.operators import context as ctx
from sifter.operators import search
from sifter.plans import catalog
from sifter.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def test_retrieval_profile_idempotent_on_passages(spark):
    p = fx.passages(fx.table(spark, SF, "documents"))
    assert p.filter(tx.clean_retrieval("passage") != F.col("passage")).count() == 0


def test_every_passage_in_its_own_page(spark):
    docs = fx.table(spark, SF, "documents")
    p = fx.passages(docs)
    pages = ctx.prepare_pages(fx.doc_pages(docs))
    joined = p.join(pages, ["doc_id", "page_no"])
    assert joined.count() == p.count()
    assert joined.filter(~F.contains(F.col("page_lc"), F.lower("passage"))).count() == 0


def test_found_pages_contain_their_passage_and_k_bound(spark):
    psg, idx = catalog._index(spark, SF)
    hits, _ = search.search_passages(psg, catalog._queries(spark, SF), 5, index=idx)
    per_query = hits.groupBy("query_id").count()
    assert per_query.filter(F.col("count") > 5).count() == 0
    assert search.dedupe_hits(hits).groupBy("query_id").count().filter(F.col("count") > 5).count() == 0
    best = search.best_match(hits)
    found = ctx.find_context(best, catalog._pages(spark, SF)).join(best, "query_id")
    bad = found.filter(F.col("context").isNotNull() & ~F.contains(F.lower("context"), F.lower("best_match")))
    assert bad.count() == 0
    # each best passage comes from the corpus, so some page holds it
    assert found.filter(F.col("context").isNull()).count() == 0
