"""Registered queries: one per inventory row with an oracle check, each a
Spark plan over the driver tables and the DuckDB SQL that must give the same
rows. Array results are compared as joined strings, scores after rounding to
six digits, integers as BIGINT."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables as tf
from ..functions import text as tx
from ..functions.vectors import round_score
from ..operators import context as ctx
from ..operators import bounded, cells, hooks, layout, needles, search, store
from ..plans import jobs
from ..session import ensure_checkpoint_dir, materialise, materialise_bucketed
from ..sinks.documents import document_key, write_document_files, write_files
from ..sinks.writers import write_corpus, write_page_dict, write_per_document, write_result_csv
from ..sources import fixtures as fx
from ..sources.decks import read_decks
from ..sources.files import read_folder_passages, read_lines, read_page_dict, scan_documents
from ..sources.page_dict import read_page_dict_object, write_page_dict_object
from . import oracle as o

SEP = " || "  # separator when an array is compared as one string
EXAMPLE_QUERY = "Please explain the theory of business cycles."  # the original's sample query
K = search.DEFAULT_K

# user-defined substitution pairs for the generic chain (T1) test
URL_PAIRS = [(r"^[a-z]+://", ""), (r"[?#].*$", ""), (r"\.example\.", "."), (r"/+", "/")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fx.table(spark, sf, name)


def _docs(spark, sf):
    return _t(spark, sf, "documents")


def _queries(spark, sf):
    return _t(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _joined(arr) -> F.Column:
    return F.array_join(arr, SEP)


def _big(c) -> F.Column:
    return c.cast("bigint")


# ---------------------------------------------------------------------------
# Scans, splitting, cleaning
# ---------------------------------------------------------------------------
@register("split_passages", o.with_views("doc_lines") + "SELECT doc_id, line_no, line AS passage FROM doc_lines")
def q_split_passages(spark, sf):
    return fx.doc_lines(_docs(spark, sf)).withColumnRenamed("line", "passage")


@register("clean_lines", o.with_views("doc_lines") + f"SELECT doc_id, line_no, {o.strip('line')} AS line FROM doc_lines")
def q_clean_lines(spark, sf):
    return fx.doc_lines(_docs(spark, sf)).select("doc_id", "line_no", tx.strip("line").alias("line"))


@register("drop_blank_lines", o.with_views("doc_lines")
          + f"SELECT doc_id, line_no, line FROM doc_lines WHERE {o.not_blank('line')}")
def q_drop_blank_lines(spark, sf):
    return fx.doc_lines(_docs(spark, sf)).filter(tx.is_not_blank("line"))


@register("chain_sub", f"SELECT page_id, {o.chain('url', URL_PAIRS)} AS url FROM pages")
def q_chain_sub(spark, sf):
    return _t(spark, sf, "pages").select("page_id", tx.chain_sub("url", URL_PAIRS).alias("url"))


@register("clean_documents", f"SELECT doc_id, {o.t2('text')} AS text FROM documents")
def q_clean_documents(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.clean_retrieval("text").alias("text"))


@register("clean_pages", f"SELECT page_id, {o.t2('html')} AS html FROM pages")
def q_clean_pages(spark, sf):
    return _t(spark, sf, "pages").select("page_id", tx.clean_retrieval("html").alias("html"))


@register("clean_corpus_profile", f"SELECT page_id, {o.t3('html')} AS html FROM pages")
def q_clean_corpus_profile(spark, sf):
    return _t(spark, sf, "pages").select("page_id", tx.clean_corpus_profile("html").alias("html"))


@register("clean_slide_de", f"SELECT conv_id, turn, {o.slide('text', 'de')} AS text FROM conversations")
def q_clean_slide_de(spark, sf):
    return _t(spark, sf, "conversations").select("conv_id", "turn", tx.clean_slide("text", "de").alias("text"))


@register("clean_slide_en", f"SELECT conv_id, turn, {o.slide('text', 'en')} AS text FROM conversations")
def q_clean_slide_en(spark, sf):
    return _t(spark, sf, "conversations").select("conv_id", "turn", tx.clean_slide("text", "en").alias("text"))


@register("tokenise", o.with_views("doc_lines") + f"""
SELECT doc_id, line_no, CAST(len({o.tokens('line')}) AS BIGINT) AS n_tokens,
       array_to_string({o.tokens('line')}, '{SEP}') AS tokens
FROM doc_lines""")
def q_tokenise(spark, sf):
    t = tx.tokens("line")
    return fx.doc_lines(_docs(spark, sf)).select("doc_id", "line_no", _big(F.size(t)).alias("n_tokens"),
                                                 _joined(t).alias("tokens"))


@register("mask_damaged", o.with_views("damaged_lines") + f"""
SELECT doc_id, line_no, {o.clean_tokens_line('line', with_stopwords=False, terminated=False)} AS line
FROM damaged_lines""")
def q_mask_damaged(spark, sf):
    return fx.damaged_lines(_docs(spark, sf)).select(
        "doc_id", "line_no", tx.rejoin(tx.mask_damaged(tx.tokens("line"))).alias("line"))


@register("remove_stopwords", o.with_views("damaged_lines") + f"""
SELECT doc_id, line_no, {o.clean_tokens_line('line', with_stopwords=True, terminated=False)} AS line
FROM damaged_lines""")
def q_remove_stopwords(spark, sf):
    toks = tx.remove_stopwords(tx.tokens("line"), fx.TEST_STOPWORDS)
    return fx.damaged_lines(_docs(spark, sf)).select(
        "doc_id", "line_no", tx.rejoin(tx.mask_damaged(toks)).alias("line"))


@register("clean_corpus_lines", o.with_views("damaged_lines") + f"""
SELECT doc_id, line_no, {o.clean_tokens_line('line')} AS line FROM damaged_lines""")
def q_clean_corpus_lines(spark, sf):
    return fx.damaged_lines(_docs(spark, sf)).select(
        "doc_id", "line_no", tx.clean_tokens_line("line", fx.TEST_STOPWORDS).alias("line"))


@register("clean_corpus_lines_join", o.with_views("damaged_lines") + f"""
SELECT doc_id, line_no, {o.clean_tokens_line('line')} AS line FROM damaged_lines""")
def q_clean_corpus_lines_join(spark, sf):
    """T7-T10 with the stopword list as a table: anti join."""
    return jobs.clean_tokens_with_stopword_table(fx.damaged_lines(_docs(spark, sf)), fx.stopwords_frame(spark), max_inline=0)


@register("clean_corpus_job", o.with_views("damaged_lines") + f"""
SELECT doc_id, line_no, {o.t3(o.clean_tokens_line('line'))} AS line FROM damaged_lines""")
def q_clean_corpus_job(spark, sf):
    return jobs.clean_corpus_job(fx.damaged_lines(_docs(spark, sf)), fx.TEST_STOPWORDS)


_CONTAINS_SQL = """
SELECT b.item_id, CAST(count(d.doc_id) AS BIGINT) AS n_docs
FROM benchmark b LEFT JOIN documents d
  ON contains(replace(lower(d.text), chr(962), chr(963)), replace(lower(b.text), chr(962), chr(963)))
GROUP BY b.item_id"""


def _items_found(spark, sf, containing) -> DataFrame:
    items = _t(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    d = _docs(spark, sf).select("doc_id", tx.fold_case("text").alias("page_lc"))
    hits = containing(items, d, "text", ["doc_id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return items.select("query_id").join(hits, "query_id", "left").select(
        F.col("query_id").alias("item_id"), F.coalesce(F.col("n_docs"), F.lit(0)).cast("bigint").alias("n_docs"))


@register("contains_ci", _CONTAINS_SQL)
def q_contains_ci(spark, sf):
    return _items_found(spark, sf, ctx.containing)


@register("contains_ci_automaton", _CONTAINS_SQL)
def q_contains_ci_automaton(spark, sf):
    """F2 for all needles in one scan of the texts."""
    return _items_found(spark, sf, needles.containing_any)


@register("cut_context", "SELECT doc_id, substring(text, 1501) AS context FROM documents")
def q_cut_context(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.cut_context("text").alias("context"))


def _prompt_sql(context: str, query: str) -> str:
    parts = []
    import string

    for literal, name, _, _ in string.Formatter().parse(tx.DEFAULT_PROMPT_TEMPLATE):
        if literal:
            parts.append(o.lit(literal).replace("\n", "' || chr(10) || '"))
        if name:
            parts.append(context if name == "context" else query)
    return "(" + " || ".join(parts) + ")"


@register("render_prompt", f"""
SELECT conv_id, turn, {_prompt_sql('ctx', 'text')} AS prompt FROM (
  SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ctx
  FROM conversations) WHERE role = 'user' AND ctx IS NOT NULL""")
def q_render_prompt(spark, sf):
    from pyspark.sql import Window

    c = _t(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("ctx", F.lead("text").over(w)).filter((F.col("role") == "user") & F.col("ctx").isNotNull())
    return c.select("conv_id", "turn", tx.render_prompt({"context": "ctx", "query": "text"}).alias("prompt"))


# ---------------------------------------------------------------------------
# Page assembly
# ---------------------------------------------------------------------------
def _marked(spark, sf):
    el = fx.elements(_docs(spark, sf))
    return layout.mark_table_suppression(layout.order_elements(layout.classify(el)))


def _records(spark, sf):
    return layout.assemble_pages(fx.elements(_docs(spark, sf)))


@register("layout_order", o.with_views("marked") + "SELECT doc_id, page_no, elem_ix, ord FROM ordered")
def q_layout_order(spark, sf):
    el = layout.order_elements(fx.elements(_docs(spark, sf)))
    return el.select("doc_id", "page_no", _big(F.col("elem_ix")).alias("elem_ix"), _big(F.col("ord")).alias("ord"))


@register("layout_kind_counts", o.with_views("elements") + """
SELECT kind, count(*) AS n_elements, count(DISTINCT (doc_id, page_no)) AS n_pages
FROM elements WHERE kind IN ('text', 'figure', 'rect') GROUP BY kind""")
def q_layout_kind_counts(spark, sf):
    el = layout.classify(fx.elements(_docs(spark, sf)))
    return el.groupBy("kind").agg(F.count(F.lit(1)).alias("n_elements"),
                                  F.count_distinct("doc_id", "page_no").alias("n_pages"))


@register("layout_formats", o.with_views("entries") + """
SELECT doc_id, page_no, CAST(ord AS BIGINT) AS ord, array_to_string(fonts, ',') AS fonts,
       array_to_string(list_transform(sizes, lambda s: CAST(CAST(s AS BIGINT) AS VARCHAR)), ',') AS sizes
FROM entries WHERE kind = 'text'""")
def q_layout_formats(spark, sf):
    el = layout.order_elements(fx.elements(_docs(spark, sf))).filter(F.col("kind") == "text")
    fonts, sizes = layout.text_formats(F.col("chars"))
    return el.select("doc_id", "page_no", _big(F.col("ord")).alias("ord"), F.array_join(fonts, ",").alias("fonts"),
                     F.array_join(F.transform(sizes, lambda s: s.cast("bigint").cast("string")), ",").alias("sizes"))


@register("layout_suppress", o.with_views("marked") + """
SELECT doc_id, page_no, elem_ix, kind, keep FROM marked WHERE kind IN ('text', 'figure', 'rect')""")
def q_layout_suppress(spark, sf):
    return _marked(spark, sf).select("doc_id", "page_no", _big(F.col("elem_ix")).alias("elem_ix"), "kind", "keep")


@register("layout_figures", o.with_views("page_records") + f"""
SELECT doc_id, page_no, CAST(len(text_from_images) AS BIGINT) AS n_images,
       array_to_string(text_from_images, '{SEP}') AS images
FROM page_records""")
def q_layout_figures(spark, sf):
    r = _records(spark, sf)
    return r.select("doc_id", "page_no", _big(F.size("text_from_images")).alias("n_images"),
                    _joined(F.col("text_from_images")).alias("images"))


@register("table_to_text", o.with_views("elements") + f"""
SELECT doc_id, page_no, elem_ix, {o.table_text_sql('tbl')} AS table_text FROM elements WHERE kind = 'rect'""")
def q_table_to_text(spark, sf):
    el = fx.elements(_docs(spark, sf)).filter(F.col("kind") == "rect")
    return el.select("doc_id", "page_no", _big(F.col("elem_ix")).alias("elem_ix"),
                     tf.table_to_text("table").alias("table_text"))


@register("nth_table", o.with_views("page_tables") + f"""
SELECT doc_id, page_no, CAST(len(tables) AS BIGINT) AS n_tables,
       {o.table_text_sql('tables[1]')} AS table_0, {o.table_text_sql('tables[2]')} AS table_1
FROM page_tables""")
def q_nth_table(spark, sf):
    m = _marked(spark, sf).filter((F.col("kind") == "rect") & F.col("table").isNotNull())
    pages = m.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("ord", "table"))).alias("_t"))
    tabs = F.transform("_t", lambda x: x["table"])
    return pages.select("doc_id", "page_no", _big(F.size(tabs)).alias("n_tables"),
                        tf.table_to_text(tf.nth_table(tabs, 0)).alias("table_0"),
                        tf.table_to_text(tf.nth_table(tabs, 1)).alias("table_1"))


def _records_as_strings(r: DataFrame) -> DataFrame:
    fmt = F.transform("line_format", lambda x: F.concat(
        x["kind"], F.lit(":"), F.array_join(x["fonts"], ","), F.lit(":"),
        F.array_join(F.transform(x["sizes"], lambda s: s.cast("bigint").cast("string")), ",")))
    return r.select("doc_id", "page_no", _joined(F.col("page_text")).alias("page_text"),
                    _joined(fmt).alias("line_format"), _joined(F.col("text_from_images")).alias("text_from_images"),
                    _joined(F.col("text_from_tables")).alias("text_from_tables"),
                    _joined(F.col("page_content")).alias("page_content"))


@register("assemble_pages", o.with_views("page_records") + f"""
SELECT doc_id, page_no, array_to_string(page_text, '{SEP}') AS page_text,
       array_to_string(line_format, '{SEP}') AS line_format,
       array_to_string(text_from_images, '{SEP}') AS text_from_images,
       array_to_string(text_from_tables, '{SEP}') AS text_from_tables,
       array_to_string(page_content, '{SEP}') AS page_content
FROM page_records""")
def q_assemble_pages(spark, sf):
    return _records_as_strings(_records(spark, sf))


@register("layout_multi_table", o.with_views("regions") + """
SELECT doc_id, page_no, elem_ix, kind, CAST(region AS BIGINT) AS region, CAST(n_tables AS BIGINT) AS n_tables, keep FROM regions""")
def q_layout_multi_table(spark, sf):
    el = layout.mark_tables(layout.order_elements(fx.table_extents(fx.elements(_docs(spark, sf)))))
    return layout.classify(el).select("doc_id", "page_no", _big(F.col("elem_ix")).alias("elem_ix"), "kind", _big(F.col("region")).alias("region"),
                                      _big(F.col("n_tables")).alias("n_tables"), "keep")


@register("assemble_pages_multi", o.with_views("multi_records") + f"""
SELECT doc_id, page_no, array_to_string(page_text, '{SEP}') AS page_text, array_to_string(kinds, ',') AS kinds,
       array_to_string(text_from_tables, '{SEP}') AS text_from_tables, array_to_string(page_content, '{SEP}') AS page_content
FROM multi_records""")
def q_assemble_pages_multi(spark, sf):
    r = layout.assemble_pages(fx.table_extents(fx.elements(_docs(spark, sf))), multi_table=True)
    return r.select("doc_id", "page_no", _joined(F.col("page_text")).alias("page_text"),
                    F.array_join(F.transform("line_format", lambda x: x["kind"]), ",").alias("kinds"),
                    _joined(F.col("text_from_tables")).alias("text_from_tables"), _joined(F.col("page_content")).alias("page_content"))


@register("page_text", o.with_views("page_records") + """
SELECT doc_id, page_no, array_to_string(page_content, '') AS text FROM page_records""")
def q_page_text(spark, sf):
    return layout.with_page_text(_records(spark, sf)).select("doc_id", "page_no", "text")


@register("page_key", o.with_views("page_records") + """
SELECT doc_id, page_no, 'Page_' || CAST(page_no AS VARCHAR) AS page_key FROM page_records""")
def q_page_key(spark, sf):
    return _records(spark, sf).select("doc_id", "page_no", tf.page_key("page_no").alias("page_key"))


@register("nest_pages", o.with_views("page_records") + """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_pages,
       string_agg('Page_' || CAST(page_no AS VARCHAR), ',' ORDER BY page_no) AS page_keys,
       string_agg(array_to_string(page_content, ''), chr(10) ORDER BY page_no) AS text
FROM page_records GROUP BY doc_id""")
def q_nest_pages(spark, sf):
    nested = layout.nest_pages(_records(spark, sf))
    vals = F.map_values("pages")
    return nested.select("doc_id", _big(F.size("pages")).alias("n_pages"),
                         F.array_join(F.map_keys("pages"), ",").alias("page_keys"),
                         F.array_join(F.transform(vals, lambda v: tf.page_text(v["page_content"])), "\n").alias("text"))


@register("nest_turns", f"""
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_parts,
       string_agg({o.slide('text', 'en')}, '{SEP}' ORDER BY turn) AS parts
FROM conversations GROUP BY conv_id""")
def q_nest_turns(spark, sf):
    c = _t(spark, sf, "conversations").withColumn("text", tx.clean_slide("text", "en"))
    n = layout.nest_parts(c, "conv_id", ["turn"], "text")
    return n.select("conv_id", _big(F.size("parts")).alias("n_parts"), _joined(F.col("parts")).alias("parts"))


@register("first_per_key", o.with_views("passages") + """
SELECT doc_id, line_no, passage FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rn FROM passages) WHERE rn = 1""")
def q_first_per_key(spark, sf):
    return layout.first_per_key(fx.passages(_docs(spark, sf)), ["doc_id"], ["line_no"], ["passage"])


_TURN_LINE_SQL = o.strip(o.slide("text", "en"))


@register("turn_corpus", f"""
SELECT conv_id, turn, line FROM (SELECT conv_id, turn, {_TURN_LINE_SQL} AS line FROM conversations)
WHERE {o.not_blank('line')}""")
def q_turn_corpus(spark, sf):
    return jobs.turn_corpus(_t(spark, sf, "conversations"))


@register("page_corpus", o.with_views("page_records") + """
SELECT doc_id, page_no, 'Page_' || CAST(page_no AS VARCHAR) AS page_key, array_to_string(page_content, '') AS text
FROM page_records""")
def q_page_corpus(spark, sf):
    return jobs.page_corpus(fx.elements(_docs(spark, sf)))


@register("corpus_union", o.with_views("page_records") + f"""
SELECT 'page' AS source, doc_id AS file_id, page_no AS part_no, array_to_string(page_content, '') AS text
FROM page_records
UNION ALL
SELECT 'turn' AS source, conv_id AS file_id, turn AS part_no, line AS text
FROM (SELECT conv_id, turn, {_TURN_LINE_SQL} AS line FROM conversations) WHERE {o.not_blank('line')}""")
def q_corpus_union(spark, sf):
    pages = jobs.page_corpus(fx.elements(_docs(spark, sf))).select(
        F.lit("page").alias("source"), F.col("doc_id").alias("file_id"), F.col("page_no").alias("part_no"), "text")
    turns = jobs.turn_corpus(_t(spark, sf, "conversations")).select(
        F.lit("turn").alias("source"), F.col("conv_id").alias("file_id"), F.col("turn").alias("part_no"),
        F.col("line").alias("text"))
    return layout.corpus_union(pages, turns)


# ---------------------------------------------------------------------------
# Search (V1b-V9) and context (J3), jobs P1, P5
# ---------------------------------------------------------------------------
# Corpus tables built once per session and input version, reused by every
# query over the same documents (the index is built once, queried by batches).
_CORPUS: dict[tuple, dict] = {}


def _signature(spark: SparkSession, path: str) -> tuple:
    """Identity of an input on any file system, as one row computed by
    Spark from its own listing (contents are not read): file count, total
    length, latest modification time and an order-free digest of
    (path, length, time) over all files."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                      F.max("modificationTime").alias("latest"),
                      F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("digest")
                      ).collect()[0]
    return (path, row.n, row.bytes, str(row.latest), str(row.digest))


def corpus(spark: SparkSession, sf: str) -> dict:
    key = (spark.sparkContext.applicationId, sf, _signature(spark, f"{sf}/documents.parquet"))
    if key not in _CORPUS:
        _CORPUS[key] = {}
    return _CORPUS[key]


def _passages(spark, sf):
    """Cleaned passages, written once to the checkpoint folder bucketed on
    the passage key: the index build (term counts, norms) runs on that
    partitioning without an exchange, and a very large document spreads over
    all buckets; the hit text reads the same table."""
    c = corpus(spark, sf)
    if "passages" not in c:
        c["passages"] = materialise_bucketed(fx.passages(_docs(spark, sf)), ["doc_id", "line_no"], name="passages")
    return c["passages"]


def _index(spark, sf):
    c = corpus(spark, sf)
    psg = _passages(spark, sf)
    if "index" not in c:
        c["index"] = search.tfidf_index(psg)
    return psg, c["index"]


def _pages(spark, sf):
    c = corpus(spark, sf)
    if "pages" not in c:
        c["pages"] = materialise(ctx.prepare_pages(fx.doc_pages(_docs(spark, sf))), "pages")
    return c["pages"]


def _page_index(spark, sf):
    c = corpus(spark, sf)
    if "page_index" not in c:
        c["page_index"] = ctx.page_term_index(_pages(spark, sf))
    return c["page_index"]


def build_corpus(spark: SparkSession, sf: str) -> None:
    """Build the reusable corpus tables (passages, TF-IDF index, cleaned
    pages and their term index) for ``sf`` now."""
    _index(spark, sf)
    _page_index(spark, sf)


@register("tfidf_weights", o.with_views("tfidf") + """
SELECT doc_id, line_no, term, round(weight, 6) AS weight, round(nweight, 6) AS nweight FROM p_post""")
def q_tfidf_weights(spark, sf):
    _, idx = _index(spark, sf)
    return idx.postings.select("doc_id", "line_no", "term", round_score("weight").alias("weight"),
                               round_score("nweight").alias("nweight"))


@register("cosine_sparse", o.with_views("sparse") + """
SELECT query_id, doc_id, line_no, round(score, 6) AS score FROM sparse""")
def q_cosine_sparse(spark, sf):
    _, idx = _index(spark, sf)
    s = search.sparse_scores(idx, idx.query_weights(_queries(spark, sf)))
    return s.select("query_id", "doc_id", "line_no", round_score("score").alias("score"))


@register("topk_sparse", o.with_views("hits") + """
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, line_no, score FROM hits""")
def q_topk_sparse(spark, sf):
    _, idx = _index(spark, sf)
    h = search.sparse_topk(idx, idx.query_weights(_queries(spark, sf)), K)
    return h.select("query_id", _big(F.col("rank")).alias("rank"), "doc_id", "line_no", "score")


@register("topk_sparse_bounded", o.with_views("hits") + """
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, line_no, score FROM hits""")
def q_topk_sparse_bounded(spark, sf):
    """V2 and V3 from the blocks of postings that can hold a hit."""
    c = corpus(spark, sf)
    _, idx = _index(spark, sf)
    if "blocks" not in c:
        c["blocks"] = bounded.block_index(idx)
    got = bounded.bounded_topk(c["blocks"], idx.query_weights(_queries(spark, sf)), K)
    return got.hits.select("query_id", _big(F.col("rank")).alias("rank"), "doc_id", "line_no", "score")


@register("hit_passages", o.with_views("hit_text") + """
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, line_no, corpus_passage, score FROM hit_text""")
def q_hit_passages(spark, sf):
    psg, idx = _index(spark, sf)
    hits, _ = search.search_passages(psg, _queries(spark, sf), K, index=idx)
    return hits.select("query_id", _big(F.col("rank")).alias("rank"), "doc_id", "line_no", "corpus_passage", "score")


_EXAMPLE_SQL = o.with_views("tfidf") + f"""
, ex_tf AS (
  SELECT term, count(*) AS tf FROM (SELECT unnest({o.terms(o.lit(EXAMPLE_QUERY))}) AS term) GROUP BY term),
ex_w AS (
  SELECT e.term, e.tf * ln((n.n + 1) / (CAST(coalesce(d.df, 0) AS DOUBLE) + 1)) AS w
  FROM ex_tf e LEFT JOIN p_df d USING (term) CROSS JOIN n_docs n),
ex_n AS (SELECT term, w / sqrt(sum(w * w) OVER ()) AS nw FROM ex_w),
ex_s AS (
  SELECT p.doc_id, p.line_no, round(sum(e.nw * p.nweight), 6) AS score
  FROM ex_n e JOIN p_post p USING (term) GROUP BY ALL)
SELECT CAST(rank AS BIGINT) AS rank, doc_id, line_no, passage AS corpus_passage, score FROM (
  SELECT s.*, p.passage, row_number() OVER (ORDER BY s.score DESC, s.doc_id, s.line_no) AS rank
  FROM ex_s s JOIN passages p USING (doc_id, line_no)) WHERE rank <= {K}"""


@register("topk_ordered", _EXAMPLE_SQL)
def q_topk_ordered(spark, sf):
    psg, idx = _index(spark, sf)
    q = spark.range(1).select(F.lit(0).cast("bigint").alias("query_id"), F.lit(EXAMPLE_QUERY).alias("query"))
    # one query: its few tokens bound its weights
    s = search.sparse_scores(idx, idx.query_weights(q, small=True), True, search.few_query_terms(q)).drop("query_id")
    top = search.topk(s, K, group=None)
    out = search.attach_passages(top, psg, hits_small=True)  # k rows
    return out.select(_big(F.col("rank")).alias("rank"), "doc_id", "line_no", "corpus_passage", "score")


@register("saved_index", o.with_views("hits") + """
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, line_no, score FROM hits""")
def q_saved_index(spark, sf):
    """V1b kept between runs: the index saved, opened again and searched."""
    path = _written(spark, "index")
    psg, idx = _index(spark, sf)
    idx.save(path)
    hits, _ = search.search_passages(psg, _queries(spark, sf), K, index=search.TfidfIndex.load(spark, path))
    return hits.select("query_id", _big(F.col("rank")).alias("rank"), "doc_id", "line_no", "score")


@register("search_unique", o.with_views("hit_text") + """
SELECT DISTINCT query_id, corpus_passage, score FROM hit_text""")
def q_search_unique(spark, sf):
    psg, idx = _index(spark, sf)
    return jobs.search_unique(_docs(spark, sf), _queries(spark, sf), K, passages=psg, index=idx)


@register("best_match", o.with_views("best") + "SELECT query_id, best_match, score FROM best")
def q_best_match(spark, sf):
    psg, idx = _index(spark, sf)
    hits, _ = search.search_passages(psg, _queries(spark, sf), K, index=idx)
    return search.best_match(hits)


@register("rerank_jaccard", o.with_views("hit_text", "queries") + f"""
SELECT h.query_id, CAST(h.rank AS BIGINT) AS rank, h.doc_id, h.line_no, h.score,
       round(CASE WHEN len(list_distinct(list_concat(qt, pt))) = 0 THEN 0.0
                  ELSE CAST(len(list_intersect(list_distinct(qt), list_distinct(pt))) AS DOUBLE)
                       / len(list_distinct(list_concat(qt, pt))) END, 6) AS cross_score
FROM (SELECT h.*, {o.terms('q.query')} AS qt, {o.terms('h.corpus_passage')} AS pt
      FROM hit_text h JOIN queries q USING (query_id)) h""")
def q_rerank_jaccard(spark, sf):
    q = _queries(spark, sf)
    psg, idx = _index(spark, sf)
    hits, _ = search.search_passages(psg, q, K, index=idx)
    r = hooks.rerank(hits.join(q, "query_id"), hooks.jaccard_scorer)
    return r.select("query_id", _big(F.col("rank")).alias("rank"), "doc_id", "line_no", "score",
                    round_score("cross_score").alias("cross_score"))


@register("find_context", o.with_views("found") + "SELECT query_id, doc_id, page_no, context FROM found")
def q_find_context(spark, sf):
    psg, idx = _index(spark, sf)
    hits, _ = search.search_passages(psg, _queries(spark, sf), K, index=idx)
    best = materialise(search.best_match(hits), "best")
    return ctx.find_context(best, _pages(spark, sf), page_index=_page_index(spark, sf))


@register("find_context_anchor", o.with_views("found") + "SELECT query_id, doc_id, page_no, context FROM found")
def q_find_context_anchor(spark, sf):
    """J3 without a page index built before: the page tokens are taken from the
    pages, filtered by the wanted terms."""
    psg, idx = _index(spark, sf)
    hits, _ = search.search_passages(psg, _queries(spark, sf), K, index=idx)
    best = materialise(search.best_match(hits), "best")
    return ctx.find_context(best, _pages(spark, sf), method="anchor")


@register("retrieve_and_prompt", o.with_views("found", "queries") + f"""
SELECT q.query_id, b.best_match, b.score, f.doc_id, f.page_no,
       {_prompt_sql('substring(f.context, 1501)', 'q.query')} AS prompt
FROM queries q LEFT JOIN best b USING (query_id) LEFT JOIN found f USING (query_id)""")
def q_retrieve_and_prompt(spark, sf):
    psg, idx = _index(spark, sf)
    return jobs.retrieve_and_prompt(_docs(spark, sf), _queries(spark, sf), passages=psg, index=idx,
                                    pages=_pages(spark, sf), page_index=_page_index(spark, sf))


def _written(spark, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sifter-files/{name}-{uuid.uuid4().hex}"


@register("page_dict_files", o.with_views("page_records") + """
SELECT CAST(doc_id AS VARCHAR) AS file, page_no, array_to_string(page_content, '') AS text FROM page_records""")
def q_page_dict_files(spark, sf):
    """Page dictionaries written as JSON lines and read back."""
    path = _written(spark, "page-dict")
    write_page_dict(layout.nest_pages(_records(spark, sf)), path)
    return read_page_dict(spark, path).select("file", "page_no", "text")


@register("page_dict_object", o.with_views("page_records") + f"""
SELECT CAST(doc_id AS VARCHAR) AS file, page_no, array_to_string(page_text, '{SEP}') AS page_text,
       CAST(len(line_format) AS BIGINT) AS n_formats, array_to_string(text_from_images, '{SEP}') AS text_from_images,
       array_to_string(text_from_tables, '{SEP}') AS text_from_tables, array_to_string(page_content, '') AS text FROM page_records""")
def q_page_dict_object(spark, sf):
    """The corpus written as one JSON object in one file and read
    back by as many tasks as it has splits."""
    path = _written(spark, "page-object")
    write_page_dict_object(_records(spark, sf), path)
    d = read_page_dict_object(spark, f"{path}/pages.json")
    return d.select("file", "page_no", _joined(F.col("page_text")).alias("page_text"), _big(F.size("line_format")).alias("n_formats"),
                    _joined(F.col("text_from_images")).alias("text_from_images"),
                    _joined(F.col("text_from_tables")).alias("text_from_tables"), "text")


@register("corpus_files", f"""
SELECT line, CAST(count(*) AS BIGINT) AS n_lines
FROM (SELECT {_TURN_LINE_SQL} AS line FROM conversations) WHERE {o.not_blank('line')} GROUP BY line""")
def q_corpus_files(spark, sf):
    """The clean corpus written as text and its lines read back."""
    path = _written(spark, "corpus")
    write_corpus(jobs.turn_corpus(_t(spark, sf, "conversations")), path, ["conv_id", "turn"])
    return read_lines(spark, path, line_sep="\n").groupBy("line").agg(F.count(F.lit(1)).alias("n_lines"))


@register("per_document_files", f"""
SELECT conv_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS passage_no, unnest(parts) AS passage FROM (
  SELECT conv_id, regexp_split_to_array(string_agg({o.slide('text', 'en')} || chr(10), '' ORDER BY turn), '\r\n|\r|\n') AS parts
  FROM conversations GROUP BY conv_id)""")
def q_per_document_files(spark, sf):
    """One folder of text per conversation, read back as passages. A
    conversation that spans several part files is one text."""
    path = _written(spark, "documents")
    turns = _t(spark, sf, "conversations").select("conv_id", "turn", tx.clean_slide("text", "en").alias("text"))
    write_per_document(turns, path, "conv_id", ["turn"])
    p = read_folder_passages(spark, path)
    return p.select(F.regexp_extract("file", r"conv_id=(\d+)/", 1).cast("bigint").alias("conv_id"), "passage_no", "passage")


@register("field_corpus_files", o.with_views("page_records") + """
SELECT line, CAST(count(*) AS BIGINT) AS n_lines
FROM (SELECT unnest(string_split(array_to_string(page_content, ''), chr(10))) AS line FROM page_records) GROUP BY line""")
def q_field_corpus_files(spark, sf):
    """Every page's text and a newline, all files in one corpus, its lines read back."""
    path = _written(spark, "field-corpus")
    write_corpus(jobs.page_corpus(fx.elements(_docs(spark, sf))), path, ["doc_id", "page_no"], "text")
    return read_lines(spark, path, line_sep="\n").groupBy("line").agg(F.count(F.lit(1)).alias("n_lines"))


@register("raw_slide_corpus_files", f"""
WITH shapes AS (
  SELECT role AS text FROM conversations WHERE conv_id % {fx.CUT_DECKS} <> 3
  UNION ALL SELECT text FROM conversations WHERE conv_id % {fx.CUT_DECKS} <> 3)
SELECT line, CAST(count(*) AS BIGINT) AS n_lines FROM (SELECT {o.slide('text', 'en')} AS line FROM shapes) GROUP BY line""")
def q_raw_slide_corpus_files(spark, sf):
    """P3 over decks, K3 and S5: the cleaned shapes of every readable deck, one a line, read back."""
    path = _written(spark, "raw-slides")
    write_files(fx.decks(_t(spark, sf, "conversations")), f"{path}/decks/lectures")
    _, raw, _ = jobs.slide_corpus(read_decks(spark, f"{path}/decks"), "en")
    write_corpus(raw, f"{path}/raw", ["file", "slide_no", "shape_ix"])
    return read_lines(spark, f"{path}/raw", line_sep="\n").groupBy("line").agg(F.count(F.lit(1)).alias("n_lines"))


@register("document_files", f"""
SELECT 'conv_' || CAST(conv_id AS VARCHAR) || '/a.pptx' AS file, string_agg({o.slide('text', 'en')} || chr(10), '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def q_document_files(spark, sf):
    """K1: one text file per conversation, named by its key, read back whole."""
    path = _written(spark, "document-files")
    key = F.concat(F.lit("conv_"), F.col("conv_id"), F.lit("/a.pptx"))
    write_document_files(_t(spark, sf, "conversations").select(key.alias("file"), "turn", tx.clean_slide("text", "en").alias("text")),
                         path, "file", ["turn"])
    return scan_documents(spark, path, "*.txt").select(
        document_key(F.substring_index("path", "/", -1)).alias("file"), F.decode("content", "UTF-8").alias("text"))


@register("deck_files", f"""
WITH turns AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS slide_no, role, text
  FROM conversations WHERE conv_id % {fx.PLAIN_DECKS} <> 0)
SELECT conv_id, slide_no, CAST(0 AS BIGINT) AS shape_ix, role AS text, FALSE AS damaged FROM turns WHERE conv_id % {fx.CUT_DECKS} <> 3
UNION ALL
SELECT conv_id, slide_no, CAST(1 AS BIGINT) AS shape_ix, text, FALSE AS damaged FROM turns WHERE conv_id % {fx.CUT_DECKS} <> 3
UNION ALL
SELECT DISTINCT conv_id, NULL, NULL, NULL, TRUE FROM turns WHERE conv_id % {fx.CUT_DECKS} = 3""")
def q_deck_files(spark, sf):
    """Decks written as files, found by name and read back; those
    without a special character in their name are not taken, those cut off give
    an error row."""
    path = _written(spark, "decks")
    write_files(fx.decks(_t(spark, sf, "conversations")), f"{path}/lectures")
    rows = read_decks(spark, path, require_special=True)
    return rows.select(F.regexp_extract("file", r"conv_(\d+)[.]pptx$", 1).cast("bigint").alias("conv_id"), "slide_no", "shape_ix", "text",
                       F.col("error").isNotNull().alias("damaged"))


@register("cleaned_files", o.with_views("damaged_lines") + f"""
SELECT line, CAST(count(*) AS BIGINT) AS n_lines
FROM (SELECT {o.t3(o.clean_tokens_line('line'))} AS line FROM damaged_lines) GROUP BY line""")
def q_cleaned_files(spark, sf):
    """The cleaned corpus written as text and its lines read back."""
    path = _written(spark, "cleaned")
    write_corpus(jobs.clean_corpus_job(fx.damaged_lines(_docs(spark, sf)), fx.TEST_STOPWORDS), path, ["doc_id", "line_no"])
    return read_lines(spark, path, line_sep="\n").groupBy("line").agg(F.count(F.lit(1)).alias("n_lines"))


@register("result_csv_files", o.with_views("hit_text") + """
SELECT corpus_passage, score, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT DISTINCT query_id, corpus_passage, score FROM hit_text) GROUP BY ALL""")
def q_result_csv_files(spark, sf):
    """K6: the result table written as CSV and read back."""
    path = _written(spark, "results")
    psg, idx = _index(spark, sf)
    write_result_csv(jobs.search_unique(_docs(spark, sf), _queries(spark, sf), K, passages=psg, index=idx), path)
    back = (spark.read.schema("corpus_passage string, score double").option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return back.groupBy("corpus_passage", "score").agg(F.count(F.lit(1)).alias("n_rows"))


@register("generate_echo", o.with_views("queries") + """
SELECT query_id, split_part(query, chr(10), 1) AS answer FROM queries""")
def q_generate_echo(spark, sf):
    """M1: a generator that answers with the query line of the prompt."""
    q = _queries(spark, sf).select("query_id", tx.render_prompt({"context": F.lit(""), "query": "query"}).alias("prompt"))
    return hooks.generate(q, "prompt", hooks.echo_generator).select("query_id", "answer")


@register("generate_resumed", o.with_views("queries") + """
SELECT query_id, split_part(query, chr(10), 1) AS answer FROM queries""")
def q_generate_resumed(spark, sf):
    """M1 from stored answers: a second run finds every prompt answered."""
    q = _queries(spark, sf).select("query_id", tx.render_prompt({"context": F.lit(""), "query": "query"}).alias("prompt"))
    answers = store.ContentStore(spark, _written(spark, "answers"), "string")
    store.generate_resumable(q, "prompt", hooks.echo_generator, answers)
    return store.generate_resumable(q, "prompt", hooks.echo_generator, answers)[0].select("query_id", "answer")


@register("stored_vectors", o.with_views("letters") + """
SELECT doc_id, line_no, array_to_string(list_transform(e, lambda x: CAST(x AS BIGINT)), ',') AS vector FROM p_vec""")
def q_stored_vectors(spark, sf):
    """V1 by content: the queries' vectors are stored first, then the passages
    that are not among them, each distinct text once."""
    vectors = store.ContentStore(spark, _written(spark, "vectors"), "array<float>")
    store.embed_stored(_queries(spark, sf), "query", hooks.letter_encoder, vectors)
    got, _ = store.embed_stored(_passages(spark, sf), "passage", hooks.letter_encoder, vectors)
    return got.select("doc_id", "line_no", F.array_join(F.col("embedding").cast("array<bigint>"), ",").alias("vector"))


def _emb(spark, sf):
    """All vectors, and as queries those whose id is divisible by 20."""
    e = _t(spark, sf, "embeddings")
    return e, e.filter(F.col("vec_id") % 20 == 0)


@register("cosine_dense", o.with_views("dense") + "SELECT query_id, vec_id, round(score, 6) AS score FROM dense")
def q_cosine_dense(spark, sf):
    corpus, qs = _emb(spark, sf)
    return search.dense_scores(corpus, qs).select("query_id", "vec_id", round_score("score").alias("score"))


_DENSE_TOPK_SQL = o.with_views("dense") + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, round(score, 6) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, vec_id) AS rank
  FROM dense) WHERE rank <= {K}"""


@register("topk_dense", _DENSE_TOPK_SQL)
def q_topk_dense(spark, sf):
    corpus, qs = _emb(spark, sf)
    t = search.topk(search.dense_scores(corpus, qs, K), K, ["vec_id"])
    return t.select("query_id", _big(F.col("rank")).alias("rank"), "vec_id", "score")


@register("topk_dense_bounded", _DENSE_TOPK_SQL)
def q_topk_dense_bounded(spark, sf):
    """V2 and V3 from the cells of vectors that can hold a hit."""
    vectors, qs = _emb(spark, sf)
    t = cells.bounded_dense_topk(cells.cell_index(vectors), qs, K).hits
    return t.select("query_id", _big(F.col("rank")).alias("rank"), "vec_id", "score")


@register("semantic_search", _DENSE_TOPK_SQL)
def q_semantic_search(spark, sf):
    corpus, qs = _emb(spark, sf)
    out = jobs.semantic_search(corpus, qs, K)
    return out.select("query_id", _big(F.col("rank")).alias("rank"), "vec_id", "score")


@register("semantic_search_passages", o.with_views("letters") + """
SELECT DISTINCT query_id, corpus_passage, score FROM letter_hits""")
def q_semantic_search_passages(spark, sf):
    """P5 with an encoder (V1): letter counts, which the check can repeat."""
    return jobs.semantic_search_passages(_passages(spark, sf), _queries(spark, sf), hooks.letter_encoder, K)
