"""Context lookup: for each query's best passage, the first page (in file,
then page order) whose cleaned text contains it, case-insensitively; then the
context cut and the prompt.

The plan has equi joins only, at every size. A page that contains passage *p*
contains every *interior* token of *p* (not the first or last) as a whole
space-bounded token; the rarest one is the passage's anchor, joined with the
page tokens. A passage of one or two tokens has no interior token: its longest
token lies inside some page token, so it is looked up by its first characters
among the character grams of the *distinct* page tokens, and every page token
that holds it is an anchor. Candidate pages are then verified with
``contains``. ``method="nested"`` tests every page instead (a brute-force
check).

The first page per query is a minimum over the page keys alone, so a passage
found on a third of all pages collapses map-side; the text of that one page is
joined afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_CONTEXT_SKIP, DEFAULT_PROMPT_TEMPLATE, clean_retrieval, cut_context, fold_case, render_prompt
from ..session import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS


def prepare_pages(pages: DataFrame, text_col: str = "page_raw", order: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """``(order..., context, page_lc)``: retrieval profile on the whole page
    (newlines deleted, so lines glue) and its lower-cased form for matching."""
    clean = clean_retrieval(F.col(text_col))
    return pages.select(*order, clean.alias("context")).withColumn("page_lc", fold_case(F.col("context")))


def _first_page(matches: DataFrame, pages: DataFrame, order: Sequence[str]) -> DataFrame:
    first = matches.groupBy("query_id").agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_m"))
    first = first.select("query_id", *[F.col(f"_m.{c}").alias(c) for c in order])
    return first.join(pages.select(*order, "context"), list(order))


def _hint(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _nested_matches(best: DataFrame, pages: DataFrame, order: Sequence[str], small: bool) -> DataFrame:
    b = _hint(best.select("query_id", "_p_lc"), small)
    return pages.join(b, F.contains(F.col("page_lc"), F.col("_p_lc"))).select("query_id", *order)


def page_terms(pages: DataFrame, order: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """``(order..., term)``: each page's distinct space-separated tokens of
    its lower-cased cleaned text (the page side of the anchor join)."""
    return pages.select(*order, F.explode(F.array_distinct(F.split(F.col("page_lc"), " ", -1))).alias("term"))


def page_term_index(pages: DataFrame, order: Sequence[str] = ("doc_id", "page_no")) -> tuple[DataFrame, DataFrame]:
    """``(page_terms, page_term_df)`` written once per corpus version under
    the checkpoint folder, so query batches reuse them: the page tokens and
    the number of pages holding each token (a partial aggregate on term)."""
    from ..session import materialise

    pt = materialise(page_terms(pages, order), "page_terms")
    ptdf = materialise(pt.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "page_term_df")
    return pt, ptdf


#: Longest character gram by which a short passage finds the page tokens that hold it.
GRAM = 3


def _piece() -> Column:
    """The longest token of a passage."""
    return F.element_at(F.array_sort(F.transform("_toks", lambda t: F.struct(F.length(t).alias("n"), t.alias("t")))), -1)["t"]


def _grams(n: int) -> Column:
    """The runs of ``n`` characters of ``term``."""
    if n == 0:
        return F.array(F.lit(""))
    starts = F.sequence(F.lit(1), F.greatest(F.length("term") - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.substring(F.col("term"), i, n))


def _short_anchors(short: DataFrame, vocabulary: DataFrame, small: bool, lengths: list[int]) -> DataFrame:
    """``(query_id, _p_lc, term)``: every distinct page token that holds the
    longest token of a passage of one or two tokens. ``lengths`` are those of
    the wanted grams; only such grams are cut from the vocabulary."""
    wanted = short.select("query_id", "_p_lc", _piece().alias("_piece")).withColumn("gram", F.substring("_piece", 1, GRAM))
    # the empty gram belongs to every token: an empty passage is on every page
    held = vocabulary.select("term", F.explode(F.array_distinct(F.concat(*map(_grams, lengths)))).alias("gram"))
    return held.join(_hint(wanted, small), "gram").where(F.contains(F.col("term"), F.col("_piece"))).select("query_id", "_p_lc", "term")


def _anchors(b: DataFrame, vocabulary: DataFrame, small: bool, lengths: list[int]) -> DataFrame:
    """``(query_id, _p_lc, term)``: the page tokens by which each passage finds
    its candidate pages. The vocabulary is cut into grams only if there is a
    short passage."""
    interior = b.where(F.size("_toks") >= 3).select(
        "query_id", "_p_lc",
        F.explode(F.array_distinct(F.slice(F.col("_toks"), 2, F.size(F.col("_toks")) - 2))).alias("term"))
    wanted = interior.select("term").distinct()
    term_df = vocabulary.join(_hint(wanted, small), "term", "left_semi")
    # rarest interior token per passage, ties by the token; a token found on
    # no page (df 0) means no page can contain the passage
    ranked = interior.join(_hint(term_df, small), "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarest = ranked.groupBy("query_id", "_p_lc").agg(F.min(F.struct("df", "term")).alias("_a")).select(
        "query_id", "_p_lc", F.col("_a.term").alias("term"))
    if not lengths:
        return rarest
    return rarest.unionByName(_short_anchors(b.where(F.size("_toks").between(1, 2)), vocabulary, small, lengths))


def _folded(needles: DataFrame, text_col: str) -> DataFrame:
    return needles.select("query_id", fold_case(F.col(text_col)).alias("_p_lc")).withColumn(
        "_toks", F.split(F.col("_p_lc"), " ", -1)).where(F.col("_p_lc").isNotNull())


def _stats(b: DataFrame, max_broadcast_rows: int) -> tuple[bool, list[int]]:
    """Whether the frames that the passages bound may be broadcast, and the
    lengths of the short passages' grams."""
    # one pass over the query-sized table: its count, tokens and text bound
    # everything derived from it
    gram_length = F.least(F.length(_piece()), F.lit(GRAM))
    s = b.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("_toks")), F.lit(0)).alias("t"),
              F.coalesce(F.sum(F.octet_length("_p_lc")), F.lit(0)).alias("bytes"),
              F.sort_array(F.collect_set(F.when(F.size("_toks") < 3, gram_length))).alias("lengths")).first()
    return max(s["n"], s["t"]) <= max_broadcast_rows and s["bytes"] <= DEFAULT_BROADCAST_BYTES, s["lengths"]


def containing(needles: DataFrame, pages: DataFrame, passage_col: str, order: Sequence[str] = ("doc_id", "page_no"),
               method: str = "anchor", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               page_index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``(query_id, order...)``: every page whose ``page_lc`` contains the
    needle, ignoring case (F2). Null needles match nothing, an empty one
    matches every page."""
    order = list(order)
    b = _folded(needles, passage_col)
    small, lengths = _stats(b, max_broadcast_rows)
    if method == "nested":
        return _nested_matches(b, pages, order, small)
    if method != "anchor":
        raise ValueError(f"unknown method {method!r}")
    if page_index is None:  # unwritten: the wanted terms filter the page tokens before they are counted
        pterms = page_terms(pages, order)
        page_index = pterms, pterms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    pterms, vocabulary = page_index
    anchors = _hint(_anchors(b, vocabulary, small, lengths), small and not lengths)
    # a short passage can meet one page through several of its tokens
    cand = pterms.join(anchors, "term").select("query_id", *order, "_p_lc").distinct()
    return (pages.select(*order, "page_lc").join(cand, order)
            .filter(F.contains(F.col("page_lc"), F.col("_p_lc"))).select("query_id", *order))


def find_context(best: DataFrame, pages: DataFrame, passage_col: str = "best_match",
                 order: Sequence[str] = ("doc_id", "page_no"), method: str = "anchor",
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 page_index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``(query_id, order..., context)`` with the first page containing the
    passage; queries without such a page get nulls (left join).

    ``pages`` must carry ``order`` columns (unique per page), ``context``
    (cleaned page text) and ``page_lc`` (its folded case), as made by
    ``prepare_pages``. ``best`` should be materialised by the caller: it is
    counted once to decide whether the frames it bounds (its tokens) are
    broadcast; above the bound the planner's shuffle joins are used.
    ``page_index`` takes the ``page_term_index`` of the same pages, built once
    and reused; without it the page tokens are taken from the pages here."""
    matches = containing(best, pages, passage_col, order, method, max_broadcast_rows, page_index)
    found = _first_page(matches, pages, list(order)).select("query_id", *order, "context")
    return best.select("query_id").join(found, "query_id", "left")


def prompts(found: DataFrame, queries: DataFrame, query_id_col: str = "query_id", query_col: str = "query",
            skip: int = DEFAULT_CONTEXT_SKIP, template: str = DEFAULT_PROMPT_TEMPLATE) -> DataFrame:
    """Cut the context and render the prompt per query."""
    q = queries.select(F.col(query_id_col).alias("query_id"), F.col(query_col).alias("_query"))
    ctx = cut_context(F.col("context"), skip)
    return found.join(q, "query_id").withColumn("prompt", render_prompt({"context": ctx, "query": F.col("_query")},
                                                                        template)).drop("_query")
