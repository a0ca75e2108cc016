"""End-to-end jobs (P1-P5), each a chain of the operators, DataFrame in and
DataFrame out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (DEFAULT_CONTEXT_SKIP, DEFAULT_PROMPT_TEMPLATE, clean_corpus_profile, clean_slide,
                              clean_tokens_line, is_not_blank, strip, tokens)
from ..operators.context import find_context, prepare_pages, prompts
from ..operators.layout import assemble_pages, with_page_text
from ..operators.search import (DEFAULT_K, TfidfIndex, best_match, dedupe_hits, dense_scores, search_passages,
                                topk, validate_passages)
from ..session import DEFAULT_BROADCAST_ROWS, bounded_broadcast, materialise, materialise_bucketed
from ..sources.fixtures import clean_passages, doc_lines


# Most stopwords of a table that are filtered in the row.
MAX_INLINE_STOPWORDS = 10_000


def make_passages(documents: DataFrame) -> DataFrame:
    """``(doc_id, line_no, passage)``: cleaned, non-blank lines; keys of any type."""
    return clean_passages(doc_lines(documents)).select("doc_id", "line_no", "passage")


def _materialise(df: DataFrame, on: bool, name: str = "table", bucket_key: str | list[str] | None = None) -> DataFrame:
    """Parquet table under the session's checkpoint folder (lineage cut,
    survives executor loss, computed once); bucketed on ``bucket_key`` when
    given, so later work keyed on it needs no exchange."""
    if not on:
        return df
    return materialise_bucketed(df, bucket_key, name=name) if bucket_key else materialise(df, name)


def retrieve_and_prompt(documents: DataFrame, queries: DataFrame, k: int = DEFAULT_K, method: str = "anchor",
                        skip: int = DEFAULT_CONTEXT_SKIP, template: str = DEFAULT_PROMPT_TEMPLATE,
                        query_id_col: str = "query_id", query_col: str = "query",
                        materialise: bool = True, passages: DataFrame | None = None,
                        index: TfidfIndex | None = None, pages: DataFrame | None = None,
                        generator_factory=None, page_index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Split documents into passages, clean them, score every query
    against every passage (TF-IDF cosine), keep the top k, take the best match, find the first page that contains it and render the
    prompt. ``(query_id, best_match, score, doc_id, page_no, prompt)``; a
    query whose best passage is on no page keeps null page and prompt, and one
    that shares no term with any passage keeps nulls throughout.

    ``passages``/``index``/``pages`` take corpus tables built earlier from the
    same documents (reused across query batches); missing ones are built.
    ``pages`` is a page table ``(doc_id, page_no, text)``, such as P2 or a page
    dictionary gives, or one that ``prepare_pages`` made; without it every
    document is one page.
    ``page_index`` (``page_term_index`` of the pages) serves the anchor plan.
    With ``generator_factory`` (M1) an ``answer`` column is added by the
    caller's model, one model per Python worker; null prompts stay
    unanswered."""
    q = queries.select(F.col(query_id_col).alias("query_id"), F.col(query_col).alias("query"))
    psg = passages if passages is not None else _materialise(make_passages(documents), materialise, "passages", ["doc_id", "line_no"])
    hits, _ = search_passages(psg, q, k, index=index)
    best = _materialise(best_match(hits), materialise, "best")
    if pages is None:
        pages = documents.select("doc_id", F.lit(0).cast("bigint").alias("page_no"), "text")
    if "page_lc" not in pages.columns:
        pages = _materialise(prepare_pages(pages, "text"), materialise, "pages")
    found = find_context(best, pages, method=method, page_index=page_index)
    out = prompts(found, q, skip=skip, template=template)
    result = q.select("query_id").join(best, "query_id", "left").join(out, "query_id", "left").select("query_id", "best_match", "score", "doc_id", "page_no", "prompt")
    if generator_factory is not None:
        from ..operators.hooks import generate

        result = generate(result, "prompt", generator_factory)
    return result


def search_unique(documents: DataFrame, queries: DataFrame, k: int = DEFAULT_K, materialise: bool = True,
                  passages: DataFrame | None = None, index: TfidfIndex | None = None) -> DataFrame:
    """Top-k per query, then duplicate (passage, score) rows dropped."""
    psg = passages if passages is not None else _materialise(make_passages(documents), materialise, "passages", ["doc_id", "line_no"])
    hits, _ = search_passages(psg, queries, k, index=index)
    return dedupe_hits(hits)


def page_corpus(elements: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no"), multi_table: bool = False) -> DataFrame:
    """The caller's layout elements (``operators.layout``) -> page records
    -> page text per page, ``(file, page_no, page_key, text)``."""
    pages = with_page_text(assemble_pages(elements, page_keys, multi_table))
    return pages.select(*page_keys, "page_key", "text")


def turn_corpus(parts: DataFrame, file_col: str = "conv_id", order: Sequence[str] = ("turn",),
                text_col: str = "text", lang: str | None = "en") -> DataFrame:
    """P3 (slide corpus) over ordered parts: slide profile per part (skipped
    for ``lang=None``, text already cleaned), strip, drop blank lines.
    ``(file, order..., line)``."""
    text = F.col(text_col) if lang is None else clean_slide(F.col(text_col), lang)
    cleaned = parts.select(file_col, *order, strip(text).alias("line"))
    return cleaned.filter(is_not_blank(F.col("line")))


def slide_corpus(shapes: DataFrame, lang: str = "de") -> tuple[DataFrame, DataFrame, DataFrame]:
    """P3 over extracted shapes ``(file, slide_no, shape_ix, text[, error])``:
    returns ``(nested, raw, clean)`` - the slide dictionary (L12, for K5), the
    raw corpus of cleaned shape texts (K3) and the clean corpus with stripped,
    non-blank lines (K4)."""
    from ..operators.layout import nest_parts
    from ..sources.slides import drop_unreadable

    good = drop_unreadable(shapes) if "error" in shapes.columns else shapes
    raw = good.select("file", "slide_no", "shape_ix", clean_slide(F.col("text"), lang).alias("line"))
    nested = nest_parts(raw, "file", ["slide_no", "shape_ix"], "line")
    clean = turn_corpus(raw, "file", ("slide_no", "shape_ix"), "line", lang=None)
    return nested, raw, clean


def clean_tokens_with_stopword_table(lines: DataFrame, stopwords: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"),
                                     line_col: str = "line", word_col: str = "word",
                                     terminated: bool | Column = True,
                                     max_inline: int = MAX_INLINE_STOPWORDS) -> DataFrame:
    """T7-T10 with the stopword list as a table (J4). Up to ``max_inline``
    words are filtered in the row. Beyond, each line's distinct tokens meet the
    table in a semi join, only the words found move on (one small set per line
    that holds any), and the line drops them in the row. Damaged tokens are
    exempt and masked. ``(keys..., line)``, the same rows as
    ``clean_tokens_line`` with a list."""
    words = stopwords.select(F.col(word_col).alias("tok")).filter(F.col("tok").isNotNull()).distinct()
    head = [r["tok"] for r in words.limit(max_inline + 1).collect()]
    if len(head) <= max_inline:
        return lines.select(*keys, clean_tokens_line(F.col(line_col), head, terminated).alias("line"))
    # the terminator adds an empty token, so the words are sought as the line is cut
    end = F.when(terminated, F.lit("\n")).otherwise(F.lit("")) if isinstance(terminated, Column) else F.lit("\n" if terminated else "")
    toks = F.array_distinct(tokens(F.concat(F.col(line_col), end)))
    found = (lines.select(*keys, F.explode(toks).alias("tok")).join(bounded_broadcast(words), "tok", "left_semi")
             .groupBy(*keys).agg(F.collect_set("tok").alias("_found")))
    listed = F.coalesce(F.col("_found"), F.array().cast("array<string>"))
    return lines.join(found, list(keys), "left").select(
        *keys, clean_tokens_line(F.col(line_col), listed, terminated).alias("line"))


def clean_corpus_job(lines: DataFrame, stopwords: list[str] | None = None, apply_profile: bool = True,
                     keys: Sequence[str] = ("doc_id", "line_no"), line_col: str = "line",
                     terminated: bool | Column = True) -> DataFrame:
    """Tokenise each line (as read, with its terminator), mask damaged
    tokens, drop stopwords, rejoin, then the corpus profile. With
    ``apply_profile=False`` the profile is skipped, as the original wrote.
    ``terminated`` says (per line, if a column) that the terminator was there."""
    joined = clean_tokens_line(F.col(line_col), stopwords, terminated)
    out = clean_corpus_profile(joined) if apply_profile else joined
    return lines.select(*keys, out.alias("line"))


def semantic_search(corpus: DataFrame, queries: DataFrame, k: int = DEFAULT_K, key_col: str = "vec_id",
                    vec_col: str = "embedding", query_id_col: str = "vec_id",
                    query_vec_col: str = "embedding") -> DataFrame:
    """P5 over supplied vectors: exact cosine, top-k per query (ties by key),
    ``(query_id, rank, key, score)``."""
    scores = dense_scores(corpus, queries, k, key_col, vec_col, query_id_col, query_vec_col)
    return topk(scores, k, [key_col]).select("query_id", "rank", key_col, "score")


def semantic_search_passages(passages: DataFrame, queries: DataFrame, encoder_factory, k: int = DEFAULT_K,
                             keys: Sequence[str] = ("doc_id", "line_no"), text_col: str = "passage",
                             query_id_col: str = "query_id", query_col: str = "query",
                             corpus_vectors: DataFrame | None = None) -> DataFrame:
    """The original's semantic search with a model: embed passages and
    queries with the caller's encoder (V1), exact cosine top-k (V2, V3), hit
    text (V4), duplicate rows dropped (V6): ``(query_id, corpus_passage,
    score)``. The corpus vectors are written once (pass ``corpus_vectors``
    to reuse them across query batches); only queries are encoded per run."""
    from ..operators.hooks import embed
    from ..operators.search import attach_passages

    keys = list(keys)
    validate_passages(passages, text_col)
    vecs = corpus_vectors if corpus_vectors is not None else materialise(
        embed(passages.select(*keys, text_col), text_col, encoder_factory).drop(text_col), "passage_vectors")
    # written too: the model runs once per query, and the count comes from the files
    qv = materialise(embed(queries.select(F.col(query_id_col).alias("query_id"), F.col(query_col).alias("query")),
                           "query", encoder_factory), "query_vectors")
    scores = dense_scores(vecs, qv, k, keys, "embedding", "query_id", "embedding")
    hits = topk(scores, k, keys)
    hits_small = qv.count() * k <= DEFAULT_BROADCAST_ROWS
    return dedupe_hits(attach_passages(hits, passages, keys, text_col, hits_small=hits_small))


__all__ = ["semantic_search_passages", "retrieve_and_prompt", "search_unique", "page_corpus", "turn_corpus", "slide_corpus", "clean_corpus_job",
           "semantic_search", "validate_passages"]
