"""DataFrame operators: page assembly, search, context lookup, model hooks."""

from .context import find_context, page_term_index, page_terms, prepare_pages, prompts
from .hooks import embed, generate, rerank
from .layout import (assemble_pages, classify, corpus_union, first_per_key, mark_table_suppression, nest_pages,
                     nest_parts, order_elements, text_formats, with_page_text)
from .search import (TfidfIndex, attach_passages, best_match, dedupe_hits, dense_scores, search_passages,
                     sparse_scores, tfidf_index, topk, validate_passages)
