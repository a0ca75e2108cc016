"""Column expressions (built-in Spark functions only)."""

from .tables import nth_table, page_key, page_text, table_to_text
from .text import (CORPUS_PROFILE, DEFAULT_PROMPT_TEMPLATE, RETRIEVAL_PROFILE, SLIDE_PROFILE_DE, SLIDE_PROFILE_OTHER,
                   chain_sub, clean_corpus_profile, clean_retrieval, clean_slide, clean_tokens_line, contains_ci,
                   cut_context, is_not_blank, mask_damaged, rejoin, remove_stopwords, render_prompt, strip,
                   template_variables, tokens)
from .vectors import cosine, dot, norm, round_score
