"""End-to-end jobs (P1-P5); the registered queries live in ``catalog``."""

from .jobs import (clean_corpus_job, clean_tokens_with_stopword_table, page_corpus, retrieve_and_prompt,
                   search_unique, semantic_search, semantic_search_passages, slide_corpus, turn_corpus)
