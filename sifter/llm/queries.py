"""The registered queries of this subpackage and their DuckDB SQL.

Queries without SQL train a model, hash with functions DuckDB lacks or call a
tokenizer; ``tests/llm`` holds them against brute force, round trips or
held-out accuracy."""

from __future__ import annotations

import corpus_pipeline
from sifter.llm import (centroid_clustering, chat_format, conversation_repair, decontaminate, language_id, line_dedup, line_quality, pseudo_likelihood,
                        quality_classifier, sentencepiece_codec, simhash_dedup, token_counts, token_store)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_simhash_dedup": simhash_dedup.op2_simhash_dedup,
    "op3_token_store": token_store.op3_token_store,
    "op4_line_quality": line_quality.op4_line_quality,
    "op5_quality_classifier": quality_classifier.op5_quality_classifier,
    "op6_sentencepiece": sentencepiece_codec.op6_sentencepiece,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_pseudo_likelihood": pseudo_likelihood.op8_pseudo_likelihood,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_centroid_clustering": centroid_clustering.op13_centroid_clustering,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op4_line_quality": line_quality.ORACLE,
    "op7_chat_format": chat_format.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
    "op13_centroid_clustering": centroid_clustering.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
