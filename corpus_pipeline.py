"""Corpus pipeline: ``documents`` to clean, deduplicated token ids.

``STAGES`` are ``(name, function)``; each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm import decontaminate, language_id, line_dedup, sentencepiece_codec, simhash_dedup
from sifter.llm._common import learnable
from sifter.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if no language is found or the best has no more than this.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language; others pass unchanged."""
    model = language_id.train_language_id(docs.where(learnable(F.col("doc_id"))))
    got = language_id.identify(docs, model, lang_out="__lang", score_out="__score")
    return got.where((F.col("__lang") != language_id.UNKNOWN) & (F.col("__score") > MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated passages out of the texts; ``n_chars`` follows."""
    got = line_dedup.line_dedup(docs)
    return got.withColumn("n_chars", F.when(F.col("__removed_lines") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one document of each group of near copies."""
    return simhash_dedup.simhash_dedup(docs, shingle=3, radius=3).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32, round_trip."""
    return sentencepiece_codec.round_trip(docs.select("doc_id", "text"), sentencepiece_codec.model_path()).drop("text")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontaminate", drop_benchmark),
    ("sentencepiece", tokenize),
]

#: The stages train, hash and encode; SQL can't express them (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and
    read again."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sifter-pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
