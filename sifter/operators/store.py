"""Results of a model kept by content: V1 vectors that are computed once per text,
and M1 answers that resume.

A store is a folder of batches. A row is the SHA-256 of a text, the text itself and
the value; a text is looked up by both, so two texts of one digest could not change
places. Only texts that the store lacks go to the model, each once however often it
stands in the table. Texts are joined as they are, so a text moves alone and its digest
is made where it arrives; a stored text whose digest is another's is no match. Missing
texts are written once, in files of a small share of ``GROUP_ROWS``; some files are a group;
each group is one Spark job, written to a folder of its own and then named in the
list of committed batches. A run that breaks keeps its committed groups: the next
finds them by the anti join and goes on with the rest. A folder that was never
named is not read. One run writes to a store at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..session import ensure_checkpoint_dir
from .hooks import Encoder, Generator, _model, _pickled, vector_lists

#: Texts of one commit.
GROUP_ROWS = 1_000_000
#: Files that the texts of a full group are written to, at least.
FILES_OF_A_GROUP = 16
#: Words of a batch of prompts, each counted as long as the longest.
WORD_BUDGET = 16_384


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256)


@dataclass
class ContentStore:
    """A folder that all executors reach, and the SQL type of its values."""

    spark: SparkSession
    path: str
    value_type: str

    def batches(self) -> list[str]:
        """Names of the committed batches, one a commit."""
        try:
            got = self.spark.read.schema("batch string").parquet(f"{self.path}/committed").distinct().collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["batch"] for r in got)

    def rows(self) -> DataFrame:
        """``(digest, text, value)`` of every committed text."""
        schema = f"digest string, text string, value {self.value_type}"
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/batches/{n}" for n in names])

    def missing(self, texts: DataFrame) -> DataFrame:
        """``(digest, text)``: the distinct non-null texts that the store lacks."""
        wanted = texts.where(F.col("text").isNotNull()).select("text").distinct()
        return wanted.join(self._sound().select("text"), "text", "left_anti").select(_digest().alias("digest"), "text")

    def _sound(self) -> DataFrame:
        """``(text, value)`` of the rows that stand under their text's digest."""
        return self.rows().where(F.col("digest") == _digest()).select("text", "value")

    def commit(self, rows: DataFrame) -> None:
        """Add ``(digest, text, value)`` rows: all of them or none."""
        name = uuid.uuid4().hex
        rows.select("digest", "text", F.col("value").cast(self.value_type).alias("value")).write.parquet(f"{self.path}/batches/{name}")
        self.spark.range(1).select(F.lit(name).alias("batch")).write.mode("append").parquet(f"{self.path}/committed")

    def fill(self, texts: DataFrame, compute: Callable[[DataFrame], DataFrame], group_rows: int = GROUP_ROWS) -> int:
        """Add the values of the texts that the store lacks, ``compute`` taking
        ``(digest, text)`` rows; returns how many there were."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/sifter-tables/missing-{uuid.uuid4().hex}"
        self.missing(texts).write.option("maxRecordsPerFile", max(1, group_rows // FILES_OF_A_GROUP)).parquet(path)
        todo = self.spark.read.schema("digest string, text string").parquet(path)
        # rows of each file, from the footers; a group reads its own files only
        files = sorted((f"{path}/{r['name']}", r["n"]) for r in todo.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).collect())
        groups: list[list[str]] = []
        rows = 0
        for name, n in files:
            if not groups or rows + n > group_rows:
                groups.append([])
                rows = 0
            groups[-1].append(name)
            rows += n
        for names in groups:
            self.commit(compute(self.spark.read.schema("digest string, text string").parquet(*names)))
        return sum(n for _, n in files)

    def look_up(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        """``df`` with the stored value of each row's text; null for a null text."""
        kept = self._sound().select(F.col("text").alias("_text"), F.col("value").alias(out_col))
        return df.join(kept, F.col(text_col) == F.col("_text"), "left").select(*[df[c] for c in df.columns], out_col)


def embed_stored(df: DataFrame, text_col: str, encoder_factory: Callable[[], Encoder], store: ContentStore, out_col: str = "embedding",
                 group_rows: int = GROUP_ROWS) -> tuple[DataFrame, int]:
    """V1 with stored vectors: ``df`` with ``out_col``, and the number of texts
    that had to be encoded. A null text has a null vector."""
    factory = _pickled(encoder_factory)

    def compute(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    vectors = np.asarray(_model(factory)(batch.column("text").to_pylist()), np.float32)
                    yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("text"), vector_lists(vectors)], names=["digest", "text", "value"])

        return rows.select("digest", "text").mapInArrow(run, "digest string, text string, value array<float>")

    n = store.fill(df.select(F.col(text_col).alias("text")), compute, group_rows)
    return store.look_up(df, text_col, out_col), n


def like_length_batches(batches: Iterator[pd.DataFrame], budget: int) -> Iterator[pd.DataFrame]:
    """Rows in order of ``words``, cut where a batch padded to its longest row
    would pass ``budget`` words; a longer row is a batch of its own."""
    left = None
    for pdf in batches:
        pdf = pdf if left is None or left.empty else pd.concat([left, pdf], ignore_index=True)
        words, first = np.maximum(pdf["words"].to_numpy(), 1), 0
        for i in range(len(pdf)):
            if i > first and (i - first + 1) * words[i] > budget:
                yield pdf.iloc[first:i]
                first = i
        left = pdf.iloc[first:]
    if left is not None and not left.empty:
        yield left


def generate_resumable(df: DataFrame, prompt_col: str, generator_factory: Callable[[], Generator], store: ContentStore, out_col: str = "answer",
                       group_rows: int = GROUP_ROWS, word_budget: int = WORD_BUDGET) -> tuple[DataFrame, int]:
    """M1 that resumes: ``df`` with ``out_col``, and the number of prompts that
    were answered by this run. Prompts of like length share a batch. A null
    prompt has a null answer; equal prompts have one answer."""
    factory = _pickled(generator_factory)

    def compute(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in like_length_batches(batches, word_budget):
                yield pdf[["digest", "text"]].assign(value=list(_model(factory)(pdf["text"].tolist())))

        words = F.size(F.split(F.col("text"), f"{WS_CLASS}+", -1)).alias("words")
        ordered = rows.select("digest", "text", words).repartitionByRange("words", "digest").sortWithinPartitions("words", "digest")
        return ordered.mapInPandas(run, "digest string, text string, value string")

    n = store.fill(df.select(F.col(prompt_col).alias("text")), compute, group_rows)
    return store.look_up(df, prompt_col, out_col), n
