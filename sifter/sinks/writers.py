"""Sinks: per-document text, corpus text files, page/slide dictionaries as
JSON lines and the result CSV. All are DataFrame writers; order inside a
file comes from stored keys, never from scan order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import write_folders


def write_per_document(pages: DataFrame, path: str, file_col: str = "doc_id", order: Sequence[str] = ("page_no",),
                       text_col: str = "text") -> None:
    """K1: one folder per document (``file=<key>``) holding its page texts,
    one per line, in page order. Range partitioning on (file, page) lets a
    very large document span several tasks, whose part files follow each
    other in page order."""
    write_folders(pages, path, file_col, order, text_col)


def write_corpus(lines: DataFrame, path: str, order: Sequence[str], text_col: str = "line") -> None:
    """K2/K3/K4/K7: all files' lines into one corpus, in key order (range
    partitioned, so part files follow each other in order and no task holds
    the whole corpus)."""
    (lines.select(*order, text_col)
     .repartitionByRange(*order)
     .sortWithinPartitions(*order)
     .select(F.col(text_col).alias("value"))
     .write.mode("overwrite").text(path))


def write_page_dict(nested: DataFrame, path: str, file_col: str = "doc_id", value_col: str = "pages") -> None:
    """K5: one JSON object ``{file: {"Page_n": record}}`` (or ``{file:
    [part, ...]}`` for slides) per file and line, parse-equal for any
    language, in file order (range partitioned)."""
    obj = F.to_json(F.create_map(F.col(file_col).cast("string"), F.col(value_col)))
    (nested.select(file_col, obj.alias("value")).repartitionByRange(file_col).sortWithinPartitions(file_col)
     .select("value").write.mode("overwrite").text(path))


def write_result_csv(result: DataFrame, path: str, columns: Sequence[str] = ("corpus_passage", "score")) -> None:
    """K6: result table as CSV with a header, overwritten each run. Quotes are
    doubled and blanks at the ends kept, as common CSV readers expect."""
    (result.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
