"""Column expressions over detected tables and page records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col

NULL_CELL = "None"  # how a missing cell is written


def table_to_text(table: ColumnOrName) -> Column:
    """``ARRAY<ARRAY<STRING>>`` -> ``|a|b|`` rows joined by newlines.

    A null cell prints as ``None``, a newline inside a cell becomes a space,
    an empty table gives ``''`` and an empty row gives ``||``."""
    def row_text(row: Column) -> Column:
        cells = F.transform(row, lambda c: F.coalesce(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit(NULL_CELL)))
        return F.concat(F.lit("|"), F.array_join(cells, "|"), F.lit("|"))

    return F.array_join(F.transform(_col(table), row_text), "\n")


def nth_table(tables: ColumnOrName, n: int | Column) -> Column:
    """0-based table of a page; null when the page has fewer tables."""
    return F.get(_col(tables), n)


def page_text(page_content: ColumnOrName) -> Column:
    """Text of a page: its content parts concatenated without separator."""
    return F.array_join(_col(page_content), "")


def page_key(page_no: ColumnOrName) -> Column:
    """Dictionary key of a page, ``Page_<n>`` with ``n`` from 0."""
    return F.concat(F.lit("Page_"), _col(page_no).cast("string"))
