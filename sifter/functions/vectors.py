"""Vector column expressions (dense embeddings stored as ``ARRAY<FLOAT>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col

SCORE_DIGITS = 6  # scores are compared and ranked after rounding to this many digits


def as_double_array(col: ColumnOrName) -> Column:
    return _col(col).cast("array<double>")


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    prods = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Cosine similarity of two dense vectors of one row."""
    return dot(a, b) / (norm(a) * norm(b))


def round_score(col: ColumnOrName) -> Column:
    """Half-up rounding to ``SCORE_DIGITS`` digits in double arithmetic
    (``F.round`` goes through a decimal per value and costs about five times
    as much on millions of candidate scores)."""
    scale = float(10 ** SCORE_DIGITS)
    c = _col(col)
    return F.when(F.isnan(c), c).otherwise(F.floor(c * scale + 0.5) / scale)
