"""Text normalisation used by every staging model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """``nullif(x, '')``."""
    x = _c(x)
    return F.when(x != F.lit(""), x)


def clean_text(x) -> Column:
    """``nullif(trim(x), '')``. ``trim`` removes ASCII spaces only; tabs and
    other whitespace are kept, as in the source warehouse."""
    return blank_to_null(F.trim(_c(x).cast("string")))


def clean_lower(x) -> Column:
    """``lower(nullif(trim(x), ''))``."""
    return F.lower(clean_text(x))


def least_non_null(a, b) -> Column:
    """Smaller of two values ignoring NULLs; NULL only when both are NULL.
    (Spark's ``least`` already skips NULLs.)"""
    return F.least(_c(a), _c(b))
