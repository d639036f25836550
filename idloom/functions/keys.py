"""Deterministic keys.

``concat`` is NULL when any part is NULL, so every key coalesces its parts
first; ``concat_ws`` (which skips NULLs) is never used in keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def md5_key(*parts, sep: str = "|") -> Column:
    """``md5(coalesce(p1,'') || sep || coalesce(p2,'') || ...)`` as 32 hex chars."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(F.coalesce(_c(p).cast("string"), F.lit("")))
    return F.md5(F.concat(*cols))


def surrogate_key(natural, fallback_text, prefix: str = "h_") -> Column:
    """``coalesce(natural, prefix || md5(fallback_text))``."""
    return F.coalesce(_c(natural).cast("string"),
                      F.concat(F.lit(prefix), F.md5(_c(fallback_text))))


def email_key(tiktok_id, email, style: str = "md5") -> Column:
    """Key of a (creator, email) pair.

    The source warehouse used a vendor 64-bit hash whose values cannot be
    reproduced elsewhere. "md5" is portable (same hex in any SQL engine) and
    128-bit, so collisions stay negligible at billions of rows. "int64" keeps
    the positive-integer-text shape of the original with ``xxhash64``; the
    absolute value is taken as decimal so Long.MIN_VALUE cannot overflow.
    """
    if style == "md5":
        return F.md5(F.concat(F.coalesce(_c(tiktok_id), F.lit("")), F.lit("|"),
                              F.coalesce(_c(email), F.lit(""))))
    if style == "int64":
        h = F.xxhash64(F.coalesce(_c(tiktok_id), F.lit("")), F.lit("|"),
                       F.coalesce(_c(email), F.lit("")))
        return F.abs(h.cast("decimal(20,0)")).cast("string")
    raise ValueError(f"unknown key style {style!r}")
