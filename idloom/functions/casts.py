"""Typed casts with an explicit strict / lenient mode.

Strict mode is Spark's own cast in an ANSI session: a value that is not NULL
but cannot be converted raises an error naming the value. ``require_ansi``
refuses sessions where the cast would give NULL. Lenient mode returns NULL
instead (``try_cast``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names used by the staging models and their
# Spark types ("number" without precision is NUMBER(38,0)).
SPARK_TYPES = {
    "varchar": "string",
    "number": "decimal(38,0)",
    "float": "double",
    "timestamp_ntz": "timestamp_ntz",
    "date": "date",
    "boolean": "boolean",
}

_FLOATING = (T.FloatType, T.DoubleType)


def _bool_words(x: Column) -> Column:
    # The warehouse also accepts on/off as booleans; Spark does not.
    w = F.lower(F.trim(x))
    return F.when(w == "on", F.lit("true")).when(w == "off", F.lit("false")).otherwise(x)


def require_ansi(df: DataFrame, mode: str) -> None:
    """Strict casts need the session's ANSI mode (Spark's default)."""
    if mode == "strict" and str(df.sparkSession.conf.get("spark.sql.ansi.enabled")).lower() != "true":
        raise ValueError("strict casts need spark.sql.ansi.enabled=true; use cast_mode='lenient' without it")


def cast_to(x: Column, wtype: str, mode: str = "strict", source_type: T.DataType | None = None) -> Column:
    """Cast ``x`` to the Spark type of warehouse type ``wtype``."""
    target = SPARK_TYPES[wtype]
    if wtype == "boolean" and (source_type is None or isinstance(source_type, T.StringType)):
        x = _bool_words(x.cast("string"))
    if source_type is not None and target == source_type.simpleString():
        return x
    if mode == "lenient":
        return x.try_cast(target)
    if mode != "strict":
        raise ValueError(f"unknown cast mode {mode!r}")
    return x.cast(target)


def types_by_name(df: DataFrame) -> dict[str, T.DataType]:
    """Column types by lower-cased name: names match in any case."""
    return {f.name.lower(): f.dataType for f in df.schema.fields}


def check_not_floating(name: str, dtype: T.DataType) -> None:
    """Ids must not arrive as floating point: their text form would be
    scientific notation (1.2345E18) and silently lose digits."""
    if isinstance(dtype, _FLOATING):
        raise TypeError(f"id column {name!r} has floating type {dtype.simpleString()}")
