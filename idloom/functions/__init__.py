"""Column-level helpers; all are built-in Spark expressions (codegen, no UDF)."""

from idloom.functions.text import clean_lower, clean_text, blank_to_null, least_non_null
from idloom.functions.casts import cast_to, SPARK_TYPES
from idloom.functions.keys import md5_key, surrogate_key, email_key

__all__ = ["clean_lower", "clean_text", "blank_to_null", "least_non_null", "cast_to",
           "SPARK_TYPES", "md5_key", "surrogate_key", "email_key"]
