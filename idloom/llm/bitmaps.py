"""Which 64-bit hashes occur in a table, as a bitmap of bounded size that tasks
test before they send a row: no hash of the table is ever refused, and others
mostly are as long as the table has fewer rows than the bitmap has bits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB: at most 2^18 rows of 64 bits reach the driver, whatever the input.
BITS = 24


def occurring(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of the values of ``column`` (long), 2^bits bits."""
    place = df.select(F.shiftrightunsigned(column, 64 - bits).alias("place"))
    masks = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("mask"))
    got = masks.toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64)
    return out.view(np.uint64)


def found(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """For each hash (uint64), whether it may occur."""
    place = hashed >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
