"""Positions within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_in_groups(df: DataFrame, groups: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: a row's position from 0 in its group, gapless, by bucket
    and then ``order``.

    A group of a third of all rows does not meet in one task: rows are ranked
    within (group, bucket), and the counts of the earlier buckets, one small
    row for each, are added. ``df`` is evaluated twice, so what the columns in
    ``groups`` and ``bucket`` come from must be repeatable.
    """
    df = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    ahead = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*keys, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return ranked.join(counts, keys).withColumn(name, F.col("_ahead") + F.col("_rank")).drop("_bucket", "_rank", "_ahead")
