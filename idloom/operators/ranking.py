"""Positions in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idloom.session import materialize


def with_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with ``name``: each row's place from 1 in ``order``, gapless.

    Rows go to range partitions, written once so that the partitions stay what
    they are; ranks within a partition plus the sizes of those before it (one
    row for each partition) are the positions. Rows that tie in ``order`` go by
    their other columns, NULLs last; equal rows are interchangeable, and split
    between partitions, so that they may be any share of the table.
    """
    columns = df.columns
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in columns]
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order, *ties, F.col("_row"))
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "range-parts")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row for each partition
    ahead = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", ahead.alias("_ahead"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order, *ties, "_row")))
    return ranked.join(sizes, "_part").select(*[F.col(f"`{c}`") for c in columns], (F.col("_ahead") + F.col("_rank")).alias(name))
