"""Time buckets for ordered lookups within keys of any size.

``Window.partitionBy(key).orderBy(time)`` sends all rows of a key to one task.
The lookups here go in two levels instead, with the same plan at every size:
windows over (key, bucket) see the rows of one bucket, windows over the key see
one row for each of its buckets, and the two are joined on (key, bucket).

A key's buckets come from its own data: one aggregate takes a quantile sketch
of each key's times, and a key of more than ``most`` rows is cut at quantiles
into parts of about ``most`` rows, be they spread over years or loaded within
one second. Other keys are one bucket. Rows that tie on (key, time) are
aggregated before, and meet their result in an equi-join whose two sides have
shuffles of their own, which Spark's adaptive execution splits when one key is
hot.

What a task sorts or aggregates follows the rows it gets. A split of a written
copy is cut by bytes, and of rows that compress to a few bytes each it holds tens
of millions; shuffle partitions are as many for any table. Of tables too large
for that, ``tasks_for`` tells how many tasks get ``ROWS_PER_TASK`` rows each, and
``dealt`` sends their rows to so many, whole groups to one: an aggregate over
them streams a hot group into one row. Adaptive execution does not split the
partitions of such a shuffle, so a join on it has to part hot keys itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Quantiles of a key that are kept: the most buckets it can have.
GRID = 1024
#: Rows of a key above which it is cut, and about the rows of a bucket.
ROWS_PER_BUCKET = 1 << 17
_RUN = 32  # bounds are searched 32 by 32
#: Rows that a task gets at a time, about.
ROWS_PER_TASK = 1 << 21


def ntz_micros(col) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the
    session time zone (casting NTZ to TIMESTAMP would apply it, and in a zone
    with daylight saving two wall-clock times could collide)."""
    c = F.col(col) if isinstance(col, str) else col
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60
    frac = (F.date_part(F.lit("SECOND"), c) * 1000000).cast("long")
    return days * 86400000000 + secs * 1000000 + frac


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int | None:
    """How many tasks ``rows`` go to so that each gets about ``rows_per_task``;
    None if those that the session makes by itself get no more. Never fewer than
    its shuffle partitions, or joins would shuffle the rows once more; nor, if it can
    be, more than a shuffle writes straight to files: for more, each task that reads a
    dense copy gathers all its rows in memory, to sort them by partition."""
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism  # adaptive execution merges partitions down to these
    except Exception:  # e.g. a Spark Connect session: no SparkContext handle
        cores = 1
    if rows <= rows_per_task * min(shuffled, cores):
        return None
    tasks, unsorted = -(-rows // rows_per_task), int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(shuffled, tasks if shuffled > unsorted else min(tasks, unsorted))


def dealt(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``rows`` by ``keys`` in so many tasks, which what reads them by these keys
    keeps; None leaves it to the session."""
    return rows if tasks is None else rows.repartition(tasks, *keys)


def time_buckets(rows: DataFrame, key: str, time: str, counted: str | None = None, most: int = ROWS_PER_BUCKET,
                 tasks: int | None = None) -> DataFrame:
    """``rows`` with ``_bucket`` (0 and up), which grows with ``time`` within
    ``key``. ``counted``: a column without NULLs to count rows by; naming one
    that the other readers of ``rows`` need lets Spark reuse its shuffle.
    ``tasks``: the buckets are dealt to so many, which all readers share."""
    cuts = F.percentile_approx(ntz_micros(time), [i / GRID for i in range(1, GRID)], 10000)
    sketch = rows.groupBy(F.col(key).alias("_key")).agg(F.count(counted or time).alias("_n"), cuts.alias("_cuts"))
    step = F.greatest(F.lit(1), F.ceil(F.lit(GRID * most) / F.col("_n"))).cast("int")
    heavy = sketch.filter(F.col("_n") > most).withColumn("_step", step).select(
        "_key", F.xxhash64("_key").alias("_mixed"),
        F.expr("filter(_cuts, (x, i) -> (i + 1) % _step = 0)").alias("_bounds"))
    heavy = heavy.withColumn("_runs", F.expr(f"filter(_bounds, (x, i) -> (i + 1) % {_RUN} = 0)"))
    # the hash makes the join use a shuffle of its own, not the sketch's, so that a hot key can be split
    out = rows.withColumn("_at", ntz_micros(time)).join(heavy, (F.col(key) == F.col("_key")) & (F.xxhash64(key) == F.col("_mixed")), "left")
    out = out.withColumn("_before", F.size(F.filter("_runs", lambda x: x <= F.col("_at"))) * _RUN)
    within = F.size(F.filter(F.slice("_bounds", F.col("_before") + 1, _RUN), lambda x: x <= F.col("_at")))
    bucket = F.when(F.col("_bounds").isNotNull(), F.col("_before") + within).otherwise(0)
    return dealt(out.select(*[F.col(c) for c in rows.columns], bucket.alias("_bucket")), tasks, key, "_bucket")
