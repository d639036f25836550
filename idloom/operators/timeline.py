"""Ownership timeline (SCD type 2) of a contested key and its published log
(the point-in-time lookup over the log is in ``pit.py``).

For handles: each (handle, id) pair starts at its first sighting; the pair's
ownership ends when the next pair of the same handle starts (order: start
ascending NULLs last, then id ascending NULLs last). A NULL end marks the
current owner. The functions take column names so they serve any entity
whose key can pass from one owner to another.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from idloom.config import PipelineConfig
from idloom.operators.observe import observed_at
from idloom.operators.ordered import ROWS_PER_BUCKET, ROWS_PER_TASK, dealt, time_buckets
from idloom.session import materialize


def first_seen_pairs(obs: DataFrame, key: str = "handle_name", owner: str = "tiktok_id",
                     start: str = "handle_start", tasks: int | None = None) -> DataFrame:
    """First sighting of each complete (key, owner) pair (also de-duplicates).
    Planned as a partial + final hash aggregate, so a hot pair collapses on
    the map side before the shuffle; with ``tasks`` (see ``ordered``) after it."""
    complete = obs.filter(F.col(key).isNotNull() & F.col(owner).isNotNull()).select(key, owner, observed_at().alias(start))
    return dealt(complete, tasks, key, owner).groupBy(key, owner).agg(F.min(start).alias(start))


def timeline_from_pairs(pairs: DataFrame, key: str = "handle_name", owner: str = "tiktok_id",
                        start: str = "handle_start", end: str = "handle_end",
                        first_col: str = "created_at", flag: str = "is_current_owner",
                        strategy: str = "buckets", rows_per_bucket: int = ROWS_PER_BUCKET,
                        tasks: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``end`` (next pair's start), ``first_col`` (the key's first start)
    and ``flag`` (no end = current owner) to the first-sighting pairs, which
    are unique by (key, owner).

    "buckets" (default): see ``ordered``; with ``tasks`` the pairs are written
    once and dealt to so many. "window" is the plain ``Window.partitionBy(key)``
    form, kept to compare with.
    """
    if strategy == "window":
        w = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_last(), F.col(owner).asc_nulls_last())
        out = (pairs.withColumn(end, F.lead(start).over(w))
                    .withColumn(first_col, F.min(start).over(Window.partitionBy(key))))
    elif strategy == "buckets":
        same = (F.col(f"p.{key}") == F.col(f"n.{key}")) & F.col(f"p.{start}").eqNullSafe(F.col(f"n.{start}"))
        if tasks is None:
            starts = pairs.filter(F.col(start).isNotNull()).groupBy(key, start).agg(F.max(owner).alias("_last"))
            nexts = _next_starts(starts, key, start, first_col, rows_per_bucket, tasks)
        else:
            pairs, hot = _dealt_pairs(pairs, key, owner, start, tasks, rows_per_task)
            # the maximum of the start itself: a filter on a grouping column would go below the shuffle, which the join reads too
            starts = pairs.groupBy(key, "_at", "_dated", "_part").agg(F.max(owner).alias("_last"), F.max(start).alias(start))
            starts = dealt(starts.filter(F.col(start).isNotNull()).select(key, start, "_last"), tasks, key, start)
            starts = starts.groupBy(key, start).agg(F.max("_last").alias("_last"))
            nexts = _keyed(_next_starts(starts, key, start, first_col, rows_per_bucket, tasks), start).join(hot, [key, "_at", "_dated"], "left")
            nexts = nexts.withColumn("_part", F.explode(F.expr("sequence(0L, coalesce(_parts, 1L) - 1)")))
            same = reduce(and_, [F.col(f"p.{c}") == F.col(f"n.{c}") for c in (key, "_at", "_dated", "_part")])
        # all but the last owner of a start are followed by that start again
        later = F.when(F.col(f"p.{owner}") < F.col("_last"), F.col(f"p.{start}")).otherwise(F.col("_next"))
        out = (pairs.alias("p").join(nexts.alias("n"), same, "left")
                    .select("p.*", F.col(f"n.{first_col}"), later.alias(end)))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.select(key, owner, first_col, start, end, F.col(end).isNull().alias(flag))


def _keyed(rows: DataFrame, start: str) -> DataFrame:
    """``rows`` with ``_at`` and ``_dated``, never NULL, that stand for ``start``."""
    return rows.withColumns({"_at": F.coalesce(start, F.lit("1970-01-01").cast("timestamp_ntz")), "_dated": F.col(start).isNotNull()})


def _dealt_pairs(pairs: DataFrame, key: str, owner: str, start: str, tasks: int, rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """The pairs, written once, in ``tasks`` by key, start and ``_part``, and the
    ``hot(key, _at, _dated, _parts)`` starts: their owners go to as many parts."""
    at = [key, "_at", "_dated"]
    pairs = _keyed(materialize(pairs.select(key, owner, start), "first-pairs"), start)
    hot = dealt(pairs.select(*at), tasks, *at).groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    hot = materialize(hot.select(*at, F.ceil(F.col("_n") / rows_per_task).alias("_parts")), "hot-starts")  # small: joins broadcast it
    part = F.coalesce(F.pmod(F.xxhash64(owner), F.col("_parts")), F.lit(0)).alias("_part")
    return dealt(pairs.join(hot, at, "left").select(*at, owner, start, part), tasks, *at, "_part"), hot


def _next_starts(starts: DataFrame, key: str, start: str, first_col: str, rows_per_bucket: int, tasks: int | None) -> DataFrame:
    """(key, start, _last, _next, first): each distinct start of a key with its
    last owner, the key's next distinct start and its first one; and one row
    with a NULL start for each key that has a dated pair."""
    starts = time_buckets(starts, key, start, counted="_last", most=rows_per_bucket, tasks=tasks)
    starts = starts.withColumn("_next", F.lead(start).over(Window.partitionBy(key, "_bucket").orderBy(start)))
    buckets = starts.groupBy(key, "_bucket").agg(F.min(start).alias("_head"))
    buckets = buckets.select(key, "_bucket", F.lead("_head").over(Window.partitionBy(key).orderBy("_bucket")).alias("_after"),
                             F.min("_head").over(Window.partitionBy(key)).alias(first_col))
    dated = starts.join(buckets, [key, "_bucket"]).select(
        key, start, "_last", F.coalesce("_next", "_after").alias("_next"), first_col)
    undated = buckets.groupBy(key).agg(F.min(first_col).alias(first_col)).select(
        key, F.lit(None).cast("timestamp_ntz").alias(start), F.lit(None).cast("string").alias("_last"),
        F.lit(None).cast("timestamp_ntz").alias("_next"), first_col)
    return dated.unionByName(undated)


def ownership_timeline(obs: DataFrame, config: PipelineConfig | None = None, tasks: int | None = None) -> DataFrame:
    """``(handle_name, tiktok_id, created_at, handle_start, handle_end,
    is_current_owner)`` from the observation map."""
    config = config or PipelineConfig()
    tl = timeline_from_pairs(first_seen_pairs(obs, tasks=tasks), strategy=config.scan_strategy, tasks=tasks)
    if config.ordered:
        tl = tl.orderBy(F.col("handle_name").asc_nulls_last(), F.col("handle_start").asc_nulls_last())
    return tl


def handle_log(timeline: DataFrame) -> DataFrame:
    """Published log: ``[valid_from, valid_to)``, NULL ``valid_to`` = current."""
    return timeline.select(
        "tiktok_id",
        F.col("handle_name").alias("handle"),
        F.col("handle_start").alias("valid_from"),
        F.col("handle_end").alias("valid_to"),
        "is_current_owner",
    )
