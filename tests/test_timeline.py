import random

import pytest
from pyspark.sql import functions as F

from helpers import ts
from idloom.config import PipelineConfig
from idloom.operators.observe import observation_map, observed_at
from idloom.operators.timeline import handle_log, ownership_timeline, timeline_from_pairs

OBS = "tiktok_id string, handle_name string, source_table string, created_at timestamp_ntz, updated_at timestamp_ntz"


def obs(spark, rows):
    return spark.createDataFrame([(i, h, "t", ts(c), ts(u)) for i, h, c, u in rows], OBS)


def rows_of(df):
    return sorted((r.tiktok_id, r.handle_name, r.handle_start, r.handle_end, r.is_current_owner,
                   r.created_at) for r in df.collect())


STRATS = ["buckets", "window"]


def test_f3_observed_at(spark):
    df = spark.createDataFrame([(ts("2024-01-05"), None), (None, ts("2024-01-03")), (None, None),
                                (ts("2024-02-01"), ts("2024-01-10"))], "created_at timestamp_ntz, updated_at timestamp_ntz")
    out = [r[0] for r in df.select(observed_at()).collect()]
    assert out == [ts("2024-01-05"), ts("2024-01-03"), None, ts("2024-01-10")]


@pytest.mark.parametrize("strategy", STRATS)
def test_f4_owner_change(spark, strategy):
    o = obs(spark, [("A", "h", "2024-01-01", None), ("B", "h", "2024-02-01", None),
                    ("A", "h", "2024-01-05", None)])
    r = rows_of(ownership_timeline(o, PipelineConfig(scan_strategy=strategy)))
    assert r == [("A", "h", ts("2024-01-01"), ts("2024-02-01"), False, ts("2024-01-01")),
                 ("B", "h", ts("2024-02-01"), None, True, ts("2024-01-01"))]


@pytest.mark.parametrize("strategy", STRATS)
def test_f5_return_to_a(spark, strategy):
    o = obs(spark, [("A", "h", "2024-01-01", None), ("B", "h", "2024-02-01", None),
                    ("A", "h", "2024-03-01", None)])
    r = rows_of(ownership_timeline(o, PipelineConfig(scan_strategy=strategy)))
    assert [x[:5] for x in r] == [("A", "h", ts("2024-01-01"), ts("2024-02-01"), False),
                                  ("B", "h", ts("2024-02-01"), None, True)]


@pytest.mark.parametrize("strategy", STRATS)
def test_f6_tied_starts(spark, strategy):
    o = obs(spark, [("B", "h", "2024-01-01", None), ("A", "h", "2024-01-01", None)])
    r = rows_of(ownership_timeline(o, PipelineConfig(scan_strategy=strategy)))
    assert [x[:5] for x in r] == [("A", "h", ts("2024-01-01"), ts("2024-01-01"), False),
                                  ("B", "h", ts("2024-01-01"), None, True)]


@pytest.mark.parametrize("strategy", STRATS)
def test_f7_undated_pair_two_current(spark, strategy):
    o = obs(spark, [("A", "h", "2024-01-01", None), ("B", "h", None, None)])
    r = rows_of(ownership_timeline(o, PipelineConfig(scan_strategy=strategy)))
    assert [x[:5] for x in r] == [("A", "h", ts("2024-01-01"), None, True),
                                  ("B", "h", None, None, True)]


def test_incomplete_rows_dropped(spark):
    o = obs(spark, [(None, "h", "2024-01-01", None), ("A", None, "2024-01-01", None)])
    assert ownership_timeline(o).count() == 0


def test_log_columns(spark):
    o = obs(spark, [("A", "h", "2024-01-01", None)])
    assert handle_log(ownership_timeline(o)).columns == ["tiktok_id", "handle", "valid_from",
                                                         "valid_to", "is_current_owner"]


def _random_pairs(spark, n, hot_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        h = "hot" if rnd.random() < hot_share else f"h{rnd.randrange(40)}"
        start = None if rnd.random() < 0.05 else ts(f"2024-01-{rnd.randrange(1, 28):02d}")
        rows.append((h, f"id{i}", start))
    return spark.createDataFrame(rows, "handle_name string, tiktok_id string, handle_start timestamp_ntz")


@pytest.mark.parametrize("seed", [1, 3])
def test_buckets_equal_window_with_hot_handle(spark, seed):
    # One handle holds ~40% of all pairs.
    pairs = _random_pairs(spark, 3000, 0.4, seed=seed)
    assert rows_of(timeline_from_pairs(pairs, strategy="window")) == rows_of(timeline_from_pairs(pairs))


def test_buckets_equal_window_at_outermost_dates(spark):
    times = ["0001-01-01", "1500-06-01", "1969-12-31 23:59:59.999999", "1970-01-01", "2024-03-31 02:30:00", "2024-03-31 02:30:00.000001",
             "9999-12-31", "9999-12-31 23:59:59.999999", None]
    rows = [(f"h{i % 4}", f"id{i:03d}", ts(times[(i * 7 + i // 4) % len(times)])) for i in range(150)]
    rows += [("tied", f"id{i:03d}", ts("2024-01-01")) for i in range(100)] + [("never", "a", None), ("never", "b", None)]
    pairs = spark.createDataFrame(rows, "handle_name string, tiktok_id string, handle_start timestamp_ntz")
    assert rows_of(timeline_from_pairs(pairs, strategy="window")) == rows_of(timeline_from_pairs(pairs))


def test_intervals_contiguous(spark):
    pairs = _random_pairs(spark, 500, 0.3, seed=7)
    tl = timeline_from_pairs(pairs, strategy="buckets").toPandas()
    for h, g in tl.groupby("handle_name"):
        dated = g[g.handle_start.notna()].sort_values(["handle_start", "tiktok_id"])
        ends = list(dated.handle_end)
        starts = list(dated.handle_start)
        for i in range(len(starts) - 1):
            assert ends[i] == starts[i + 1]
        assert g.created_at.nunique(dropna=False) == 1


def test_market_dates_swapped(spark):
    # the positional union of the original swaps MARKET's dates.
    raw = {"MARKET": spark.createDataFrame(
        [("1", "H", ts("2024-01-01"), ts("2024-02-01"))],
        "tiktok_id string, handle_name string, create_date timestamp_ntz, last_update timestamp_ntz")}
    r = observation_map(raw).collect()[0]
    assert (r.created_at, r.updated_at) == (ts("2024-02-01"), ts("2024-01-01"))
    r2 = observation_map(raw, PipelineConfig(swap_market_dates=False)).collect()[0]
    assert (r2.created_at, r2.updated_at) == (ts("2024-01-01"), ts("2024-02-01"))


def test_blank_handles_and_ids_collapse(spark):
    raw = {"CREATORINFO": spark.createDataFrame(
        [("  ", " H ", ts("2024-01-01"), None)],
        "tiktok_id string, handle_name string, create_date timestamp_ntz, last_update timestamp_ntz")}
    r = observation_map(raw).collect()[0]
    assert r.tiktok_id is None and r.handle_name == "h"


def test_windows_see_distinct_times_only(spark):
    """A hot handle whose starts all tie is one row in every window; its pairs
    meet that row in a join, whose sides have shuffles of their own."""
    rows = [("hot", f"id{i:05d}", ts("2024-01-01")) for i in range(3000)] + [(f"h{i}", "x", ts("2024-01-01")) for i in range(50)]
    pairs = spark.createDataFrame(rows, "handle_name string, tiktok_id string, handle_start timestamp_ntz")
    tl = timeline_from_pairs(pairs)
    got = rows_of(tl)
    assert got == rows_of(timeline_from_pairs(pairs, strategy="window"))
    plan = tl._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and not any("tiktok_id" in line for line in windows)


def test_ordered_option_sorts_output(spark):
    o = obs(spark, [("B", "h2", "2024-01-02", None), ("A", "h1", "2024-01-01", None),
                    ("C", "h1", "2024-01-03", None)])
    got = [(r.handle_name, r.tiktok_id) for r in
           ownership_timeline(o, PipelineConfig(ordered=True)).collect()]
    assert got == [("h1", "A"), ("h1", "C"), ("h2", "B")]


def test_dealt_rows_give_the_same_timeline(spark):
    from idloom.operators.timeline import first_seen_pairs
    n = F.col("id")
    obs = spark.range(6000).select(F.when(n % 3 == 0, "hot").when(n % 40 == 1, None).otherwise(F.concat(F.lit("h"), n % 25)).alias("handle_name"),
                                   F.when(n % 7 == 0, "a").otherwise((n % 900).cast("string")).alias("tiktok_id"),
                                   F.when(n % 11 != 0, F.date_add(F.lit("2024-01-01"), (n % 60).cast("int"))).cast("timestamp_ntz").alias("created_at"),
                                   F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    want = sorted(map(str, timeline_from_pairs(first_seen_pairs(obs), strategy="window").collect()))
    assert want == sorted(map(str, timeline_from_pairs(first_seen_pairs(obs, tasks=40), rows_per_bucket=50, tasks=40).collect()))
    assert want == sorted(map(str, timeline_from_pairs(first_seen_pairs(obs)).collect()))


def test_starts_and_pairs_are_dealt_by_rows(spark):
    """Neither the distinct starts nor the join of the pairs keep the session's shuffle partitions, and a start
    of many owners, or their undated pairs, go to several tasks."""
    import re
    n = F.col("id")
    pairs = spark.range(9000).select(
        F.when(n % 3 != 0, "hot").otherwise(F.concat(F.lit("h"), n % 25)).alias("handle_name"), n.cast("string").alias("tiktok_id"),
        F.when(n % 3 == 1, F.lit("2024-03-01")).when(n % 3 == 0, F.date_add(F.lit("2024-01-01"), (n % 90).cast("int"))).cast("timestamp_ntz").alias("handle_start"))
    want = sorted(map(str, timeline_from_pairs(pairs, strategy="window").collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # as of large tables: only the hot starts are few
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        out = timeline_from_pairs(pairs, rows_per_bucket=200, tasks=40, rows_per_task=250)
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold") if old[1] is None else spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])
    assert set(re.findall(r"Exchange hashpartitioning\(handle_name#\d+, _at#\d+, _dated#\d+, _part#\d+L?, (\d+)\)", plan)) == {"40"}
    assert set(re.findall(r"Exchange hashpartitioning\(handle_name#\d+, handle_start#\d+, (\d+)\)", plan)) == {"40"}
    assert sum(sizes) == 9000 and max(sizes) < 1000
    assert want == sorted(map(str, out.collect()))
