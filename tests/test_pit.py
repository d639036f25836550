import contextlib
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import ts
from idloom.operators.pit import overlapping_intervals, owner_at
from idloom.operators.timeline import handle_log, timeline_from_pairs


def brute_force(facts, log):
    """Plain range join in Python over the small fixture."""
    out = []
    for f in facts:
        hit = [l for l in log if l[1] == f[0] and f[1] is not None and l[2] is not None
               and f[1] >= l[2] and (l[3] is None or f[1] < l[3])]
        if not hit:
            out.append((f[0], f[1], f[2], None, None, None))
        for l in hit:
            out.append((f[0], f[1], f[2], l[0], l[2], l[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 4])
def test_owner_at_matches_range_join(spark, seed):
    rnd = random.Random(seed)
    pairs = []
    for i in range(300):
        h = "hot" if rnd.random() < 0.5 else f"h{rnd.randrange(10)}"
        start = None if rnd.random() < 0.05 else ts(f"2024-01-{rnd.randrange(1, 28):02d}")
        pairs.append((h, f"id{i % 37}", start))
    pdf = spark.createDataFrame(pairs, "handle_name string, tiktok_id string, handle_start timestamp_ntz") \
               .groupBy("handle_name", "tiktok_id").agg(F.min("handle_start").alias("handle_start"))
    log = handle_log(timeline_from_pairs(pdf, strategy="window"))
    facts = [(("hot" if rnd.random() < 0.5 else f"h{rnd.randrange(12)}"),
              None if rnd.random() < 0.05 else ts(f"2024-01-{rnd.randrange(1, 30):02d} 12:00:00"
                                                   if rnd.random() < 0.5 else f"2024-01-{rnd.randrange(1, 30):02d}"),
              n) for n in range(500)]
    fdf = spark.createDataFrame(facts, "handle string, ts timestamp_ntz, n long")
    got = owner_at(fdf, log, ts="ts")
    got = sorted((tuple(r) for r in got.select("handle", "ts", "n", "tiktok_id", "valid_from", "valid_to").collect()), key=str)
    want = brute_force(facts, [tuple(r) for r in log.select("tiktok_id", "handle", "valid_from", "valid_to").collect()])
    assert got == want


def test_start_inclusive_end_exclusive(spark):
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), ts("2024-02-01")),
                                 ("B", "h", ts("2024-02-01"), None)],
                                "tiktok_id string, handle string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([("h", ts("2024-01-01")), ("h", ts("2024-02-01")), ("h", ts("2023-12-31")),
                                   ("x", ts("2024-01-01"))], "handle string, ts timestamp_ntz")
    got = {(r.ts, r.handle): r.tiktok_id for r in owner_at(facts, log).collect()}
    assert got == {(ts("2024-01-01"), "h"): "A", (ts("2024-02-01"), "h"): "B",
                   (ts("2023-12-31"), "h"): None, (ts("2024-01-01"), "x"): None}


def test_facts_without_handle_or_time_pass_through(spark):
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), None)],
                                "tiktok_id string, handle string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(None, ts("2024-02-01"), 1), ("h", None, 2), ("h", ts("2024-02-01"), 3)],
                                  "handle string, ts timestamp_ntz, n int")
    got = {r.n: r.tiktok_id for r in owner_at(facts, log).collect()}
    assert got == {1: None, 2: None, 3: "A"}
    assert owner_at(facts, log).columns == ["handle", "ts", "n", "tiktok_id", "valid_from", "valid_to"]


LOG = "tiktok_id string, handle string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def test_outermost_dates_and_clashing_columns(spark):
    log = spark.createDataFrame([("A", "h", ts("0001-01-01"), ts("1500-06-01")), ("B", "h", ts("1500-06-01"), ts("9999-12-31")),
                                 ("C", "h", ts("9999-12-31"), None)], LOG)
    facts = [("h", ts(t), i, 9007199254740993 + i) for i, t in enumerate(
        ("0001-01-01", "0001-01-02", "1500-05-31 23:59:59", "1500-06-01", "2024-01-01", "9999-12-30", "9999-12-31"))]
    df = spark.createDataFrame(facts, "handle string, ts timestamp_ntz, _hour int, big long")
    got = {r._hour: (r.tiktok_id, r.big) for r in owner_at(df, log).collect()}
    assert got == {i: (o, 9007199254740993 + i) for i, o in enumerate("AAABBBC")}


def test_overlapping_intervals_are_reported(spark):
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), None), ("B", "h", ts("2024-02-01"), None), ("A", "k", ts("2024-01-01"), ts("2024-02-01")),
                                 ("B", "k", ts("2024-02-01"), None), ("C", "k", ts("2024-02-01"), ts("2024-02-01")), ("D", "u", None, None)], LOG)
    assert [tuple(r) for r in overlapping_intervals(log).collect()] == [("h", 2)]


def test_tied_facts_of_a_hot_handle_are_joined_not_gathered(spark):
    """Neither a window nor an aggregate holds the facts: both see distinct times."""
    log = spark.createDataFrame([("A", "hot", ts("2024-01-01"), None)], LOG)
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), "id")).alias("handle"),
                                     F.lit(ts("2024-03-01")).cast("timestamp_ntz").alias("ts"), F.col("id").alias("payload"))
    out = owner_at(facts, log)
    assert out.where("tiktok_id = 'A'").count() == 1000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and not any("payload" in line for line in windows)
    assert "Python" not in plan and "Arrow" not in plan


def _facts_with_ties(spark):
    """9000 facts of 31 handles: a third ties on one (handle, time), some have no handle or time."""
    n = F.col("id")
    return spark.range(9000).select(
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(F.concat(F.lit("h"), n % 30)).alias("handle"),
        F.when(n % 3 == 0, F.lit("2024-03-01")).when(n % 70 == 1, None).otherwise(F.date_add(F.lit("2024-01-01"), (n % 90).cast("int"))).cast("timestamp_ntz").alias("ts"),
        n.alias("payload"))


def _log_of_many(spark):
    pairs = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 30)).alias("handle_name"),
                                     F.col("id").cast("string").alias("tiktok_id"),
                                     F.date_add(F.lit("2024-01-01"), (F.col("id") * 7 % 80).cast("int")).cast("timestamp_ntz").alias("handle_start"))
    return handle_log(timeline_from_pairs(pairs, strategy="window"))


@contextlib.contextmanager
def _settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tasks_of_a_lookup_follow_the_rows(spark):
    """What a task sorts is a share of the rows, whatever the session's shuffle partitions; the rows found are the same."""
    facts, log = _facts_with_ties(spark), _log_of_many(spark)
    with _settings(spark, autoBroadcastJoinThreshold="-1"):
        dealt = owner_at(facts, log, rows_per_bucket=200, rows_per_task=100)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
    both = re.findall(r"Exchange hashpartitioning\((?:handle|_h)#\d+, (?:ts|_t)#\d+, _o_part#\d+L?, (\d+)\), (\w+)", plan)
    assert both == [("90", "ENSURE_REQUIREMENTS"), ("90", "REPARTITION_BY_NUM")]
    plain = owner_at(facts, log)
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_NUM" not in plain._jdf.queryExecution().executedPlan().toString()
    rows = sorted((tuple(r) for r in dealt.collect()), key=str)
    assert len(rows) == 9000 and rows == sorted((tuple(r) for r in plain.collect()), key=str)
    raw = [tuple(r) for r in facts.collect()]
    assert rows == sorted(((h, t, p, *o) for h, t, p, *o in brute_force(raw, [tuple(r) for r in log.select("tiktok_id", "handle", "valid_from", "valid_to").collect()])), key=str)


def test_a_hot_time_is_parted_when_rows_are_dealt(spark):
    """3000 facts of one time and 3000 without any: no partition of the join gets many more rows than its share."""
    facts = _facts_with_ties(spark).filter("ts is not null").unionByName(spark.range(3000).selectExpr("'hot' as handle", "cast(null as timestamp_ntz) as ts", "id as payload"))
    log = _log_of_many(spark)
    with _settings(spark, autoBroadcastJoinThreshold="20k", adaptive__autoBroadcastJoinThreshold="-1"):  # as of large tables: only the hot times are few
        out = owner_at(facts, log, rows_per_task=250)
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == facts.count() and max(sizes) < 1000
    want = owner_at(facts, log)
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", ["owner_at_time", "owner_at_time_range"])
def test_the_query_deals_its_written_sightings(spark, monkeypatch, name):
    """A split of the written copy may hold any number of rows: no aggregate sees them before they are dealt."""
    from helpers import SF_SMALL
    from idloom.operators import ordered, pit, timeline
    from idloom.plans import catalog, pipeline
    seen = []
    small = lambda s, rows, most=0: ordered.tasks_for(s, rows, 500)
    monkeypatch.setattr(pit, "tasks_for", small)
    monkeypatch.setattr(pipeline, "tasks_for", small)
    first = timeline.first_seen_pairs
    monkeypatch.setattr(timeline, "first_seen_pairs", lambda *a, **k: seen.append(first(*a, **k)) or seen[-1])
    want = sorted((tuple(r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect()), key=str)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.index("Exchange hashpartitioning") > plan.rindex("HashAggregate(")
    monkeypatch.undo()
    assert want == sorted((tuple(r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect()), key=str)


def test_dealt_rows_are_not_sorted_by_the_shuffle_that_deals_them(spark):
    """Beyond 200 partitions the shuffle's writer holds a split's rows in memory; a split of a dense copy has tens of millions."""
    from idloom.operators.ordered import tasks_for
    with _settings(spark, shuffle__partitions="12"):
        assert tasks_for(spark, 100, 100) is None
        assert tasks_for(spark, 15000, 100) == 150
        assert tasks_for(spark, 25000, 100) == 200
    with _settings(spark, shuffle__partitions="300"):  # sorted anyway
        assert tasks_for(spark, 50000, 100) == 500
    big = spark.range(50000).select(F.concat(F.lit("h"), F.col("id") % 1000).alias("handle"), F.lit("2024-03-01").cast("timestamp_ntz").alias("ts"))
    plan = owner_at(big, spark.createDataFrame([], LOG), rows_per_task=100)._jdf.queryExecution().executedPlan().toString()
    assert max(map(int, re.findall(r"hashpartitioning\([^()]*, (\d+)\)", plan))) == 200
