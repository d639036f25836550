"""Data-driven buckets, interval joins, global positions."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import ts
from idloom.operators.intervals import blocks
from idloom.operators.ordered import time_buckets
from idloom.operators.pit import overlapping_intervals, owner_at, owners_at
from idloom.operators.ranking import with_positions
from idloom.operators.timeline import timeline_from_pairs
from idloom.session import ensure_checkpoint_dir
from test_pit import LOG, brute_force


def hot_pairs(spark, n=24000):
    """A third of the rows belongs to one key, at distinct microseconds of one hour."""
    start = F.when(F.col("id") % 3 == 0, F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, (id * 7919 % 1000003) / 1000000.0)"))
    start = start.otherwise(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 300 as int))"))
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 2000)).alias("handle_name"),
                                 F.concat(F.lit("u"), "id").alias("tiktok_id"), start.alias("handle_start"))


def test_a_hot_key_within_one_hour_is_dealt_evenly(spark):
    rows = hot_pairs(spark).groupBy("handle_name", "handle_start").agg(F.max("tiktok_id").alias("last"))
    cut = time_buckets(rows, "handle_name", "handle_start", counted="last", most=100)
    sizes = [r["count"] for r in cut.repartition(8, "handle_name", "_bucket").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    hot = cut.where("handle_name = 'hot'").groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("handle_start").alias("lo"), F.max("handle_start").alias("hi"))
    hot = sorted(hot.collect())
    assert len(hot) > 50 and max(r.n for r in hot) <= 220
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))  # buckets follow time
    assert cut.where("handle_name <> 'hot' and _bucket <> 0").count() == 0


def test_buckets_do_not_change_the_timeline(spark):
    pairs = hot_pairs(spark, 3000)
    plain = timeline_from_pairs(pairs, strategy="window")
    cut = timeline_from_pairs(pairs, rows_per_bucket=20)
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def overlapping_log(rnd, n=160):
    log = []
    for i in range(n):
        start = rnd.randrange(1, 28)
        end = None if rnd.random() < 0.2 else start + rnd.choice((0, 0, 1, 3, 12))
        day = lambda d: ts(f"2024-{1 + d // 29:02d}-{1 + d % 29:02d}")
        log.append((f"id{i % 31}", rnd.choice(("hot", "hot", "h1", "h2", None)), None if rnd.random() < 0.05 else day(start), None if end is None else day(end)))
    return log + log[:5]


@pytest.mark.parametrize("most", [3, 1 << 17])
def test_all_owners_of_overlapping_logs(spark, most):
    rnd = random.Random(most)
    log = overlapping_log(rnd)
    facts = [(rnd.choice(("hot", "h1", "h2", "h3", None)), None if rnd.random() < 0.05 else ts(f"2024-01-{rnd.randrange(1, 30):02d}"), n) for n in range(200)]
    want = brute_force(facts, [l for l in log if l[1] is not None])
    df = spark.createDataFrame(facts, "handle string, ts timestamp_ntz, n long")
    got = owners_at(df, spark.createDataFrame(log, LOG), rows_per_bucket=most)
    assert got.columns == ["handle", "ts", "n", "tiktok_id", "valid_from", "valid_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert len(want) > 2 * len(facts)
    open_at = lambda h, t: sum(1 for _, k, a, b in log if k == h and a is not None and a <= t and (b is None or t < b))
    most_open = {h: max(open_at(h, x) for _, k, a, b in log for x in (a, b) if k == h and x is not None) for h in ("hot", "h1", "h2")}
    found = {r.handle: r.most for r in overlapping_intervals(spark.createDataFrame(log, LOG), rows_per_bucket=most).collect()}
    assert found == {h: n for h, n in most_open.items() if n > 1}


def test_blocks_cover_each_position_once(spark):
    ranges = [(lo, hi) for lo in range(1, 20) for hi in range(lo, 21)]
    df = blocks(spark.createDataFrame(ranges, "_lo long, _hi long").withColumn("lo", F.col("_lo")).withColumn("hi", F.col("_hi")))
    held = {}
    for r in df.collect():
        held.setdefault((r.lo, r.hi), []).extend(range(r._block << r._level, (r._block + 1) << r._level))
    assert all(sorted(held.get((lo, hi), [])) == list(range(lo, hi)) for lo, hi in ranges)


def test_facts_with_columns_of_the_result(spark):
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), None)], LOG)
    facts = spark.createDataFrame([("h", ts("2024-02-01"), "old", 1, 2)], "handle string, ts timestamp_ntz, tiktok_id string, _at int, _t int")
    for found in (owner_at(facts, log), owners_at(facts, log)):
        assert found.columns == ["handle", "ts", "_at", "_t", "tiktok_id", "valid_from", "valid_to"]
        assert [tuple(r)[2:5] for r in found.collect()] == [(1, 2, "A")]


def test_positions_are_gapless_and_ties_are_split(spark):
    rows = [(("same" if i % 2 else f"k{i % 50:02d}") if i % 7 else None, i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = sorted((r.position, r.k, r.v) for r in with_positions(df, [F.col("k").asc_nulls_last()]).collect())
    assert [p for p, _, _ in got] == list(range(1, 4001))
    assert [(k, v) for _, k, v in got] == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert with_positions(df.limit(0), [F.col("k").asc()]).count() == 0


def test_owners_meet_facts_last_and_at_every_level(spark):
    """Thousands of ends of one key, intervals of every length, ties."""
    micros = lambda c: F.expr(f"timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, cast({c} as decimal(18, 6)) / 1000)")
    spans = spark.range(3000).select(F.concat(F.lit("o"), "id").alias("tiktok_id"), F.when(F.col("id") % 10 == 0, "k").otherwise("hot").alias("handle"), F.expr("id * 7919 % 5003").alias("a"),
                                     F.when(F.col("id") % 101 == 0, None).otherwise(F.expr("id * 7919 % 5003 + shiftleft(1, cast(id % 13 as int)) - 1")).alias("b"))
    log = spans.select("tiktok_id", "handle", micros("a").alias("valid_from"), micros("b").alias("valid_to"))
    facts = spark.range(400).select(F.when(F.col("id") % 10 == 0, "k").otherwise("hot").alias("handle"), micros("id * 6007 % 9001 - 20").alias("ts"), "id")
    got = owners_at(facts, log)
    same = "f.handle = l.handle and f.ts >= l.valid_from and (l.valid_to is null or f.ts < l.valid_to)"
    want = facts.alias("f").join(log.alias("l"), F.expr(same), "left").select("f.*", "tiktok_id", "valid_from", "valid_to")
    assert want.count() > 20 * 400
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # the answer is made by the outermost join and not moved again
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    outermost = next(line for line in plan if "Join " in line)
    assert "_block" in outermost and "_level" in outermost


def shuffled_rows(df):
    """Rows that the answer's own plan shuffles, without the copies made before; the answer's rows."""
    n = len(df.collect())
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            total += plan.metrics().apply("shuffleRecordsWritten").value()
        inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
        todo += inner + [plan.children().apply(i) for i in range(plan.children().size())]
    return total, n


def test_equal_facts_go_as_one_and_claims_to_few_cells(spark):
    at = lambda c: F.expr(f"timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast({c} as int))")
    log = spark.range(2000).select(F.concat(F.lit("o"), "id").alias("tiktok_id"), F.lit("hot").alias("handle"), at("id").alias("valid_from"), at("id + 900").alias("valid_to"))
    facts = spark.range(40000).select(F.when(F.col("id") % 4000 == 1, None).when(F.col("id") % 10 == 0, "none").otherwise("hot").alias("handle"),
                                      F.when(F.col("id") % 10 > 4, at("3000")).when(F.col("id") % 10 == 4, at("2795")).alias("ts"), F.expr("cast(id % 2 as string)").alias("s"))
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(broadcast, "-1")
    try:
        got = owners_at(facts, log)
        moved, n = shuffled_rows(got)
    finally:
        spark.conf.unset(broadcast)
    assert 2000 < moved < 2000 * 15
    want = facts.alias("f").join(log.alias("l"), F.expr("f.handle = l.handle and f.ts >= l.valid_from and f.ts < l.valid_to"), "left").select("f.*", "tiktok_id", "valid_from", "valid_to")
    count = lambda df: sorted((tuple(r) for r in df.groupBy(*df.columns).count().collect()), key=str)
    assert count(got) == count(want) and n == want.count() > 400_000  # 4000 equal facts with 104 owners each
    signed = facts.limit(3).withColumn("s", F.when(F.col("s") == "0", -0.0).otherwise(0.0))
    assert sorted(str(r.s) for r in owners_at(signed, log).collect()) == sorted(str(r.s) for r in signed.collect())


def test_steps_of_owners_leave_only_what_the_answer_reads(spark):
    jvm = spark._jvm
    disk = lambda: {f.getName() for f in jvm.scala.jdk.javaapi.CollectionConverters.asJava(jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    copies = lambda: {p for p in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if p.startswith("idloom-")}
    shuffles, before = disk(), copies()
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), None), ("B", "h", ts("2024-01-03"), ts("2024-01-09"))], LOG).repartition(3)
    facts = spark.createDataFrame([("h", ts("2024-01-04"), 1), ("x", None, 2), (None, ts("2024-01-04"), 3)], "handle string, ts timestamp_ntz, n long").repartition(3)
    held = owners_at(facts, log)
    for _ in range(50):  # removed in the background
        if not disk() - shuffles:
            break
        time.sleep(0.2)
    assert not disk() - shuffles
    assert sorted(p.rsplit("-", 1)[0] for p in copies() - before) == ["idloom-interval-ranges", "idloom-positioned-facts"]
    assert sorted((r.n, r.tiktok_id) for r in held.collect() if r.n == 1) == [(1, "A"), (1, "B")]
    # a log of a type that Parquet does not hold is read where it is
    open_ended = log.select("tiktok_id", "handle", "valid_from", F.lit(None).alias("valid_to"))
    assert sorted(str((r.n, r.tiktok_id)) for r in owners_at(facts, open_ended).collect()) == ["(1, 'A')", "(1, 'B')", "(2, None)", "(3, None)"]
