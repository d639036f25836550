import hashlib
import random

import pytest

from helpers import ts
from idloom.config import PipelineConfig
from idloom.operators.email import email_dimension, flag_latest_per_creator

SRC = "tiktok_id string, email string, created_at timestamp_ntz, updated_at timestamp_ntz"


def clean_sources(spark, rows):
    """rows: (source, tiktok_id, email, created, updated) -> {SOURCE: cleaned df}."""
    out = {}
    for src in ("BRAVO_V1", "BRAVO_V2", "CREATORINFO", "HYDRATE", "MARKET", "ECHO"):
        mine = [(i, e, ts(c), ts(u)) for s, i, e, c, u in rows if s == src]
        df = spark.createDataFrame(mine, SRC)
        if src in ("CREATORINFO", "HYDRATE", "MARKET"):
            df = df.selectExpr("tiktok_id", "email as email_address", "created_at as create_date",
                               "updated_at as last_update")
        elif src == "ECHO":
            df = df.selectExpr("tiktok_id", "email", "created_at as created_time",
                               "updated_at as last_updated_time")
        out[src] = df
    return out


def dim(spark, rows, **cfg):
    return {(r.tiktok_id, r.email): r for r in email_dimension(clean_sources(spark, rows),
                                                              PipelineConfig(**cfg)).collect()}


@pytest.mark.parametrize("strategy", ["one_pass", "two_pass"])
def test_f11_null_update_wins(spark, strategy):
    d = dim(spark, [("BRAVO_V1", "A", "e", "2024-01-01", None),
                    ("BRAVO_V2", "A", "e", "2024-01-02", "2024-03-01")], email_strategy=strategy)
    r = d[("A", "e")]
    assert r.data_source == "BRAVO_V1" and r.updated_at == ts("2024-03-01")
    assert r.created_at == ts("2024-01-01")


def test_null_rank_last_option(spark):
    d = dim(spark, [("BRAVO_V1", "A", "e", "2024-01-01", None),
                    ("BRAVO_V2", "A", "e", "2024-01-02", "2024-03-01")], null_rank="last")
    assert d[("A", "e")].data_source == "BRAVO_V2"


def test_f12_current_ties_and_none(spark):
    d = dim(spark, [("HYDRATE", "A", "e1", None, "2024-01-05"), ("ECHO", "A", "e2", None, "2024-01-05"),
                    ("HYDRATE", "A", "e3", None, "2024-01-01"), ("MARKET", "B", "f", "2024-01-01", None)])
    assert d[("A", "e1")].is_current and d[("A", "e2")].is_current
    assert not d[("A", "e3")].is_current
    assert d[("B", "f")].is_current is False
    assert d[("B", "f")].data_source == "MARKET"


def test_f13_blank_id_kept(spark):
    d = dim(spark, [("CREATORINFO", "", "e", "2024-01-01", "2024-01-02")])
    assert ("", "e") in d


def test_incomplete_rows_dropped(spark):
    d = dim(spark, [("CREATORINFO", None, "e", "2024-01-01", None), ("ECHO", "A", None, None, None)])
    assert d == {}


def test_tie_break_by_source(spark):
    d = dim(spark, [("HYDRATE", "A", "e", "2024-01-01", "2024-01-02"),
                    ("CREATORINFO", "A", "e", "2024-01-01", "2024-01-02")])
    assert d[("A", "e")].data_source == "CREATORINFO"


def test_md5_key(spark):
    d = dim(spark, [("ECHO", "42", "a@b", None, None)])
    assert d[("42", "a@b")].creator_email_id == hashlib.md5(b"42|a@b").hexdigest()


def test_int64_key_is_positive_text(spark):
    d = dim(spark, [("ECHO", "42", "a@b", None, None)], email_key_style="int64")
    k = d[("42", "a@b")].creator_email_id
    assert k.isdigit()


def test_one_pass_equals_two_pass_random(spark):
    rnd = random.Random(3)
    srcs = ["BRAVO_V1", "BRAVO_V2", "CREATORINFO", "HYDRATE", "MARKET", "ECHO"]
    days = [None, "2024-01-01", "2024-01-02", "2024-01-03"]
    rows = [(rnd.choice(srcs), f"i{rnd.randrange(5)}", f"e{rnd.randrange(3)}", rnd.choice(days),
             rnd.choice(days)) for _ in range(400)]
    for nr in ("first", "last"):
        a = dim(spark, rows, email_strategy="one_pass", null_rank=nr)
        b = dim(spark, rows, email_strategy="two_pass", null_rank=nr)
        assert a == b


def test_flag_window_equals_join(spark):
    df = spark.createDataFrame([("A", "e1", ts("2024-01-01")), ("A", "e2", None), ("B", "e", None),
                                ("C", "x", ts("2024-01-02")), ("C", "y", ts("2024-01-02"))],
                               "tiktok_id string, email string, updated_at timestamp_ntz")
    a = sorted(tuple(r) for r in flag_latest_per_creator(df, strategy="join").collect())
    b = sorted(tuple(r) for r in flag_latest_per_creator(df, strategy="window")
               .select("tiktok_id", "email", "updated_at", "is_current").collect())
    assert [x[3] for x in a] == [x[3] for x in b]


def test_ntz_micros_exact(spark):
    import datetime as dt
    from idloom.operators.email import ntz_micros
    vals = [dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
            dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r[0] for r in df.select(ntz_micros("t")).collect()]
    want = [(v - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for v in vals]
    assert got == want


def test_latest_source_independent_of_session_zone(spark):
    # 02:30 on 2024-03-10 does not exist in New York; it must still rank
    # below 03:15, as wall-clock NTZ values.
    rows = [("BRAVO_V1", "A", "e", None, "2024-03-10 02:30:00"),
            ("BRAVO_V2", "A", "e", None, "2024-03-10 03:15:00")]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        d = dim(spark, rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert d[("A", "e")].data_source == "BRAVO_V2"


def test_unknown_source_rejected(spark):
    from pyspark.errors import PySparkException
    from idloom.operators.email import email_pairs
    df = spark.createDataFrame([("A", "e", "ELSEWHERE", None, None)],
                               "tiktok_id string, email string, data_source string, created_at timestamp_ntz, updated_at timestamp_ntz")
    with pytest.raises(PySparkException, match="unknown data_source"):
        email_pairs(df).collect()


def test_email_invariants_on_adapters(spark):
    """One row per (tiktok_id, email); is_current rows carry the creator's
    max updated_at; keys unique."""
    from pyspark.sql import functions as F
    from idloom.plans.catalog import _pipe
    e = _pipe(spark, "/root/testdata/sf0.001").email
    assert e.count() == e.select("tiktok_id", "email").distinct().count()
    assert e.select("creator_email_id").distinct().count() == e.count()
    mx = e.groupBy("tiktok_id").agg(F.max("updated_at").alias("mx"))
    bad = e.join(mx, "tiktok_id").filter(F.col("is_current") & (F.col("updated_at") != F.col("mx")))
    assert bad.count() == 0
    missing = e.join(mx, "tiktok_id").filter(~F.col("is_current") & (F.col("updated_at") == F.col("mx")))
    assert missing.count() == 0


def test_keys_stable_under_repartition(spark):
    from idloom.plans.catalog import _pipe
    p = _pipe(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in p.email.collect())
    shuffled = {k: v.repartition(7) for k, v in p.clean.items()}
    from idloom.operators.email import email_dimension
    b = sorted(tuple(r) for r in email_dimension(shuffled).collect())
    assert a == b


@pytest.mark.parametrize("tied", [True, False])
def test_hot_creator_id_is_split(spark, tied):
    """A third of all pairs belong to one creator id (the blank id of the
    original data), with one date or many. The join and the window give the
    same flags, and both sides of the join have a shuffle right below them,
    which is what adaptive execution needs to split the id."""
    import re

    from pyspark.sql import functions as F
    n = 30000
    date = F.lit("2024-01-01") if tied else F.timestamp_seconds(F.col("id") % 1000)
    pairs = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise((F.col("id") % 5000).cast("string")).alias("tiktok_id"),
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("email"),
        F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(date).cast("timestamp_ntz").alias("updated_at")))
    res = [sorted((r.tiktok_id, r.email, r.is_current) for r in flag_latest_per_creator(pairs, strategy=s).collect())
           for s in ("join", "window")]
    assert res[0] == res[1]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flag_latest_per_creator(pairs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [re.sub(r"^[\s:+\-]*", "", x) for x in plan.splitlines()]
    at = next(i for i, x in enumerate(lines) if x.startswith("SortMergeJoin"))
    assert sum(x.startswith("Exchange hashpartitioning(tiktok_id") and "ENSURE_REQUIREMENTS" in x and "_hash" in x for x in lines[at:]) == 2
