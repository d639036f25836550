from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from idloom.functions.casts import cast_to
from idloom.functions.text import clean_lower, clean_text
from idloom.operators.staging import SPECS, apply_spec, clean_source


def test_spec_widths():
    widths = {k: len(v.columns) for k, v in SPECS.items()}
    assert widths == {"CREATORINFO": 27, "CRMCREATOR": 13, "HYDRATE": 19, "MARKET": 74,
                      "SEARCHINFO": 20, "BRAVO_V1": 22, "BRAVO_V2": 37, "ECHO": 30,
                      "ADDRESS_PHONE": 10, "ZIP_LAT_LON": 3}
    assert sum(widths.values()) == 255


def test_f1_blank_text(spark):
    df = spark.createDataFrame([("",), ("   ",), (" A b ",), (None,), ("\tA",)], "x string")
    out = [r[0] for r in df.select(clean_text("x")).collect()]
    assert out == [None, None, "A b", None, "\tA"]
    low = [r[0] for r in df.select(clean_lower("x")).collect()]
    assert low == [None, None, "a b", None, "\ta"]


def test_clean_is_idempotent(spark):
    df = spark.createDataFrame([(" Ab ",), ("",), (None,), ("x y",)], "x string")
    once = df.select(clean_lower("x").alias("x"))
    twice = once.select(clean_lower("x").alias("x"))
    assert once.collect() == twice.collect()


def test_f2_number_cast(spark):
    df = spark.createDataFrame([("1.5",), ("-1.5",), ("12",), (None,)], "x string")
    out = [r[0] for r in df.select(cast_to(F.col("x"), "number")).collect()]
    assert out == [Decimal(2), Decimal(-2), Decimal(12), None]


@pytest.mark.parametrize("bad", ["", "x"])
def test_f2_strict_raises_lenient_nulls(spark, bad):
    df = spark.createDataFrame([(bad,)], "x string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        df.select(cast_to(F.col("x"), "number", "strict")).collect()
    assert df.select(cast_to(F.col("x"), "number", "lenient")).collect()[0][0] is None


def test_boolean_words(spark):
    df = spark.createDataFrame([("on",), ("OFF",), ("yes",), ("t",), ("0",), (None,)], "x string")
    out = [r[0] for r in df.select(cast_to(F.col("x"), "boolean")).collect()]
    assert out == [True, False, True, True, False, None]


def test_float_id_rejected(spark):
    df = spark.createDataFrame([(1.2e18, "h")], "tiktok_id double, handle_name string")
    with pytest.raises(TypeError, match="floating"):
        clean_source(df, "BRAVO_V1", missing="drop")


def test_full_width_row_count_and_types(spark):
    spec = SPECS["HYDRATE"]
    row = {c.name: None for c in spec.columns}
    row.update(handle_name="  Foo ", tiktok_id="12", acct_create="2024-01-02", is_tts="on",
               is_commerce="no", fan_cnt="10.5", create_date="2024-01-02 03:04:05")
    df = spark.createDataFrame([row, {**row, "handle_name": " "}],
                               ", ".join(f"{c.name} string" for c in spec.columns))
    out = apply_spec(df, spec)
    assert out.columns == spec.names()
    assert out.count() == 2
    types = dict(out.dtypes)
    assert types["fan_cnt"] == "decimal(38,0)" and types["create_date"] == "timestamp_ntz"
    assert types["acct_create"] == "date" and types["is_tts"] == "boolean"
    r = out.collect()
    assert r[0]["handle_name"] == "foo" and r[1]["handle_name"] is None
    assert r[0]["is_tts"] is True and r[0]["is_commerce"] is False
    assert r[0]["fan_cnt"] == Decimal(11)


def test_missing_columns(spark):
    df = spark.createDataFrame([("1", "x")], "tiktok_id string, handle_name string")
    with pytest.raises(KeyError):
        apply_spec(df, SPECS["ECHO"])
    assert apply_spec(df, SPECS["ECHO"], missing="drop").columns == ["handle_name", "tiktok_id"]
    assert len(apply_spec(df, SPECS["ECHO"], missing="null").columns) == 30


def test_ids_not_blank_collapsed(spark):
    # T2: the cleaning layer casts ids but does not trim or blank them.
    df = spark.createDataFrame([(" ", "e@x")], "tiktok_id string, email string")
    r = clean_source(df, "BRAVO_V1", missing="drop").collect()[0]
    assert r["tiktok_id"] == " "


def test_blank_id_to_null_option(spark):
    from idloom.config import PipelineConfig
    from idloom.operators.email import email_dimension
    from idloom.plans.pipeline import Pipeline
    raw = {"BRAVO_V1": spark.createDataFrame([(" ", "e@x", None, None), ("7", "f@x", None, None)],
                                             "tiktok_id string, email string, created_at timestamp_ntz, updated_at timestamp_ntz")}
    keep = Pipeline(raw, missing="drop")
    assert {r.tiktok_id for r in keep.email.collect()} == {" ", "7"}
    drop = Pipeline(raw, PipelineConfig(blank_id_to_null=True), missing="drop")
    assert {r.tiktok_id for r in drop.email.collect()} == {"7"}


def test_upper_case_raw_columns_and_float_ids(spark):
    raw = spark.createDataFrame([("1", "s")], "TIKTOK_ID string, HANDLE_NAME string")
    out = clean_source(raw, "CREATORINFO", missing="drop")
    assert out.columns == ["tiktok_id", "handle_name"] and out.collect()[0][0] == "1"
    for name, source in (("tiktok_id", "MARKET"), ("creator_open_id", "BRAVO_V2")):
        with pytest.raises(TypeError, match="floating"):
            clean_source(spark.createDataFrame([(1.5,)], f"{name} double"), source, missing="drop")


def test_the_map_honours_cast_mode_and_float_ids(spark):
    from idloom.config import PipelineConfig
    from idloom.operators.observe import observation_map

    raw = spark.createDataFrame([("1", "h", "2024-01-01", "no date")], "TIKTOK_ID string, handle_name string, create_date string, last_update string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        observation_map({"CREATORINFO": raw}).collect()
    r = observation_map({"CREATORINFO": raw}, PipelineConfig(cast_mode="lenient")).collect()[0]
    assert r.created_at is not None and r.updated_at is None
    with pytest.raises(TypeError, match="floating"):
        observation_map({"CREATORINFO": raw.withColumn("TIKTOK_ID", F.lit(1.5))})


def test_strict_casts_need_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            clean_source(spark.createDataFrame([("1",)], "tiktok_id string"), "CREATORINFO", missing="drop")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_wide_cleaning_runs_in_methods_that_the_jvm_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    s = spark.newSession()
    for limit, kept in (("65535", "8000"), ("20000", "20000")):  # Spark's default, a session's own choice
        s.conf.set(key, limit)
        raw = s.range(3).select(*[F.lit(None).cast("string").alias(c.name) for c in SPECS["MARKET"].columns])
        assert clean_source(raw, "MARKET").count() == 3
        assert s.conf.get(key) == kept
