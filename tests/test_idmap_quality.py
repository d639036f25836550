import pytest

from helpers import ts
from idloom.operators import quality
from idloom.operators.idmap import external_id_map


def echo(spark, rows):
    return spark.createDataFrame(rows, "tiktok_id string, creator_id string")


def test_f14_id_normalising(spark):
    ids = ["temp_temp_12_x", "tiktok_12", "12_a_b", "tiktok_tiktok_9", "temp_99", "tiktok_"]
    out = [r.id for r in external_id_map(echo(spark, [("1", i) for i in ids])).collect()]
    assert out == ["12", "12", "12", "tiktok", "temp", ""]


def test_null_creator_id_dropped(spark):
    assert external_id_map(echo(spark, [("1", None)])).count() == 0


def test_f15_duplicate_external_id(spark):
    m = external_id_map(echo(spark, [("1", "abc"), ("1", "abc")]))
    assert m.select("map_id").distinct().count() == 1 and m.count() == 2
    assert quality.unique(m, "map_id").collect()[0]["n_records"] == 2
    assert external_id_map(echo(spark, [("1", "abc"), ("1", "abc")]), dedupe=True).count() == 1


def test_f16_conflicting_external_id(spark):
    m = external_id_map(echo(spark, [("A", "12_a"), ("B", "12_b"), (None, "12_c"), ("C", "7")]))
    bad = [tuple(r) for r in quality.no_multi_tiktok_per_external_id(m).collect()]
    assert bad == [("tiktok_creator_id", "12")]


def test_accepted_values_ignores_null(spark):
    df = spark.createDataFrame([("echo",), (None,), ("other",)], "id_source string")
    assert [r[0] for r in quality.accepted_values(df, "id_source", ["echo"]).collect()] == ["other"]


def test_summary_matches_offenders(spark):
    log = spark.createDataFrame([("A", "h", ts("2024-01-01"), None, True), ("B", "h", None, None, True)],
                                "tiktok_id string, handle string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current_owner boolean")
    idm = external_id_map(echo(spark, [("A", "12_a"), ("B", "12_b"), ("A", "12_a")]))
    em = spark.createDataFrame([("k", "A", "e", "NOPE", True), ("k", "A", "f", "ECHO", None)],
                               "creator_email_id string, tiktok_id string, email string, data_source string, is_current boolean")
    tables = {"dim_creator_handle_log": log, "dim_creator_id_map": idm, "dim_creator_email": em}
    s = {r.check_name: r.failures for r in quality.summary(tables).collect()}
    assert len(s) == 17
    for c in quality.CHECKS:
        n = quality.offenders(tables[c.model], c).count()
        assert s[c.name] == n, c.name
    assert s["not_null_dim_creator_handle_log_valid_from"] == 1
    assert s["unique_dim_creator_id_map_map_id"] == 1
    assert s["no_multi_tiktok_per_external_id_dim_creator_id_map"] == 1
    assert s["unique_dim_creator_email_creator_email_id"] == 1
    assert s["accepted_values_dim_creator_email_data_source"] == 1


def test_multi_owner_handles(spark):
    tl = spark.createDataFrame([("h", "A", True), ("h", "B", True), ("g", "C", True), ("g", "D", False)],
                               "handle_name string, tiktok_id string, is_current_owner boolean")
    assert [tuple(r) for r in quality.multi_owner_handles(tl).collect()] == [("h", 2)]
