"""Plan-shape tests and the driver contract."""

import hashlib

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from idloom.plans.catalog import QUERIES, _pipe
from idloom.plans.oracles import oracle_sql
from idloom.plans.pipeline import target_schema
from idloom.plans.writers import write_table
from idloom.sources.adapters import ADAPTER_COLUMNS, raw_sources


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["tiktok_id", "handle", "valid_from", "valid_to", "is_current_owner"]
    assert df.count() > 0


def test_every_query_has_oracle():
    """The reference's own operators; other registered queries may have none."""
    assert set(QUERIES) == set(oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_adapter_columns(spark):
    raw = raw_sources(spark, SF_SMALL)
    for name, df in raw.items():
        assert tuple(df.columns) == ADAPTER_COLUMNS[name], name


def test_timeline_scans_only_sources_with_both_keys(spark):
    p = _pipe(spark, SF_SMALL)
    from idloom.operators.timeline import first_seen_pairs
    plan = plan_text(first_seen_pairs(p.observations))
    # CREATORINFO (orders), HYDRATE (events), MARKET (lineitem): 3 scans
    assert plan.count("FileScan parquet") == 3 or plan.count("Scan parquet") == 3


def test_email_pairs_have_no_join_and_no_python(spark):
    from idloom.operators.email import email_observations, email_pairs
    p = _pipe(spark, SF_SMALL)
    plan = plan_text(email_pairs(email_observations(p.clean)))
    assert "Join" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_observation_projection_is_pruned(spark):
    p = _pipe(spark, SF_SMALL)
    plan = p.observations._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_extendedprice" not in plan


def test_target_schema():
    assert target_schema("prod", "core", "analytics") == "CORE"
    assert target_schema("prod", None, "analytics") == "ANALYTICS"
    assert target_schema("dev", "core", "dbt_me") == "dbt_me"


def test_write_table_with_comments(spark, tmp_path):
    df = spark.createDataFrame([("A", "h")], "tiktok_id string, handle string")
    back = write_table(spark, df, "dim_creator_handle_log", schema="CORE", root=str(tmp_path))
    assert back.count() == 1
    assert (tmp_path / "CORE" / "dim_creator_handle_log").exists()


def test_registry_reads_sources(spark, tmp_path):
    from idloom.sources.registry import SourceRegistry
    raw = raw_sources(spark, SF_SMALL, ["ECHO"])["ECHO"]
    raw.write.parquet(str(tmp_path / "echo"))
    reg = SourceRegistry().register("echo", "parquet", str(tmp_path / "echo"))
    assert reg.read(spark)["ECHO"].count() == raw.count()
    with pytest.raises(KeyError):
        reg.register("NOPE", "parquet", "x")


def test_register_views_sql(spark):
    p = _pipe(spark, SF_SMALL)
    names = p.register_views(["stg_echo", "dim_creator_id_map", "stg_tiktok_id_handle_map"])
    assert names == ["stg_echo", "dim_creator_id_map", "stg_tiktok_id_handle_map"]
    n = spark.sql("select count(*) from dim_creator_id_map").collect()[0][0]
    assert n == p.id_map.count()
    assert spark.sql("select count(*) from stg_echo").collect()[0][0] == p.raw["ECHO"].count()


def test_publish_and_check(spark, tmp_path):
    p = _pipe(spark, SF_SMALL)
    tables = p.publish(spark, root=str(tmp_path))
    assert set(tables) == {"dim_creator_handle_log", "dim_creator_id_map", "dim_creator_email"}
    s = {r.check_name: r.failures for r in p.quality_summary(tables).collect()}
    assert len(s) == 17
    assert s["not_null_dim_creator_email_creator_email_id"] == 0
    assert (tmp_path / "analytics" / "dim_creator_email").exists()
    meta = tables["dim_creator_email"].schema["email"].metadata
    assert "comment" in meta  # Parquet keeps Spark field metadata


def test_command_line_end_to_end(spark, tmp_path):
    import json
    from idloom.plans.run import main
    raw = raw_sources(spark, SF_SMALL)
    spec = {}
    for name in raw:
        path = str(tmp_path / "raw" / name.lower())
        raw[name].write.parquet(path)
        spec[name] = {"format": "parquet", "path": path}
    (tmp_path / "sources.json").write_text(json.dumps(spec))
    code = main(["--sources", str(tmp_path / "sources.json"), "--out", str(tmp_path / "wh"),
                 "--env", "prod", "--missing", "null"])
    # The adapters plant undated pairs and repeated external ids, so the
    # not_null(valid_from) and unique(map_id) checks report failures.
    assert code == 1
    for t in ("dim_creator_handle_log", "dim_creator_id_map", "dim_creator_email"):
        assert (tmp_path / "wh" / "CORE" / t).exists()


def test_catalog_write_keeps_comments(spark):
    df = spark.createDataFrame([("A", "e")], "tiktok_id string, email string")
    t = write_table(spark, df, "dim_creator_email", schema="CORE")
    assert t.count() == 1
    desc = {r.col_name: r.comment for r in spark.sql("describe table CORE.dim_creator_email").collect()}
    assert desc["email"].startswith("Creator email address")
    ext = {r.col_name: r.data_type for r in spark.sql("describe table extended CORE.dim_creator_email").collect()}
    assert ext["Comment"].startswith("A table of creator email addresses")


def test_cleanup_materialized(spark):
    import os
    from idloom.session import _WRITTEN, cleanup_materialized, materialize
    cleanup_materialized(spark)
    df = materialize(spark.range(10), "probe")
    path = _WRITTEN[-1]
    assert df.count() == 10 and os.path.exists(path.replace("file:", ""))
    assert cleanup_materialized(spark) == 1
    assert not os.path.exists(path.replace("file:", ""))


def test_pushdown_and_pruning_on_raw_parquet(spark, tmp_path):
    """With raw sources stored as Parquet (the deployment shape), the email
    scans push IsNotNull(tiktok_id) into the reader and read 4 columns."""
    import re
    from idloom.operators.email import email_observations, email_pairs
    from idloom.plans.pipeline import Pipeline
    from idloom.sources.registry import SourceRegistry
    reg = SourceRegistry()
    for name, df in raw_sources(spark, SF_SMALL).items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        reg.register(name, "parquet", path)
    p = Pipeline(reg.read(spark), missing="null")
    plan = plan_text(email_pairs(email_observations(p.clean)))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 6
    for cols, pushed in scans:
        assert "IsNotNull(tiktok_id)" in pushed
        assert len(cols.split(",")) == 4
    # the pipeline's email inputs also push the raw email column's IS NOT NULL
    plan = plan_text(email_pairs(email_observations(p._email_inputs())))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 6
    for cols, pushed in scans:
        assert "IsNotNull(tiktok_id)" in pushed
        assert re.search(r"IsNotNull\((email|email_address)\)", pushed), pushed



def test_timeline_scans_push_raw_not_null(spark, tmp_path):
    import re
    from idloom.operators.observe import observation_map
    from idloom.operators.timeline import first_seen_pairs
    from idloom.plans.pipeline import Pipeline
    from idloom.sources.registry import SourceRegistry
    reg = SourceRegistry()
    for name, df in raw_sources(spark, SF_SMALL).items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        reg.register(name, "parquet", path)
    raw = reg.read(spark)
    plan = plan_text(first_seen_pairs(observation_map(raw, complete_only=True)))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 3
    for _cols, pushed in scans:
        assert "IsNotNull(tiktok_id)" in pushed and "IsNotNull(handle_name)" in pushed
    a = sorted(map(tuple, first_seen_pairs(observation_map(raw, complete_only=True)).collect()), key=str)
    b = sorted(map(tuple, first_seen_pairs(observation_map(raw)).collect()), key=str)
    assert a == b
