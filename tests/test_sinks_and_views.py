"""Safe rebuilds, the key gate, stored views, SQL over models, shared models."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from idloom.config import PipelineConfig
from idloom.plans.pipeline import Pipeline
from idloom.plans.views import create_views
from idloom.plans.writers import RefusedTable, recover, write_table
from idloom.sources import adapters
from idloom.sources.adapters import raw_sources

EMAIL = "creator_email_id string, n int"


def boom(df):
    return df.select("creator_email_id", F.expr("cast(if(n > 1, 'x', '1') as int)").alias("n"))


@pytest.mark.parametrize("files", [True, False])
def test_a_failing_or_refused_rebuild_keeps_the_old_table(spark, tmp_path, files):
    where = {"root": str(tmp_path), "schema": "CORE"} if files else {"schema": "swap_test"}
    name = "dim_creator_email"
    good = spark.createDataFrame([("a", 1), ("b", 1)], EMAIL)
    read = lambda: spark.read.parquet(f"{tmp_path}/CORE/{name}") if files else spark.table(f"swap_test.{name}")
    rows = lambda: sorted(tuple(r) for r in read().collect())
    write_table(spark, good, name, **where)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_table(spark, boom(spark.createDataFrame([("c", 1), ("d", 2)], EMAIL)), name, **where)
    assert rows() == [("a", 1), ("b", 1)]
    with pytest.raises(RefusedTable, match="repeats"):
        write_table(spark, good.unionByName(good.where("creator_email_id = 'b'")), name, **where)
    with pytest.raises(RefusedTable, match="1 rows without"):
        write_table(spark, spark.createDataFrame([(None, 1)], EMAIL), name, **where)
    assert rows() == [("a", 1), ("b", 1)]
    write_table(spark, spark.createDataFrame([("z", 5)], EMAIL), name, **where)
    assert rows() == [("z", 5)]
    twice = spark.createDataFrame([("a", 1), ("a", 2)], EMAIL)
    assert write_table(spark, twice, name, key="", **where).count() == 2
    if files:
        assert sorted(os.listdir(tmp_path / "CORE")) == [name, f"{name}_comment"]
    else:
        assert [t.name for t in spark.catalog.listTables("swap_test")] == [name]


def test_the_old_table_comes_back_after_a_half_swap(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path + ".__old")
    recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not os.path.exists(path + ".__old")
    spark.range(5).write.parquet(path + ".__old")
    recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not os.path.exists(path + ".__old")


def test_the_gate_reads_no_source_twice(spark, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counted.add(len(b))
            yield b

    df = spark.range(100).selectExpr("cast(id as string) as creator_email_id", "1 as n").mapInPandas(count, EMAIL)
    write_table(spark, df, "dim_creator_email", root=str(tmp_path))
    assert counted.value == 100


def test_stored_views_are_read_by_another_session(spark):
    raw = raw_sources(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_test")
    relations = {}
    for s in raw:
        text = adapters.ADAPTER_SQL[s].format(**{t: f"parquet.`{SF_SMALL}/{t}.parquet`" for t in adapters.TABLES_USED})
        spark.sql(f"CREATE OR REPLACE VIEW raw_test.{s.lower()} AS {text}")
        relations[s] = f"raw_test.{s.lower()}"
    names = create_views(spark, relations, PipelineConfig(env="prod"))
    assert len(names) == 13 and all(n.startswith("STAGING.stg_") for n in names)
    other = spark.newSession()
    models = Pipeline(raw)
    for name in ("stg_echo", "stg_hydrate", "stg_tiktok_id_handle_map_time", "stg_creator"):
        want, got = models._model(name), other.table(f"STAGING.{name}")
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sql_over_models_builds_those_named_alone(spark):
    p = Pipeline(raw_sources(spark, SF_SMALL))
    got = p.sql("select id_source, count(*) as n from {dim_creator_id_map} group by 1 order by 2")
    assert [r.n for r in got.collect()] == [p.id_map.count()]
    assert "email" not in p.__dict__ and "timeline" not in p.__dict__


def test_a_model_that_two_read_is_written_once(spark):
    p = Pipeline(raw_sources(spark, SF_SMALL))
    want = sorted(map(str, Pipeline(raw_sources(spark, SF_SMALL)).handle_log.collect()))
    p.share("stg_tiktok_id_handle_map", "dim_creator_handle_log")
    assert len(p._shared) == 1 and "timeline" not in p.__dict__
    files = {f.rsplit("/", 2)[-2] for f in p.handle_log.inputFiles()}
    assert len(files) == 1  # the copy, and no source
    assert sorted(map(str, p.handle_log.collect())) == want
    path = p._shared[0]
    p.close()
    assert not os.path.exists(path) and "observations" not in p.__dict__
    assert not Pipeline(raw_sources(spark, SF_SMALL)).share("dim_creator_handle_log")._shared
