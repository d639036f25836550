"""The oracle SQL states sources, columns, rules and checks on its own: a
changed rule of the library turns its row red."""

import inspect

import duckdb
import pytest

from helpers import SF_SMALL
from idloom.operators import email, observe, quality, staging
from idloom.plans import catalog, oracles
from idloom.sources import adapters, raw_columns
from idloom.sources.registry import DRIVER_TABLES


def agree(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    answer = con.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return False
    return sorted(map(repr, answer.fetchall())) == sorted(map(repr, map(tuple, df.select(*names).collect())))


def rule(source, column, **change):
    spec = staging.SPECS[source]
    columns = tuple(staging.ColumnSpec(**{**vars(c), **change}) if c.name == column else c for c in spec.columns)
    return source, staging.StagingSpec(source, columns)


def test_nothing_is_taken_from_the_operators():
    for module in (oracles, adapters, raw_columns):
        assert "idloom.operators" not in inspect.getsource(module)


@pytest.mark.parametrize("query, source, column, change", [
    ("clean_crmcreator", "CRMCREATOR", "display_name", {"rule": "C"}),
    ("clean_crmcreator", "CRMCREATOR", "display_name", {"rule": "TL"}),
    ("clean_crmcreator", "CRMCREATOR", "code", {"wtype": "float"}),
    ("clean_zip_lat_lon", "ZIP_LAT_LON", "latitude", {"wtype": "number"}),
])
def test_a_changed_cleaning_rule_shows(spark, monkeypatch, query, source, column, change):
    assert agree(spark, query)
    monkeypatch.setitem(staging.SPECS, *rule(source, column, **change))
    assert not agree(spark, query)


def test_a_missing_column_shows(spark, monkeypatch):
    spec = staging.SPECS["CRMCREATOR"]
    monkeypatch.setitem(staging.SPECS, "CRMCREATOR", staging.StagingSpec("CRMCREATOR", spec.columns[1:]))
    assert not agree(spark, "clean_crmcreator")


def test_a_changed_check_shows(spark, monkeypatch):
    assert agree(spark, "quality_summary")
    monkeypatch.setattr(quality.summary, "__defaults__", (quality.CHECKS[1:],))
    assert not agree(spark, "quality_summary")


def test_changed_sources_show(spark, monkeypatch):
    assert agree(spark, "email_observations") and agree(spark, "handle_observations")
    monkeypatch.setattr(email, "EMAIL_SOURCES", email.EMAIL_SOURCES[1:])
    assert not agree(spark, "email_observations")
    plain = {"specs": tuple(observe.ObservationSpec(**{**vars(s), "created_col": s.updated_col}) for s in observe.OBSERVATION_SPECS)}
    defaults = tuple(plain["specs"] if d is observe.OBSERVATION_SPECS else d for d in observe.observation_map.__defaults__)
    monkeypatch.setattr(observe.observation_map, "__defaults__", defaults)
    assert not agree(spark, "handle_observations")
