"""Source registry: each raw source is a (format, path, options) entry read
with ``spark.read``; nothing is read until an action runs, so Catalyst pushes
column pruning and filters into every scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The ten raw source names of the warehouse database RAW.S3.
SOURCE_NAMES = (
    "CREATORINFO", "CRMCREATOR", "HYDRATE", "MARKET", "SEARCHINFO",
    "BRAVO_V1", "BRAVO_V2", "ECHO", "ADDRESS_PHONE", "ZIP_LAT_LON",
)

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


@dataclass
class SourceEntry:
    format: str
    path: str
    options: dict = field(default_factory=dict)


class SourceRegistry:
    """``{NAME: SourceEntry}``; ``read(spark)`` returns ``{NAME: DataFrame}``."""

    def __init__(self, entries: dict[str, SourceEntry] | None = None):
        self.entries: dict[str, SourceEntry] = {}
        for name, e in (entries or {}).items():
            self.register(name, e.format, e.path, **e.options)

    def register(self, name: str, fmt: str, path: str, **options) -> "SourceRegistry":
        key = name.upper()
        if key not in SOURCE_NAMES:
            raise KeyError(f"unknown source {name!r}; expected one of {SOURCE_NAMES}")
        self.entries[key] = SourceEntry(fmt, path, options)
        return self

    def read_one(self, spark: SparkSession, name: str) -> DataFrame:
        e = self.entries[name.upper()]
        return spark.read.format(e.format).options(**e.options).load(e.path)

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {n: self.read_one(spark, n) for n in self.entries}


# Schemas of the driver tables the adapters read. Giving them
# skips Parquet schema inference, which costs one small Spark job per table.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_driver_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """The driver's parquet tables under ``sf_dir`` as lazy DataFrames."""
    out = {}
    for n in names or DRIVER_TABLES:
        reader = spark.read.schema(DRIVER_SCHEMAS[n]) if n in DRIVER_SCHEMAS else spark.read
        out[n] = reader.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")
    return out
