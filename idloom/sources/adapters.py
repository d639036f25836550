"""Adapters that shape the driver's test tables into the ten raw sources.

Each adapter is one SQL text with ``{table}`` placeholders. Spark runs it as
``spark.sql(text, orders=df, ...)`` and the DuckDB oracle runs the very same
text with the placeholders replaced by view names, so both engines see
identical raw rows. Every adapter reads its whole driver table; modulo
arithmetic appears only inside CASE expressions, where it plants the blank
ids, blank handles, missing timestamps and prefixed ids the pipeline must
cope with.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from idloom.sources.raw_columns import RAW_COLUMNS
from idloom.sources.registry import read_driver_tables

_BASE_SQL: dict[str, str] = {
    "CREATORINFO": """
select case when o_orderkey % 11 = 0 then ' ' when o_orderkey % 13 = 0 then null
            else cast(o_custkey % 300 as string) end as tiktok_id,
       case when o_orderkey % 17 = 0 then '  '
            else concat('  H_', cast(o_custkey % 211 as string), ' ') end as handle_name,
       case when o_orderkey % 19 = 0 then ' '
            else concat(' U', cast(o_orderkey % 3 as string), '_', cast(o_custkey % 300 as string), '@X.COM ') end as email_address,
       o_orderdate as create_date,
       case when o_orderkey % 5 = 0 then null else o_orderdate + interval '3' day end as last_update
from {orders}""",
    "CRMCREATOR": """
select concat(case when o_orderkey % 2 = 0 then 'CRM_' else 'H_' end, cast(o_orderkey % 150 as string)) as handle_name,
       cast(o_custkey as string) as creator_id,
       o_orderdate as create_date, o_orderdate as last_update
from {orders}""",
    "HYDRATE": """
select cast(user_id as string) as tiktok_id,
       concat('h_', cast(event_id % 400 as string)) as handle_name,
       concat('u', cast(event_id % 3 as string), '_', cast(user_id as string), '@x.com') as email_address,
       case when event_id % 100 = 0 then null else ts end as acct_create,
       case when event_id % 100 = 0 or event_id % 7 = 0 then null else ts end as handle_modify,
       ts as create_date, ts as last_update
from {events}""",
    "MARKET": """
select cast(l_suppkey as string) as tiktok_id,
       concat(' M_', cast(l_partkey % 250 as string)) as handle_name,
       concat('u0_', cast(l_suppkey as string), '@x.com') as email_address,
       l_shipdate as create_date,
       l_shipdate + interval '10' day as last_update
from {lineitem}""",
    "SEARCHINFO": """
select concat('S_', cast(event_id % 90 as string)) as handle_name,
       ts as create_date, case when event_id % 8 = 0 then null else ts end as last_update
from {events}""",
    "BRAVO_V1": """
select concat('b', cast(o_custkey as string)) as tiktok_id, 'ignored' as handle_name,
       concat('b', cast(o_custkey as string), '@x.com') as email,
       o_orderdate as created_at, o_orderdate as updated_at
from {orders}""",
    "BRAVO_V2": """
select cast(user_id as string) as tiktok_id, 'ignored' as handle_name,
       case when event_id % 6 = 0 then null else concat('u1_', cast(user_id as string), '@X.com') end as email,
       ts as created_at, ts + interval '1' day as updated_at
from {events}""",
    "ECHO": """
select case when event_id % 9 = 0 then null else cast(user_id as string) end as tiktok_id,
       'ignored' as handle_name,
       case when event_id % 10 = 0 then null
            else concat(case event_id % 3 when 0 then 'temp_temp_' when 1 then 'tiktok_' else '' end,
                        cast(user_id as string), '_', event_type) end as creator_id,
       concat('u2_', cast(user_id as string), '@x.com') as email,
       ts as created_time, ts as last_updated_time
from {events}""",
    "ADDRESS_PHONE": """
select cast(c_custkey as string) as data_id, concat('h_', cast(c_custkey % 211 as string)) as handle_name,
       c_name as first_last, cast(c_custkey + 5550000 as string) as phone_number,
       cast(c_nationkey as string) as country, c_mktsegment as state, c_mktsegment as city,
       cast(10000 + c_nationkey as string) as zipcode, c_name as address_1, '' as address_2
from {customer}""",
    "ZIP_LAT_LON": """
select cast(10000 + n_nationkey as string) as zipcode,
       cast(n_nationkey as double) + 0.25 as latitude, cast(n_regionkey as double) - 0.5 as longitude
from {nation}""",
}

_BASE_COLUMNS = {
    "CREATORINFO": ("tiktok_id", "handle_name", "email_address", "create_date", "last_update"),
    "CRMCREATOR": ("handle_name", "creator_id", "create_date", "last_update"),
    "HYDRATE": ("tiktok_id", "handle_name", "email_address", "acct_create", "handle_modify",
                "create_date", "last_update"),
    "MARKET": ("tiktok_id", "handle_name", "email_address", "create_date", "last_update"),
    "SEARCHINFO": ("handle_name", "create_date", "last_update"),
    "BRAVO_V1": ("tiktok_id", "handle_name", "email", "created_at", "updated_at"),
    "BRAVO_V2": ("tiktok_id", "handle_name", "email", "created_at", "updated_at"),
    "ECHO": ("tiktok_id", "handle_name", "creator_id", "email", "created_time", "last_updated_time"),
    "ADDRESS_PHONE": ("data_id", "handle_name", "first_last", "phone_number", "country", "state",
                      "city", "zipcode", "address_1", "address_2"),
    "ZIP_LAT_LON": ("zipcode", "latitude", "longitude"),
}

# What numbers the rows of each driver table.
_ROW = {"orders": "o_orderkey", "events": "event_id", "lineitem": "(l_orderkey * 8 + l_linenumber)"}


def _derived(row: str, k: int, form: str) -> str:
    """A raw text for the k-th further column of a source, in the forms that its
    cleaning has to deal with: blanks, spaces, capitals, fractions, signs,
    on/off and NULLs."""
    n = f"({row} + {k})"
    if form == "number":
        value = f"concat(cast({n} % 1000 - 500 as string), case {n} % 4 when 1 then '.5' else '' end)"
    elif form == "float":
        value = f"concat(cast({n} % 997 - 400 as string), '.25')"
    elif form in ("timestamp", "date"):
        time = f", ' 0', cast({n} % 10 as string), ':30:00'" if form == "timestamp" else ""
        value = f"concat('202', cast({row} % 5 as string), '-0', cast(1 + {n} % 9 as string), '-1', cast({row} % 10 as string){time})"
    elif form == "boolean":
        value = f"case {n} % 6 when 0 then 'on' when 1 then 'OFF' when 2 then 'yes' when 3 then 'no' when 4 then 'true' else 'false' end"
    elif form == "varchar":
        value = f"concat('V', cast({n} % 29 as string))"
    else:
        value = f"case when {n} % 13 = 0 then '  ' else concat('  Val_', cast({n} % 23 as string), ' ') end"
    return f"case when {n} % 11 = 0 then null else {value} end"


def _full(source: str) -> tuple[str, tuple]:
    """The adapter with every raw column of the source."""
    text, names = _BASE_SQL[source], _BASE_COLUMNS[source]
    head, table = text.rsplit("\nfrom {", 1)
    table = table.rstrip("}")
    more = [(c, form) for c, form in RAW_COLUMNS[source].items() if c not in names]
    if not more:
        return text, names
    exprs = ",\n       ".join(f"{_derived(_ROW[table], k, form)} as {c}" for k, (c, form) in enumerate(more))
    return f"{head},\n       {exprs}\nfrom {{{table}}}", (*names, *(c for c, _ in more))


ADAPTER_SQL: dict[str, str] = {s: _full(s)[0] for s in _BASE_SQL}
# Columns each adapter produces (checked against Spark's schema in tests).
ADAPTER_COLUMNS: dict[str, tuple] = {s: _full(s)[1] for s in _BASE_SQL}

TABLES_USED = ("orders", "events", "lineitem", "customer", "nation")


def adapter_sql_for(name: str) -> str:
    """Adapter text with plain table names, for DuckDB (views pre-registered)."""
    return ADAPTER_SQL[name].format(**{t: t for t in TABLES_USED})


def adapter_ctes(names) -> str:
    """``raw_<name> as (...)`` CTE list for oracle SQL."""
    return ",\n".join(f"raw_{n.lower()} as ({adapter_sql_for(n)}\n)" for n in names)


class LazySources(Mapping):
    """``{SOURCE: DataFrame}`` whose adapters are analysed on first access, so
    a query that needs one source does not pay for analysing all ten."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=None):
        self._spark, self._dir = spark, sf_dir
        self._names = tuple(names or ADAPTER_SQL)
        self._tables: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def _table(self, t: str) -> DataFrame:
        if t not in self._tables:
            self._tables[t] = read_driver_tables(self._spark, self._dir, [t])[t]
        return self._tables[t]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            text = ADAPTER_SQL[name]
            kwargs = {t: self._table(t) for t in TABLES_USED if "{" + t + "}" in text}
            self._built[name] = self._spark.sql(text, **kwargs)
        return self._built[name]

    def __contains__(self, name) -> bool:  # membership must not build the adapter
        return name in self._names

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


def raw_sources(spark: SparkSession, sf_dir: str, names=None) -> Mapping:
    """``{SOURCE: DataFrame}`` shaped from the driver tables under ``sf_dir``."""
    return LazySources(spark, sf_dir, names)
