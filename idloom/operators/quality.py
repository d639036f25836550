"""Data-quality checks on the published tables.

A check passes when it returns no rows. ``not_null`` / ``accepted_values``
are row-level and ``summary`` evaluates all of them for one table in a single
aggregate pass; ``unique`` and ``no_multi`` need one grouping each.
``unique`` and ``accepted_values`` ignore NULLs (standard semantics).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str            # not_null | unique | accepted_values | no_multi
    model: str
    column: str | None = None
    values: tuple = ()

    @property
    def name(self) -> str:
        if self.kind == "no_multi":
            return f"no_multi_tiktok_per_external_id_{self.model}"
        return f"{self.kind}_{self.model}_{self.column}"


# The checks declared on the three published tables.
EMAIL_SOURCES_ACCEPTED = ("CREATORINFO", "HYDRATE", "MARKET", "BRAVO_V1", "BRAVO_V2", "ECHO")
CHECKS = (
    Check("not_null", "dim_creator_handle_log", "tiktok_id"),
    Check("not_null", "dim_creator_handle_log", "handle"),
    Check("not_null", "dim_creator_handle_log", "valid_from"),
    Check("no_multi", "dim_creator_id_map"),
    Check("not_null", "dim_creator_id_map", "map_id"),
    Check("unique", "dim_creator_id_map", "map_id"),
    Check("not_null", "dim_creator_id_map", "id_type"),
    Check("accepted_values", "dim_creator_id_map", "id_type", ("tiktok_creator_id",)),
    Check("not_null", "dim_creator_id_map", "id"),
    Check("not_null", "dim_creator_id_map", "id_source"),
    Check("accepted_values", "dim_creator_id_map", "id_source", ("echo",)),
    Check("not_null", "dim_creator_email", "creator_email_id"),
    Check("unique", "dim_creator_email", "creator_email_id"),
    Check("not_null", "dim_creator_email", "tiktok_id"),
    Check("not_null", "dim_creator_email", "email"),
    Check("accepted_values", "dim_creator_email", "data_source", EMAIL_SOURCES_ACCEPTED),
    Check("accepted_values", "dim_creator_email", "is_current", (True, False)),
)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once: ``(col, n_records)``."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def no_multi_tiktok_per_external_id(df: DataFrame) -> DataFrame:
    """External ids mapped to more than one creator id: ``(id_type, id)``.
    ``count(distinct x) > 1`` is written as ``min(x) <> max(x)``: same answer,
    but a plain partial aggregate with no distinct expansion."""
    return (df.filter(F.col("tiktok_id").isNotNull()).groupBy("id_type", "id")
              .agg(F.min("tiktok_id").alias("_lo"), F.max("tiktok_id").alias("_hi"))
              .filter(F.col("_lo") != F.col("_hi")).select("id_type", "id"))


def offenders(df: DataFrame, check: Check) -> DataFrame:
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "no_multi":
        return no_multi_tiktok_per_external_id(df)
    raise ValueError(check.kind)


def _row_level_condition(check: Check):
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    return c.isNotNull() & ~c.isin(list(check.values))


def _pooled(df: DataFrame, model: str, checks) -> DataFrame | None:
    """Row-level and ``unique`` checks of one table from ONE aggregate.

    ``groupingSets`` with the grand total ``()`` plus one set per unique
    column: the grand-total row carries the row-level failure counts, and
    each unique column's groups carry their record counts. A second, tiny
    aggregate over that output counts the offending groups. The table is
    scanned once, and all buffers are counts, so it stays a hash aggregate.
    """
    rows = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    uniq = [c for c in checks if c.kind == "unique"]
    if not rows and not uniq:
        return None
    keys = list(dict.fromkeys(c.column for c in uniq))
    sets = [[]] + [[k] for k in keys]
    g = df.groupingSets(sets, *keys).agg(
        *[F.count(F.when(_row_level_condition(c), 1)).alias(f"c{i}") for i, c in enumerate(rows)],
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
    full = (1 << len(keys)) - 1  # grouping id of the grand total
    gid_of = {k: full & ~(1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    total = F.col("_gid") == full
    counts = [F.max(F.when(total, F.col(f"c{i}"))).alias(f"r{i}") for i in range(len(rows))]
    counts += [F.count(F.when((F.col("_gid") == gid_of[c.column]) & F.col(c.column).isNotNull()
                              & (F.col("_n") > 1), 1)).alias(f"u{j}") for j, c in enumerate(uniq)]
    per_check = [(c, f"r{i}") for i, c in enumerate(rows)] + [(c, f"u{j}") for j, c in enumerate(uniq)]
    return g.agg(*counts).select(F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(model).alias("model"),
                 F.lit(c.column).cast("string").alias("column_name"),
                 F.coalesce(F.col(col), F.lit(0)).cast("long").alias("failures"))
        for c, col in per_check])).alias("r")).select("r.*")


def summary(tables: dict[str, DataFrame], checks=CHECKS) -> DataFrame:
    """One row per check: ``(check_name, model, column_name, failures)``.

    Per table, the row-level and ``unique`` checks come from one pooled
    aggregate (``_pooled``); ``no_multi`` (a min/max over text, which needs a
    sort-based aggregate) runs as its own grouping so the pooled pass stays
    hash-based.
    """
    parts = []
    for model, df in tables.items():
        mine = [c for c in checks if c.model == model]
        pooled = _pooled(df, model, mine)
        if pooled is not None:
            parts.append(pooled)
        for c in mine:
            if c.kind == "no_multi":
                parts.append(offenders(df, c).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(c.name).alias("check_name"), F.lit(model).alias("model"),
                    F.lit(None).cast("string").alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def multi_owner_handles(timeline: DataFrame) -> DataFrame:
    """Handles with more than one current owner (undated pairs leave the
    previous pair open too): ``(handle, n_current_owners)``."""
    return (timeline.filter(F.col("is_current_owner"))
                    .groupBy(F.col("handle_name").alias("handle"))
                    .agg(F.count(F.lit(1)).alias("n_current_owners"))
                    .filter(F.col("n_current_owners") > 1))
