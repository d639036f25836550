"""Creator spine: one row per known creator, including creators that are
missing an id or a handle.

Three disjoint parts are unioned:
  a) current (handle, id) owners from the ownership timeline
  b) ids that never appeared with a handle
  c) handles that never appeared with an id (surrogate key 'h_' || md5(handle))

``creator_key`` prefers the natural id, else the surrogate. As in the original:
an id whose every handle passed to someone else has no row, and an id that
currently owns two handles appears twice with one key.

Plan: one ``groupingSets`` aggregate over the observation map yields the
(handle, id) pairs, the per-id and the per-handle summaries in a single scan
and a single shuffle (Expand + partial aggregation), instead of three scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.config import PipelineConfig
from idloom.functions.keys import surrogate_key
from idloom.operators.observe import observed_at
from idloom.operators.timeline import timeline_from_pairs

# grouping_id() bit layout for groupingSets(..., "tiktok_id", "handle_name"):
# bit 1 = tiktok_id aggregated away, bit 0 = handle_name aggregated away.
_GID_PAIR, _GID_ID, _GID_HANDLE = 0, 1, 2


def observation_summary(obs: DataFrame) -> DataFrame:
    """Per (handle, id), per id and per handle: first sighting and how many
    sightings carried the other key. Column ``gid`` tells the grouping."""
    o = obs.select("tiktok_id", "handle_name", observed_at().alias("observed_at"))
    return (o.groupingSets([["tiktok_id", "handle_name"], ["tiktok_id"], ["handle_name"]],
                           "tiktok_id", "handle_name")
             .agg(F.min("observed_at").alias("first_observed_at"),
                  F.count("handle_name").alias("n_with_handle"),
                  F.count("tiktok_id").alias("n_with_id"),
                  F.grouping_id().alias("gid")))


def pairs_from_summary(summary: DataFrame) -> DataFrame:
    return (summary.filter((F.col("gid") == _GID_PAIR) & F.col("tiktok_id").isNotNull()
                           & F.col("handle_name").isNotNull())
                   .select("handle_name", "tiktok_id", F.col("first_observed_at").alias("handle_start")))


def keys_never_with(summary: DataFrame, key: str) -> DataFrame:
    """Keys (``tiktok_id`` or ``handle_name``) never sighted with the other key:
    ``(key, first_observed_at)``. Written as an aggregate with a post-filter,
    so no join is needed."""
    if key == "tiktok_id":
        gid, other = _GID_ID, "n_with_handle"
    elif key == "handle_name":
        gid, other = _GID_HANDLE, "n_with_id"
    else:
        raise ValueError(key)
    return (summary.filter((F.col("gid") == gid) & F.col(key).isNotNull() & (F.col(other) == 0))
                   .select(key, "first_observed_at"))


def ids_without_handle(obs: DataFrame) -> DataFrame:
    return (obs.filter(F.col("tiktok_id").isNotNull())
               .groupBy("tiktok_id")
               .agg(F.min(observed_at()).alias("first_observed_at"),
                    F.count("handle_name").alias("n"))
               .filter(F.col("n") == 0).drop("n"))


def handles_without_id(obs: DataFrame) -> DataFrame:
    return (obs.filter(F.col("handle_name").isNotNull())
               .groupBy("handle_name")
               .agg(F.min(observed_at()).alias("first_observed_at"),
                    F.count("tiktok_id").alias("n"))
               .filter(F.col("n") == 0).drop("n"))


def spine_from_parts(current: DataFrame, ids_only: DataFrame, handles_only: DataFrame) -> DataFrame:
    t, f = F.lit(True), F.lit(False)
    null_s = F.lit(None).cast("string")
    a = current.select("handle_name", "tiktok_id", "first_observed_at",
                       f.alias("is_missing_tiktok_id"), f.alias("is_missing_handle"),
                       null_s.alias("surrogate_id"))
    b = ids_only.select(null_s.alias("handle_name"), "tiktok_id", "first_observed_at",
                        f.alias("is_missing_tiktok_id"), t.alias("is_missing_handle"),
                        null_s.alias("surrogate_id"))
    c = handles_only.select("handle_name", null_s.alias("tiktok_id"), "first_observed_at",
                            t.alias("is_missing_tiktok_id"), f.alias("is_missing_handle"),
                            F.concat(F.lit("h_"), F.md5("handle_name")).alias("surrogate_id"))
    u = a.unionByName(b).unionByName(c)
    return u.select(surrogate_key("tiktok_id", "handle_name").alias("creator_key"),
                    "tiktok_id", F.col("handle_name").alias("handle"),
                    "is_missing_tiktok_id", "is_missing_handle", "surrogate_id",
                    "first_observed_at")


def creator_spine(obs: DataFrame, config: PipelineConfig | None = None) -> DataFrame:
    config = config or PipelineConfig()
    from idloom.session import materialize

    # The summary feeds three consumers; writing it once to the shared
    # checkpoint folder means the raw sources are scanned once. Pairs without
    # an id or a handle have no consumer.
    used = (F.col("gid") != _GID_PAIR) | (F.col("tiktok_id").isNotNull() & F.col("handle_name").isNotNull())
    summary = materialize(observation_summary(obs).filter(used), "observation-summary")
    tl = timeline_from_pairs(pairs_from_summary(summary), strategy=config.scan_strategy)
    current = tl.filter(F.col("is_current_owner")).select(
        "handle_name", "tiktok_id", F.col("handle_start").alias("first_observed_at"))
    spine = spine_from_parts(current, keys_never_with(summary, "tiktok_id"),
                             keys_never_with(summary, "handle_name"))
    if config.ordered:
        grp = (F.when(F.col("tiktok_id").isNotNull() & F.col("handle").isNotNull(), 0)
                .when(F.col("tiktok_id").isNotNull(), 1).otherwise(2))
        spine = spine.orderBy(grp, F.col("handle").asc_nulls_last(), F.col("tiktok_id").asc_nulls_last())
    return spine
