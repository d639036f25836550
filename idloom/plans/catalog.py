"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` through the adapters
(whole tables) and runs one model or operator of the pipeline.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.config import PipelineConfig
from idloom.functions.casts import cast_to
from idloom.functions.text import clean_lower, clean_text
from idloom.operators import email as email_ops
from idloom.operators import quality, spine, timeline
from idloom.operators.pit import overlapping_intervals, owner_at, owners_at
from idloom.operators.ranking import with_positions
from idloom.operators.observe import observed_at
from idloom.plans.pipeline import Pipeline
from idloom.plans.views import create_views
from idloom.plans.writers import write_table
from idloom.session import ensure_checkpoint_dir
from idloom.sources import adapters
from idloom.sources.adapters import raw_sources
from idloom.sources.registry import read_driver_tables


def _pipe(spark: SparkSession, sf_dir: str, config: PipelineConfig | None = None) -> Pipeline:
    return Pipeline(raw_sources(spark, sf_dir), config)


def _clean(source: str):
    def q(spark, sf_dir):
        return _pipe(spark, sf_dir).clean[source]
    return q


def q_clean_text(spark, sf_dir):
    r = raw_sources(spark, sf_dir, ["CREATORINFO"])["CREATORINFO"]
    return r.select(F.col("handle_name").alias("raw_handle"), clean_text("handle_name").alias("clean_handle"),
                    F.col("email_address").alias("raw_email"), clean_text("email_address").alias("clean_email"))


def q_clean_lower(spark, sf_dir):
    r = raw_sources(spark, sf_dir, ["CREATORINFO"])["CREATORINFO"]
    return r.select(F.col("handle_name").alias("raw_handle"), clean_lower("handle_name").alias("clean_handle"),
                    F.col("email_address").alias("raw_email"), clean_lower("email_address").alias("clean_email"))


def strict_cast_inputs(orders: DataFrame) -> DataFrame:
    """Text renderings of order fields, as a raw feed would deliver them."""
    return orders.select(
        "o_orderkey",
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".5")).alias("num_pos_text"),
        F.concat(F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".5")).alias("num_neg_text"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".25")).alias("float_text"),
        F.col("o_orderdate").cast("string").alias("ts_text"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date_text"),
        F.when(F.col("o_orderstatus") == "O", "on").when(F.col("o_orderstatus") == "F", "off")
         .otherwise("yes").alias("bool_text"))


def q_strict_casts(spark, sf_dir):
    t = strict_cast_inputs(read_driver_tables(spark, sf_dir, ["orders"])["orders"])
    return t.select(
        "o_orderkey",
        cast_to(F.col("num_pos_text"), "number").alias("num_pos"),
        cast_to(F.col("num_neg_text"), "number").alias("num_neg"),
        cast_to(F.col("float_text"), "float").alias("float_val"),
        cast_to(F.col("ts_text"), "timestamp_ntz").alias("ts_val"),
        cast_to(F.col("date_text"), "date").alias("date_val"),
        cast_to(F.col("bool_text"), "boolean").alias("bool_val"))


def q_observed_at(spark, sf_dir):
    o = _pipe(spark, sf_dir).observations
    return o.select(*o.columns, observed_at().alias("observed_at"))


def q_handle_observations(spark, sf_dir):
    return _pipe(spark, sf_dir).observations


def q_first_seen_pair(spark, sf_dir):
    return timeline.first_seen_pairs(_pipe(spark, sf_dir).observations)


def q_ownership_timeline(spark, sf_dir):
    return _pipe(spark, sf_dir).timeline


def q_ownership_timeline_window(spark, sf_dir):
    return _pipe(spark, sf_dir, PipelineConfig(scan_strategy="window")).timeline


def q_handle_log(spark, sf_dir):
    return _pipe(spark, sf_dir).handle_log


def sighting_facts(obs: DataFrame) -> DataFrame:
    """Every dated-or-not sighting of a handle, as facts to resolve."""
    return obs.filter(F.col("handle_name").isNotNull()).select(
        F.col("handle_name").alias("handle"), "source_table", observed_at().alias("observed_at"))


def q_owner_at_time(spark, sf_dir, config: PipelineConfig | None = None):
    # the facts are sightings, so the log and the facts read one copy of the map
    p = _pipe(spark, sf_dir, config).share("stg_tiktok_id_handle_map", "dim_creator_handle_log")
    return owner_at(sighting_facts(p.observations), p.handle_log, ts="observed_at", rows=p.sightings)


def first_claims(obs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Thirty days from the first sighting of each (handle, id): claims of one
    handle overlap."""
    pairs = timeline.first_seen_pairs(obs, tasks=tasks)
    return pairs.select(F.col("handle_name").alias("handle"), "tiktok_id", F.col("handle_start").alias("valid_from"),
                        (F.col("handle_start") + F.expr("interval 30 days")).alias("valid_to"))


def q_owners_at_time(spark, sf_dir):
    """Every id with a claim at each sighting: several for many facts."""
    p = _pipe(spark, sf_dir).share("stg_tiktok_id_handle_map", "dim_creator_handle_log")
    out = owners_at(sighting_facts(p.observations), first_claims(p.observations, p.sighting_tasks()), ts="observed_at", rows=p.sightings)
    p.close()  # claims and facts have copies of their own by now
    return out


def q_overlapping_intervals(spark, sf_dir):
    return overlapping_intervals(first_claims(_pipe(spark, sf_dir).observations))


def q_timeline_positions(spark, sf_dir):
    order = [F.col("handle_name").asc_nulls_last(), F.col("handle_start").asc_nulls_last()]
    timeline_ = _pipe(spark, sf_dir).timeline.select("handle_name", "handle_start", "tiktok_id")
    return with_positions(timeline_, order)


def q_spine_positions(spark, sf_dir):
    rank = (F.when(F.col("tiktok_id").isNotNull() & F.col("handle").isNotNull(), 0)
             .when(F.col("tiktok_id").isNotNull(), 1).otherwise(2))
    order = [rank, F.col("handle").asc_nulls_last(), F.col("tiktok_id").asc_nulls_last()]
    return with_positions(_pipe(spark, sf_dir).spine.select("handle", "tiktok_id", "creator_key", "first_observed_at"), order)


def q_first_seen_by_ordinals(spark, sf_dir):
    """SQL text with grouping by position over a model."""
    return _pipe(spark, sf_dir).sql("""select handle_name, tiktok_id, min(least(created_at, updated_at)) as handle_start
from {stg_tiktok_id_handle_map} where handle_name is not null and tiktok_id is not null group by 1, 2""")


def q_email_sources_by_ordinals(spark, sf_dir):
    return _pipe(spark, sf_dir).sql("""select data_source, is_current, count(*) as n, min(created_at) as first_created
from {dim_creator_email} group by 1, 2 having count(*) > 1 order by 3 desc, 1, 2""")


def _stored_view(name: str):
    """A view model as stored in the catalog, over raw relations that are views too."""
    def q(spark, sf_dir):
        relations = {}
        raw = raw_sources(spark, sf_dir)
        spark.sql("CREATE DATABASE IF NOT EXISTS idloom_raw")
        for s in raw:
            text = adapters.ADAPTER_SQL[s].format(**{t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in adapters.TABLES_USED})
            spark.sql(f"CREATE OR REPLACE VIEW idloom_raw.{s.lower()} AS {text}")
            relations[s] = f"idloom_raw.{s.lower()}"
        create_views(spark, relations, PipelineConfig(base_schema="idloom_views"))
        return spark.table(f"idloom_views.{name}")
    return q


def _published(name: str):
    """A published table, written with its gate and read back."""
    def q(spark, sf_dir):
        df = _pipe(spark, sf_dir).core_tables()[name]
        return write_table(spark, df, name, schema="CORE", root=f"{ensure_checkpoint_dir(spark)}/published-{uuid.uuid4().hex}")
    return q


# The *_range names stay registered; they run the one plan of all sizes.
q_ownership_timeline_range = q_ownership_timeline
q_owner_at_time_range = q_owner_at_time


def q_creator_spine_range(spark, sf_dir):
    return _pipe(spark, sf_dir).spine


def q_email_dimension_range(spark, sf_dir):
    return _pipe(spark, sf_dir).email


def q_ids_without_handle(spark, sf_dir):
    return spine.ids_without_handle(_pipe(spark, sf_dir).observations)


def q_handles_without_id(spark, sf_dir):
    return spine.handles_without_id(_pipe(spark, sf_dir).observations)


def q_creator_spine(spark, sf_dir):
    return _pipe(spark, sf_dir).spine


def q_email_observations(spark, sf_dir):
    return email_ops.email_observations(_pipe(spark, sf_dir).clean)


def q_email_pair_span(spark, sf_dir):
    return email_ops.email_pair_span(email_ops.email_observations(_pipe(spark, sf_dir).clean))


def q_email_latest_source(spark, sf_dir):
    return email_ops.email_latest_source(email_ops.email_observations(_pipe(spark, sf_dir).clean))


def q_email_dimension(spark, sf_dir):
    return _pipe(spark, sf_dir).email


def q_email_dimension_two_pass(spark, sf_dir):
    return _pipe(spark, sf_dir, PipelineConfig(email_strategy="two_pass")).email


def q_email_dimension_null_last(spark, sf_dir):
    return _pipe(spark, sf_dir, PipelineConfig(null_rank="last")).email


def q_external_id_map(spark, sf_dir):
    return _pipe(spark, sf_dir).id_map


def q_check_not_null(spark, sf_dir):
    return quality.not_null(_pipe(spark, sf_dir).handle_log, "valid_from")


def q_check_unique(spark, sf_dir):
    return quality.unique(_pipe(spark, sf_dir).id_map, "map_id")


def q_check_accepted_values(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    tables = p.core_tables()
    parts = [quality.accepted_values(tables[c.model], c.column, c.values).select(
                 F.lit(c.name).alias("check_name"), F.col(c.column).cast("string").alias("value"))
             for c in quality.CHECKS if c.kind == "accepted_values"]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_check_no_multi(spark, sf_dir):
    return quality.no_multi_tiktok_per_external_id(_pipe(spark, sf_dir).id_map)


def q_check_no_multi_coarse(spark, sf_dir):
    """The same check on data that fails it: external ids cut to two characters."""
    m = _pipe(spark, sf_dir).id_map
    return quality.no_multi_tiktok_per_external_id(m.withColumn("id", F.substring("id", 1, 2)))


def q_check_accepted_values_narrow(spark, sf_dir):
    """The same check with fewer values accepted, by value."""
    rows = quality.accepted_values(_pipe(spark, sf_dir).email, "data_source", ("HYDRATE", "ECHO"))
    return rows.groupBy("data_source").agg(F.count(F.lit(1)).alias("n"))


def q_quality_summary(spark, sf_dir):
    return _pipe(spark, sf_dir).quality_summary()


def q_multi_owner_handles(spark, sf_dir):
    return quality.multi_owner_handles(_pipe(spark, sf_dir).timeline)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f"clean_{s.lower()}": _clean(s) for s in (
        "CREATORINFO", "CRMCREATOR", "HYDRATE", "MARKET", "SEARCHINFO", "BRAVO_V1", "BRAVO_V2",
        "ECHO", "ADDRESS_PHONE", "ZIP_LAT_LON")},
    "clean_text": q_clean_text,
    "clean_lower": q_clean_lower,
    "strict_casts": q_strict_casts,
    "observed_at": q_observed_at,
    "handle_observations": q_handle_observations,
    "first_seen_pair": q_first_seen_pair,
    "ownership_timeline": q_ownership_timeline,
    "ownership_timeline_window": q_ownership_timeline_window,
    "ownership_timeline_range": q_ownership_timeline_range,
    "handle_log": q_handle_log,
    "owner_at_time": q_owner_at_time,
    "owner_at_time_range": q_owner_at_time_range,
    "owners_at_time": q_owners_at_time,
    "overlapping_intervals": q_overlapping_intervals,
    "timeline_positions": q_timeline_positions,
    "spine_positions": q_spine_positions,
    "first_seen_by_ordinals": q_first_seen_by_ordinals,
    "email_sources_by_ordinals": q_email_sources_by_ordinals,
    "stored_view_handle_map": _stored_view("stg_tiktok_id_handle_map"),
    "stored_view_timeline": _stored_view("stg_tiktok_id_handle_map_time"),
    "stored_view_creator": _stored_view("stg_creator"),
    "stored_view_market": _stored_view("stg_market"),
    "published_handle_log": _published("dim_creator_handle_log"),
    "published_id_map": _published("dim_creator_id_map"),
    "published_email": _published("dim_creator_email"),
    "ids_without_handle": q_ids_without_handle,
    "handles_without_id": q_handles_without_id,
    "creator_spine": q_creator_spine,
    "creator_spine_range": q_creator_spine_range,
    "email_observations": q_email_observations,
    "email_pair_span": q_email_pair_span,
    "email_latest_source": q_email_latest_source,
    "email_dimension": q_email_dimension,
    "email_dimension_range": q_email_dimension_range,
    "email_dimension_two_pass": q_email_dimension_two_pass,
    "email_dimension_null_last": q_email_dimension_null_last,
    "external_id_map": q_external_id_map,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted_values": q_check_accepted_values,
    "check_no_multi": q_check_no_multi,
    "check_no_multi_coarse": q_check_no_multi_coarse,
    "check_accepted_values_narrow": q_check_accepted_values_narrow,
    "quality_summary": q_quality_summary,
    "multi_owner_handles": q_multi_owner_handles,
}
