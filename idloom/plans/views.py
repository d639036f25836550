"""The view models as SQL text, stored in the catalog: sessions that do not run
this package read them. Only views over named relations are made; the text of a
model names the views it reads, in the target schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from idloom.config import PipelineConfig
from idloom.operators.observe import OBSERVATION_SPECS
from idloom.operators.staging import SPECS, ColumnSpec
from idloom.session import limit_methods

_LEAST = "least(created_at, updated_at)"


def column_sql(c: ColumnSpec) -> str:
    x = c.name
    if c.rule in ("T", "TL"):
        x = f"nullif(trim({x}), '')"
    if c.rule == "TL":
        x = f"lower({x})"
    if c.wtype == "boolean":
        x = f"case lower(trim(cast({c.name} as string))) when 'on' then 'true' when 'off' then 'false' else cast({x} as string) end"
    return f"cast({x} as {c.spark_type}) as {c.name}"


def clean_sql(source: str, relation: str) -> str:
    columns = ", ".join(column_sql(c) for c in SPECS[source].columns)
    return f"select {columns} from {relation}"


def observations_sql(relations: Mapping[str, str], swap_market_dates: bool = True) -> str:
    parts = []
    for s in OBSERVATION_SPECS:
        if s.source not in relations:
            continue
        created, updated = s.created_col, s.updated_col
        if swap_market_dates and s.source == "MARKET":
            created, updated = updated, created
        owner = f"nullif(trim(cast({s.id_col} as string)), '')" if s.id_col else "cast(null as string)"
        handle = f"lower(nullif(trim({s.handle_col}), ''))" if s.handle_col else "cast(null as string)"
        parts.append(f"select {owner} as tiktok_id, {handle} as handle_name, '{s.tag}' as source_table, "
                     f"cast({created} as timestamp_ntz) as created_at, cast({updated} as timestamp_ntz) as updated_at from {relations[s.source]}")
    return " union all ".join(parts)


def timeline_sql(observations: str, ordered: bool = False) -> str:
    key = "partition by handle_name"
    text = f"""select handle_name, tiktok_id, min(handle_start) over ({key}) as created_at, handle_start,
       lead(handle_start) over ({key} order by handle_start asc nulls last, tiktok_id asc nulls last) as handle_end,
       lead(handle_start) over ({key} order by handle_start asc nulls last, tiktok_id asc nulls last) is null as is_current_owner
from (select handle_name, tiktok_id, min({_LEAST}) as handle_start from {observations}
      where handle_name is not null and tiktok_id is not null group by 1, 2)"""
    return text + (" order by handle_name asc nulls last, handle_start asc nulls last" if ordered else "")


def spine_sql(observations: str, timeline: str, ordered: bool = False) -> str:
    text = f"""select coalesce(tiktok_id, surrogate_id) as creator_key, tiktok_id, handle, is_missing_tiktok_id, is_missing_handle, surrogate_id, first_observed_at
from (select tiktok_id, handle_name as handle, false as is_missing_tiktok_id, false as is_missing_handle, cast(null as string) as surrogate_id, handle_start as first_observed_at
      from {timeline} where is_current_owner
      union all
      select tiktok_id, null, false, true, null, min({_LEAST}) from {observations} where tiktok_id is not null group by tiktok_id having count(handle_name) = 0
      union all
      select null, handle_name, true, false, concat('h_', md5(handle_name)), min({_LEAST}) from {observations} where handle_name is not null group by handle_name having count(tiktok_id) = 0)"""
    rank = "case when tiktok_id is not null and handle is not null then 0 when tiktok_id is not null then 1 else 2 end"
    return text + (f" order by {rank}, handle asc nulls last, tiktok_id asc nulls last" if ordered else "")


def view_texts(relations: Mapping[str, str], schema: str, config: PipelineConfig | None = None) -> dict[str, str]:
    """``{view: SQL}`` of the view models over ``relations`` ({SOURCE: table
    name, or format.`path`}), each after those it reads."""
    config = config or PipelineConfig()
    if config.cast_mode != "strict" or config.blank_id_to_null:
        raise ValueError("views are made for strict casts and ids as they are")
    out = {f"stg_{s.lower()}": clean_sql(s, relation) for s, relation in relations.items()}
    observations, timeline = (f"`{schema}`.{n}" for n in ("stg_tiktok_id_handle_map", "stg_tiktok_id_handle_map_time"))
    if all(s.source in relations for s in OBSERVATION_SPECS):
        out["stg_tiktok_id_handle_map"] = observations_sql(relations, config.swap_market_dates)
        out["stg_tiktok_id_handle_map_time"] = timeline_sql(observations, config.ordered)
        out["stg_creator"] = spine_sql(observations, timeline, config.ordered)
    return out


def create_views(spark: SparkSession, relations: Mapping[str, str], config: PipelineConfig | None = None) -> list[str]:
    """Store the view models in the target schema; returns their names. Other
    sessions that read wide ones set ``spark.sql.codegen.hugeMethodLimit`` to
    8000 themselves (see ``limit_methods``)."""
    from idloom.plans.pipeline import MODEL_FOLDER, target_schema

    limit_methods(spark)
    config = config or PipelineConfig()
    schema = target_schema(config.env, MODEL_FOLDER["staging"], config.base_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    names = []
    for name, text in view_texts(relations, schema, config).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.{name} AS {text}")
        names.append(f"{schema}.{name}")
    return names
