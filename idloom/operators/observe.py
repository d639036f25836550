"""Observation map: every sighting of a (tiktok_id, handle) pair, one shape.

Eight raw sources are projected to ``(tiktok_id, handle_name, source_table,
created_at, updated_at)``, unioned (bag semantics, no dedupe) and normalised
(blank ids and handles become NULL). The map reads the raw tables, not the
cleaned ones. Branches whose id or handle is a constant NULL are pruned by
Catalyst as soon as a consumer filters on that column being non-NULL, so the
ownership timeline scans only the three sources that carry both.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.config import PipelineConfig
from idloom.functions.casts import cast_to, check_not_floating, require_ansi, types_by_name
from idloom.functions.text import clean_lower, least_non_null

OBS_COLUMNS = ("tiktok_id", "handle_name", "source_table", "created_at", "updated_at")


@dataclass(frozen=True)
class ObservationSpec:
    source: str
    tag: str
    id_col: str | None       # None: the source has no usable id
    handle_col: str | None   # None: the source's handle is not trusted
    created_col: str
    updated_col: str


# Which raw columns feed the observation map, per source.
# BRAVO_V1, BRAVO_V2 and ECHO are not trusted for handles; CRMCREATOR and
# SEARCHINFO carry no id; HYDRATE is dated by account creation / handle change.
OBSERVATION_SPECS = (
    ObservationSpec("CREATORINFO", "creatorinfo", "tiktok_id", "handle_name", "create_date", "last_update"),
    ObservationSpec("CRMCREATOR", "crmcreator", None, "handle_name", "create_date", "last_update"),
    ObservationSpec("HYDRATE", "hydrate", "tiktok_id", "handle_name", "acct_create", "handle_modify"),
    ObservationSpec("MARKET", "market", "tiktok_id", "handle_name", "create_date", "last_update"),
    ObservationSpec("SEARCHINFO", "searchinfo", None, "handle_name", "create_date", "last_update"),
    ObservationSpec("BRAVO_V1", "bravo_v1", "tiktok_id", None, "created_at", "updated_at"),
    ObservationSpec("BRAVO_V2", "bravo_v2", "tiktok_id", None, "created_at", "updated_at"),
    ObservationSpec("ECHO", "echo", "tiktok_id", None, "created_time", "last_updated_time"),
)

# The MARKET branch of the original lists updated before created in a
# positional union, so its two dates arrive swapped (kept unless disabled).
_SWAPPED_SOURCES = ("MARKET",)


def observation_branch(raw: DataFrame, spec: ObservationSpec, swap_dates: bool = False,
                       mode: str = "strict") -> DataFrame:
    require_ansi(raw, mode)
    types = types_by_name(raw)
    if spec.id_col:
        check_not_floating(spec.id_col, types[spec.id_col.lower()])
    created, updated = spec.created_col, spec.updated_col
    if swap_dates:
        created, updated = updated, created
    tid = F.col(spec.id_col).cast("string") if spec.id_col else F.lit(None).cast("string")
    handle = F.col(spec.handle_col) if spec.handle_col else F.lit(None).cast("string")
    return raw.select(
        F.nullif(F.trim(tid), F.lit("")).alias("tiktok_id"),
        clean_lower(handle).alias("handle_name"),
        F.lit(spec.tag).alias("source_table"),
        cast_to(F.col(created), "timestamp_ntz", mode, types[created.lower()]).alias("created_at"),
        cast_to(F.col(updated), "timestamp_ntz", mode, types[updated.lower()]).alias("updated_at"),
    )


def observation_map(raw: dict[str, DataFrame], config: PipelineConfig | None = None,
                    specs=OBSERVATION_SPECS, complete_only: bool = False) -> DataFrame:
    """Union of all branches whose source is present in ``raw``.

    ``complete_only``: only sightings that can carry both an id and a handle,
    for consumers that drop the others anyway (the ownership timeline).
    Sources lacking either column are left out, and each remaining branch
    filters its raw id and handle for IS NOT NULL. A NULL raw value always
    normalises to NULL, so the consumer sees the same rows, but these
    filters on raw columns reach the Parquet reader as pushed predicates.
    """
    config = config or PipelineConfig()
    parts = []
    for s in specs:
        if s.source not in raw:
            continue
        df = raw[s.source]
        if complete_only:
            if not (s.id_col and s.handle_col):
                continue
            df = df.filter(F.col(s.id_col).isNotNull() & F.col(s.handle_col).isNotNull())
        parts.append(observation_branch(df, s, config.swap_market_dates and s.source in _SWAPPED_SOURCES,
                                        config.cast_mode))
    if not parts:
        raise ValueError("no observation source given")
    return reduce(DataFrame.unionByName, parts)


def observed_at(created: str = "created_at", updated: str = "updated_at") -> Column:
    """Earliest reliable date of a sighting: the smaller non-NULL date."""
    return least_non_null(created, updated)
