"""External-id map: ids of other systems mapped to the creator's id.

ECHO's ``creator_id`` is normalised by removing one leading ``temp_temp_`` or
``tiktok_`` and then everything from the first underscore on. Map-only
(no shuffle): a filter and two regex replacements fused into the scan stage.
Rows are not de-duplicated unless asked, so a repeated external id yields
repeated ``map_id`` values, which the uniqueness check then reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.functions.keys import md5_key

# Id type and source tags, and the two normalising patterns.
ID_TYPE = "tiktok_creator_id"
ID_SOURCE = "echo"
PREFIX_PATTERN = "^(temp_temp_|tiktok_)"
SUFFIX_PATTERN = "_.*$"


def normalize_external_id(col) -> "F.Column":
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.regexp_replace(c.cast("string"), PREFIX_PATTERN, ""), SUFFIX_PATTERN, "")


def external_id_map(echo_clean: DataFrame, dedupe: bool = False) -> DataFrame:
    src = (echo_clean.filter(F.col("creator_id").isNotNull())
                     .select(F.col("tiktok_id").cast("string").alias("tiktok_id"),
                             F.lit(ID_TYPE).alias("id_type"),
                             normalize_external_id("creator_id").alias("id"),
                             F.lit(ID_SOURCE).alias("id_source")))
    out = src.select(md5_key("id_type", "id", "id_source").alias("map_id"),
                     "tiktok_id", "id_type", "id", "id_source")
    return out.dropDuplicates() if dedupe else out
