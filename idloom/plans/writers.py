"""Sinks: full-rebuild table writes that carry table and column comments, check
the declared key, and swap the new table in whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Descriptions of the published tables and their columns.
TABLE_COMMENTS = {
    "dim_creator_handle_log": "Time-bounded mapping from handle → TikTok ID for point-in-time joins (valid_from/valid_to).",
    "dim_creator_id_map": "A Mapping table that maps various types of creator IDs to their TikTok ID",
    "dim_creator_email": "A table of creator email addresses collected from multiple TikTok data sources. Each row represents a unique combination of TikTok ID and email. The table keeps the earliest date an email was first seen, the most recent update, and flags which email is currently the most up to date for each creator.",
}
COLUMN_COMMENTS = {
    "dim_creator_handle_log": {
        "tiktok_id": "Unique TikTok ID",
        "handle": "Creator's TikTok Username",
        "valid_from": "Start of validity window (inclusive)",
        "valid_to": "End of validity window (exclusive); NULL = current",
    },
    "dim_creator_id_map": {
        "map_id": "Deterministic surrogate key generated as md5(id_type || '|' || id || '|' || id_source).",
        "tiktok_id": "TikTok creator ID associated with the creator record. May be null if not available in the source.",
        "id_type": "Type of the external identifier represented in `id`. The id could be from multiple social platforms.",
        "id": "Normalized creator ID value. Cleaning logic removes the prefixes `temp_temp_` or `tiktok_` and strips any suffix beginning with `_`.",
        "id_source": "Source system or staging model that provided the ID.",
    },
    "dim_creator_email": {
        "creator_email_id": "Unique identifier for each creator–email combination, generated using a consistent hash.",
        "tiktok_id": "Unique identifier for a TikTok creator.",
        "email": "Creator email address that has been cleaned (made lowercase and trimmed of any white space).",
        "data_source": "The original dataset where this creator’s email record was last updated.",
        "created_at": "The earliest date this email address was first recorded for the creator.",
        "updated_at": "The most recent date this email record was updated.",
        "is_current": "Indicates whether this email is the creator’s most recently updated email address.",
    },
}


def with_comments(df: DataFrame, model: str) -> DataFrame:
    """Attach column descriptions as StructField metadata ``{"comment": ..}``."""
    comments = COLUMN_COMMENTS.get(model, {})
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
                       else F.col(c) for c in df.columns])


# Fixed value: the declared key of a published table.
DECLARED_KEYS = {"dim_creator_email": "creator_email_id"}


class RefusedTable(ValueError):
    """A new table that fails its gate; the table before it stays."""


def _paths(spark: SparkSession, *paths: str):
    """The Hadoop file system of the first path, and the paths: works on HDFS
    and object stores alike."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    out = [hadoop(p) for p in paths]
    return out[0].getFileSystem(spark._jsc.hadoopConfiguration()), *out


def recover(spark: SparkSession, path: str) -> None:
    """Put the old table back if a writer died between its two renames."""
    fs, now, old = _paths(spark, path, path + ".__old")
    if not fs.exists(old):
        return
    if fs.exists(now):
        fs.delete(old, True)
    else:
        fs.rename(old, now)


def _swap(spark: SparkSession, new: str, path: str) -> None:
    """``new`` takes the place of ``path``: two renames, and ``recover`` if the
    second does not come."""
    fs, new_, now, old, marker = _paths(spark, new, path, path + ".__old", new + "/_SUCCESS")
    if not fs.exists(marker):
        raise RuntimeError(f"{new} was not committed")
    fs.mkdirs(now.getParent())
    if fs.exists(now) and not fs.rename(now, old):
        raise RuntimeError(f"could not move {path} aside")
    if not fs.rename(new_, now):
        recover(spark, path)
        raise RuntimeError(f"could not move {new} to {path}")
    fs.delete(old, True)


def _drop(spark: SparkSession, path: str) -> None:
    fs, gone = _paths(spark, path)
    fs.delete(gone, True)


def gate(written: DataFrame, key: str | None, seen: dict) -> list[str]:
    """What is wrong with a new table: ``seen`` are the metrics of its write
    job; whether ``key`` repeats is counted on the written files, one column."""
    wrong = []
    if key is not None:
        if seen["keyless"]:
            wrong.append(f"{seen['keyless']} rows without {key}")
        repeated = written.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col(key).isNotNull()).limit(1).collect()
        if repeated:
            wrong.append(f"{key} repeats, e.g. {repeated[0][0]!r}")
    return wrong


def write_table(spark: SparkSession, df: DataFrame, name: str, schema: str | None = None,
                root: str | None = None, fmt: str = "parquet", key: str | None = None) -> DataFrame:
    """Full rebuild of table ``name``.

    With ``root``: files at ``root/<schema>/<name>``, for a shared file system
    or object store. Without: a catalog table, which keeps the column comments
    and the table comment. Either way the new rows are written beside the old
    ones and take their place only when the job is done and committed, so a
    failing job changes nothing.

    ``key``: a column that must have values, each once (by default the table's
    declared key, where ``df`` has it; "" for none). Rows without it are counted by
    the write job itself (an observed metric); repeats on the new files, before
    they take the place of the old. A table that fails raises ``RefusedTable``.
    """
    import uuid

    from pyspark.sql import Observation

    if key is None and DECLARED_KEYS.get(name) in df.columns:
        key = DECLARED_KEYS[name]
    key = key or None
    out, seen = with_comments(df, name), Observation(f"gate-{name}")
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(key).isNull(), 1) if key else F.lit(None)).alias("keyless"))
    beside = f"__new_{uuid.uuid4().hex}"
    if root is not None:
        path = f"{root.rstrip('/')}/{schema or 'default'}/{name}"
        recover(spark, path)
        new = f"{path}.{beside}"
        try:
            out.write.format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").save(new)
            wrong = gate(spark.read.format(fmt).load(new), key, seen.get)
            if wrong:
                raise RefusedTable(f"{name}: " + "; ".join(wrong))
            _swap(spark, new, path)
        finally:
            _drop(spark, new)  # nothing is left there after a swap
        if TABLE_COMMENTS.get(name):  # files have no place for a table's comment: it lies beside them
            spark.createDataFrame([(name, TABLE_COMMENTS[name])], "name string, comment string").coalesce(1).write.mode("overwrite").json(path + "_comment")
        return spark.read.format(fmt).load(path)
    place = f"`{schema}`." if schema else ""
    if schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    now, new, old = f"{place}`{name}`", f"{place}`{name}{beside}`", f"{place}`{name}__old`"
    if spark.catalog.tableExists(old):  # a writer died between its two renames
        spark.sql(f"DROP TABLE {old}" if spark.catalog.tableExists(now) else f"ALTER TABLE {old} RENAME TO {now}")
    try:
        out.write.format(fmt).saveAsTable(new)
        wrong = gate(spark.table(new), key, seen.get)
        if wrong:
            raise RefusedTable(f"{name}: " + "; ".join(wrong))
        if TABLE_COMMENTS.get(name):
            quoted = TABLE_COMMENTS[name].replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {new} IS '{quoted}'")
        if spark.catalog.tableExists(now):
            spark.sql(f"ALTER TABLE {now} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {now}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
    return spark.table(now)
