"""Intermediate tables in the folder that the session names in
``spark.checkpoint.dir``: executors share it, so a lost executor takes no part
of a written table with it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local-mode session without one
    gets a folder of its own; anywhere else it must be set."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local") or "local-cluster" in spark.conf.get("spark.master"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="idloom-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: cuts lineage, and makes a
    random or positional column the same for every later reader."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")  # nothing reads this write's shuffles once the table is there
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
