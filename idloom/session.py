"""Session settings the pipeline expects, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on. Every function also spells out its types
# (timestamp_ntz casts, explicit NULL ordering), so a session without these
# still computes the same rows; they matter for speed and for SQL users.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "idloom", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster pass the cluster's master
    and a shuffle-partition count sized to the data (about 128-256 MB each)."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def limit_methods(spark: SparkSession) -> None:
    """Let Spark generate methods that the JVM compiles. HotSpot only interprets
    a method above 8000 bytes, and a projection of many columns makes one such
    method for its whole stage; with this limit Spark splits the projection
    into small ones. A limit that the session chose itself is kept."""
    if spark.conf.get(_METHOD_LIMIT) == "65535":  # Spark's default
        spark.conf.set(_METHOD_LIMIT, DEFAULT_CONF[_METHOD_LIMIT])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only in local mode (tests), when the session names none, is a scratch
    folder under the system temp dir used. On a cluster the setting must
    point at shared storage, and a missing setting is an error rather than a
    silent fall-back to executor-local disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no SparkContext handle
        sc = None
    if sc is None:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the cluster shares")
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(HDFS, object store) so written intermediates survive a lost executor")
        d = tempfile.mkdtemp(prefix="idloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, label: str = "stage", paths: list | None = None, alone: bool = False):
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a DataFrame reading it back.

    Used where one reduced result feeds several consumers, or where later
    readers must see exactly one evaluation (e.g. sampled range bounds). The
    write is a single job (an eager RDD ``checkpoint()`` would compute its
    last stage twice: once to count, once to save), the copy is columnar so
    readers get column pruning and filter push-down, and it lives on shared
    storage, so a lost executor does not force recomputation from the raw
    sources. The copies stay until ``cleanup_materialized`` (or the
    checkpoint folder's retention policy) removes them; with ``paths``, the
    copy is the caller's, listed there, for ``remove_written``. ``alone``: the
    shuffle files of the write go when it ends, not when the driver next happens
    to collect its garbage.
    """
    import uuid

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/idloom-{label}-{uuid.uuid4().hex}"
    if alone:
        before = spark.conf.get(_CLEANUP)
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if alone:
            spark.conf.set(_CLEANUP, before)
    (_WRITTEN if paths is None else paths).append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def cleanup_materialized(spark) -> int:
    """Delete the intermediate copies this process wrote. Call it once the
    DataFrames built from them are no longer needed; returns the count."""
    return remove_written(spark, _WRITTEN)


def remove_written(spark, paths: list) -> int:
    """Delete the copies in ``paths`` and empty the list (through the Hadoop
    FileSystem API, so it works on HDFS and object stores)."""
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no SparkContext handle; the copies stay
        return 0
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    n = 0
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n
