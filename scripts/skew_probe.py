"""Skew probe: ownership timeline over a pair table in which ONE handle holds
a third of all rows. Compares Window.partitionBy(handle) with the two-level windows:
wall time and the longest single task (from the Spark event log).

The input is synthetic on purpose (generated with spark.range): it is a
stress test of the two strategies, not a registered query.

usage: python scripts/skew_probe.py [n_pairs] [partitions]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from idloom.operators.timeline import timeline_from_pairs  # noqa: E402
from idloom.session import build_session  # noqa: E402


def _lines(path):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.StringIO(zstandard.ZstdDecompressor().stream_reader(fh).read().decode())
    else:
        with open(path) as fh:
            yield from fh


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    evdir = tempfile.mkdtemp(prefix="idloom-skew-", dir="/tmp")
    spark = build_session("local[8]", app="idloom-skew", shuffle_partitions=parts,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir,
                                 "spark.driver.memory": "16g"})
    sc = spark.sparkContext
    pairs = (spark.range(n, numPartitions=parts)
             .select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                      .otherwise(F.concat(F.lit("h"), (F.col("id") % 100000).cast("string"))).alias("handle_name"),
                     F.col("id").cast("string").alias("tiktok_id"),
                     F.timestamp_seconds(F.lit(1_600_000_000) + (F.col("id") * 7919) % 50_000_000)
                      .cast("timestamp_ntz").alias("handle_start")))
    res = {}
    for strategy in ("window", "buckets"):
        sc.setJobGroup(strategy, strategy)
        t0 = time.perf_counter()
        timeline_from_pairs(pairs, strategy=strategy).write.format("noop").mode("overwrite").save()
        res[strategy] = time.perf_counter() - t0
    sc.setJobGroup("done", "done")
    spark.stop()
    stage_group, longest = {}, {}
    for f in sorted(x for x in glob.glob(f"{evdir}/**/*", recursive=True) if os.path.isfile(x)):
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                for s in e.get("Stage IDs", []):
                    stage_group[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e.get("Event") == "SparkListenerTaskEnd":
                g = stage_group.get(e.get("Stage ID"))
                info = e.get("Task Info") or {}
                d = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                if g:
                    longest[g] = max(longest.get(g, 0), d)
    for s in ("window", "buckets"):
        print(json.dumps({"strategy": s, "pairs": n, "hot_share": "1/3", "partitions": parts,
                          "wall_sec": round(res[s], 2), "longest_task_sec": round(longest.get(s, 0) / 1000, 2)}))


if __name__ == "__main__":
    main()
