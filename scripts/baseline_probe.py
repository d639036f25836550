"""
shuffle bytes written per run (from a Spark event log in a scratch folder).

usage: python scripts/baseline_probe.py [sf_dir] [runs]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from idloom.config import PipelineConfig  # noqa: E402
from idloom.operators import quality, spine, timeline  # noqa: E402
from idloom.plans.catalog import _pipe  # noqa: E402
from idloom.session import build_session  # noqa: E402


def _lines(path):
    """Lines of a (possibly zstd-compressed) event log file."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        yield from io.StringIO(data.decode())
    else:
        with open(path) as fh:
            yield from fh


def variants(spark, sf):
    def handle_log():
        return _pipe(spark, sf, PipelineConfig(scan_strategy="buckets")).handle_log

    def handle_log_window():
        return _pipe(spark, sf, PipelineConfig(scan_strategy="window")).handle_log

    def email_one():
        return _pipe(spark, sf).email

    def email_two():
        return _pipe(spark, sf, PipelineConfig(email_strategy="two_pass")).email

    def spine_summary():
        return _pipe(spark, sf).spine

    def spine_three_scans():
        p = _pipe(spark, sf)
        tl = p.timeline.filter("is_current_owner").select(
            "handle_name", "tiktok_id", F.col("handle_start").alias("first_observed_at"))
        return spine.spine_from_parts(tl, spine.ids_without_handle(p.observations),
                                      spine.handles_without_id(p.observations))

    def id_map():
        return _pipe(spark, sf).id_map

    def quality_pooled():
        return _pipe(spark, sf).quality_summary()

    def quality_per_check():
        p = _pipe(spark, sf)
        tables = p.core_tables()
        parts = [quality.offenders(tables[c.model], c).agg(F.count(F.lit(1)).alias("failures"))
                 .select(F.lit(c.name).alias("check_name"), "failures") for c in quality.CHECKS]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out

    return {"handle_log (buckets)": handle_log, "handle_log (window)": handle_log_window,
            "email_dimension one-aggregate": email_one, "email_dimension two-pass": email_two,
            "creator_spine summary aggregate": spine_summary,
            "creator_spine three separate scans": spine_three_scans,
            "external_id_map": id_map, "quality_summary pooled": quality_pooled,
            "quality_summary one query per check": quality_per_check}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    evdir = tempfile.mkdtemp(prefix="idloom-events-", dir="/tmp")
    spark = build_session("local[8]", app="idloom-probe", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir,
                                 "spark.driver.memory": "16g"})
    sc = spark.sparkContext
    rows_idmap = _pipe(spark, sf).id_map.count()
    res = {}
    for name, fn in variants(spark, sf).items():
        fn().write.format("noop").mode("overwrite").save()  # warm-up
        ts = []
        for i in range(runs):
            sc.setJobGroup(f"{name}#{i}", name)
            t0 = time.perf_counter()
            fn().write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        res[name] = statistics.median(ts)
    sc.setJobGroup("done", "done")
    spark.stop()
    # shuffle bytes written per job group, from the event log
    stage_group, shuffle = {}, {}
    files = [f for f in glob.glob(f"{evdir}/**/*", recursive=True) if os.path.isfile(f)]
    for f in sorted(files):
        for line in _lines(f):
            if True:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in e.get("Stage IDs", []):
                        stage_group[s] = g
                elif ev == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    g = stage_group.get(e.get("Stage ID"))
                    if g:
                        shuffle[g] = shuffle.get(g, 0) + m.get("Shuffle Bytes Written", 0)
    print(f"| variant | median sec | shuffle MB written / run |")
    print("| --- | --- | --- |")
    for name, sec in res.items():
        mb = statistics.median(shuffle.get(f"{name}#{i}", 0) for i in range(runs)) / 1e6
        print(f"| {name} | {sec:.2f} | {mb:.1f} |")
    print(f"\nexternal_id_map rows: {rows_idmap}; rows/s: {rows_idmap / res['external_id_map']:.0f}")


if __name__ == "__main__":
    main()
