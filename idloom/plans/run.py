"""Build and publish the identity tables, then run the quality checks.

usage:
  python -m idloom.plans.run --sources sources.json [--out ROOT] [--env prod]
                             [--base-schema analytics] [--null-rank first|last]
                             [--cast-mode strict|lenient] [--missing error|null|drop]

``sources.json`` maps raw source names to ``{"format": .., "path": ..,
"options": {..}}``, e.g. ``{"CREATORINFO": {"format": "parquet", "path":
"s3a://bucket/raw/creatorinfo"}}``. With ``--out`` the tables are written
under ``ROOT/<schema>/<table>``; without, into the session catalog. The check
summary is printed as JSON lines; the exit code is 1 when a check fails.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from idloom.config import PipelineConfig
from idloom.plans.pipeline import Pipeline
from idloom.session import cleanup_materialized
from idloom.sources.registry import SourceRegistry, SourceEntry


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sources", required=True)
    ap.add_argument("--out")
    ap.add_argument("--env", default="dev")
    ap.add_argument("--base-schema", default="analytics")
    ap.add_argument("--null-rank", default="first", choices=["first", "last"])
    ap.add_argument("--cast-mode", default="strict", choices=["strict", "lenient"])
    ap.add_argument("--missing", default="error", choices=["error", "null", "drop"],
                    help="raw columns a cleaning spec lists but the source lacks")
    a = ap.parse_args(argv)
    with open(a.sources) as fh:
        spec = json.load(fh)
    reg = SourceRegistry({k: SourceEntry(v["format"], v["path"], v.get("options", {}))
                          for k, v in spec.items()})
    spark = SparkSession.builder.getOrCreate()
    cfg = PipelineConfig(env=a.env, base_schema=a.base_schema, null_rank=a.null_rank,
                         cast_mode=a.cast_mode)
    pipe = Pipeline(reg.read(spark), cfg, missing=a.missing)
    published = pipe.publish(spark, root=a.out)
    failed = 0
    for r in pipe.quality_summary(published).collect():
        print(json.dumps(r.asDict()))
        failed += r.failures > 0
    cleanup_materialized(spark)  # intermediates; the published tables stay
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
