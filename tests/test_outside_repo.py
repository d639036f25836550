"""Queries must run when the caller's working directory is not the
repository: Python workers then cannot import the package, so the range
scan's task functions have to travel by value."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_range_query_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.enabled", "false").getOrCreate())
        import __spark_entry__ as E
        n = E.queries()["ownership_timeline_range"](spark, "/root/testdata/sf0.001").count()
        print("ROWS", n)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-3000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
