"""Partition balancing and running the registered queries the way the
driver does: a plain session started from another working directory."""
import os
import subprocess
import sys
import textwrap

from tests.conftest import SF001
from threadscope.operators import relational as R

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_spread_does_as_told_at_every_size(spark):
    for parts in (1, 50):
        df = spark.range(0, 1000, 1, parts)
        assert R.spread(df, 6, "id").rdd.getNumPartitions() == 6
        assert R.spread(df, 6).rdd.getNumPartitions() == 6


def test_queries_run_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.enabled", "false").getOrCreate())
        import __spark_entry__ as E
        q = E.queries()
        print("entry", E.entry(spark).count())
        for name in ["c2_clean_text", "x4_baha_floors", "c11_skip_non_records"]:
            print(name, q[name](spark, {SF001!r}).count())
    """)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    counts = dict(line.split() for line in out.stdout.splitlines() if line.count(" ") == 1)
    assert int(counts["entry"]) > 0 and int(counts["c2_clean_text"]) == 200
    assert int(counts["x4_baha_floors"]) > 0 and int(counts["c11_skip_non_records"]) >= 200  # a row a comment, each post at least once
