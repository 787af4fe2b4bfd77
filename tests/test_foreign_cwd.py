"""The driver may run from any directory: Python workers must not need to
import this package (functions shipped to them are self-contained)."""
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
rows = e.entry(spark).collect()
assert len(rows) > 0
assert e.queries()["rank_ties"](spark, "/root/testdata/sf0.001").count() > 0
print("OK", len(rows))
"""


def test_entry_runs_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                           capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    assert "OK" in r.stdout
