"""Queries must run from any folder, with workers that know nothing of this repository."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("infer_batch", "verify"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() == 200
assert entry.entry(spark).count() == 6
print("fine")
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
