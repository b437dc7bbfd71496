"""Python workers find the package from any working folder."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
print("rows", entry.queries()["collect_named_files"](spark, "/root/testdata/sf0.001").count())
"""


def test_query_with_workers_from_a_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, f"{REPO}/__spark_entry__.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in out.stdout and int(out.stdout.split()[-1]) > 0, out.stderr[-2000:]
