"""The driver loads __spark_entry__.py by path from elsewhere, in a fresh process."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import importlib.util, json, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
spec = importlib.util.spec_from_file_location("entry_under_test", sys.argv[1])
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
df = m.entry(spark)
rows = df.collect()
print(json.dumps({"columns": df.columns, "rows": len(rows), "queries": len(m.queries()), "oracles": len(m.oracle_sql())}))
"""


def test_entry_loaded_by_path(tmp_path):
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")],
        cwd=tmp_path, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert (rec["columns"], rec["rows"]) == (["genre", "avg_rating", "n_ratings"], 22)
    assert rec["queries"] >= rec["oracles"] >= 41  # the optional queries come on top
