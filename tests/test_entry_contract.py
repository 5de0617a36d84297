"""The driver contract works from any working directory: the package is
shipped to the Python workers (Arrow UDFs are pickled by module reference)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_probe", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
assert m.entry(spark).count() == 1
assert m.queries()["nearest_topk"](spark, "/root/testdata/sf0.001").count() > 0
print("CONTRACT-OK")
"""


def test_entry_and_udf_query_from_foreign_cwd(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-2000:]
