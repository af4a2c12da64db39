"""The entry file works when loaded by path from another directory (workers get the code by value)."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry_by_path", {entry!r})
e = importlib.util.module_from_spec(spec)
spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
print("ROWS", e.queries()["score_policy"](spark, "/root/testdata/sf0.001").count(), e.entry(spark).count())
"""


def test_entry_loaded_by_path_from_other_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="trajlake-cwd-")
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=os.path.join(REPO, "__spark_entry__.py"))],
                         cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert line and line[0] == "ROWS 500 4", out.stdout[-2000:] + out.stderr[-2000:]
