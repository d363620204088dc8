"""The driver imports __spark_entry__ from its own working directory with its
own session: Python stages (mapInPandas / applyInPandasWithState) must still
find the package on the workers."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as e
q = e.queries()
print("ROWS", q["batch_generate"](spark, "/root/testdata/sf0.001").count(),
      q["stream_daily_quota"](spark, "/root/testdata/sf0.001").count())
"""


def test_python_stages_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory(dir="/tmp") as cwd:
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                           timeout=600)
    line = [ln for ln in r.stdout.splitlines() if ln.startswith("ROWS")]
    assert line, r.stderr[-3000:]
    a, b = map(int, line[0].split()[1:])
    assert a > 0 and b > 0
