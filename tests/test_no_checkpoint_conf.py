"""A session without spark.checkpoint.dir (no spark-defaults) still runs materialising queries."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
assert E.entry(spark).count() > 0
assert E.queries()["priority_scores"](spark, "/root/testdata/sf0.001").count() > 0
print("OK")
'''


def test_runs_without_checkpoint_setting():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="lapse-noconf-", dir="/tmp"))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK" in out.stdout
