"""The driver contract from a fresh process outside the repository: a plain
session (not build_session) must run entry() and the Arrow-batched queries,
whose Python workers import the package shipped by session.tune."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

from sf_dirs import ROOT

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
q = E.queries()
for name in ["E1_score_batch", "D14_hsv_shift"]:
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("OK")
"""


def test_plain_session_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="imagelake-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("OK")
