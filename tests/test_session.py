"""The session keeps what it was given, and staged folders go."""

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.getOrCreate()
from tidewater.session import build_session, clear_staging, staging_path
spark = build_session()
path = staging_path(spark, "t")
spark.range(3).write.parquet(path)
import os
there = os.path.isdir(path.removeprefix("file:"))
clear_staging(spark)
print("GOT", spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"), there,
      os.path.isdir(path.removeprefix("file:")))
"""


def test_given_master_and_partitions_stay_and_staging_is_removed(tmp_path):
    env = os.environ | {
        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=999 "
        f"--conf spark.ui.enabled=false --conf spark.checkpoint.dir={tmp_path} pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True,
                         cwd=tmp_path, timeout=120)
    assert "GOT local[2] 999 True False" in out.stdout, out.stderr[-2000:]
