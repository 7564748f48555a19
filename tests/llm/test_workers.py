"""All queries where tasks cannot import this package."""

import os
import subprocess
import sys

import pytest

from sentrylake.llm.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# The driver finds the package by a path that it does not hand to its workers.
CODE = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
def absent(_):
    try:
        import sentrylake
    except ImportError:
        return [True]
    return [False]
assert all(spark.sparkContext.parallelize(range(4), 4).mapPartitions(absent).collect())
repo, sf, names = sys.argv[1], sys.argv[2], sys.argv[3:]
sys.path.insert(0, repo)
import __spark_entry__
for name in names:
    print(name, __spark_entry__.queries()[name](spark, sf).count(), flush=True)
"""


@pytest.mark.parametrize("names", [sorted(QUERIES), ["pipeline"]])
def test_queries_without_the_package_on_workers(sf, tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE, REPO, sf, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert [line.split()[0] for line in run.stdout.splitlines()] == names
