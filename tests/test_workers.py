"""Queries whose rows go through Python workers, with workers that can't import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from conftest import DATA

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
{load}
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def see(rows):
    try:
        import corpusmill
        yield from ([1] for _ in rows)
    except ImportError:
        yield from ([0] for _ in rows)

assert spark.range(1).rdd.mapPartitions(see).collect() == [[0]], "workers have the package"
ran, failed = 0, []
for name, query in sorted(QUERIES.items()):
    try:
        df = query(spark, {data!r})
        plan = df._jdf.queryExecution().executedPlan().toString()
        if any(word in plan for word in ("Python", "Arrow", "Pandas")):
            ran += 1
            df.write.format("noop").mode("overwrite").save()
    except Exception as e:
        failed.append((name, str(e)[:300]))
assert not failed, failed
assert ran >= {least}, ran
"""


def run_elsewhere(tmp_path, load: str, least: int) -> None:
    """A driver in another folder that has the package by its own path alone, which workers don't inherit."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), load=load, data=DATA, least=least)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]


def test_queries_with_workers_that_lack_the_package(tmp_path):
    run_elsewhere(tmp_path, "from corpusmill.plans.registry import QUERIES", 10)
