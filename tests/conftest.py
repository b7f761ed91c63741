"""A session and a comparison with DuckDB for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def normal(frame):
    """Rows as sorted tuples of columns by name; doubles to nine digits."""
    import math

    import pandas as pd

    def one(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return None
        if isinstance(x, bool):
            return x
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return float(f"{x:.9g}")
        return x if isinstance(x, (int, str, bool)) else str(x)

    cols = sorted(frame.columns)
    rows = [tuple(one(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False)]
    return cols, sorted(rows, key=repr)


def duck(sql: str, data: str = DATA):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con.execute(sql).df()


def same_as_oracle(spark, query, sql: str, data: str = DATA) -> None:
    got, want = normal(query(spark, data).toPandas()), normal(duck(sql, data))
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    wrong = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    assert not wrong, wrong[:3]
