"""Rust answers, simulation tables, task texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corpusmill.functions import rust
from corpusmill.operators import simulations as S


def test_rust_checks(spark):
    rows = [("pub fn go<T>(x: T) { x.push_str(y) }", "fn go<T>(x: T)", "String::push_str"), ("fn gone() {}", "fn go()", "Vec::push"), ("", "struct A", "")]
    got = spark.createDataFrame(rows, "c string, s string, a string").select(rust.has_signature(F.col("c"), F.col("s")), rust.uses_api(F.col("c"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (False, False)]
    rows = [(True, None), (False, "Compilation error: error[E0502]: x"), (False, "Compilation error: missing ;"), (False, "Timeout: x"), (False, "Test execution error: USE OF MOVED VALUE"), (False, "assert")]
    got = spark.createDataFrame(rows, "p boolean, m string").select(rust.failure_kind(F.col("p"), F.col("m"))).collect()
    assert [r[0] for r in got] == [None, "borrow", "compile", "timeout", "borrow", "test"]


def test_simulation_tables(spark):
    tasks = spark.createDataFrame(
        [("a", [("transfer_to_human", "assistant")], ["e"], None), ("b", [("x", "assistant"), ("y", "user")], None, ["n", "m"]), ("c", None, None, None)],
        "id string, actions array<struct<name:string,requestor:string>>, env_assertions array<string>, nl_assertions array<string>",
    )
    sims = spark.createDataFrame([("s1", "a", 1.0), ("s2", "b", 0.0), ("s3", "zz", 1.0), ("s4", "c", 1.0)], "simulation_id string, task_id string, reward double")
    out = {r["simulation_id"]: tuple(r[c] for c in r.__fields__ if c.startswith("task_num")) for r in S.flatten(sims, tasks).collect()}
    assert out == {"s1": (1, 0, -1, 1, 0), "s2": (1, 1, 2, 0, 2), "s4": (0, 0, 0, 0, 0)}
    runs = spark.createDataFrame([("s", ["DB"], {"DB": 1.0}, [("w", True), ("w", False), ("r", True)])], "id string, basis array<string>, parts map<string,double>, checks array<struct<name:string,match:boolean>>")
    assert tuple(S.reward_breakdown(runs, "basis", "parts", "checks", ["w"], ["id"]).first()) == ("s", True, None, 1, 2)
    assert S.action_rows(runs, "checks", ["id"]).count() == 3


def test_request_sections(spark):
    text = "# Task: Fix it \nintro\n## Notes\n## Issue #12\nbroken\n\nvery\n## Description\ndo this\n## Other\n## Requirements\nnot this"
    got = {r["k"]: tuple(r)[1:] for r in S.request_sections(spark.createDataFrame([(1, text), (2, "")], "k int, t string"), "k", "t").collect()}
    assert got[1] == ("Fix it", "intro\ndo this\n## Other", "broken\nvery")
    assert got[2] == ("Unknown title", "No description provided.", "No issue description provided.")


def test_billing_dates(spark):
    d = S.billing_dates(F.lit(dt.date(2024, 12, 20)))
    assert tuple(spark.range(1).select(*d.values()).first()) == (dt.date(2025, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 14), dt.date(2024, 11, 1), dt.date(2024, 11, 30))
