"""Model calls with stub clients."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import calls


def test_ask_once_and_keep_errors(spark):
    def client(prompt, model):
        if prompt == "bad":
            raise ValueError("no")
        return f"{model}:{prompt}"

    df = spark.createDataFrame([(1, "a", "m"), (2, "a", "m"), (3, "bad", "m"), (4, "a", "n")], "i int, p string, m string")
    out = {r["i"]: (r["reply"], r["error"]) for r in calls.ask(df, "p", "m", client).collect()}
    assert out == {1: ("m:a", None), 2: ("m:a", None), 3: (None, "ValueError: no"), 4: ("n:a", None)}
    left = calls.surviving(calls.ask(calls.sampled(df, 2), "p", "m", client), "i").collect()
    assert sorted((r["i"], r["all_failed"]) for r in left) == [(1, False), (1, False), (2, False), (2, False), (3, True), (4, False), (4, False)]


def test_clients():
    seen = []

    def flaky(prompt, model):
        seen.append(model)
        if len(seen) < 3:
            raise TimeoutError
        return "ok"

    assert calls.with_retry(flaky, 3, 0)("p", "m") == "ok"
    with pytest.raises(TimeoutError):
        seen.clear()
        calls.with_retry(flaky, 2, 0)("p", "m")
    assert calls.with_fallback(lambda p, m: 1 / 0, lambda p, m: "b")("p", "m") == "b"
    asked = []
    pick = calls.with_model_switch(lambda p, m: asked.append(m) or {"x": "0.2", "y": "0.9"}[m], ["x", "y"], float, 0.7, 3)
    assert pick("p", "x") == "0.9" and asked == ["x", "y"]


def test_busy_servers_are_asked_again():
    tries = []

    def flaky(prompt, model):
        tries.append(prompt)
        if len(tries) < 3:
            raise calls.ServerError(503)
        return "ok"

    assert calls.with_retry(flaky, 3, 0.0)("p", "m") == "ok" and len(tries) == 3

    def refuses(prompt, model):
        tries.append(prompt)
        raise calls.ServerError(400)

    tries.clear()
    with pytest.raises(calls.ServerError):
        calls.with_retry(refuses, 3, 0.0)("p", "m")
    assert len(tries) == 1


def test_round_robin_passes_on():
    def down(prompt, model):
        raise ConnectionError

    client = calls.with_round_robin([lambda p, m: "a", down, lambda p, m: "c"])
    assert [client("p", "m") for _ in range(4)] == ["a", "c", "c", "a"]


def test_typed_calls(spark):
    options = F.array(F.lit("cat"), F.lit("dog"))
    df = spark.createDataFrame([('{"classification": "b"}', '{"score": 4}', '{"a": 1}'), ('```json\n{"classification": "A"}\n```', '{"score": 9}', '{"a": null}'), ("no", "4", "x")], "c string, s string, o string")
    out = df.select(calls.chosen(F.col("c"), options), calls.yes_no(F.col("c")), calls.scored(F.col("s"), 1, 5), calls.read_object(F.col("o"), ["a"])["whole"]).collect()
    assert [tuple(r) for r in out] == [(1, False, 4, True), (0, True, None, False), (None, None, None, False)]
    prompt = df.limit(1).select(calls.choice_prompt(F.lit("Which?"), F.lit("woof"), options)).first()[0]
    assert "A. cat\nB. dog" in prompt and prompt.startswith("Which?")


def test_replies_are_reduced(spark):
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (1, "y", 2), (2, "z", 0), (2, "z", 1)], "k int, reply string, i int")
    got = {how: dict(tuple(r) for r in calls.reduced(df, "k", "reply", "i", how).collect()) for how in ("first", "majority", "unanimous")}
    assert got == {"first": {1: "x", 2: "z"}, "majority": {1: "y", 2: "z"}, "unanimous": {1: None, 2: "z"}}
    with pytest.raises(ValueError):
        calls.reduced(df, "k", "reply", "i", "odd")


def test_cache_asks_once(spark, tmp_path):
    path = str(tmp_path / "cache")
    df = spark.createDataFrame([("a", "m"), ("a", "m"), ("b", "m")], "p string, m string")
    one = calls.ask_cached(df, "p", "m", lambda p, m: f"{p}1", path, 1)
    assert sorted(r["reply"] for r in one.collect()) == ["a1", "a1", "b1"]
    two = calls.ask_cached(df.union(spark.createDataFrame([("c", "m")], df.schema)), "p", "m", lambda p, m: f"{p}2", path, 2)
    assert sorted(r["reply"] for r in two.collect()) == ["a1", "a1", "b1", "c2"]
    assert spark.read.parquet(f"{path}/run=2").count() == 1


def test_all_failed(spark):
    with pytest.raises(RuntimeError):
        calls.all_failed(spark.createDataFrame([("x",)], "error string"))
    calls.all_failed(spark.createDataFrame([("x",), (None,)], "error string"))


def test_calls_in_flight():
    """Eight open calls of 20 ms take about an eighth of the time; order is kept, items are read as results are taken, errors
    come where they belong, and calls begin at the rate that is given."""
    import threading
    import time

    from corpusmill.operators.calls import in_order

    now, most, lock = [0], [0], threading.Lock()

    def call(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        if i == 77:
            raise ValueError(i)
        return i

    start = time.perf_counter()
    assert list(in_order(call, range(64), 8)) == list(range(64))
    assert time.perf_counter() - start < 64 * 0.02 / 3 and most[0] <= 8
    read = []
    results = in_order(call, (read.append(i) or i for i in range(70, 200)), 4)
    assert [next(results) for _ in range(7)] == list(range(70, 77)) and len(read) <= 7 + 8
    try:
        next(results)
        raise AssertionError
    except ValueError:
        pass
    start = time.perf_counter()
    assert len(list(in_order(lambda i: i, range(30), 5, per_second=100))) == 30
    assert time.perf_counter() - start > 0.2


def test_ask_with_calls_in_flight(spark):
    import time

    from corpusmill.operators.calls import ask

    def client(prompt, model):
        time.sleep(0.01)
        if prompt.endswith("7"):
            raise ValueError(prompt)
        return f"{model}:{prompt}"

    df = spark.range(60).selectExpr("id", "concat('p', id) as prompt", "'m' as model").coalesce(1)
    out = {r.id: (r.reply, r.error) for r in ask(df, "prompt", "model", client, in_flight=8).collect()}
    assert out == {i: (None, f"ValueError: p{i}") if i % 10 == 7 else (f"m:p{i}", None) for i in range(60)}
