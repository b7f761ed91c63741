"""Model calls from DataFrames: a client is any function of a prompt and a model name, and travels to the executors."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Client = Callable[[str, str], str]


#: Answers of a server that is busy or being replaced.
BUSY = (502, 503, 504)


class ServerError(Exception):
    """A server's answer that is no reply, with its status."""

    def __init__(self, status: int, text: str = "") -> None:
        super().__init__(f"{status} {text}".strip())
        self.status = status


def with_retry(client: Client, tries: int = 3, wait: float = 1.0, transient: tuple[type[BaseException], ...] = (ConnectionError, TimeoutError)) -> Client:
    """Transient failures, lost connections, time-outs and busy servers, are tried again after wait, 2 * wait, ... seconds; the
    last one is raised, any other at once."""

    def call(prompt: str, model: str) -> str:
        for i in range(tries):
            try:
                return client(prompt, model)
            except (ServerError, *transient) as e:
                if i == tries - 1 or (isinstance(e, ServerError) and e.status not in BUSY):
                    raise
                time.sleep(wait * 2**i)
        raise AssertionError

    return call


def with_round_robin(clients: list[Client]) -> Client:
    """Endpoints in turn, within a task; one that fails passes the call on to the next, the last failure is raised."""
    turn = {"at": 0}

    def call(prompt: str, model: str) -> str:
        first, turn["at"] = turn["at"], turn["at"] + 1
        for i in range(len(clients)):
            try:
                return clients[(first + i) % len(clients)](prompt, model)
            except Exception:  # noqa: BLE001
                if i == len(clients) - 1:
                    raise
        raise AssertionError

    return call


def with_fallback(first: Client, second: Client) -> Client:
    """The second endpoint where the first one fails."""

    def call(prompt: str, model: str) -> str:
        try:
            return first(prompt, model)
        except Exception:  # noqa: BLE001
            return second(prompt, model)

    return call


def with_model_switch(client: Client, models: list[str], confidence: Callable[[str], float], least: float, retries: int) -> Client:
    """Asked again, model by model in turn, until a reply's confidence reaches `least` or retries are spent; the best reply."""

    def call(prompt: str, model: str) -> str:
        order = [model, *[m for m in models if m != model]]
        best, top = "", -1.0
        for i in range(retries + 1):
            reply = client(prompt, order[i % len(order)])
            if (c := confidence(reply)) > top:
                best, top = reply, c
            if top >= least:
                break
        return best

    return call


class Bucket:
    """Tokens that come in at `rate` a second, up to `size`; each call takes one, and waits for it."""

    def __init__(self, rate: float, size: int) -> None:
        self.rate, self.size, self.held, self.at, self.lock = rate, size, float(size), time.monotonic(), threading.Lock()

    def take(self) -> None:
        with self.lock:
            now = time.monotonic()
            self.held = min(self.size, self.held + (now - self.at) * self.rate) - 1
            self.at = now
            wait = -self.held / self.rate if self.held < 0 else 0.0
        if wait:
            time.sleep(wait)


def in_order(call: Callable[[Any], Any], items: Iterable[Any], in_flight: int, per_second: float | None = None) -> Iterator[Any]:
    """`call` of each item, in their order, up to `in_flight` of them at a time and `per_second` begun a second. What is open or
    done and not yet taken is at most twice `in_flight`: items are read no faster than results are taken. A call that raises
    does so where its result is taken."""
    bucket = Bucket(per_second, max(1, in_flight)) if per_second else None

    def one(item: Any) -> Any:
        if bucket:
            bucket.take()
        return call(item)

    with ThreadPoolExecutor(max_workers=max(1, in_flight)) as pool:
        open_calls: deque[Future] = deque()
        try:
            for item in items:
                open_calls.append(pool.submit(one, item))
                if len(open_calls) >= 2 * in_flight:
                    yield open_calls.popleft().result()
            while open_calls:
                yield open_calls.popleft().result()
        finally:
            for f in open_calls:
                f.cancel()


def ask(df: DataFrame, prompt: str, model: str, client: Client, reply: str = "reply", in_flight: int = 1, per_second: float | None = None) -> DataFrame:
    """Adds the reply and, where the call failed, error. Equal prompts to one model are asked once and joined back by hash. A task
    has up to `in_flight` calls open at a time, of which it begins `per_second`; a client is called from several threads then."""
    key = F.sha2(F.to_json(F.struct(F.col(prompt).alias("p"), F.col(model).alias("m"))), 256)
    keyed = df.withColumn("__key", key)
    once = keyed.groupBy("__key").agg(F.first(prompt).alias("p"), F.first(model).alias("m"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(r: Any) -> tuple[Any, ...]:
            try:
                return r[1], client(r.p, r.m), None
            except Exception as e:  # noqa: BLE001
                return r[1], None, f"{type(e).__name__}: {e}"

        held: list[tuple[Any, ...]] = []
        for row in in_order(one, (r for batch in batches for r in batch.itertuples()), in_flight, per_second):
            held.append(row)
            if len(held) == 1000:
                yield pd.DataFrame(held, columns=["__key", reply, "error"])
                held = []
        if held:
            yield pd.DataFrame(held, columns=["__key", reply, "error"])

    asked = once.select("__key", "p", "m").mapInPandas(run, f"__key string, {reply} string, error string")
    return keyed.join(asked, "__key", "left").drop("__key")


def sampled(df: DataFrame, n: int, name: str = "sample") -> DataFrame:
    """Each row n times, numbered from 0: redundant calls, whose replies `analysis.majority` reduces."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def reduced(replies: DataFrame, key: str, reply: str, order: str, how: str) -> DataFrame:
    """(key, reply) of several replies to each key: `first` of them by order, `majority`, ties to the one seen first, or
    `unanimous`, null where they differ."""
    from corpusmill.operators.analysis import majority

    if how == "first":
        return replies.groupBy(key).agg(F.min_by(reply, order).alias(reply))
    votes = majority(replies, key, reply, order)
    if how == "majority":
        return votes.select(key, F.col("winner").alias(reply))
    if how == "unanimous":
        return votes.select(key, F.when(F.col("unanimous"), F.col("winner")).alias(reply))
    raise ValueError(f"unknown way {how!r}")


def retried(df: DataFrame, prompt: str, model: str, client: Client, good: Callable[[str], bool], most: int = 3, reply: str = "reply") -> DataFrame:
    """As `ask`, but a reply that isn't good is asked for again, up to `most` times in all; the last one stands."""

    def until(text: str, name: str) -> str:
        out = ""
        for _ in range(most):
            out = client(text, name)
            if good(out):
                break
        return out

    return ask(df, prompt, model, until, reply)


def ask_cached(df: DataFrame, prompt: str, model: str, client: Client, path: str, run: int, reply: str = "reply") -> DataFrame:
    """As `ask`, over a store of earlier replies in the folder `path`, by the hash of prompt and model: only what no earlier run
    has asked goes to the client, and replies without an error are added under `run`, a number above those of earlier ones."""
    spark = df.sparkSession
    keyed = df.withColumn("__hash", F.sha2(F.to_json(F.struct(F.col(prompt).alias("p"), F.col(model).alias("m"))), 256))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = None
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.parquet(path).where(F.col("run") < run).select("__hash", reply)
    new = keyed.dropDuplicates(["__hash"]) if known is None else keyed.dropDuplicates(["__hash"]).join(known, "__hash", "left_anti")
    asked = ask(new.select("__hash", prompt, model), prompt, model, client, reply)
    asked.where("error is null").select("__hash", reply).write.mode("overwrite").parquet(f"{path}/run={run}")
    return keyed.join(spark.read.parquet(path).where(F.col("run") <= run).select("__hash", reply), "__hash", "left").drop("__hash")


# Typed calls: a prompt that says what form the reply must have, and the reply read in that form; null where it hasn't got it.


def choice_prompt(instruction: Column, text: Column, options: Column) -> Column:
    from corpusmill.functions.prompts import display_choices

    return F.concat(instruction, F.lit("\n\nText:\n"), text, F.lit("\n\nChoices:\n"), display_choices(options)["text"], F.lit('\n\nReply with JSON: {"classification": "<letter>"}'))


def chosen(reply: Column, options: Column) -> Column:
    """The place, from 0, of the option whose letter the reply gives."""
    from corpusmill.functions.jsonish import field, first_parsed, fenced_json
    from corpusmill.functions.prompts import display_choices

    return F.try_element_at(display_choices(options)["places"], F.upper(F.trim(field(first_parsed(reply, fenced_json(reply)), "classification", "string"))))


def yes_no(reply: Column) -> Column:
    """True for the first of two options, yes and no."""
    return chosen(reply, F.array(F.lit("Yes"), F.lit("No"))) == 0


def scored(reply: Column, least: int, most: int) -> Column:
    """The whole number that the reply gives as its score, if it is in range."""
    from corpusmill.functions.jsonish import field, fenced_json, first_parsed

    n = field(first_parsed(reply, fenced_json(reply)), "score", "int")
    return F.when(n.between(least, most), n)


def read_object(reply: Column, required: list[str]) -> Column:
    """(object, whole): the reply's JSON object as VARIANT, and whether it has all required fields."""
    from corpusmill.functions.jsonish import fenced_json, first_parsed
    from corpusmill.functions.prompts import whole_or_raw

    v = first_parsed(reply, fenced_json(reply))
    return F.struct(v.alias("object"), whole_or_raw(v, required).alias("whole"))


def all_failed(df: DataFrame, error: str = "error") -> None:
    """An error if there were calls and none of them came through."""
    one = df.agg(F.count("*").alias("n"), F.count(error).alias("bad")).first()
    if one["n"] and one["n"] == one["bad"]:
        raise RuntimeError(f"all {one['n']} calls failed")


def surviving(df: DataFrame, group: str, error: str = "error") -> DataFrame:
    """Replies without an error; a group of which none is left appears with `all_failed`."""
    good = df.where(F.col(error).isNull()).withColumn("all_failed", F.lit(False))
    lost = df.groupBy(group).agg(F.bool_and(F.col(error).isNotNull()).alias("all_failed")).where("all_failed")
    return good.unionByName(lost, allowMissingColumns=True)


#: Prompt builders by name, for configurations.
BUILDERS: dict[str, Callable[..., Any]] = {}


def builder(name: str) -> Callable[[Callable[..., Any]], Callable[..., Any]]:
    def add(f: Callable[..., Any]) -> Callable[..., Any]:
        BUILDERS[name] = f
        return f

    return add
