"""Joins and lookups of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def backfill(left: DataFrame, right: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Blank fields of the left side from the right one."""
    other = right.select(key, *[F.col(c).alias(f"__{c}") for c in cols])
    out = left.join(other, key, "left")
    return out.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"__{c}")) for c in cols}).drop(*[f"__{c}" for c in cols])


def missing_and_extra(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys that only one side has: missing or extra."""
    a, b = expected.select(key).distinct().withColumn("__a", F.lit(True)), found.select(key).distinct().withColumn("__b", F.lit(True))
    both = a.join(b, key, "full").where("__a is null or __b is null")
    return both.select(key, F.when(F.col("__b").isNull(), "missing").otherwise("extra").alias("side"))


def unprocessed(items: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Items that a run still has to do."""
    return items.join(done.select(*keys).distinct(), list(keys), "left_anti")


def action_matched(gold_name: Column, gold_args: Column, compare: Column, calls: Column) -> Column:
    """Whether any call has the gold action's name and, on the keys to compare, its arguments. Without such keys those of the
    call are compared: gold arguments that the call lacks don't count then."""

    def same(call: Column) -> Column:
        keys = F.coalesce(compare, F.map_keys(call["arguments"]))
        return (call["name"] == gold_name) & F.forall(keys, lambda k: F.coalesce(F.try_element_at(call["arguments"], k).eqNullSafe(F.try_element_at(gold_args, k)), F.lit(False)))

    return F.exists(calls, same)


def info_communicated(info: Column, messages: Column) -> Column:
    """Whether an assistant's message has the text, case aside; commas are taken out of the message only."""
    return F.exists(messages, lambda m: (m["role"] == "assistant") & F.contains(F.replace(F.lower(m["content"]), F.lit(","), F.lit("")), F.lower(info)))


def arrival_day(day: Column, arrive: Column) -> Column:
    """The day of arrival: the next one for a time that ends in +1."""
    return F.date_add(day.cast("date"), F.when(F.contains(arrive, F.lit("+1")), 1).otherwise(0))


def one_stop(first: DataFrame, second: DataFrame, on: str, via: str, arrive: str, depart: str, day: str) -> DataFrame:
    """Pairs of legs: the second starts where the first ends, on its arrival day, not before it arrives. Times are texts
    `HH:MM:SS`, those of the next day with +1 behind, and are compared as texts; days are dates. The join is on place and day."""
    a = first.select(*[F.col(c).alias(f"a_{c}") for c in first.columns]).withColumn("__day", arrival_day(F.col(f"a_{day}"), F.col(f"a_{arrive}")))
    b = second.select(*[F.col(c).alias(f"b_{c}") for c in second.columns])
    return a.join(b, (F.col(f"a_{via}") == F.col(f"b_{on}")) & (F.col("__day") == F.col(f"b_{day}")) & (F.col(f"b_{depart}") >= F.col(f"a_{arrive}"))).drop("__day")


def one_stop_counts(first: DataFrame, second: DataFrame, on: str, via: str, arrive: str, depart: str, day: str) -> DataFrame:
    """(a_day, n): how many pairs `one_stop` has for each day of the first leg, without making them: legs are counted by place, day
    and time, and each arrival takes the running count of the departures of its place and day that are not before it. A
    window has a row for each time of a day and not for each leg."""
    left = first.select(F.col(via).alias("p"), arrival_day(F.col(day), F.col(arrive)).alias("d"), F.col(arrive).alias("t"), F.col(day).alias("a_day")).groupBy("p", "d", "t", "a_day").agg(F.count("*").alias("m"))
    right = second.select(F.col(on).alias("p"), F.col(day).cast("date").alias("d"), F.col(depart).alias("t")).groupBy("p", "d", "t").agg(F.count("*").alias("k"))
    both = left.unionByName(right, allowMissingColumns=True).where("p is not null and d is not null and t is not null")
    # A range has all rows of equal times.
    later = Window.partitionBy("p", "d").orderBy(F.col("t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("s", F.coalesce(F.sum("k").over(later), F.lit(0))).where("m is not null and s > 0")
    return met.groupBy("a_day").agg(F.sum(F.col("m") * F.col("s")).alias("n"))


def within(points: DataFrame, spans: DataFrame, key: str, point: str, start: str, end: str, width: int) -> DataFrame:
    """Points inside closed spans of the same key. Spans are dealt to the blocks of `width` that they touch, so that the
    join is on key and block and not on an inequality alone."""
    p = points.withColumn("__b", F.floor(F.col(point) / width))
    s = spans.withColumn("__b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(s, [key, "__b"]).where(F.col(point).between(F.col(start), F.col(end))).drop("__b")


def combinations(sets: dict[str, DataFrame], optional: bool = True, valid: Column | None = None, name_of_parts: str | None = None) -> DataFrame:
    """All choices of one value of each set, or of none of it, that are `valid`; each set is a table with one column of its name.
    `name_of_parts` adds the values chosen, sorted. A product has as many rows as its sets multiply to; Spark broadcasts a
    set whose size it knows to be small."""
    out = None
    for name, df in sets.items():
        one = df.select(name).union(df.sparkSession.createDataFrame([(None,)], f"{name} {df.schema[name].dataType.simpleString()}")) if optional else df.select(name)
        out = one if out is None else out.crossJoin(one)
    if valid is not None:
        out = out.where(valid)
    if name_of_parts:
        out = out.withColumn(name_of_parts, F.array_sort(F.filter(F.array(*[F.col(n).cast("string") for n in sets]), lambda x: x.isNotNull())))
    return out


def lookup(df: DataFrame, equal: dict[str, str], folded: dict[str, str] | None = None) -> DataFrame:
    """Rows with equal fields; those in `folded` case aside."""
    for col, value in equal.items():
        df = df.where(F.col(col) == value)
    for col, value in (folded or {}).items():
        df = df.where(F.lower(col) == value.lower())
    return df


def outcome_pairs(a: DataFrame, b: DataFrame, key: str, success: str) -> DataFrame:
    """One row: tasks that both, neither, only the first, only the second solved."""
    both = a.select(key, F.col(success).alias("x")).join(b.select(key, F.col(success).alias("y")), key, "full")
    x, y = F.coalesce("x", F.lit(False)), F.coalesce("y", F.lit(False))
    return both.agg(F.count_if(x & y).alias("both"), F.count_if(~x & ~y).alias("neither"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"))
