"""Evaluation analytics over runs and trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def group_stats(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Mean, sample deviation (null for one row), population deviation, number."""
    return df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.stddev_pop(col).alias("std_pop"), F.count(col).alias("n"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Counts and percentages of values."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("__t"))
    return counts.crossJoin(F.broadcast(total)).select(col, "n", (F.col("n") * 100 / F.col("__t")).alias("percent"))


def success_rollup(df: DataFrame, by: str, success: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Totals and the breakdown by a column in one pass; the total's row has scope `all`."""
    aggs = [F.count("*").alias("total"), F.count_if(success).alias("n_success"), *[c.alias(n) for n, c in (extra or {}).items()]]
    out = df.rollup(by).agg(F.grouping(by).alias("__all"), *aggs)
    return out.withColumn("scope", F.when(F.col("__all") == 1, "all").otherwise(F.col(by).cast("string"))).withColumn("success_rate", rate(F.col("n_success"), F.col("total"))).drop("__all", by)


def bucketed_mean(df: DataFrame, bucket: str, value: str, buckets: list[int]) -> DataFrame:
    """Mean by bucket, 0 for the buckets without rows."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(b,) for b in buckets], f"{bucket} {df.schema[bucket].dataType.simpleString()}")
    return wanted.join(df.groupBy(bucket).agg(F.avg(value).alias("mean")), bucket, "left").fillna(0.0, ["mean"])


def success_pivot(df: DataFrame, row: str, col: str, values: list[str], success: str) -> DataFrame:
    """Success rate by row and column value, with the row's share of all rows."""
    wide = df.groupBy(row).pivot(col, values).agg(F.avg(F.col(success).cast("int")))
    return wide.join(value_shares(df, row).select(row, "percent"), row)


def mode_delta(df: DataFrame, by: str, mode: str, a: str, b: str, value: str) -> DataFrame:
    """Mean value in mode a less that in mode b."""
    wide = df.groupBy(by).pivot(mode, [a, b]).agg(F.avg(value))
    return wide.select(by, F.col(a).alias("mean_a"), F.col(b).alias("mean_b"), (F.col(a) - F.col(b)).alias("delta"))


def failure_shares(df: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Share of false among the known values of each flag."""
    return df.groupBy(by).agg(*[F.avg(F.when(F.col(c).isNotNull(), (~F.col(c)).cast("int"))).alias(f"{c}_failed") for c in flags])


def fault_distribution(df: DataFrame, col: str) -> DataFrame:
    out = value_shares(df.where(F.col(col).isNotNull()), col)
    return out.withColumn("percent", F.round("percent", 2))


def complete_cost(df: DataFrame, by: str, cost: str, tokens: str, role: str = "role") -> DataFrame:
    """Sums without tool turns: cost is null if any turn lacks it, tokens skip what is missing."""
    kept = df.where(F.col(role) != "tool")
    return kept.groupBy(by).agg(F.when(F.count("*") == F.count(cost), F.sum(cost)).alias("cost"), F.sum(tokens).alias("tokens"), F.count("*").alias("n_turns"))


def majority(df: DataFrame, group: str, value: str, position: str) -> DataFrame:
    """The most frequent value of each group; ties go to the one seen first."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("__n"), F.min(position).alias("__first"))
    best = counts.groupBy(group).agg(F.max_by(F.struct(value, "__n"), F.struct("__n", (-F.col("__first")).alias("f"))).alias("b"), F.count("*").alias("n_distinct"))
    return best.select(group, F.col(f"b.{value}").alias("winner"), F.col("b.__n").alias("votes"), (F.col("n_distinct") == 1).alias("unanimous"))


def overall_verdict(df: DataFrame, group: str, verdict: str) -> DataFrame:
    return df.groupBy(group).agg(F.when(F.bool_or(F.col(verdict) == "PASS"), "PASS").otherwise("FAIL").alias("overall"))


def attempt_outcome(df: DataFrame, task: str, attempt: str, verdict: str, most: int = 3) -> DataFrame:
    """Attempts until the first PASS or overflow, `most` at the most: how many were made, and the last one's verdict."""
    stop = F.min(F.when(F.col(verdict).isin("PASS", "SKIPPED_CONTEXT_OVERFLOW"), F.col(attempt))).over(Window.partitionBy(task))
    made = df.where(F.col(attempt) <= most).withColumn("__stop", stop).where(F.col("__stop").isNull() | (F.col(attempt) <= F.col("__stop")))
    return made.groupBy(task).agg(F.max(attempt).alias("attempts"), F.max_by(verdict, attempt).alias("final_verdict"))


def merge_intervals(df: DataFrame, key: str, start: str, end: str, gap: int = 5) -> DataFrame:
    """Intervals of a key joined where one starts within `gap` of the end so far."""
    w = Window.partitionBy(key).orderBy(start, end)
    far = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(F.col(start) <= far + gap, 0).otherwise(1)).withColumn("__g", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "__g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_merged")).drop("__g")


def leaderboard(df: DataFrame, name: str, domain: str, scores: dict[int, str], domains: list[str]) -> DataFrame:
    """Overall score by k, the mean over domains with a value, only for those that have pass^1 in all domains; consistency is
    pass^4 over pass^1; ranked with data first, then by overall pass^1, nulls last, ties by name."""
    one = df.where(F.col(domain).isin(domains)).groupBy(name).agg(F.count(scores[1]).alias("__n"), *[F.avg(c).alias(f"__k{k}") for k, c in scores.items()])
    full = F.col("__n") == len(domains)
    out = one.select(name, *[F.when(full, F.col(f"__k{k}")).alias(f"overall_{k}") for k in scores])
    if {1, 4} <= set(scores):
        out = out.withColumn("consistency", F.when(F.col("overall_1") > 0, F.col("overall_4") / F.col("overall_1")))
    # A leaderboard has a row for each submission: few enough for one window.
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.col("overall_1").isNotNull().desc(), F.col("overall_1").desc_nulls_last(), name)))


def verify_counts(tasks: DataFrame, runs: DataFrame, key: str, expected: int) -> DataFrame:
    """Tasks whose number of runs isn't the expected one."""
    counts = runs.groupBy(key).agg(F.count("*").alias("n_runs"))
    return tasks.select(key).distinct().join(counts, key, "left").select(key, F.coalesce("n_runs", F.lit(0)).alias("n_runs")).where(F.col("n_runs") != expected)


def uniform_config(df: DataFrame, file: str, config: Column) -> DataFrame:
    """One row: whether all files have the same configuration, and how many there are."""
    return df.agg((F.countDistinct(F.sha2(config, 256)) <= 1).alias("uniform"), F.countDistinct(file).alias("n_files"))


def metric_mismatches(submitted: DataFrame, computed: DataFrame, keys: list[str], value: str) -> DataFrame:
    a, b = submitted.select(*keys, F.col(value).alias("submitted")), computed.select(*keys, F.col(value).alias("computed"))
    return a.join(b, keys, "full").where(~F.col("submitted").eqNullSafe(F.col("computed")))


def contiguous_attempts(df: DataFrame, task: str, attempt: str, complete: str) -> DataFrame:
    """The last attempt n such that 1..n are all there, and the last complete one among them."""
    ranked = df.select(task, attempt, complete).withColumn("__r", F.row_number().over(Window.partitionBy(task).orderBy(attempt))).where(F.col("__r") == F.col(attempt))
    return ranked.groupBy(task).agg(F.max(attempt).alias("last_attempt"), F.max(F.when(F.col(complete), F.col(attempt))).alias("last_complete"))


def perplexity(df: DataFrame, nll: str) -> DataFrame:
    return df.agg(F.exp(F.avg(nll)).alias("perplexity"))


def cheapest_capable(jobs: DataFrame, models: DataFrame, need: str, has: str, model: str, key: str) -> DataFrame:
    """For each job the model of least sufficient capability; ties by name; no row for a job that none can do. Needs and
    capabilities are put in one order, in which the next model behind a job is its own: no join of unequal keys."""
    asked = jobs.select(F.col(need).alias("__x")).distinct()
    points = asked.select("__x", F.lit(None).cast("string").alias("__m"), F.lit(0).alias("__kind")).unionByName(models.groupBy(F.col(has).alias("__x")).agg(F.min(model).alias("__m")).select("__x", "__m", F.lit(1).alias("__kind")))
    # Distinct needs and models, not jobs, are one window.
    w = Window.orderBy(F.col("__x"), F.col("__kind")).rowsBetween(0, Window.unboundedFollowing)
    chosen = points.withColumn(model, F.first("__m", ignorenulls=True).over(w)).where("__kind = 0").select("__x", model)
    return jobs.join(chosen, jobs[need] == chosen["__x"]).where(F.col(model).isNotNull()).select(key, model)
