"""Repeated trials: pass^k and three kinds of pass@k, told apart by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.scoring import comb, pass_at_k


def is_success(reward: Column) -> Column:
    return reward.between(1 - 1e-6, 1 + 1e-6)


def task_counts(trials: DataFrame, task: str = "task_id", success: str = "success", by: tuple[str, ...] = ()) -> DataFrame:
    return trials.groupBy(*by, task).agg(F.count("*").alias("n"), F.count_if(success).alias("c"))


def pass_hat_k(trials: DataFrame, max_k: int, task: str = "task_id", success: str = "success", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, k, pass_hat_k, n_tasks): the mean over tasks of C(c, k) / C(n, k), by each task's own number of trials; tasks with
    fewer than k trials don't count."""
    counts = task_counts(trials, task, success, by).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max_k)))).where("n >= k")
    return counts.groupBy(*by, "k").agg(F.avg(comb(F.col("c"), F.col("k")) / comb(F.col("n"), F.col("k"))).alias("pass_hat_k"), F.count("*").alias("n_tasks"))


def pass_hat_k_shared(trials: DataFrame, max_k: int, task: str = "task_id", trial: str = "trial", success: str = "success") -> DataFrame:
    """The first version: all tasks are taken to have as many trials as there are distinct ones."""
    n = trials.agg(F.countDistinct(trial).alias("n"))
    counts = trials.groupBy(task).agg(F.count_if(success).alias("c")).crossJoin(F.broadcast(n)).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max_k)))).where("n >= k")
    return counts.groupBy("k").agg((F.sum(comb(F.col("c"), F.col("k")) / comb(F.col("n"), F.col("k"))) / F.count("*")).alias("pass_hat_k"))


def pass_at_k_unbiased(trials: DataFrame, max_k: int, task: str = "task_id", success: str = "success") -> DataFrame:
    """(k, pass_at_k): the mean over tasks of 1 - C(n - c, k) / C(n, k), for each k that all tasks have trials for."""
    counts = task_counts(trials, task, success)
    least = counts.agg(F.min("n").alias("least"))
    each = counts.crossJoin(F.broadcast(least)).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max_k)))).where("k <= least")
    return each.groupBy("k").agg(F.avg(pass_at_k(F.col("n"), F.col("c"), F.col("k"))).alias("pass_at_k"))


def hit_at_k(rows: DataFrame, predictions: str, actual: str, ks: tuple[int, ...]) -> DataFrame:
    """(k, hit_rate): any of the first k predicted lists meets the actual one; an empty actual list counts as met."""
    hit = lambda k: F.when(F.size(actual) == 0, True).otherwise(F.exists(F.slice(predictions, 1, k), lambda p: F.coalesce(F.arrays_overlap(p, F.col(actual)), F.lit(False))))
    one = rows.agg(*[F.avg(hit(k).cast("int")).alias(f"k{k}") for k in ks])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("hit_rate")) for k in ks])).alias("r")).select("r.k", "r.hit_rate")


def best_k_mean(rows: DataFrame, group: str, score: str, k: int) -> DataFrame:
    """(group, pass_at_k): the mean of a group's k best scores, rounded to 3. Ranked before it is gathered: groups may be large."""
    from corpusmill.operators.split import cap_per_group

    best = cap_per_group(rows.select(group, score, (-F.col(score)).alias("__neg")), group, k, "__neg")
    return best.groupBy(group).agg(F.round(F.avg(score), 3).alias("pass_at_k"))


def agent_metrics(trials: DataFrame, max_k: int = 4, task: str = "task_id", reward: str = "reward", cost: str = "cost") -> DataFrame:
    """One row: mean reward, mean cost (nulls skipped), pass_hat_1..max_k."""
    flagged = trials.withColumn("__s", is_success(F.col(reward)))
    means = flagged.agg(F.avg(reward).alias("avg_reward"), F.avg(cost).alias("avg_cost"), F.count("*").alias("n_trials"))
    hats = pass_hat_k(flagged, max_k, task, "__s").groupBy().pivot("k", list(range(1, max_k + 1))).agg(F.first("pass_hat_k"))
    return means.crossJoin(F.broadcast(hats.select(*[F.col(str(k)).alias(f"pass_hat_{k}") for k in range(1, max_k + 1)])))
