"""What is left of a run: by item, or by trial, task and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending_trials(tasks: DataFrame, done: DataFrame, seeds: list[int], task: str = "task_id") -> DataFrame:
    """(task, trial, seed) that no finished run has. Trials are a short list of seeds."""
    each = tasks.select(task).distinct().withColumn("__s", F.explode(F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(s).alias("seed")) for i, s in enumerate(seeds)])))
    wanted = each.select(task, "__s.trial", "__s.seed")
    return wanted.join(done.select(task, "trial", "seed").distinct(), [task, "trial", "seed"], "left_anti")


def config_hash(*cols: Column) -> Column:
    """What must be equal for a run to be resumed."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
