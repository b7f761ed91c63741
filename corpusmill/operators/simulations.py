"""Simulation result sets as flat tables, and task metadata from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import strip


def task_metrics(tasks: DataFrame, task: str = "id", actions: str = "actions", env: str = "env_assertions", nl: str = "nl_assertions") -> DataFrame:
    """(task, numbers of gold actions by side and of assertions); a single action that is a transfer counts as -1 actions."""
    by = lambda side: F.size(F.filter(F.coalesce(F.col(actions), F.array().cast(tasks.schema[actions].dataType)), lambda a: a["requestor"] == side))
    agent, user = by("assistant"), by("user")
    transfer = (F.size(actions) == 1) & F.contains(F.lower(F.try_element_at(F.col(actions), F.lit(1))["name"]), F.lit("transfer"))
    count = lambda c: F.greatest(F.size(F.coalesce(F.col(c), F.array().cast(tasks.schema[c].dataType))), F.lit(0))
    return tasks.select(task, agent.alias("task_num_agent_actions"), user.alias("task_num_user_actions"), F.when(F.coalesce(transfer, F.lit(False)), -1).otherwise(agent + user).alias("task_num_actions"), count(env).alias("task_num_env_assertions"), count(nl).alias("task_num_nl_assertions"))


def flatten(simulations: DataFrame, tasks: DataFrame, sim_task: str = "task_id", task: str = "id") -> DataFrame:
    """A row for each simulation with its task's metrics; simulations of unknown tasks are left out."""
    return simulations.join(task_metrics(tasks, task).withColumnRenamed(task, sim_task), sim_task)


def action_rows(simulations: DataFrame, checks: str, keep: list[str]) -> DataFrame:
    """A row for each action check."""
    return simulations.select(*keep, F.explode(checks).alias("c")).select(*keep, "c.*")


def reward_breakdown(simulations: DataFrame, basis: str, parts: str, checks: str, writes: list[str], keep: list[str]) -> DataFrame:
    """Success by basis (null where it isn't part of the basis), and correct and total write actions."""
    flag = lambda name: F.when(F.array_contains(basis, name), F.try_element_at(F.col(parts), F.lit(name)) == 1.0)
    write = F.filter(checks, lambda c: c["name"].isin(writes))
    return simulations.select(*keep, flag("DB").alias("database"), flag("COMMUNICATE").alias("communication"), F.size(F.filter(write, lambda c: c["match"])).alias("correct_writes"), F.size(write).alias("total_writes"))


def request_sections(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, title, description, issue) of a task's text: the title line; from then on lines belong to the issue after its
    heading, else to the description, up to the requirements. Missing parts have their stock phrases."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    is_title = F.startswith("line", F.lit("# Task:"))
    is_issue = ~is_title & F.contains("line", F.lit("Issue #"))
    is_desc = ~is_issue & (F.startswith("line", F.lit("## Description")) | F.startswith("line", F.lit("## PR Information")))
    marked = lines.withColumn("first", is_title & (F.sum(is_title.cast("int")).over(w) == 1)).withColumn("head", F.when(is_issue, "issue").when(is_desc, "description"))
    marked = marked.withColumn("over", F.max(F.startswith("line", F.lit("## Requirements"))).over(w)).withColumn("section", F.coalesce(F.last("head", ignorenulls=True).over(w), F.lit("none")))
    body = ~F.col("first") & F.col("head").isNull() & ~F.col("over")
    of = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("pos", "line")))), lambda x: x["line"]), "\n")
    in_desc = body & (F.col("section") != "issue") & ((F.col("section") == "description") | ~F.startswith("line", F.lit("##")))
    out = marked.groupBy(key).agg(F.max(F.when(F.col("first"), strip(F.expr("substring(line, 8)")))).alias("title"), of(in_desc).alias("d"), of(body & (F.col("section") == "issue") & (strip(F.col("line")) != "")).alias("i"))
    fill = lambda c, phrase: F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(phrase))
    return out.select(key, fill(F.col("title"), "Unknown title").alias("title"), fill(F.col("d"), "No description provided.").alias("description"), fill(F.col("i"), "No issue description provided.").alias("issue"))


def speed_estimate(range_low: Column, range_high: Column, signal: Column, base: Column) -> Column:
    """The middle of the technology's range by signal and base factors, to two digits."""
    return F.round((range_low + range_high) / 2 * signal * base, 2)


def billing_dates(day: Column) -> dict[str, Column]:
    """Start of the next month, the cycle's end, its due date two weeks later, and the previous month's range."""
    first = F.trunc(day, "MM")
    return {"next_start": F.add_months(first, 1), "cycle_end": F.last_day(day), "due": F.date_add(F.last_day(day), 14), "previous_start": F.add_months(first, -1), "previous_end": F.date_sub(first, 1)}
