"""Queries of evaluation tables: judged outputs, submissions, comparisons, filters of runs and tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import evaluation as E
from corpusmill.operators import similarity
from corpusmill.plans.metrics import _trials
from corpusmill.plans.tables import table


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's reply for each line item, an output of its order: scores by quantity and discount, one of them missing, no
    number or without an output at times; task types by order."""
    k = F.col("l_orderkey")
    types = F.get(F.array(*[F.lit(x) for x in ("debugging", "code_gen", "explain_code", "Understanding", "other")]), (k % 5).cast("int"))
    metric = lambda name, value: F.concat(F.lit(f'"{name}": '), value, F.lit(", "))
    q, d = F.col("l_quantity").cast("int").cast("string"), F.format_string("%.2f", F.col("l_discount"))
    first = F.when(F.col("l_linenumber") == 3, F.lit('"n/a"')).otherwise(q)
    body = F.concat(*[metric(n, v) for n, v in (("bug_fixed", first), ("functional_correctness", first), ("comprehension_accuracy", first), ("root_cause_identified", d), ("task_completion", d), ("repo_context_awareness", d))])
    reply = F.when(F.col("l_linenumber") == 4, "no JSON").otherwise(F.concat(F.lit("{"), body, F.lit('"reasoning": "r"}')))
    rows = table(spark, sf_dir, "lineitem").select(k.alias("item"), F.col("l_linenumber").alias("number"), types.alias("task_type"), F.when(F.col("l_returnflag") != "A", F.lit("x")).otherwise("").alias("output"), reply.alias("reply"))
    return E.judged_outputs(rows, "task_type", "output", "reply")


def type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.task_type_summary(_judged(spark, sf_dir), "task_type", "item").select("task_type", "metric", F.round("mean", 6).alias("mean"), "n_outputs", "n_items")


def best_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.best_of_first(_judged(spark, sf_dir), "item", "number", 3, ["task_type"]).select("task_type", "metric", F.round("mean", 6).alias("mean"))


def extracted_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as answers: in a json fence, in a fence, bare, empty, without a question, no JSON."""
    k = F.col("item_id") % 6
    body = F.to_json(F.struct(F.when(k == 3, F.lit("")).otherwise(F.col("text")).alias("answer")))
    raw = F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit(" ```"), body, F.lit("```\n"))).when(k == 5, F.concat(body, F.lit("x"))).otherwise(body)
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.when(k == 4, "").otherwise(F.concat(F.lit("q"), F.col("item_id").cast("string"))).alias("question"), raw.alias("answer_raw"))
    return E.question_answers(rows, ("item_id",)).select("item_id", "question", F.sha2("answer", 256).alias("answer_sha"))


def evaluation_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' priorities as predictions of three words; references differ by status, some are blank."""
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("is "), F.col("o_orderpriority")).alias("p"), F.when(F.col("o_orderkey") % 10 == 0, F.lit("  ")).when(F.col("o_orderstatus") == "F", F.concat(F.lit(" is "), F.col("o_orderpriority"))).otherwise(F.lit("it is not")).alias("r"), F.lit("is it").alias("s"),
    )
    out = E.eval_row(o, "p", "r", F.startswith(F.col("p"), F.lit("is 1")), similarity.rouge_l(F.col("p"), F.col("r")), similarity.sari(F.col("s"), F.col("p"), F.col("r")))
    return out.select("count", F.round("rougeL", 6).alias("rougeL"), "exact_match", "schema_compliance")


def output_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lines with and without histories and results of several kinds; some are no JSON, some blank."""
    k = F.col("o_orderkey")
    result = F.when(k % 5 == 0, '{"resolved": true}').when(k % 5 == 1, '{"FAIL_TO_PASS": 2}').when(k % 5 == 2, '{"resolved": false, "FAIL_TO_PASS": 0}').when(k % 5 == 3, '{"git_patch": "x"}').otherwise('""')
    line = F.concat(F.lit('{"history": '), F.when(k % 3 == 0, "[]").otherwise('[{"a": 1}]'), F.lit(', "test_result": '), result, F.lit("}"))
    return E.output_profile(table(spark, sf_dir, "orders").select(F.when(k % 11 == 0, "  ").when(k % 13 == 0, "{broken").otherwise(line).alias("value"))).withColumn("resolved_percent", F.round("resolved_percent", 6))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials with a domain, a persona and a number of issues by task."""
    k = F.col("task_id")
    return _trials(spark, sf_dir).withColumns({
        "domain": F.get(F.array(F.lit("airline"), F.lit("retail"), F.lit("telecom")), (k % 3).cast("int")), "persona": F.get(F.array(F.lit("Easy"), F.lit("Hard"), F.lit("None")), (k % 4).cast("int")),
        "issues": F.when(k % 7 == 0, -1).otherwise((k % 4).cast("int")), "num_actions": (k % 6).cast("int"), "num_trials": F.lit(40),
    })


def largest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.max_k(_runs(spark, sf_dir), "task_id", "num_trials").select(F.col("max_k").cast("long").alias("max_k"))


def task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.task_pass_table(_runs(spark, sf_dir), "task_id", "success", "num_actions", 3).select("task_id", "num_actions", *[F.round(f"pass_{k}", 6).alias(f"pass_{k}") for k in (1, 2, 3)])


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.domain_submission(_runs(spark, sf_dir), "domain", "task_id", "success", "cost")
    return out.select("domain", *[F.round(c, 6).alias(c) for c in ("pass_1", "pass_2", "pass_3", "pass_4", "cost")])


def submission_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the counts of runs as figures."""
    domains = _runs(spark, sf_dir).groupBy("domain").agg(F.count("*").alias("runs"), F.count_if("success").alias("passed"))
    return E.submission_json(domains, "domain", "m")


def repeated_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are event types, domains what users they have modulo 40: those of one type only are fine."""
    return E.duplicate_domains(table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 40).alias("domain")).where("domain > 30 or event_type = 'view'"), "event_type", "domain")


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).where("persona is not null")
    out = E.persona_modes(runs, "llm", "persona", "mode", ("default", "solo"), "task_id", "success")
    return out.select("llm", "persona", F.round("default", 6).alias("default_rate"), F.round("solo", 6).alias("solo_rate"))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.issue_curves(_runs(spark, sf_dir), "llm", "mode", "issues", "task_id", "success", 2, "default")
    return out.select("llm", "mode", "issues", "k", F.round("pass_hat_k", 6).alias("pass_hat_k"), F.round("share", 6).alias("share"))


def column_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over quantity, tax and discount of line items."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax", F.when(F.col("l_partkey") % 3 > 0, F.col("l_discount")).alias("l_discount"))
    out = E.across_columns(li, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_tax", "l_discount"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("mean", 6).alias("mean"), F.round("std_pop", 6).alias("std_pop"))


def model_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as code answers: by supplier class, with parts as APIs."""
    k = F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 5).alias("model"), (F.col("l_returnflag") == "R").alias("passed"), (k % 2 == 0).alias("sig"), (k % 3 == 0).alias("used"), k.alias("api"), F.when(F.col("l_returnflag") != "R", F.get(F.array(F.lit("borrow"), F.lit("compile"), F.lit("timeout"), F.lit("test")), (k % 4).cast("int"))).alias("failure"))
    out = E.model_success(rows, "model", "passed", "sig", "used", "api", "failure")
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def chunk_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    status = F.get(F.array(*[F.lit(x) for x in ("SUCCESS", "SUCCESS", "SUCCESS", "UNKNOWN", "INVALID", "ERROR")]), (F.col("l_partkey") % 6).cast("int"))
    named = lambda c, n: F.array(F.concat(F.lit(c), (F.col("l_suppkey") % n).cast("string")))
    summary = F.create_map(F.lit("primary"), named("p", 3), F.lit("edge_cases"), F.array(F.lit("e"), F.concat(F.lit("e"), (F.col("l_suppkey") % 2).cast("string"))))
    out = E.chunk_results(li.select(F.col("l_orderkey").alias("task"), status.alias("status"), (F.col("l_partkey") % 2).alias("retries"), summary.alias("summary")), "task", "status", "retries", "summary")
    return out.select("task", F.round("confidence", 6).alias("confidence"), "n_chunks", "n_failed", F.array_join("primary", ",").alias("primary"), F.size("secondary").alias("n_secondary"), F.array_join("edge_cases", ",").alias("edge_cases"))


def datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties against what was expected of them, by kind of event, with tokens and prices."""
    k = F.col("event_id")
    want = F.when(k % 3 == 0, F.lit('{"k":1}')).otherwise(F.replace("props", F.lit(" "), F.lit("")))
    points = table(spark, sf_dir, "events").select("event_id", "event_type", "props", want.alias("want"), F.when(k % 10 == 0, "boom").alias("error"))
    out = E.datapoint_results(points, "props", "want", "error")
    usage = E.primitive_usage(points, "event_type", {"event_id": F.col("event_id"), "props": F.col("props")}, F.col("want"))
    models = spark.createDataFrame([("view", 0.5, 1.5, 0.1, 0.01), ("click", 0.1, 0.2, 0.3, 0.0)], "event_type string, price_in double, price_out double, latency_base double, latency_token double")
    priced = E.call_prices(usage, models, "event_type", "tokens_in", "tokens_out")
    counts = out.groupBy("event_type").agg(F.count_if("is_error").alias("n_errors"), F.count_if("is_correct").alias("n_correct"))
    return priced.join(counts, "event_type").select("event_type", "n", "tokens_in", "tokens_out", "n_errors", "n_correct", F.round("cost", 4).alias("cost"), F.round("latency", 4).alias("latency"))


def spendings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.spending(_runs(spark, sf_dir), "llm", "mode", "cost").select("llm", F.round("mean_cost", 6).alias("mean_cost"), F.round("total_cost", 4).alias("total_cost"))


def tool_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.when(F.col("turn") % 2 == 1, "tool").otherwise("user").alias("role"), F.contains("text", F.lit("e ")).alias("error"))
    return E.tool_errors(turns, "conv_id", "role", "error")


def run_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what each filter leaves: first failures, faults of the agent, frequent kinds, tasks for solo and gold agents."""
    runs = _runs(spark, sf_dir)
    failed = E.failed_runs(runs, "reward", "event_id", 500)
    verdicts = runs.select("event_id", F.when(F.col("event_id") % 3 == 0, "AGENT").otherwise("USER").alias("author"))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("ticket"),
        F.when(F.col("o_orderkey") % 5 == 0, F.array().cast("array<struct<requestor:string>>")).otherwise(F.array(F.struct(F.when(F.col("o_orderkey") % 3 == 0, "user").otherwise("assistant").alias("requestor")))).alias("actions"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(1))).alias("checks"),
    )
    names = {"failed": failed, "at_fault": E.at_fault(failed, verdicts, "event_id"), "frequent": E.frequent(runs.select((F.col("event_id") % 60 % 37).alias("x")), "x"), "solo": E.solo_tasks(o, "ticket", "actions", "checks"), "gold": E.gold_tasks(o, "actions")}
    out = None
    for name, df in names.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("filter"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as submissions: every third a custom one, scores known for some."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 3 == 0).alias("custom"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("a"), F.when(F.col("s_suppkey") % 5 == 0, 1.0).alias("b"))
    return E.shown_submissions(s, "custom", ["a", "b"], True, False).select("s_suppkey")


def found_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.find_run(_runs(spark, sf_dir), "task_id", "trial", 8, 2, "event_id").select("event_id", "task_id", "trial")


def looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part keys of line items and beyond, with the part's brand or an error."""
    keys = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("p_partkey")).distinct()
    return E.found_or_error(keys, table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", "part")


def zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders by key, first with first."""
    a, b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return E.positional_zip(a, b, "k")


def ensembles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classifiers of orders: by status, by price, by priority."""
    o = table(spark, sf_dir, "orders")
    frames = [o.select("o_orderkey", c.alias("answer")) for c in (F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no"), F.when(F.col("o_totalprice") > 200000, "yes").otherwise("no"), F.when(F.startswith("o_orderpriority", F.lit("1")), "maybe").otherwise("yes"))]
    return E.ensemble(frames, "o_orderkey", "answer")


def trial_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.seeds(spark, 20)


def persona_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 4).alias("n"))
    return E.by_component_count(p, "n", "p_partkey", ["Easy", "Hard", "None"]).select("p_partkey", "persona")


def attached_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples of orders, in order of part and supplier; results in order of supplier and part."""
    at = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col("l_linenumber").alias("c"), F.col("l_extendedprice").alias("d")).alias("at")
    li = table(spark, sf_dir, "lineitem")
    out = E.reattached(li.select("l_orderkey", at("l_partkey", "l_suppkey")), li.select("l_orderkey", at("l_suppkey", "l_partkey"), F.col("l_suppkey").alias("result")), "l_orderkey", "at")
    return out.select("l_orderkey", F.col("at.a").alias("l_partkey"), F.col("at.b").alias("l_suppkey"), "result")


def stacked_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result frames of unlike columns on top of each other."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)



QUERIES = {
    f.__name__: f
    for f in (
        type_summary, best_outputs, extracted_answers, evaluation_row, output_profiles, largest_k, task_table, submissions, submission_document, repeated_domains, personas, issues, column_spread, model_successes, chunk_confidence, datapoints,
        spendings, tool_error_counts, run_filters, shown, found_run, looked_up, zipped, ensembles, trial_seeds, persona_turns, attached_results, stacked_frames,
    )
}
_R = """r as (select event_id, user_id as task_id, event_type = 'purchase' as success, case when event_id % 4 <> 0 then round(value, 2) end as cost, 'm' || event_id % 3 as llm, case when event_id % 2 = 0 then 'default' else 'solo' end as mode,
  ['airline', 'retail', 'telecom'][user_id % 3 + 1] as domain, ['Easy', 'Hard', 'None'][user_id % 4 + 1] as persona, case when user_id % 7 = 0 then -1 else user_id % 4 end::int as issues, (user_id % 6)::int as num_actions, event_id % 5 as trial from events)"""
_COMB = {1: "c::double / n", 2: "(c * (c - 1))::double / (n * (n - 1))", 3: "(c * (c - 1) * (c - 2))::double / (n * (n - 1) * (n - 2))", 4: "(c * (c - 1) * (c - 2) * (c - 3))::double / (n * (n - 1) * (n - 2) * (n - 3))"}
_J = """
j as (select l_orderkey as item, l_linenumber as number, ['debugging', 'code_gen', 'explain_code', 'Understanding', 'other'][l_orderkey % 5 + 1] as task_type, l_returnflag <> 'A' as out, l_linenumber as ln, l_quantity::int as q, round(l_discount, 2) as d from lineitem),
m as (select item, number, task_type, unnest(case when contains(task_type, 'debug') then [{'metric': 'bug_fixed', 'v': q, 'w': 1}, {'metric': 'root_cause_identified', 'v': d, 'w': 2}]
  when contains(task_type, 'gen') then [{'metric': 'functional_correctness', 'v': q, 'w': 1}, {'metric': 'task_completion', 'v': d, 'w': 2}, {'metric': 'syntax_validity', 'v': 0, 'w': 2}]
  when task_type = 'other' then [] else [{'metric': 'comprehension_accuracy', 'v': q, 'w': 1}, {'metric': 'repo_context_awareness', 'v': d, 'w': 2}] end, recursive := true), out, ln from j),
s as (select item, number, task_type, metric, case when not out or ln = 4 or (ln = 3 and w = 1) then 0 else v end::double as v from m)"""
ORACLES = {
    "type_summary": f"with {_J} select task_type, metric, round(avg(v), 6) as mean, count(*) as n_outputs, count(distinct item) as n_items from s group by all",
    "best_outputs": f"with {_J}, b as (select item, task_type, metric, max(v) as v from s where number <= 3 group by all) select task_type, metric, round(avg(v), 6) as mean from b group by all",
    "extracted_answers": "select item_id, 'q' || item_id as question, sha256(text) as answer_sha from benchmark where item_id % 6 < 3",
    "evaluation_row": """
with o as (select o_orderstatus = 'F' as same, string_split(regexp_replace(lower('is ' || o_orderpriority), '[^a-z0-9]+', ' ', 'g'), ' ') as p, o_orderpriority as pr from orders where o_orderkey % 10 <> 0),
s as (select same, pr, len(p) as a, list_contains(p, 'not') as has_not from o)
select count(*) as count, round(avg(case when same then 1.0 else 2.0 * (1 + case when has_not then 1 else 0 end) / (a + 3) end), 6) as "rougeL", round(avg(same::int), 4) as exact_match, round(avg((pr like '1%')::int), 4) as schema_compliance from s""",
    "output_profiles": """
with l as (select o_orderkey % 3 > 0 as h, o_orderkey % 5 < 3 as t, o_orderkey % 5 < 2 as r from orders where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0)
select count(*) as total, count(*) filter (h) as with_patches, count(*) filter (t) as with_test_results, count(*) filter (h and not t) as needs_evaluation, count(*) filter (r) as resolved, count(*) filter (t and not r) as failed, round(count(*) filter (r) * 100.0::double / count(*) filter (t), 6) as resolved_percent from l""",
    "largest_k": "select least(min(n), 40)::bigint as max_k from (select count(*) as n from events group by user_id)",
    "task_table": f"with {_R}, t as (select task_id, num_actions, count(*) as n, count(*) filter (success) as c from r group by all) select task_id, num_actions, round({_COMB[1]}, 6) as pass_1, round({_COMB[2]}, 6) as pass_2, round({_COMB[3]}, 6) as pass_3 from t",
    "submissions": f"""
with {_R}, t as (select domain, task_id, count(*) as n, count(*) filter (success) as c from r group by all), p as (select domain, {", ".join(f"case when min(n) >= {k} then round(avg({e}) * 100, 6) end as pass_{k}" for k, e in _COMB.items())} from t group by 1)
select p.*, round(c.cost, 6) as cost from p join (select domain, avg(cost) as cost from r group by 1) c using (domain)""",
    "submission_document": f"""with {_R}, d as (select domain, count(*) as n, count(*) filter (success) as c from r group by 1)
select '{{"model_name":"m","results":{{' || string_agg('"' || domain || '":{{"runs":' || n || ',"passed":' || c || '}}', ',' order by domain) || '}}}}' as submission from d""",
    "repeated_domains": "select user_id % 40 as domain, count(distinct event_type) as n_files from events where user_id % 40 > 30 or event_type = 'view' group by 1 having n_files > 1",
    "personas": f"""
with {_R}, t as (select llm, persona, mode, task_id, avg(success::int) as p from r where persona is not null group by all)
select llm, persona, round(coalesce(avg(p) filter (mode = 'default'), 0), 6) as default_rate, round(coalesce(avg(p) filter (mode = 'solo'), 0), 6) as solo_rate from t group by all""",
    "issues": f"""
with {_R}, t as (select llm, mode, issues, task_id, count(*) as n, count(*) filter (success) as c from r group by all),
f as (select llm, mode, issues, 1 as k, avg({_COMB[1]}) as p from t group by all union all select llm, mode, issues, 2, avg({_COMB[2]}) from t where n >= 2 group by all),
d as (select distinct task_id, issues from r where mode = 'default'), s as (select issues, count(*) * 100.0::double / (select count(*) from d) as share from d group by 1),
g as (select a.issues, b.llm, b.mode, k.k from (select distinct issues from r) a, (select distinct llm, mode from f) b, (values (1), (2)) k(k))
select llm, mode, issues, k, round(coalesce(p, 0), 6) as pass_hat_k, round(coalesce(share, 0), 6) as share from g left join f using (llm, mode, issues, k) left join s using (issues)""",
    "column_spread": """
with l as (select l_orderkey, l_linenumber, l_partkey, list_filter([l_quantity, l_tax, case when l_partkey % 3 > 0 then l_discount end], lambda x: x is not null) as v from lineitem)
select l_orderkey, l_linenumber, l_partkey, round(list_avg(v), 6) as mean, round(list_stddev_pop(v), 6) as std_pop from l""",
    "model_successes": """
with l as (select l_suppkey % 5 as model, l_returnflag = 'R' as ok, l_partkey as k, case when l_returnflag <> 'R' then l_partkey % 4 end as f from lineitem),
c as (select model, count(*) as total, count(*) filter (ok) as success, count(*) filter (k % 2 = 0) as signature_ok, count(*) filter (k % 3 = 0) as api_used, count(*) filter (f = 0) as failed_borrow, count(*) filter (f = 1) as failed_compile, count(*) filter (f = 2) as failed_timeout, count(*) filter (f = 3) as failed_test,
  count(distinct k) as apis, count(distinct case when ok then k end) as apis_solved, count(*) filter (not ok) as failed from l group by 1)
select *, round(success / total, 6) as success_rate, round(signature_ok / total, 6) as signature_rate, round(api_used / total, 6) as api_rate, round(failed_borrow / failed, 6) as borrow_share, round(apis_solved / apis, 6) as api_coverage from c""",
    "chunk_confidence": """
with l as (select l_orderkey as task, l_partkey % 6 as s, l_partkey % 2 as r, 'p' || l_suppkey % 3 as p, 'e' || l_suppkey % 2 as e from lineitem)
select task, round(pow(0.5::double, count(*) filter (s = 3)) * pow(0.7::double, count(*) filter (s > 3)) * count(*) filter (s < 3) / count(*) * pow(0.95::double, coalesce(sum(r) filter (s < 3), 0)), 6) as confidence, count(*) as n_chunks, count(*) filter (s >= 3) as n_failed,
coalesce(string_agg(distinct p, ',' order by p) filter (s < 3), '') as primary, 0::int as n_secondary, case when count(*) filter (s < 3) > 0 then 'e,' || string_agg(distinct e, ',' order by e) filter (s < 3) else '' end as edge_cases from l group by 1""",
    "datapoints": """
with p as (select event_id, event_type, props, case when event_id % 3 = 0 then '{"k":1}' else replace(props, ' ', '') end as want from events),
u as (select event_type, count(*) as n, sum(length('{"event_id":' || event_id || ',"props":"' || replace(props, '"', '\\"') || '"}') // 4)::bigint as tokens_in, sum(length(want) // 4)::bigint as tokens_out, count(*) filter (event_id % 10 = 0) as n_errors,
  count(*) filter (event_id % 10 <> 0 and replace(props, ' ', '') = want) as n_correct from p group by 1)
select *, case event_type when 'view' then round(tokens_in * 0.5::double + tokens_out * 1.5::double, 4) when 'click' then round(tokens_in * 0.1::double + tokens_out * 0.2::double, 4) end as cost, case event_type when 'view' then round(0.1::double + 0.01::double * tokens_out, 4) when 'click' then 0.3::double end as latency from u""",
    "spendings": f"with {_R} select llm, round(avg(cost), 6) as mean_cost, round(sum(cost), 4) as total_cost from r where mode = 'default' group by 1",
    "tool_error_counts": "select conv_id, count(*) filter (turn % 2 = 1 and contains(text, 'e ')) as n_errors from conversations group by 1",
    "run_filters": """
with f as (select event_id from events where event_type <> 'purchase' order by event_id limit 500),
o as (select o_orderkey as k from orders)
select 'failed' as filter, count(*) as n from f union all select 'at_fault', count(*) from f where event_id % 3 = 0
union all select 'frequent', count(*) from (select event_id % 60 % 37 as x, count(*) as n, sum(count(*)) over () as t from events group by 1) where n / t > 0.03
union all select 'solo', count(*) from o where k % 4 > 0 and (k % 5 <> 0 or k % 2 = 0) and (k % 5 = 0 or k % 3 <> 0) union all select 'gold', count(*) from o where k % 5 <> 0""",
    "shown": "select s_suppkey from supplier where s_suppkey % 3 <> 0 and (s_suppkey % 2 = 0 or s_suppkey % 5 = 0)",
    "found_run": "select event_id, user_id as task_id, event_id % 5 as trial from events where user_id = 8 and event_id % 5 = 2 order by 1 limit 1",
    "looked_up": "select k as p_partkey, p_brand, case when p.p_partkey is null then 'part ' || k || ' not found' end as error from (select distinct l_partkey * 2 as k from lineitem) l left join part p on p.p_partkey = k",
    "zipped": "select a.r as position, a.k as a_k, b.k as b_k from (select c_custkey as k, row_number() over (order by c_custkey) as r from customer) a join (select o_orderkey as k, row_number() over (order by o_orderkey) as r from orders) b on a.r = b.r",
    "ensembles": """
with a as (select o_orderkey, case when o_orderstatus = 'F' then 'yes' else 'no' end as x, 0 as s from orders union all select o_orderkey, case when o_totalprice > 200000 then 'yes' else 'no' end, 1 from orders union all select o_orderkey, case when o_orderpriority like '1%' then 'maybe' else 'yes' end, 2 from orders),
c as (select o_orderkey, x, count(*) as n, min(s) as f from a group by all)
select o_orderkey, arg_max(x, n * 10 - f) as winner, max(n) as votes, count(*) = 1 as unanimous from c group by 1""",
    "trial_seeds": "select i::int as trial, ('0x' || substr(sha256('300:' || i), 1, 7))::bigint % 1000000 as seed from range(20) t(i)",
    "persona_turns": "select p_partkey, ['Easy', 'Hard', 'None'][(row_number() over (order by p_size % 4, p_partkey) - 1) % 3 + 1] as persona from part",
    "attached_results": """
with a as (select *, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber, l_extendedprice) as n from lineitem), b as (select *, row_number() over (partition by l_orderkey order by l_suppkey, l_partkey, l_linenumber, l_extendedprice) as n from lineitem)
select a.l_orderkey, a.l_partkey, a.l_suppkey, b.l_suppkey as result from a join b on a.l_orderkey = b.l_orderkey and a.n = b.n""",
    "stacked_frames": "select c_custkey as k, c_mktsegment as segment, null::int as nation from customer union all select s_suppkey, null, s_nationkey from supplier",
}
