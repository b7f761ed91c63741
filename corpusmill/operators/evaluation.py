"""Tables of an evaluation: judged outputs, submissions, comparisons by mode, persona and task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.functions.jsonish import canonical, field, parsed, strict_json
from corpusmill.functions.text import strip
from corpusmill.operators.analysis import rate
from corpusmill.operators.passk import pass_hat_k

# What a judge scores, by the kind of task.
JUDGED = {
    "debugging": ("bug_fixed", "root_cause_identified"),
    "generation": ("functional_correctness", "task_completion", "syntax_validity"),
    "understanding": ("comprehension_accuracy", "repo_context_awareness"),
}


def kind_of_task(task_type: Column) -> Column:
    """The kind by what a task type's name holds; null for names of no kind."""
    low = F.lower(task_type)
    return F.when(F.contains(low, F.lit("debug")), "debugging").when(F.contains(low, F.lit("gen")), "generation").when(F.contains(low, F.lit("understanding")) | F.contains(low, F.lit("exp")), "understanding")


def judge_scores(output: Column, reply: Column, kind: str) -> Column:
    """A map of the kind's metrics from a judge's JSON reply: a metric that is missing or no number is 0; without a model's
    output all are."""
    none = F.array(*[F.lit(0.0) for _ in JUDGED[kind]])
    read = lambda v: F.array(*[F.coalesce(field(v, m, "double"), F.lit(0.0)) for m in JUDGED[kind]])
    # A reply is made and parsed once for all metrics.
    scores = F.when(F.coalesce(output, F.lit("")) == "", none).otherwise(let(reply, lambda c: let(parsed(c), read)))
    return F.map_from_arrays(F.array(*[F.lit(m) for m in JUDGED[kind]]), scores)


def judged_outputs(outputs: DataFrame, task_type: str, output: str, reply: str) -> DataFrame:
    """Adds kind and metrics, the scores that the kind of each row's task asks for; empty for tasks of no kind."""
    kind = kind_of_task(F.col(task_type))
    scores = F.lit(None).cast("map<string,double>")
    for k in JUDGED:
        scores = F.when(kind == k, judge_scores(F.col(output), F.col(reply), k)).otherwise(scores)
    return outputs.withColumn("kind", kind).withColumn("metrics", F.coalesce(scores, F.create_map().cast("map<string,double>")))


def task_type_summary(outputs: DataFrame, task_type: str, item: str, metrics: str = "metrics") -> DataFrame:
    """(task type, metric, mean, n_outputs, n_items): the mean of every metric over all outputs of a type."""
    items = outputs.groupBy(task_type).agg(F.countDistinct(item).alias("n_items"))
    each = outputs.select(task_type, F.explode(metrics).alias("metric", "__v"))
    return each.groupBy(task_type, "metric").agg(F.avg("__v").alias("mean"), F.count("*").alias("n_outputs")).join(items, task_type)


def best_of_first(outputs: DataFrame, item: str, number: str, k: int, by: list[str], metrics: str = "metrics") -> DataFrame:
    """(by, metric, mean): of each item the best score among its first `k` outputs, averaged over items."""
    first = outputs.where(F.col(number) <= k).select(item, *by, F.explode(metrics).alias("metric", "__v"))
    return first.groupBy(item, *by, "metric").agg(F.max("__v").alias("__v")).groupBy(*by, "metric").agg(F.avg("__v").alias("mean"))


def question_answers(rows: DataFrame, keep: tuple[str, ...] = (), question: str = "question", raw: str = "answer_raw") -> DataFrame:
    """(question, answer) of generated pairs whose reply is JSON, in a fence or bare, with an answer that isn't empty."""
    text = strip(F.col(raw))
    opened = F.when(F.startswith(text, F.lit("```json")), F.substring(text, F.lit(8), F.length(text) - 10)).when(F.startswith(text, F.lit("```")), F.substring(text, F.lit(4), F.length(text) - 6)).otherwise(text)
    answer = field(parsed(strip(opened)), "answer", "string")
    return rows.select(*keep, question, answer.alias("answer")).where((F.coalesce(F.col(question), F.lit("")) != "") & (F.coalesce(F.col("answer"), F.lit("")) != ""))


def eval_row(pairs: DataFrame, prediction: str, reference: str, schema_ok: Column, rouge: Column, sari: Column) -> DataFrame:
    """One row: count, rougeL, sari, exact_match and schema_compliance of predictions, the last two to four digits; pairs of
    which one side is blank don't count."""
    kept = nonblank_pairs(pairs, prediction, reference)
    same = (strip(F.col(prediction)) == strip(F.col(reference))).cast("double")
    one = kept.agg(F.count("*").alias("count"), F.avg(rouge).alias("rougeL"), F.avg(sari).alias("sari"), F.round(F.avg(same), 4).alias("exact_match"), F.round(F.avg(schema_ok.cast("double")), 4).alias("schema_compliance"))
    return one.fillna(0.0)


def nonblank_pairs(pairs: DataFrame, prediction: str, reference: str) -> DataFrame:
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    return pairs.where(~blank(prediction) & ~blank(reference))


def output_profile(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row over JSON lines of runs: total, with_patches (a history), with_test_results (a result that says resolved or
    FAIL_TO_PASS), needs_evaluation (a history without such a result), resolved and failed among the results, their rate in
    percent. Lines that are no JSON don't count."""
    v = strict_json(F.col(value))
    history = F.coalesce(F.json_array_length(F.try_variant_get(v, "$.history", "variant").cast("string")) > 0, F.lit(False))
    solved, turned = F.try_variant_get(v, "$.test_result.resolved", "boolean"), F.try_variant_get(v, "$.test_result.FAIL_TO_PASS", "double")
    keys = F.json_object_keys(F.try_variant_get(v, "$.test_result", "variant").cast("string"))
    tested = F.coalesce(F.arrays_overlap(keys, F.array(F.lit("resolved"), F.lit("FAIL_TO_PASS"))), F.lit(False))
    resolved = tested & (F.coalesce(solved, F.lit(False)) | F.coalesce(turned > 0, F.lit(False)))
    facts = lines.where(strip(F.col(value)) != "").select(v.isNotNull().alias("ok"), history.alias("h"), tested.alias("t"), resolved.alias("r")).where("ok")
    one = facts.agg(F.count("*").alias("total"), F.count_if("h").alias("with_patches"), F.count_if("t").alias("with_test_results"), F.count_if(F.col("h") & ~F.col("t")).alias("needs_evaluation"), F.count_if("r").alias("resolved"), F.count_if(F.col("t") & ~F.col("r")).alias("failed"))
    return one.withColumn("resolved_percent", rate(F.col("resolved") * 100.0, F.col("with_test_results")))


def max_k(runs: DataFrame, task: str, num_trials: str) -> DataFrame:
    """One row: the largest k that pass^k can be asked for, the fewest runs of a task or the trials that were planned."""
    per_task = runs.groupBy(task).agg(F.count("*").alias("__n"), F.max(num_trials).alias("__t"))
    return per_task.agg(F.least(F.min("__n"), F.max("__t")).alias("max_k"))


def task_pass_table(runs: DataFrame, task: str, success: str, num_actions: str, most_k: int) -> DataFrame:
    """(task, num_actions, pass_1..pass_k) of each task, from few actions to many, ties by task."""
    from corpusmill.functions.scoring import comb

    per = runs.groupBy(task).agg(F.count("*").alias("__n"), F.count_if(success).alias("__c"), F.first(num_actions).alias("num_actions"))
    return per.select(task, "num_actions", *[(comb(F.col("__c"), F.lit(k)) / comb(F.col("__n"), F.lit(k))).alias(f"pass_{k}") for k in range(1, most_k + 1)]).orderBy("num_actions", task)


def domain_submission(runs: DataFrame, domain: str, task: str, success: str, cost: str, most_k: int = 4) -> DataFrame:
    """(domain, pass_1..pass_4 in percent, cost): what a submission says of each domain, cost as the mean of known ones."""
    from corpusmill.functions.scoring import comb

    per = runs.groupBy(domain, task).agg(F.count("*").alias("__n"), F.count_if(success).alias("__c"))
    ks = [F.when(F.min("__n") >= k, F.avg(F.when(F.col("__n") >= k, comb(F.col("__c"), F.lit(k)) / comb(F.col("__n"), F.lit(k)))) * 100).alias(f"pass_{k}") for k in range(1, most_k + 1)]
    return per.groupBy(domain).agg(*ks).join(runs.groupBy(domain).agg(F.avg(cost).alias("cost")), domain)


def duplicate_domains(files: DataFrame, file: str, domain: str) -> DataFrame:
    """Domains that more than one file of a submission holds: an error."""
    return files.groupBy(domain).agg(F.countDistinct(file).alias("n_files")).where("n_files > 1")


def submission_json(domains: DataFrame, domain: str, model: str) -> DataFrame:
    """One row: the submission's JSON, domains by name. A submission has a handful of them."""
    parts = domains.select(domain, F.to_json(F.struct(*[c for c in domains.columns if c != domain])).alias("__j"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(domain, "__j"))), lambda x: F.concat(F.lit('"'), x[domain], F.lit('":'), x["__j"])), ",")
    return parts.agg(F.concat(F.lit(f'{{"model_name":"{model}","results":{{'), body, F.lit("}}")).alias("submission"))


def persona_modes(runs: DataFrame, llm: str, persona: str, mode: str, modes: tuple[str, str], task: str, success: str) -> DataFrame:
    """(llm, persona, one column for each mode): pass^1 as the mean over tasks, 0 where a mode has none."""
    tasks = runs.where(F.col(mode).isin(*modes)).groupBy(llm, persona, mode, task).agg(F.avg(F.col(success).cast("double")).alias("__p"))
    return tasks.groupBy(llm, persona).pivot(mode, list(modes)).agg(F.avg("__p")).fillna(0.0, list(modes))


def issue_curves(runs: DataFrame, llm: str, mode: str, issues: str, task: str, success: str, most_k: int, share_mode: str) -> DataFrame:
    """(llm, mode, issues, k, pass_hat_k, share): pass^k by the number of a task's issues, for every number that occurs, 0
    where a model has no task of it; share is the percentage of such tasks in `share_mode`."""
    found = pass_hat_k(runs.withColumnRenamed(task, "task_id").withColumnRenamed(success, "success"), most_k, by=(llm, mode, issues))
    numbers = runs.select(issues).distinct().join(found.select(llm, mode).distinct(), how="cross").join(runs.sparkSession.range(1, most_k + 1).selectExpr("cast(id as int) as k"), how="cross")
    per = runs.where(F.col(mode) == share_mode).select(task, issues).distinct()
    shares = per.groupBy(issues).agg(F.count("*").alias("__n"))
    total = per.agg(F.count("*").alias("__t"))
    shares = shares.join(total, how="cross").select(issues, (F.col("__n") * 100.0 / F.col("__t")).alias("share"))
    return numbers.join(found.select(llm, mode, issues, "k", "pass_hat_k"), [llm, mode, issues, "k"], "left").join(shares, issues, "left").fillna(0.0, ["pass_hat_k", "share"])


def across_columns(df: DataFrame, keep: list[str], cols: list[str]) -> DataFrame:
    """Mean and population deviation over the columns of each row."""
    values = F.filter(F.array(*cols), lambda x: x.isNotNull())
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)
    spread = F.sqrt(F.aggregate(F.transform(values, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x) / F.size(values))
    return df.select(*keep, mean.alias("mean"), spread.alias("std_pop"))


def model_success(rows: DataFrame, by: str, passed: str, signature: str, api_used: str, api: str, failure: str) -> DataFrame:
    """(by, counts and rates) of code answers: successes, kept signatures, used APIs, failures by kind, the borrow checker's share
    of failures, and how many distinct APIs were asked for and solved."""
    kinds = ("borrow", "compile", "timeout", "test")
    one = rows.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(passed).alias("success"), F.count_if(signature).alias("signature_ok"), F.count_if(api_used).alias("api_used"), *[F.count_if(F.col(failure) == k).alias(f"failed_{k}") for k in kinds],
        F.countDistinct(api).alias("apis"), F.countDistinct(F.when(F.col(passed), F.col(api))).alias("apis_solved"),
    )
    out = one.withColumn("failed", F.col("total") - F.col("success"))
    rates = {"success_rate": ("success", "total"), "signature_rate": ("signature_ok", "total"), "api_rate": ("api_used", "total"), "borrow_share": ("failed_borrow", "failed"), "api_coverage": ("apis_solved", "apis")}
    return out.withColumns({n: rate(F.col(a), F.col(b)) for n, (a, b) in rates.items()})


def chunk_results(results: DataFrame, group: str, status: str, retries: str, summary: str, categories: tuple[str, ...] = ("primary", "secondary", "error_handling", "edge_cases")) -> DataFrame:
    """(group, confidence, n_chunks, n_failed, a set for each category): what the chunks of a diff say together. `summary` is a
    map of category to behaviours, of successes only. A chunk that is UNKNOWN halves the confidence, one that is INVALID or
    in ERROR takes it to seven tenths; then the share of successes and 0.95 for each of their retries."""
    good = F.col(status) == "SUCCESS"
    one = results.groupBy(group).agg(
        F.count("*").alias("n_chunks"), F.count_if(~good).alias("n_failed"), F.count_if(F.col(status) == "UNKNOWN").alias("__u"), F.count_if(F.col(status).isin("INVALID", "ERROR")).alias("__e"), F.coalesce(F.sum(F.when(good, F.col(retries))), F.lit(0)).alias("__r"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(good, F.try_element_at(F.col(summary), F.lit(c))))))).alias(c) for c in categories],
    )
    confidence = F.pow(F.lit(0.5), F.col("__u")) * F.pow(F.lit(0.7), F.col("__e")) * (F.col("n_chunks") - F.col("n_failed")) / F.col("n_chunks") * F.pow(F.lit(0.95), F.col("__r"))
    return one.select(group, confidence.alias("confidence"), "n_chunks", "n_failed", *categories)


def datapoint_results(points: DataFrame, got: str, want: str, error: str) -> DataFrame:
    """Adds is_error and is_correct: a call's JSON result deeply equal to what was expected; an error is neither."""
    failed = F.col(error).isNotNull()
    return points.withColumn("is_error", failed).withColumn("is_correct", ~failed & F.coalesce(canonical(F.col(got)) == canonical(F.col(want)), F.lit(False)))


def primitive_usage(points: DataFrame, kind: str, given: Mapping[str, Column], reply: Column) -> DataFrame:
    """(kind, n, tokens_in, tokens_out): tokens of prompts, the JSON of all fields but the reply, and of replies, a token for
    every four characters, by the kind of call."""
    prompt = F.to_json(F.struct(*[c.alias(k) for k, c in given.items()]))
    per = points.select(kind, F.floor(F.length(prompt) / 4).alias("i"), F.floor(F.length(F.coalesce(reply, F.lit(""))) / 4).alias("o"))
    return per.groupBy(kind).agg(F.count("*").alias("n"), F.sum("i").alias("tokens_in"), F.sum("o").alias("tokens_out"))


def call_prices(points: DataFrame, models: DataFrame, model: str, tokens_in: str, tokens_out: str) -> DataFrame:
    """Adds cost and latency: linear in tokens, by the model's row (model, price_in, price_out, latency_base, latency_token); null
    for a model without one."""
    joined = points.join(models, model, "left")
    cost = F.col(tokens_in) * F.col("price_in") + F.col(tokens_out) * F.col("price_out")
    return joined.withColumn("cost", cost).withColumn("latency", F.col("latency_base") + F.col("latency_token") * F.col(tokens_out)).drop("price_in", "price_out", "latency_base", "latency_token")


def tool_errors(turns: DataFrame, conv: str, role: str, error: str) -> DataFrame:
    """(conv, n_errors): tool turns that report an error."""
    return turns.groupBy(conv).agg(F.count_if((F.col(role) == "tool") & F.col(error)).alias("n_errors"))


def spending(runs: DataFrame, llm: str, mode: str, cost: str, only: str = "default") -> DataFrame:
    """Mean and sum of known costs by model, in one mode."""
    return runs.where(F.col(mode) == only).groupBy(llm).agg(F.avg(cost).alias("mean_cost"), F.sum(cost).alias("total_cost"))


# Filters of runs and tasks.


def failed_runs(runs: DataFrame, reward: str, order: str, n: int) -> DataFrame:
    """The first `n` runs by `order` whose reward is nothing: 0.001 at the most."""
    return runs.where(F.col(reward) <= 1e-3).orderBy(order).limit(n)


def at_fault(runs: DataFrame, verdicts: DataFrame, key: str, who: str = "AGENT", author: str = "author") -> DataFrame:
    """Runs whose fault was put down to `who`."""
    return runs.join(verdicts.where(F.col(author) == who).select(key).distinct(), key, "left_semi")


def frequent(df: DataFrame, col: str, least: float = 0.03) -> DataFrame:
    """(value, share) of values with more than `least` of all rows, most frequent first, ties by value."""
    total = df.agg(F.count("*").alias("__t"))
    counts = df.groupBy(col).agg(F.count("*").alias("__n")).join(total, how="cross")
    return counts.select(col, (F.col("__n") / F.col("__t")).alias("share")).where(F.col("share") > least).orderBy(F.desc("share"), col)


def shown_submissions(submissions: DataFrame, custom: str, scores: list[str], standard: bool, customs: bool) -> DataFrame:
    """Submissions of the kinds that are switched on, if any of their scores is known."""
    kinds = (F.lit(standard) & ~F.col(custom)) | (F.lit(customs) & F.col(custom))
    return submissions.where(kinds & F.coalesce(*[F.col(s) for s in scores]).isNotNull())


def solo_tasks(tasks: DataFrame, ticket: str, actions: str, assertions: str) -> DataFrame:
    """Tasks that an agent can do without a user: with a ticket, and with gold actions or assertions to check it by; and no
    action asked of the user."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    return tasks.where((F.coalesce(F.col(ticket), F.lit("")) != "") & (some(actions) | some(assertions)) & F.coalesce(F.forall(actions, lambda a: a["requestor"] == "assistant"), F.lit(True)))


def gold_tasks(tasks: DataFrame, actions: str) -> DataFrame:
    """Tasks with gold actions to follow."""
    return tasks.where(F.coalesce(F.size(actions) > 0, F.lit(False)))


def find_run(runs: DataFrame, task: str, trial: str, task_id: object, number: int, order: str) -> DataFrame:
    """The first run of a task and trial."""
    return runs.where((F.col(task) == task_id) & (F.col(trial) == number)).orderBy(order).limit(1)


def found_or_error(keys: DataFrame, records: DataFrame, key: str, what: str) -> DataFrame:
    """Each key with its record, or with `error` where there is none."""
    hit = records.withColumn("__hit", F.lit(True))
    out = keys.join(hit, key, "left")
    return out.withColumn("error", F.when(F.col("__hit").isNull(), F.concat(F.lit(f"{what} "), F.col(key).cast("string"), F.lit(" not found")))).drop("__hit")


def positional_zip(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Rows that stand at one position in both, by `order`; what one side has more of is left out. Columns but the order get
    their side's prefix."""
    from corpusmill.operators.split import global_rank

    a, b = (global_rank(df, order, name="position").select("position", *[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for df, side in ((left, "a"), (right, "b")))
    return a.join(b, "position")


def ensemble(frames: list[DataFrame], key: str, value: str) -> DataFrame:
    """(key, winner, votes, unanimous) over the answers of several sources, ties to the source named first."""
    from corpusmill.operators.analysis import majority

    out = None
    for i, df in enumerate(frames):
        one = df.select(key, value, F.lit(i).alias("__source"))
        out = one if out is None else out.unionByName(one)
    return majority(out, key, value, "__source")


def seeds(spark, n_trials: int, seed: int = 300) -> DataFrame:
    """(trial, seed): one number for each trial, of its own and the run's seed, the same on any machine."""
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 7), 16, 10).cast("long") % 1_000_000
    return spark.range(n_trials).select(F.col("id").cast("int").alias("trial"), number.alias("seed"))


def by_component_count(df: DataFrame, count: str, key: str, choices: list[str], name: str = "persona") -> DataFrame:
    """Choices in turn, over rows in order of a count, ties by key."""
    from corpusmill.operators.split import global_rank

    ranked = global_rank(df, count, key, name="__i")
    return ranked.withColumn(name, F.element_at(F.array(*[F.lit(c) for c in choices]), ((F.col("__i") - 1) % len(choices)).cast("int") + 1)).drop("__i")


def reattached(samples: DataFrame, results: DataFrame, key: str, order: str) -> DataFrame:
    """Samples with the results of their task, both in their order: the n-th result goes to the n-th sample."""
    w = Window.partitionBy(key).orderBy(order)
    a, b = (df.withColumn("__n", F.row_number().over(w)) for df in (samples, results))
    return a.join(b.drop(order), [key, "__n"], "left").drop("__n")
