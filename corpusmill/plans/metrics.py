"""Queries of evaluation analytics, retrieval, packing and diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import arrays as R
from corpusmill.functions import diff as D
from corpusmill.functions import scoring as S
from corpusmill.functions.text import word_list
from corpusmill.operators import analysis as A, ngram_model
from corpusmill.operators import packing, passk, similarity
from corpusmill.plans.tables import table


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trials: a user's events are the trials of a task, a purchase is a success."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("task_id"), (F.col("event_type") == "purchase").alias("success"), F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("reward"), F.when(F.col("event_id") % 4 != 0, F.round("value", 2)).alias("cost"), F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("llm"), F.when(F.col("event_id") % 2 == 0, "default").otherwise("solo").alias("mode"), (F.col("event_id") % 5).alias("trial"), "event_type", "value")


def pass_hat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passk.pass_hat_k(_trials(spark, sf_dir), 4).select("k", F.round("pass_hat_k", 6).alias("pass_hat_k"), "n_tasks")


def pass_hat_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passk.pass_hat_k(_trials(spark, sf_dir), 2, by=("llm", "mode")).select("llm", "mode", "k", F.round("pass_hat_k", 6).alias("pass_hat_k"), "n_tasks")


def pass_hat_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trials(spark, sf_dir).groupBy("task_id", "trial").agg(F.bool_or("success").alias("success"))
    return passk.pass_hat_k_shared(t, 3).select("k", F.round("pass_hat_k", 6).alias("pass_hat_k"))


def pass_at_unbiased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passk.pass_at_k_unbiased(_trials(spark, sf_dir), 4).select("k", F.round("pass_at_k", 6).alias("pass_at_k"))


def hit_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    f = lambda c: F.concat(F.lit("f"), (c % 4).cast("string"))
    k = F.col("o_orderkey")
    rows = o.select(F.array(F.array(f(k)), F.array(f(k + 1), f(k * 3)), F.array(f(k * 7 + 2))).alias("preds"), F.when(k % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("f"), (k % 11).cast("string")))).alias("actual"))
    return passk.hit_at_k(rows, "preds", "actual", (1, 2, 3)).select("k", F.round("hit_rate", 6).alias("hit_rate"))


def best_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passk.best_k_mean(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 3)


def agent_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passk.agent_metrics(_trials(spark, sf_dir), 3)
    return out.select(*[F.round(c, 6).alias(c) if c != "n_trials" else c for c in out.columns])


def model_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.group_stats(_trials(spark, sf_dir), ["llm", "mode"], "value")
    return out.select("llm", "mode", *[F.round(c, 6).alias(c) for c in ("mean", "std", "std_pop")], "n")


def type_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.value_shares(table(spark, sf_dir, "events"), "event_type").withColumn("percent", F.round("percent", 6))


def type_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.success_rollup(_trials(spark, sf_dir), "llm", "success", {"n_tasks": F.countDistinct("task_id")})
    return out.withColumn("success_rate", F.round("success_rate", 6))


def bucket_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trials(spark, sf_dir).withColumn("bucket", (F.col("task_id") % 6).cast("int"))
    return A.bucketed_mean(t, "bucket", "reward", list(range(9))).withColumn("mean", F.round("mean", 6))


def action_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.success_pivot(_trials(spark, sf_dir), "trial", "llm", ["m0", "m1", "m2"], "success")
    return out.select("trial", *[F.round(c, 6).alias(c) for c in ("m0", "m1", "m2", "percent")])


def mode_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.mode_delta(_trials(spark, sf_dir), "llm", "mode", "default", "solo", "value")
    return out.select("llm", *[F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "delta")])


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _trials(spark, sf_dir).withColumn("paid", F.col("cost") > 50)
    out = A.failure_shares(t, "llm", ["success", "paid"])
    return out.select("llm", F.round("success_failed", 6).alias("success_failed"), F.round("paid_failed", 6).alias("paid_failed"))


def turn_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("cost", F.when(F.col("conv_id") % 3 != 0, (F.col("turn") + 1) * 0.5)).withColumn("tokens", F.when(F.col("turn") != 2, F.length("text")))
    return A.complete_cost(c, "conv_id", "cost", "tokens").select("conv_id", "cost", F.col("tokens").cast("long").alias("tokens"), "n_turns")


def majorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.majority(_trials(spark, sf_dir), "task_id", "event_type", "event_id")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.when(F.min("l_partkey") % 3 == 0, "PASS").otherwise("FAIL").alias("verdict"))
    return A.attempt_outcome(li, "l_orderkey", "l_linenumber", "verdict")


def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("verdict", F.when(F.col("l_returnflag") == "R", "PASS").otherwise("FAIL"))
    return A.overall_verdict(li, "l_orderkey", "verdict").groupBy("overall").agg(F.count("*").alias("n"))


def merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 7).alias("k"), F.col("p_partkey").alias("s"), (F.col("p_partkey") + F.col("p_size") % 6).alias("e"))
    return A.merge_intervals(p, "k", "s", "e", 2)


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").withColumn("x", F.col("s_acctbal") / 10000)
    n = s.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    one = n.groupBy("n_name", (F.col("s_suppkey") % 3).cast("string").alias("d")).agg(F.avg("x").alias("p1"), F.min("x").alias("p4"))
    out = A.leaderboard(one, "n_name", "d", {1: "p1", 4: "p4"}, ["0", "1", "2"])
    return out.select("n_name", *[F.round(c, 6).alias(c) for c in ("overall_1", "overall_4", "consistency")], "rank")


def trial_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return A.verify_counts(c, table(spark, sf_dir, "orders"), "o_custkey", 10)


def uniformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as files: their kinds of events are not uniform, the shape of the properties is."""
    e = table(spark, sf_dir, "events")
    kinds, shapes = A.uniform_config(e, "user_id", F.col("event_type")), A.uniform_config(e, "user_id", F.regexp_replace("props", "[0-9]+", "0"))
    return kinds.select(F.lit("kinds").alias("what"), "*").unionByName(shapes.select(F.lit("shapes").alias("what"), "*"))


def metric_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("v"))
    b = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.count("*").alias("v"))
    return A.metric_mismatches(a, b, ["o_custkey"], "v")


def attempt_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("n")).agg(F.bool_or(F.col("l_linestatus") == "F").alias("ok"))
    return A.contiguous_attempts(li.where("(l_orderkey + n) % 5 <> 0"), "l_orderkey", "n", "ok")


def capable_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") / 50).alias("need"))
    models = table(spark, sf_dir, "nation").select(F.col("n_name").alias("model"), (F.col("n_nationkey") / 24).alias("has"))
    return A.cheapest_capable(jobs, models, "need", "has", "model", "p_partkey")


def _nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a model of those whose id is not divisible by ten."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return ngram_model.fitted_nll(docs, ["doc_id", "lang"], "text", F.col("doc_id") % 10 != 0)


def text_nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nll(spark, sf_dir).select("doc_id", "n_words", F.round("nll", 4).alias("nll"))


def text_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each language, for the documents that the model was fitted to and for those held out."""
    by = _nll(spark, sf_dir).groupBy("lang", (F.col("doc_id") % 10 == 0).alias("held_out")).agg(F.sum("n_words").alias("n"), F.sum("nll").alias("nll"))
    return by.select("lang", "held_out", "n", F.round(ngram_model.perplexity(F.col("n"), F.col("nll")), 4).alias("perplexity"))


def _e5(sim: Column | str) -> Column:
    """Hundred thousandths, cut: the same in any engine where nine digits are."""
    return F.floor((F.col(sim) if isinstance(sim, str) else sim) * 100000).alias("sim_e5")


def retrieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return similarity.retrieve(q, table(spark, sf_dir, "documents").select("doc_id", "text"), "item_id", "doc_id", "text", 3).select("item_id", "doc_id", _e5("sim"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.drop_exact(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.cosine_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("a", "b", _e5(F.round("sim", 9)))


def near_dup_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a pass in order keeps: one goes if a kept earlier one resembles it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity.greedy_keep(similarity.cosine_pairs(docs, "doc_id", "text"), docs, "doc_id")


def greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in order; one goes if a kept one a step or three before it has a size divisible by three."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), "p_size")
    steps = p.where("p_size % 3 = 0").select(F.col("i").alias("a"), F.explode(F.array(F.col("i") + 1, F.col("i") + 3)).alias("b"))
    pairs = steps.join(p.select(F.col("i").alias("b")), "b").select("a", "b")
    return similarity.greedy_keep(pairs, p, "i")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return similarity.hard_negatives(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", "label", 3, skip=1, least=-0.5, most=0.95, margin=0.02).select("anchor", "negative", _e5("sim"))


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    t = e.select(F.col("vec_id"), F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("p")), "vec_id").join(e.select((F.col("vec_id") - 2).alias("vec_id"), F.col("embedding").alias("n")), "vec_id")
    return similarity.triplet_accuracy(t, "a", "p", "n").select(F.round("accuracy", 6).alias("accuracy"), "n")


def _ids(text: Column) -> Column:
    """A number for each word, by its length."""
    return F.transform(word_list(text), lambda w: F.length(w).cast("long") * 997 % 30000)


def packed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", _ids(F.col("text")).alias("ids"))
    out = packing.pack_blocks(rows, "doc_id", "ids", 512)
    return out.select("block_no", F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"), F.element_at("input_ids", 1).alias("first_id"), F.element_at("input_ids", 512).alias("last_id"))


def masked_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", _ids(F.col("text")).alias("ids"))
    rows = rows.withColumn("ids", R.cut_with_eos(F.col("ids"), 1, 32)).withColumn("labels", R.masked_labels(F.col("ids"), F.lit(5)))
    out = packing.collate(rows, "conv_id", "ids", "labels", 0)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("conv_id", "turn", F.size("ids").alias("n"), total(F.col("ids")).alias("ids_sum"), total(F.col("labels")).alias("labels_sum"), total(F.col("attention_mask")).alias("mask_sum"))


def _diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-file diff for each part."""
    k = F.col("p_partkey")
    s = k.cast("string")
    head = F.concat(F.lit("diff --git a/src/f"), s, F.lit(".rs b/src/f"), s, F.lit(".rs\n--- a/x\n+++ b/x\n@@ -"), s, F.lit(",3 +"), (k + 1).cast("string"), F.lit(",4 @@\n ctx\n-old "), F.col("p_name"), F.lit("\n+new "), F.col("p_name"), F.lit("\n+more\n ctx2\n"))
    more = F.when(k % 2 == 0, F.lit("diff --git a/n.rs b/n.rs\nnew file mode 100644\n--- /dev/null\n+++ b/n.rs\n@@ -0,0 +1 @@\n+only\n")).otherwise(F.lit("diff --git a/d.rs b/d.rs\ndeleted file mode 100644\n--- a/d.rs\n+++ /dev/null\n@@ -1 +0,0 @@\n-gone\n"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(head, more).alias("diff"), F.concat(F.lit(""), head).alias("half"))


def diff_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, h = F.col("diff"), F.col("half")
    return _diffs(spark, sf_dir).select("p_partkey", F.size(D.changed_files(d)).alias("n_files"), D.tier(d, h, 150, 180).alias("tier"), D.tier_factor(D.tier(d, h, 150, 180)).alias("factor"), F.array_join(D.changed_lines(d, "+"), "|").alias("added"), F.array_join(D.changed_lines(d, "-"), "|").alias("removed"), F.coalesce(F.try_element_at(D.op_types(d), F.lit("n.rs")), F.try_element_at(D.op_types(d), F.lit("d.rs"))).alias("second_op"), D.same_changes(d, h).alias("same_as_half"), D.same_changes(d, d).alias("same_as_self"))


def diff_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.diff_lines(_diffs(spark, sf_dir), "p_partkey", "diff").select("p_partkey", "path", "kind", "text", "old_line", "new_line")


def combinations_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), (F.col("n_nationkey") % 5).alias("k"))
    return n.select("n", "k", S.comb(F.col("n"), F.col("k")).alias("comb"))


def _changed(n: int) -> Column:
    """The whole text with every n-th word doubled."""
    return F.array_join(F.transform(F.split("text", " "), lambda w, i: F.when(i % n == 0, F.concat(w, F.lit(" "), w)).otherwise(w)), " ")


def order_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return b.select("item_id", F.round(similarity.ratio(F.col("text"), F.reverse("text")), 6).alias("ratio"), F.round(similarity.rouge_l(F.col("text"), _changed(3)), 6).alias("rouge_l"), F.round(similarity.sari(F.col("text"), _changed(3), _changed(4)), 6).alias("sari"))


def fuzzy_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return similarity.fuzzy_pairs(b.unionByName(b.select((F.col("item_id") + 1000).alias("item_id"), F.concat(F.lit("Oh "), "text").alias("text"))), "item_id", "text")


QUERIES = {
    f.__name__: f
    for f in (
        pass_hat, pass_hat_by_model, pass_hat_shared, pass_at_unbiased, hit_rates, best_scores, agent_summary, model_stats, type_shares, type_rollup, bucket_means, action_pivot, mode_deltas, failures, turn_costs, majorities, attempts, overall, merged_intervals, ranking,
        trial_counts, uniformity, metric_check, attempt_state, capable_models, text_nll, text_perplexity, retrieved, exact_dedup, near_dup_pairs, near_dup_keep, greedy_dedup, hard_negatives, triplets, packed_blocks, masked_batches, diff_facts, diff_line_numbers, combinations_table, order_ratio, fuzzy_dups,
    )
}
_T = "t as (select event_id, user_id as task, event_type = 'purchase' as ok, case when event_type = 'purchase' then 1 else 0 end::double as reward, case when event_id % 4 <> 0 then round(value, 2) end as cost, 'm' || event_id % 3 as llm, case when event_id % 2 = 0 then 'default' else 'solo' end as mode, event_id % 5 as trial, event_type, value from events)"
_HAT = "list_product(list_transform(range(0, k), lambda i: (c - i)::double / (n - i)))"
_TFIDF = """
dt as (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}_]{2,}')) as term from documents), tf as (select doc_id, term, count(*) as tf from dt group by all),
df as (select term, count(*) as df from tf group by 1), n as (select count(*) as n from documents),
rw as (select doc_id, term, tf * (ln((1 + n.n) / (1 + df)) + 1) as w from tf join df using (term), n), ln_ as (select doc_id, sqrt(sum(w * w)) as l from rw group by 1), w as (select doc_id, term, w / l as w from rw join ln_ using (doc_id))"""
_LEVEL = "{name} as (select *, sum(n) over (partition by c) as total, count(*) over (partition by c) as kinds from ({source}))"
_NGRAMS = f"""
with w as (select doc_id, lang, ['<s>', '<s>'] || regexp_extract_all(text, '[^\\s]+') || ['</s>'] as t from documents),
g as (select doc_id, lang, t[i] as a, t[i + 1] as b, t[i + 2] as x from (select *, unnest(range(1, len(t) - 1)) as i from w)),
{_LEVEL.format(name="k3", source="select a || ' ' || b as c, a, b, x, count(*) as n from g where doc_id % 10 <> 0 group by all")},
{_LEVEL.format(name="k2", source="select b as c, b, x, count(*) as n from k3 group by all")},
{_LEVEL.format(name="k1", source="select '' as c, x, count(*) as n from k2 group by all")},
v as (select count(distinct x) + 1 as v, any_value(0.75 * kinds / total) as rest from k1),
r3 as (select c, any_value(0.75 * kinds / total) as rest from k3 group by 1), r2 as (select c, any_value(0.75 * kinds / total) as rest from k2 group by 1),
s as (select g.doc_id, g.lang, coalesce((k3.n - 0.75) / k3.total, 0) + coalesce(r3.rest, 1) * (coalesce((k2.n - 0.75) / k2.total, 0) + coalesce(r2.rest, 1) * (coalesce((k1.n - 0.75) / k1.total, 0) + v.rest / v.v)) as p
from g cross join v left join k3 on k3.a = g.a and k3.b = g.b and k3.x = g.x left join r3 on r3.c = g.a || ' ' || g.b
left join k2 on k2.b = g.b and k2.x = g.x left join r2 on r2.c = g.b left join k1 on k1.x = g.x)
"""
ORACLES = {
    "pass_hat": f"with {_T}, g as (select task, count(*) as n, count(*) filter (ok) as c from t group by 1), x as (select *, unnest(range(1, 5))::int as k from g) select k, round(avg(case when c < k then 0 else {_HAT} end), 6) as pass_hat_k, count(*) as n_tasks from x where n >= k group by k",
    "pass_hat_by_model": f"with {_T}, g as (select llm, mode, task, count(*) as n, count(*) filter (ok) as c from t group by all), x as (select *, unnest(range(1, 3))::int as k from g) select llm, mode, k, round(avg(case when c < k then 0 else {_HAT} end), 6) as pass_hat_k, count(*) as n_tasks from x where n >= k group by all",
    "pass_hat_shared": f"with {_T}, s as (select task, trial, bool_or(ok) as ok from t group by all), g as (select task, count(*) filter (ok) as c from s group by 1), x as (select *, (select count(distinct trial) from s) as n, unnest(range(1, 4))::int as k from g) select k, round(avg(case when c < k then 0 else {_HAT} end), 6) as pass_hat_k from x where n >= k group by k",
    "pass_at_unbiased": f"with {_T}, g as (select task, count(*) as n, count(*) filter (ok) as c from t group by 1), x as (select *, unnest(range(1, 5))::int as k from g) select k, round(avg(case when n - c < k then 1 else 1 - list_product(list_transform(range(0, k), lambda i: (n - c - i)::double / (n - i))) end), 6) as pass_at_k from x where k <= (select min(n) from g) group by k",
    "hit_rates": """
with o as (select o_orderkey as k from orders), x as (select k % 9 = 0 as e, k % 11 as a, k % 4 as p1, (k + 1) % 4 as p2, k * 3 % 4 as p3, (k * 7 + 2) % 4 as p4 from o)
select 1 as k, round(avg((e or a = p1)::int), 6) as hit_rate from x union all select 2, round(avg((e or a in (p1, p2, p3))::int), 6) from x union all select 3, round(avg((e or a in (p1, p2, p3, p4))::int), 6) from x""",
    "best_scores": "with r as (select o_custkey, o_totalprice as s, row_number() over (partition by o_custkey order by o_totalprice desc) as i from orders) select o_custkey, round(avg(s), 3) as pass_at_k from r where i <= 3 group by 1",
    "agent_summary": f"with {_T}, g as (select task, count(*) as n, count(*) filter (ok) as c from t group by 1), x as (select *, unnest(range(1, 4))::int as k from g), h as (select k, avg(case when c < k then 0 else {_HAT} end) as p from x where n >= k group by k) select round(avg(reward), 6) as avg_reward, round(avg(cost), 6) as avg_cost, count(*) as n_trials, round((select p from h where k = 1), 6) as pass_hat_1, round((select p from h where k = 2), 6) as pass_hat_2, round((select p from h where k = 3), 6) as pass_hat_3 from t",
    "model_stats": f"with {_T} select llm, mode, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, round(stddev_pop(value), 6) as std_pop, count(value) as n from t group by all",
    "type_shares": "select event_type, count(*) as n, round(count(*) * 100 / sum(count(*)) over (), 6) as percent from events group by 1",
    "type_rollup": f"with {_T} select coalesce(llm, 'all') as scope, count(*) as total, count(*) filter (ok) as n_success, count(distinct task) as n_tasks, round(count(*) filter (ok) / count(*), 6) as success_rate from t group by rollup (llm)",
    "bucket_means": f"with {_T} select b::int as bucket, round(coalesce(avg(reward), 0), 6) as mean from range(0, 9) q(b) left join t on task % 6 = b group by b",
    "action_pivot": f"with {_T} select trial, round(avg(ok::int) filter (llm = 'm0'), 6) as m0, round(avg(ok::int) filter (llm = 'm1'), 6) as m1, round(avg(ok::int) filter (llm = 'm2'), 6) as m2, round(count(*) * 100 / sum(count(*)) over (), 6) as percent from t group by trial",
    "mode_deltas": f"with {_T} select llm, round(avg(value) filter (mode = 'default'), 6) as mean_a, round(avg(value) filter (mode = 'solo'), 6) as mean_b, round(avg(value) filter (mode = 'default') - avg(value) filter (mode = 'solo'), 6) as delta from t group by 1",
    "failures": f"with {_T} select llm, round(avg((not ok)::int), 6) as success_failed, round(avg((not cost > 50)::int), 6) as paid_failed from t group by 1",
    "turn_costs": "select conv_id, case when conv_id % 3 <> 0 then sum((turn + 1) * 0.5::double) end as cost, sum(case when turn <> 2 then length(text) end)::bigint as tokens, count(*) as n_turns from conversations where role <> 'tool' group by 1",
    "majorities": "with c as (select user_id as task_id, event_type, count(*) as n, min(event_id) as f from events group by all) select task_id, arg_max(event_type, n * 1000000000 - f) as winner, max(n) as votes, count(*) = 1 as unanimous from c group by 1",
    "attempts": """
with a as (select l_orderkey, l_linenumber as n, min(l_partkey) % 3 = 0 as p from lineitem group by all having n <= 3), s as (select l_orderkey, min(n) filter (p) as s from a group by 1)
select l_orderkey, max(n) as attempts, arg_max(case when p then 'PASS' else 'FAIL' end, n) as final_verdict from a join s using (l_orderkey) where s is null or n <= s group by 1""",
    "overall": "with v as (select l_orderkey, case when bool_or(l_returnflag = 'R') then 'PASS' else 'FAIL' end as overall from lineitem group by 1) select overall, count(*) as n from v group by 1",
    "merged_intervals": """
with p as (select p_partkey % 7 as k, p_partkey as s, p_partkey + p_size % 6 as e from part), m as (select *, max(e) over (partition by k order by s, e rows between unbounded preceding and 1 preceding) as far from p),
g as (select *, sum(case when s <= far + 2 then 0 else 1 end) over (partition by k order by s, e rows unbounded preceding) as g from m) select k, min(s) as s, max(e) as e, count(*) as n_merged from g group by k, g""",
    "ranking": """
with o as (select n_name, s_suppkey % 3 as d, avg(s_acctbal / 10000) as p1, min(s_acctbal / 10000) as p4 from supplier join nation on s_nationkey = n_nationkey group by all),
a as (select n_name, case when count(p1) = 3 then avg(p1) end as o1, case when count(p1) = 3 then avg(p4) end as o4 from o group by 1)
select n_name, round(o1, 6) as overall_1, round(o4, 6) as overall_4, round(case when o1 > 0 then o4 / o1 end, 6) as consistency, row_number() over (order by o1 is null, o1 desc, n_name)::int as rank from a""",
    "trial_counts": "with n as (select o_custkey, count(*) as n from orders group by 1) select c_custkey as o_custkey, coalesce(n, 0) as n_runs from customer left join n on o_custkey = c_custkey where coalesce(n, 0) <> 10",
    "uniformity": "select 'kinds' as what, count(distinct event_type) <= 1 as uniform, count(distinct user_id) as n_files from events union all select 'shapes', count(distinct regexp_replace(props, '[0-9]+', '0', 'g')) <= 1, count(distinct user_id) from events",
    "metric_check": "with a as (select o_custkey, count(*) as v from orders group by 1), b as (select o_custkey, count(*) as v from orders where o_orderstatus <> 'P' group by 1) select o_custkey, a.v as submitted, b.v as computed from a full join b using (o_custkey) where a.v is distinct from b.v",
    "attempt_state": """
with a as (select l_orderkey, l_linenumber as n, bool_or(l_linestatus = 'F') as ok from lineitem where (l_orderkey + l_linenumber) % 5 <> 0 group by all), r as (select *, row_number() over (partition by l_orderkey order by n) as i from a)
select l_orderkey, max(n) as last_attempt, max(n) filter (ok) as last_complete from r where i = n group by 1""",
    "capable_models": "select p_partkey, arg_min(n_name, n_nationkey) as model from part join nation on n_nationkey / 24 >= p_size / 50 group by 1",
    "text_nll": _NGRAMS + "select doc_id, count(*) as n_words, round(sum(-ln(p)), 4) as nll from s group by 1",
    "text_perplexity": _NGRAMS + "select lang, doc_id % 10 = 0 as held_out, count(*) as n, round(exp(sum(-ln(p)) / count(*)), 4) as perplexity from s group by all",
    "retrieved": f"""with {_TFIDF},
qt as (select item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}')) as term from benchmark), qf as (select item_id, term, count(*) as tf from qt group by all), qr as (select item_id, term, tf * (ln((1 + n.n) / (1 + df)) + 1) as w from qf join df using (term), n),
ql as (select item_id, sqrt(sum(w * w)) as l from qr group by 1), q as (select item_id, term, w / l as qw from qr join ql using (item_id)), s as (select item_id, doc_id, round(sum(qw * w), 9) as sim from q join w using (term) group by all)
select item_id, doc_id, floor(sim * 100000)::bigint as sim_e5 from s qualify row_number() over (partition by item_id order by sim desc, doc_id) <= 3""",
    "exact_dedup": "select min(doc_id) as doc_id from documents group by text",
    "near_dup_pairs": "with " + _TFIDF + """
select a.doc_id as a, b.doc_id as b, floor(round(sum(a.w * b.w), 9) * 100000)::bigint as sim_e5 from w a join w b on a.term = b.term and a.doc_id < b.doc_id group by all having sum(a.w * b.w) >= 0.92""",
    "greedy_dedup": """
with recursive p as (select p_partkey as k, p_size % 3 = 0 as hits, row_number() over (order by p_partkey) as r from part),
f as (select 0::bigint as r, null::bigint as k, []::bigint[] as live, false as kept union all
  select r + 1, key, case when ok and hit then list_append(near, key) else near end, ok
  from (select f.r, p.k as key, p.hits as hit, list_filter(live, lambda x: x >= p.k - 2) as near, not (list_contains(live, p.k - 1) or list_contains(live, p.k - 3)) as ok from f join p on p.r = f.r + 1))
select k as i from f where kept""",
    "packed_blocks": r"""
with w as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as i from (select doc_id, regexp_extract_all(text, '\S+') as w from documents)), r as (select length(x) * 997 % 30000 as id, row_number() over (order by doc_id, i) - 1 as r from w),
b as (select r // 512 as block_no, sum(id)::bigint as id_sum, arg_min(id, r)::bigint as first_id, arg_max(id, r)::bigint as last_id, count(*) as n from r group by 1) select block_no, id_sum, first_id, last_id from b where n = 512""",
    "masked_batches": r"""
with t as (select conv_id, turn, list_append(list_transform(regexp_extract_all(text, '\S+'), lambda x: length(x) * 997 % 30000), 1)[1:32] as ids from conversations),
m as (select conv_id, turn, ids, max(len(ids)) over (partition by conv_id) as n from t)
select conv_id, turn, n::int as n, list_sum(ids)::bigint as ids_sum, (coalesce(list_sum(ids[6:]), 0) - 100 * least(5, len(ids)) - 100 * (n - len(ids)))::bigint as labels_sum, len(ids)::bigint as mask_sum from m""",
    "hard_negatives": """
with m as (select a.vec_id as anchor, b.vec_id as negative, a.label = b.label as own, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) as sim from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0),
o as (select anchor, max(sim) as best from m where own group by 1), s as (select m.* from m left join o using (anchor) where not own and sim between -0.5 and 0.95 and (best is null or sim <= best - 0.02::double))
select anchor, negative, floor(sim * 100000)::bigint as sim_e5 from s qualify row_number() over (partition by anchor order by sim desc, negative) between 2 and 4""",
    "triplets": """
select round(avg((list_cosine_similarity(a.embedding::double[], p.embedding::double[]) > list_cosine_similarity(a.embedding::double[], n.embedding::double[]))::int), 6) as accuracy, count(*) as n
from embeddings a join embeddings p on p.vec_id = a.vec_id + 1 join embeddings n on n.vec_id = a.vec_id + 2""",
    "diff_facts": """
select p_partkey, 2 as n_files, case when l <= 150 then 1 when h <= 180 then 2 else 3 end as tier, case when l <= 150 then 1 when h <= 180 then 0.95 else 0.85 end::double as factor,
'new ' || p_name || '|more' || case when p_partkey % 2 = 0 then '|only' else '' end as added, 'old ' || p_name || case when p_partkey % 2 = 0 then '' else '|gone' end as removed, case when p_partkey % 2 = 0 then 'ADD' else 'DELETE' end as second_op, false as same_as_half, true as same_as_self
from (select *, h + case when p_partkey % 2 = 0 then length('diff --git a/n.rs b/n.rs?new file mode 100644?--- /dev/null?+++ b/n.rs?@@ -0,0 +1 @@?+only?') else length('diff --git a/d.rs b/d.rs?deleted file mode 100644?--- a/d.rs?+++ /dev/null?@@ -1 +0,0 @@?-gone?') end as l
from (select p_partkey, p_name, length('diff --git a/src/f' || p_partkey || '.rs b/src/f' || p_partkey || '.rs?--- a/x?+++ b/x?@@ -' || p_partkey || ',3 +' || (p_partkey + 1) || ',4 @@? ctx?-old ' || p_name || '?+new ' || p_name || '?+more? ctx2?') as h from part))""",
    "diff_line_numbers": """
with p as (select p_partkey as k, p_name as n, 'src/f' || p_partkey || '.rs' as f from part)
select k as p_partkey, f as path, ' ' as kind, 'ctx' as text, k as old_line, k + 1 as new_line from p union all select k, f, '-', 'old ' || n, k + 1, null from p union all select k, f, '+', 'new ' || n, null, k + 2 from p union all select k, f, '+', 'more', null, k + 3 from p
union all select k, f, ' ', 'ctx2', k + 2, k + 4 from p union all select k, 'n.rs', '+', 'only', null, 1 from p where k % 2 = 0 union all select k, 'd.rs', '-', 'gone', 1, null from p where k % 2 = 1""",
    "combinations_table": "select n_nationkey as n, n_nationkey % 5 as k, case when n_nationkey < n_nationkey % 5 then 0 else (factorial(n_nationkey) / factorial(n_nationkey % 5) / factorial(n_nationkey - n_nationkey % 5)) end::double as comb from nation",
}
