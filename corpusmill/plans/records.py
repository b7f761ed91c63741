"""Queries on chat and instruction records, splits and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import records as R
from corpusmill.operators import resume, split
from corpusmill.plans.tables import table


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.exchange_pairs(table(spark, sf_dir, "conversations"))


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.sha2(F.coalesce("system", F.lit("-")), 256).alias("system_sha"), F.sha2("user", 256).alias("user_sha"), F.sha2("assistant", 256).alias("assistant_sha"))


def normalized_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases by turns, some of them empty."""
    p = _pairs(spark, sf_dir)
    raw = p.select("conv_id", "turn", F.col("system"), F.when(F.col("turn") % 2 == 0, "").otherwise(F.col("user")).alias("question"), F.col("user").alias("prompt"), F.when(F.col("conv_id") % 5 != 0, F.col("assistant")).alias("response"))
    out = R.normalize(raw, "Be helpful.", ("conv_id", "turn"))
    return out.select("conv_id", "turn", F.sha2("system", 256).alias("system_sha"), F.sha2("user", 256).alias("user_sha"), F.sha2(F.coalesce("assistant", F.lit("-")), 256).alias("assistant_sha"), "reject_reason")


def styled_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.style(_pairs(spark, sf_dir), "Answer briefly.")
    return R.render(rows, ("conv_id", "turn")).select("conv_id", "turn", F.sha2("input", 256).alias("input_sha"), F.length("target").alias("n_target"))


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = R.to_messages(table(spark, sf_dir, "conversations"))
    one = R.detect_format(m, ("conv_id",))
    return one.join(m, "conv_id").select("conv_id", F.sha2(F.coalesce("user", F.lit("-")), 256).alias("user_sha"), F.sha2(F.coalesce("assistant", F.lit("-")), 256).alias("assistant_sha"), F.size("messages").alias("n_messages"), F.sha2(R.transcript(F.col("messages")), 256).alias("transcript_sha"))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("instruction"), F.when(F.col("item_id") % 2 == 0, F.lit("  ")).otherwise(F.col("text")).alias("input"), F.lit("done").alias("output"))
    pair = R.instruction_pair(rows, ("item_id", "instruction", "input", "output"))
    return pair.select("item_id", F.sha2("user", 256).alias("user_sha"), F.sha2(R.instruction_text(F.col("instruction"), F.col("input"), F.col("output")), 256).alias("cpt_sha"), F.sha2("text", 256).alias("text_sha"))


def flipped_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.turn_index(R.flip_roles(table(spark, sf_dir, "conversations")), "conv_id", "turn")
    return out.groupBy("role").agg(F.count("*").alias("n"), F.sum("turn_idx").cast("long").alias("idx_sum"))


def output_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("output1"), F.when(F.col("item_id") % 3 == 0, F.reverse("text")).alias("output2"), F.lit("z").alias("output10"))
    return R.unpivot_outputs(items, "item_id")


def task_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.concat(F.lit("["), F.lower("c_mktsegment"), F.lit("]a"), F.repeat(F.lit("|b"), (F.col("c_custkey") % 4).cast("int")), F.lit("[PERSONA:p"), (F.col("c_custkey") % 3).cast("string"), F.lit("]")).alias("task_id"))
    return R.task_parts(ids).groupBy("intent", "persona", "num_issues").agg(F.count("*").alias("n"))


def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.seeded_shuffle(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)


def ratio_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.ratio_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.8, 0.1, 0.1)


def fixed_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.fixed_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 250)


def capped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.cap_per_group(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", 3, "o_orderkey")


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve most recent by customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("at"))
    return split.top_k(o, "o_custkey", "at", "o_orderkey", 12).select("o_custkey", "o_orderkey", "rank")


def round_robin_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.round_robin(table(spark, sf_dir, "benchmark").select("item_id"), "item_id", ["a", "b", "c"], "model")


def interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return split.interleave(docs, "lang", "doc_id", {"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}).select("doc_id", "lang", F.round("slot", 6).alias("slot"))


def pending_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    done = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("task_id"), F.lit(1).alias("trial"), F.lit(11).alias("seed"))
    return resume.pending_trials(c.select(F.col("c_custkey").alias("task_id")), done, [10, 11, 12])


QUERIES = {
    f.__name__: f
    for f in (chat_pairs, normalized_records, styled_rendered, message_rows, instruction_rows, flipped_turns, output_unpivot, task_ids, seeded_order, ratio_splits, fixed_splits, capped_orders, latest_orders, round_robin_models, interleaved, pending_trials)
}
_S = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_PAIRS = """
w as (select *, last_value(case when role = 'system' then text end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as system,
  lead(role) over (partition by conv_id order by turn) as nr, lead(text) over (partition by conv_id order by turn) as assistant from conversations),
p as (select conv_id, turn, system, text as user, assistant from w where role = 'user' and nr = 'assistant')
"""
ORACLES = {
    "chat_pairs": f"with {_PAIRS} select conv_id, turn, sha256(coalesce(system, '-')) as system_sha, sha256(\"user\") as user_sha, sha256(assistant) as assistant_sha from p",
    "normalized_records": f"""with {_PAIRS}
select conv_id, turn, sha256({_S.format("coalesce(nullif(system, ''), 'Be helpful.')")}) as system_sha, sha256(substr({_S.format('"user"')}, 1, 4096)) as user_sha,
sha256(coalesce(case when conv_id % 5 <> 0 then substr({_S.format("assistant")}, 1, 4096) end, '-')) as assistant_sha, case when conv_id % 5 = 0 then 'missing user/assistant fields' end as reject_reason from p""",
    "styled_rendered": f"""with {_PAIRS}, s as (select *, case when coalesce(system, '') = '' then 'Answer briefly.' else 'Answer briefly.' || chr(10) || chr(10) || system end as st from p)
select conv_id, turn, sha256('<|im_start|>system' || chr(10) || {_S.format("st")} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {_S.format('"user"')} || '<|im_end|>' || chr(10) || '<|im_start|>assistant') as input_sha,
length({_S.format("assistant")})::int as n_target from s""",
    "message_rows": """
select conv_id, sha256(coalesce(max_by(text, turn) filter (role = 'user'), '-')) as user_sha, sha256(coalesce(max_by(text, turn) filter (role = 'assistant'), '-')) as assistant_sha, count(*)::int as n_messages,
sha256(coalesce(string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) order by turn) filter (role <> 'system'), '')) as transcript_sha from conversations group by conv_id""",
    "instruction_rows": rf"""
with r as (select item_id, text as i, case when item_id % 2 = 0 then '  ' else text end as g from benchmark),
u as (select *, {_S.format("i || chr(10) || g")} as u from r)
select item_id, sha256(u) as user_sha, sha256(i || case when trim(g) <> '' then chr(10) || chr(10) || 'Input: ' || g else '' end || chr(10) || chr(10) || 'Response: done') as cpt_sha, sha256('<|user|>' || u || '<|end|><|assistant|>done<|end|>') as text_sha from u""",
    "flipped_turns": """
with i as (select case role when 'user' then 'assistant' when 'assistant' then 'user' else role end as role, row_number() over (partition by conv_id order by turn) - 1 as x from conversations)
select role, count(*) as n, sum(x)::bigint as idx_sum from i group by role""",
    "output_unpivot": """
select item_id, 1 as output_no, text as output_text from benchmark union all select item_id, 2, reverse(text) from benchmark where item_id % 3 = 0 union all select item_id, 10, 'z' from benchmark""",
    "task_ids": "select lower(c_mktsegment) as intent, 'p' || c_custkey % 3 as persona, (c_custkey % 4 + 1)::int as num_issues, count(*) as n from customer group by all",
    "seeded_order": "select doc_id, row_number() over (order by sha256('42:' || doc_id), doc_id) as position from documents",
    "ratio_splits": """
with r as (select doc_id, row_number() over (order by sha256('42:' || doc_id), doc_id) as p, count(*) over () as n from documents)
select doc_id, case when p <= floor(n * 0.8::double) then 'train' when p <= floor(n * 0.8::double) + floor(n * 0.1::double) then 'val' else 'test' end as split from r""",
    "fixed_splits": "select o_orderkey, case when row_number() over (order by sha256('12:' || o_orderkey), o_orderkey) <= 250 then 'test' else 'train' end as split from orders",
    "capped_orders": "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey) <= 3",
    "latest_orders": "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by epoch(o_orderdate)::bigint desc, o_orderkey)::int as rank from orders qualify rank <= 12",
    "round_robin_models": "select item_id, ['a', 'b', 'c'][((row_number() over (order by item_id)) - 1) % 3 + 1] as model from benchmark",
    "interleaved": """
with g as (select doc_id, lang, case lang when 'en' then 0.4::double when 'fr' then 0.3::double when 'de' then 0.2::double else 0.1::double end as w,
floor(-ln((('0x' || substr(md5('42|' || lang || '|' || doc_id), 1, 13))::bigint::double + 0.5) / 4503599627370496::double) * 1048576)::bigint as gap from documents where lang in ('en', 'fr', 'de', 'es')),
r as (select doc_id, lang, sum(gap) over (partition by lang order by doc_id)::bigint / 1048576::double / w as slot from g)
select doc_id, lang, round(slot, 6) as slot from r where slot <= (select min(m) from (select max(slot) as m from r group by lang))""",
    "pending_trials": "select c_custkey as task_id, t.trial::int as trial, t.seed::int as seed from customer, (values (0, 10), (1, 11), (2, 12)) t(trial, seed) where not (c_custkey % 3 = 0 and t.trial = 1)",
}
