"""Queries on prompts, messages, lookups and verdicts by tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import prompts as P
from corpusmill.functions import tiers as T
from corpusmill.operators import lookups as L
from corpusmill.operators import source
from corpusmill.operators.joins import arrival_day
from corpusmill.plans.tables import counted, table


def _sha(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("-")), 256)


def _of(col: Column, *values: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (col % len(values)).cast("int"))


def item_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as items of four types, some fields empty."""
    k, t = F.col("item_id"), F.col("text")
    prompt = P.item_prompt(_of(k, "debugging", "code_generation", "explain", ""), t, F.when(k % 2 == 0, F.concat(F.lit("fn "), t)), F.when(k % 3 == 0, F.reverse(t)), _of(k, "rust", ""), F.when(k % 5 == 0, F.lit("anyhow")).otherwise(""), F.lit("none"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.sha2(prompt, 256).alias("prompt_sha"), F.sha2(P.task_file(F.lit("T"), t), 256).alias("task_sha"))


def choice_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of a region as choices, by name."""
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    out = n.select("n_regionkey", P.display_choices(F.col("names")).alias("c"))
    return out.select("n_regionkey", F.sha2("c.text", 256).alias("text_sha"), F.col("c.places")["B"].alias("b"))


def object_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties with a field left out or null: whole objects or raw ones; and a patch of a record."""
    k = F.col("event_id") % 3
    reply = F.when(k == 0, F.lit('{"a": 1, "b": "x"}')).when(k == 1, F.lit('{"a": 1, "b": null}')).otherwise(F.lit('{"a": 1}'))
    record = F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), k.cast("string"))
    patch = P.patched(record, F.when(k == 0, F.create_map(F.lit("k"), F.lit("new"), F.lit("z"), F.lit("9"))).otherwise(F.create_map().cast("map<string,string>")))
    entries = F.array_join(F.transform(F.array_sort(F.map_entries(patch)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    out = table(spark, sf_dir, "events").select(P.whole_or_raw(F.try_parse_json(reply), ["a", "b"]).alias("whole"), entries.alias("record"))
    return out.groupBy("whole", "record").agg(F.count("*").alias("n"))


def flipped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("conv_id") + F.col("turn")
    turns = table(spark, sf_dir, "conversations").withColumn("r", F.when(k % 5 == 0, "tool").otherwise(F.col("role")))
    m = P.flipped_message(F.col("r"), F.when(k % 2 == 0, "user").otherwise("assistant"), F.when(k % 7 == 0, 1).otherwise(0))
    return turns.select(m.alias("m")).groupBy("m.role", "m.error").agg(F.count("*").alias("n"))


def provider_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as a provider's messages; short assistant turns are calls instead."""
    calls = F.when(F.length("text") % 3 == 0, F.array(F.struct(F.lit("c1").alias("id"), F.lit("f").alias("name"), F.lit('{"a":1}').alias("arguments"))))
    k = F.col("turn")
    role = F.when(k % 4 == 3, "tool").otherwise(F.col("role"))
    out = P.provider_message(role, F.when((role == "assistant") & calls.isNotNull(), None).otherwise(F.length("text").cast("string")), F.when(role == "assistant", calls), F.lit("c1"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", out.alias("message"))


def communication_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    fault = P.communication_fault(_of(e, "agent", "user", "env"), F.when(e % 4 < 2, F.col("event_type")).otherwise(" "), (e % 5 < 2).cast("int"), e % 2 == 0, e % 7 == 0)
    return table(spark, sf_dir, "events").groupBy(fault.alias("fault")).agg(F.count("*").alias("n"))


def iso_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as ISO text, every third cut to seconds, and the day on which a leg that takes seven hours arrives."""
    ts = F.col("ts").cast("timestamp")
    hour = F.hour(ts)
    arrives = F.when(hour < 17, F.format_string("%02d:00:00", hour + 7)).otherwise(F.format_string("%02d:00:00+1", hour - 17))
    return table(spark, sf_dir, "events").select("event_id", P.iso_text(F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", ts)).otherwise(ts)).alias("iso"), arrival_day(ts, arrives).cast("string").alias("arrival_day"))


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as flights on two days."""
    k = F.col("p_partkey")
    day = lambda status, n: F.struct(status.alias("status"), (k % n).cast("int").alias("seats"), F.col("p_retailprice").alias("price"))
    dates = F.create_map(F.lit("2024-05-20"), day(_of(k, "available", "cancelled", "available"), 9), F.lit("2024-05-21"), day(F.lit("available"), 7))
    return table(spark, sf_dir, "part").select(k.alias("flight_number"), _of(k, "SFO", "JFK", "LAX", "ORD").alias("origin"), _of(k, "BOS", "SEA", "DEN").alias("destination"), F.format_string("%02d:30:00", (k % 24).cast("int")).alias("departs"), F.format_string("%02d:00:00", ((k + 2) % 24).cast("int")).alias("arrives"), dates.alias("dates"))


def flight_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _flights(spark, sf_dir)
    one = L.direct_flights(f, F.lit("SFO"), F.lit("BOS"), F.lit("2024-05-20")).select("flight_number", "date", "seats", F.lit("asked").alias("search"))
    return one.unionByName(L.direct_flights(f, origin=F.lit("JFK"), leave_after=F.lit("20:00:00")).select("flight_number", "date", "seats", F.lit("late").alias("search")))


def _carrier(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as a carrier's, orders as their bills, suppliers' numbers as lines."""
    o = table(spark, sf_dir, "orders")
    bills = o.select(F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("bill_id"), F.when(F.col("o_orderstatus") == "P", "Awaiting Payment").otherwise("Paid").alias("status"))
    owned = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.concat(F.lit("B"), F.col("o_orderkey").cast("string")))).alias("bill_ids"))
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").join(owned, "c_custkey", "left").select(
        F.concat(F.lit("C"), k.cast("string")).alias("customer_id"), (k % 1000).cast("string").alias("phone_number"), F.array(F.concat(F.lit("L"), (k % 77).cast("string")), F.concat(F.lit("L"), (k + 1).cast("string"))).alias("line_ids"), F.coalesce("bill_ids", F.array().cast("array<string>")).alias("bill_ids"),
    )
    lines = table(spark, sf_dir, "supplier").select(F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("line_id"), (F.col("s_suppkey") + 5000).cast("string").alias("phone_number"))
    return customers, lines, bills


def phone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, lines, _ = _carrier(spark, sf_dir)
    numbers = lines.select(F.col("phone_number").alias("phone")).union(customers.select("phone_number")).union(spark.createDataFrame([("none",)], "phone string"))
    return L.customers_by_phone(numbers, customers, lines)


def prefix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, lines, bills = _carrier(spark, sf_dir)
    ids = lines.select(F.col("line_id").alias("id")).union(bills.where("status = 'Paid'").select("bill_id")).union(spark.createDataFrame([("L0x",), ("X1",), ("B-1",)], "id string"))
    out = L.by_prefix(ids, {"L": ("line", lines, "line_id"), "B": ("bill", bills, "bill_id"), "C": ("customer", customers.select("customer_id"), "customer_id")})
    return out.groupBy("kind", "error").agg(F.count("*").alias("n"), F.min("record").alias("least"))


def awaiting_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, _, bills = _carrier(spark, sf_dir)
    return L.bills_of_status(customers, bills, "Awaiting Payment").select("customer_id", F.array_join("bill_ids", ",").alias("bills"))


def calculations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over quantities, some of them no arithmetic."""
    q = F.col("l_quantity").cast("int").cast("string")
    expr = F.when(F.col("l_linenumber") == 3, F.lit("abs(1)")).when(F.col("l_linenumber") == 4, F.lit("1 / 0")).otherwise(F.concat(F.lit("("), q, F.lit(" + 0.5) * 2 - 3 / 4")))
    return table(spark, sf_dir, "lineitem").select(L.calculated(expr).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def speed_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    g = L.speed_grade(_of(k, "2G", "3G", "4G", "5G", "none"), _of(k, "poor", "fair", "good", "excellent"), k % 3 == 0, k % 7 == 0)
    return table(spark, sf_dir, "part").select("p_partkey", g.alias("g")).select("p_partkey", "g.mbps", "g.grade")


def source_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Rust file for each part, with braces in strings and comments, an impl block and a module."""
    n = F.col("p_partkey").cast("string")
    text = F.concat(
        F.lit("/// doc\npub fn part_"), n, F.lit("() {\n    let s = \"}{\"; // }\n"), F.expr("repeat('    call();\n', cast(p_partkey % 4 as int))"), F.lit("}\n\nimpl<T> Show for Box<T> {\n    fn show_"), n, F.lit("(&self) {}\n}\nmod inner {\n}\n")
    )
    files = table(spark, sf_dir, "part").select("p_partkey", F.lit("src/a.rs").alias("path"), text.alias("text"))
    return source.source_blocks(files, ["p_partkey"]).select("p_partkey", "name", "first", "last")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of a part's function changed."""
    n = F.col("p_partkey").cast("string")
    file = lambda x: F.concat(F.lit("use a;\n\nfn part_"), n, F.lit("() {\n    one();\n    "), x, F.lit("();\n}\n\nfn other() {}\n"))
    diff = F.lit("diff --git a/f.rs b/f.rs\n--- a/f.rs\n+++ b/f.rs\n@@ -4,2 +4,2 @@\n     one();\n-    old();\n+    new();")
    return table(spark, sf_dir, "part").select("p_partkey", diff.alias("diff"), F.create_map(F.lit("f.rs"), file(F.lit("old"))).alias("old"), F.create_map(F.lit("f.rs"), file(F.lit("new"))).alias("new"))


def context_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.context_diff(_changes(spark, sf_dir), ["p_partkey"]).select("p_partkey", F.sha2("text", 256).alias("diff_sha"))


def function_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of even key lose their other function, those of a third get one more, and a constant outside of all."""
    k = F.col("p_partkey")
    rows = _changes(spark, sf_dir)
    first = F.when(k % 2 == 0, F.lit("fn gone() {}\n")).otherwise("")
    added = F.when(k % 3 == 0, F.lit("\nconst N: u8 = 1;\nfn fresh() {\n}\n")).otherwise("")
    old, new = F.concat(first, F.col("old")["f.rs"]), F.concat(F.col("new")["f.rs"], added)
    more = F.concat(
        F.when(k % 2 == 0, F.lit("\n@@ -1,1 +1,0 @@\n-fn gone() {}")).otherwise(""), F.when(k % 3 == 0, F.lit("\n@@ -9,0 +9,4 @@\n+\n+const N: u8 = 1;\n+fn fresh() {\n+}")).otherwise("")
    )
    head = F.when(k % 2 == 0, F.replace("diff", F.lit("-4,2"), F.lit("-5,2"))).otherwise(F.col("diff"))
    made = rows.select("p_partkey", F.concat(head, more).alias("diff"), F.create_map(F.lit("f.rs"), old).alias("old"), F.create_map(F.lit("f.rs"), new).alias("new"))
    return source.readable_diff(made, ["p_partkey"])


def _patch(name: Column, added: Column) -> Column:
    return F.concat(F.lit("diff --git a/f.rs b/"), name, F.lit("\n--- a/f.rs\n+++ b/"), name, F.lit("\n@@ -1,2 +1,2 @@\n-old(1);\n+"), added, F.lit("\n ctx"))


def _summary(primary: Column, error: Column) -> Column:
    return F.concat(F.lit("BEHAVIORAL SUMMARY:\n- Primary behavior change: "), primary, F.lit("\n- Secondary effects: none\n- Error handling changes: "), error, F.lit("\n- Edge cases affected: none"))


def third_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model patches that are empty, of another file, with other lines, or right; summaries that are short, unknown, unbacked,
    different or the same."""
    k = F.col("o_orderkey")
    human, right = _patch(F.lit("f.rs"), F.lit("retry(network);")), F.lit("retry  (Network);")
    model = F.when(k % 11 == 0, " ").when(k % 11 == 1, _patch(F.lit("g.rs"), right)).when(k % 11 == 2, _patch(F.lit("f.rs"), F.lit("other();"))).otherwise(_patch(F.lit("f.rs"), F.lit("RETRY(network);")))
    told = _summary(F.lit("retry network calls on failure"), F.lit("adds a retry"))
    reply = (
        F.when(k % 7 == 0, "short").when(k % 7 == 1, "BEHAVIOR: UNKNOWN, can't tell at all").when(k % 7 == 2, _summary(F.lit("paints seven purple elephants"), F.lit("adds a retry")))
        .when(k % 7 == 3, _summary(F.lit("retry network calls forever"), F.lit("adds a retry"))).when(k % 7 == 4, _summary(F.lit("Retry  network calls on failure"), F.lit("none"))).otherwise(told)
    )
    # A verdict follows from its texts alone: each choice of them is judged once.
    asked = counted(table(spark, sf_dir, "orders").select(human.alias("human"), model.alias("model"), told.alias("told"), reply.alias("reply")))
    out = asked.select(T.third_tier(*map(F.col, ("human", "model", "told", "reply"))).alias("v"), "n").select("v.*", "n")
    return out.groupBy("verdict", "reason", "confidence").agg(F.sum("n").alias("n"))


def routed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    human = F.when(k % 3 == 0, F.lit("small")).otherwise(F.repeat(F.lit("x"), 36_000))
    context = F.when(k % 3 == 1, F.lit("ctx")).otherwise("")
    prompt = F.when(k % 50 == 7, F.repeat(F.lit("p"), 120_001)).otherwise("p")
    v = T.routed(human, F.when(k % 13 == 0, "").otherwise("m"), context, prompt, F.when(k % 4 == 0, "FINAL_VERDICT: PASS").otherwise("none"), F.when(k % 9 == 0, "Request timed out"))
    return table(spark, sf_dir, "orders").select(v.alias("v")).groupBy("v.tier", "v.verdict").agg(F.count("*").alias("n"))


def summary_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What summaries mention, chunks that were asked several times, and structured summaries that can't be trusted."""
    k = F.col("l_partkey")
    summary = F.concat_ws(" ", F.when(k % 2 == 0, "In the file core.py"), F.when(k % 3 > 0, "adds a check"), F.when(k % 5 > 0, "and an early return"), F.when(k % 7 > 0, "which prevents a crash"))
    good = F.lit("BEHAVIORAL SUMMARY:\n- Primary behavior change: x")
    replies = F.array(F.when(k % 4 == 0, good).otherwise("short"), F.when(k % 4 == 1, good).when(k % 4 == 2, "well, BEHAVIOR: UNKNOWN here").otherwise("no heading but long enough text"))
    # Checks follow from what they read alone: each choice of it is checked once.
    told = counted(table(spark, sf_dir, "lineitem").select(summary.alias("summary"), replies.alias("replies"), (k % 3).alias("tier"), F.when(k % 5 == 0, "{oops").otherwise("{}").alias("structured")))
    summary, a = F.col("summary"), T.chunk_attempts(F.col("replies"))
    rows = told.select(F.array_join(T.missing_mentions(summary), ",").alias("missing"), T.summary_complete(summary, F.repeat(F.lit("+x\n"), 20)).alias("complete"), a["status"].alias("status"), a["retries"].alias("retries"), T.summary_guard(F.col("tier"), F.col("structured")).alias("guard"), "n")
    return rows.groupBy("missing", "complete", "status", "retries", "guard").agg(F.sum("n").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        item_prompts, choice_lists, object_checks, flipped_messages, provider_messages, communication_faults, iso_stamps, flight_search, phone_lookup, prefix_lookup, awaiting_bills, calculations, speed_grades, source_functions,
        context_diffs, function_versions, third_tiers, routed_verdicts, summary_checks,
    )
}
_NL = "chr(10)"
ORACLES = {
    "item_prompts": """
with i as (select item_id as k, text as t, ['debugging', 'code_generation', 'explain', ''][item_id % 4 + 1] as ty, ['rust', ''][item_id % 2 + 1] as l from benchmark),
p as (select k, t, list_filter([case when ty <> '' then '**Task Type:** ' || ty end, case when k % 2 = 0 then '**Context Code:**' || chr(10) || '```' || l || chr(10) || 'fn ' || t || chr(10) || '```' end,
  case when k % 3 = 0 then '**Buggy Code:**' || chr(10) || '```' || l || chr(10) || reverse(t) || chr(10) || '```' end, case when k % 5 = 0 then '**Error Handling Pattern:** anyhow' end, '**Task:**' || chr(10) || t, case when k % 4 < 2 then '**Constraints:**' || chr(10) || 'none' end], lambda x: x is not null) as parts from i)
select k as item_id, sha256(array_to_string(list_transform(parts, lambda x: x || chr(10)), chr(10))) as prompt_sha,
sha256('# Task: T' || chr(10) || chr(10) || '## PR Information' || chr(10) || '**Title:** T' || chr(10) || chr(10) || '## Description' || chr(10) || t || chr(10) || chr(10) || '## Requirements' || chr(10) || 'Based on the PR description above, please implement the required changes.' || chr(10) || chr(10) || '**Please implement this feature.**' || chr(10)) as task_sha from p""",
    "choice_lists": """
with n as (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_name) - 1 as i from nation)
select n_regionkey, sha256(string_agg(chr((65 + i)::int) || '. ' || n_name, chr(10) order by i)) as text_sha, (max(i) filter (i = 1))::int as b from n group by 1""",
    "object_checks": """
select event_id % 3 = 0 as whole, case when event_id % 3 = 0 then 'k=new,type=' || event_type || ',z=9' else 'k=' || event_id % 3 || ',type=' || event_type end as record, count(*) as n from events group by all""",
    "flipped_messages": """
with t as (select case when (conv_id + turn) % 5 = 0 then 'tool' else role end as r, (conv_id + turn) % 2 = 0 as u, (conv_id + turn) % 7 = 0 as c from conversations),
m as (select r, case when r = 'assistant' and c then 'assistant tool call' when r = 'tool' and not u then 'tool reply to the assistant' when r not in ('user', 'assistant', 'tool') then 'unknown role' end as error from t)
select case when error is null then case r when 'user' then 'assistant' when 'assistant' then 'user' else r end end as role, error, count(*) as n from m group by all""",
    "provider_messages": """
with t as (select conv_id, turn, case when turn % 4 = 3 then 'tool' else role end as r, length(text) as n, length(text) % 3 = 0 as c from conversations)
select conv_id, turn, '{"role":"' || r || '","content":' || case when r = 'assistant' and c then 'null' else '"' || n || '"' end || case r when 'assistant' then ',"tool_calls":' || case when c then '[{"id":"c1","name":"f","function":{"name":"f","arguments":"{\\"a\\":1}"},"type":"function"}]' else 'null' end when 'tool' then ',"tool_call_id":"c1"' else '' end || '}' as message from t""",
    "communication_faults": """
with e as (select ['agent', 'user', 'env'][event_id % 3 + 1] as s, event_id % 4 < 2 as says, event_id % 5 < 2 as calls, event_id % 2 = 0 as solo, event_id % 7 = 0 as stops from events),
f as (select s, case when s = 'env' then null when not says and not calls then 'empty' when says and calls then 'mixed' when s = 'agent' and solo and says and not stops then 'text in solo mode' end as f from e)
select case when f is not null then s || ': ' || f end as fault, count(*) as n from f group by 1""",
    "iso_stamps": """
with e as (select event_id, ts, case when event_id % 3 = 0 then date_trunc('second', ts) else ts end as t from events)
select event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || case when strftime(t, '%f') = '000000' then '' else '.' || strftime(t, '%f') end as iso, strftime(ts::date + case when hour(ts) < 17 then 0 else 1 end, '%Y-%m-%d') as arrival_day from e""",
    "flight_search": """
select p_partkey as flight_number, '2024-05-20' as date, (p_partkey % 9)::int as seats, 'asked' as search from part where p_partkey % 4 = 0 and p_partkey % 3 = 0
union all select p_partkey, '2024-05-20', (p_partkey % 9)::int, 'late' from part where p_partkey % 4 = 1 and p_partkey % 24 >= 20 and p_partkey % 3 <> 1 union all select p_partkey, '2024-05-21', (p_partkey % 7)::int, 'late' from part where p_partkey % 4 = 1 and p_partkey % 24 >= 20""",
    "phone_lookup": """
with c as (select 'C' || c_custkey as id, (c_custkey % 1000)::varchar as p, c_custkey as k from customer), l as (select s_suppkey as s, (s_suppkey + 5000)::varchar as p from supplier),
o as (select p, id from c union all select l.p, c.id from c join l on l.s = c.k % 77 or l.s = c.k + 1), n as (select p from l union select p from c union select 'none')
select n.p as phone, min(id) as customer_id from n left join o using (p) group by 1""",
    "prefix_lookup": """
select 'line' as kind, null as error, count(*) as n, min('{"line_id":"L' || s_suppkey || '","phone_number":"' || (s_suppkey + 5000) || '"}') as least from supplier
union all select 'bill', null, count(*), min('{"bill_id":"B' || o_orderkey || '","status":"Paid"}') from orders where o_orderstatus <> 'P' union all select null, 'not found', 2, null union all select null, 'unknown kind of id', 1, null""",
    "awaiting_bills": """
select 'C' || c_custkey as customer_id, coalesce(string_agg('B' || o_orderkey, ',' order by 'B' || o_orderkey) filter (o_orderstatus = 'P'), '') as bills from customer left join orders on o_custkey = c_custkey group by 1""",
    "calculations": """
with l as (select case when l_linenumber = 3 then 'Error: ToolError' when l_linenumber = 4 then 'Error: ZeroDivisionError' else (l_quantity::int * 2) || '.25' end as value from lineitem) select value, count(*) as n from l group by 1""",
    "speed_grades": """
with p as (select p_partkey, [0.25, 3, 55, 275, 0][p_partkey % 5 + 1]::double * [0.2, 0.5, 0.8, 1][p_partkey % 4 + 1]::double * (case when p_partkey % 3 = 0 then 0.1::double else 1 end * case when p_partkey % 7 = 0 then 0.2::double else 1 end) as m from part),
r as (select p_partkey, round(m, 2) as mbps from p) select p_partkey, mbps, case when mbps < 1 then 'Very Poor' when mbps < 5 then 'Poor' when mbps < 25 then 'Fair' when mbps < 100 then 'Good' else 'Excellent' end as grade from r""",
    "source_functions": """
with p as (select p_partkey as k, (p_partkey % 4)::int as c from part)
select k as p_partkey, 'part_' || k as name, 1 as first, 4 + c as last from p union all select k, 'show_' || k || '@impl <T> Show for Box<T>', 7 + c, 7 + c from p union all select k, '<T> Show for Box<T>', 6 + c, 8 + c from p union all select k, 'inner', 9 + c, 10 + c from p""",
    "context_diffs": f"""
select p_partkey, sha256('# Enhanced Git Diff with Full Function Context' || {_NL} || '# This diff shows complete functions/methods that contain changes' || {_NL} || '# to help understand the full context of modifications.' || {_NL} || {_NL} || 'diff --git a/f.rs b/f.rs' || {_NL} || '--- a/f.rs' || {_NL} || '+++ b/f.rs' || {_NL}
|| '@@ Function context: part_' || p_partkey || ' @@' || {_NL} || '@@ -3,4 +3,4 @@' || {_NL} || ' use a;' || {_NL} || ' ' || {_NL} || '     one();' || {_NL} || '-    old();' || {_NL} || '+    new();' || {_NL} || ' ' || {_NL} || ' fn other() {{}}' || {_NL}) as diff_sha from part""",
    "function_versions": f"""
with p as (select p_partkey as k, 'fn part_' || p_partkey || '() {{' || {_NL} || '    one();' || {_NL} || '    ' as a, '();' || {_NL} || '}}' as b from part)
select k as p_partkey, 'f.rs' as path, 'function' as kind, 'part_' || k as name, 'modified' as status, a || 'old' || b as old_text, a || 'new' || b as new_text from p
union all select k, 'f.rs', 'function', 'gone', 'deleted', 'fn gone() {{}}', null from p where k % 2 = 0
union all select k, 'f.rs', 'function', 'fresh', 'new', null, 'fn fresh() {{' || {_NL} || '}}' from p where k % 3 = 0
union all select k, 'f.rs', 'outside', null, 'new', null, 'const N: u8 = 1;' from p where k % 3 = 0""",
    "third_tiers": """
with o as (select o_orderkey % 11 as a, o_orderkey % 7 as b from orders),
v as (select case when a = 0 then 'FAIL|no changes made|1' when a = 1 then 'FAIL|raw: files|0' when a = 2 then 'FAIL|raw: added|0' when b in (0, 1) then 'FAIL_INFRA|no model summary|0' when b = 2 then 'FAIL|model summary not backed|0' when b in (3, 4) then 'FAIL|behaviours differ|0.8' else 'PASS|raw parity and behaviours match|0.95' end as v from o)
select split_part(v, '|', 1) as verdict, split_part(v, '|', 2) as reason, split_part(v, '|', 3)::double as confidence, count(*) as n from v group by all""",
    "routed_verdicts": """
with o as (select o_orderkey as k, case when o_orderkey % 3 = 0 then 1 when o_orderkey % 3 = 1 then 2 else 3 end as t from orders),
v as (select case when k % 13 = 0 then 0 else t end as tier, case when k % 13 = 0 then 'FAIL' when t = 3 then null when k % 50 = 7 then 'SKIPPED_CONTEXT_OVERFLOW' when k % 9 = 0 then 'FAIL' when k % 4 = 0 then 'PASS' else 'FAIL' end as verdict from o)
select tier::int as tier, verdict, count(*) as n from v group by all""",
    "summary_checks": """
with l as (select l_partkey as k from lineitem),
s as (select k, k % 2 <> 0 as f, not (k % 3 > 0 ) as g, not (k % 5 > 0) as c, not (k % 7 > 0) as b from l),
m as (select array_to_string(list_filter([case when f then 'Files Mentioned' end, case when g then 'Logic Changes' end, case when c then 'Control Flow' end, case when b then 'Behavioral Impact' end], lambda x: x is not null), ',') as missing,
  case k % 4 when 0 then 'SUCCESS' when 1 then 'SUCCESS' when 2 then 'UNKNOWN' else 'ERROR' end as status, case when k % 4 = 0 then 0 else 1 end as retries, case when k % 3 > 1 then 'RISK_AWARE_REJECTION' when k % 5 = 0 then 'JSON_PARSE_FAILURE' end as guard from s)
select missing, missing = '' as complete, status, retries::int as retries, guard, count(*) as n from m group by all""",
}
