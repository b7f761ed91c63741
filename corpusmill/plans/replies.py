"""Queries on model replies: answers inside chat text, code, JSON of any dress, tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import jsonish as J
from corpusmill.functions import rust as S
from corpusmill.functions import text as X
from corpusmill.plans.tables import table


def _sha(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("-")), 256)


def assistant_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns dressed as chat templates of five kinds: with a user tag behind, closed, of several turns, as plain prompts, bare."""
    t, k = F.col("text"), (F.col("conv_id") + F.col("turn")) % 5
    dressed = (
        F.when(k == 0, F.concat(F.lit("<|user|>q<|assistant|>"), t, F.lit("<|user|>next question")))
        .when(k == 1, F.concat(F.lit("<|assistant|>first<|user|>more<|assistant|> "), t, F.lit(" </|assistant|>rest")))
        .when(k == 2, F.concat(F.lit("<|system|>be\nbrief</|system|><|user|>q</|user|>\n"), t))
        .when(k == 3, F.concat(F.lit("User: why?\nAssistant: "), t))
        .otherwise(t)
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(X.assistant_reply(dressed), 256).alias("reply_sha"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rust answers to parts: fenced, bare after prose, without the asked function, or no code at all."""
    k, n = F.col("p_partkey"), F.col("p_partkey").cast("string")
    body = F.concat(F.lit("fn part_"), n, F.lit("(a: i32) -> i32 {\n    let b = a.checked_add("), n, F.lit(");\n    b.unwrap()\n}"))
    wrong = F.lit("use std::cmp;\nuse core::Mem;\nfn other() {\n    cmp::max(1, 2);\n    let z = 3;\n}\n")
    code = (
        F.when(k % 5 == 0, F.concat(F.lit("Sure:\n```rust\n"), body, F.lit("\n```\nand\n```\nno\n```")))
        .when(k % 5 == 1, F.concat(F.lit("Here you are\n"), body, F.lit("\nHope that helps")))
        .when(k % 5 == 2, F.concat(F.lit("use std::fmt;\n"), body, F.lit("\n")))
        .when(k % 5 == 3, wrong)
        .otherwise(F.concat(F.lit("I can't "), n))
    )
    signature = F.concat(F.lit("#[inline]\n/// like fn old()\npub fn part_"), n, F.lit("(a: i32) -> i32;"))
    api = F.when(k % 3 == 0, "i32::checked_add").when(k % 3 == 1, "std::mem").otherwise("Vec<T>")
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("reply"), signature.alias("signature"), api.alias("api"))


def rust_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _answers(spark, sf_dir).withColumn("code", X.fenced_code(F.col("reply")))
    code, sig = F.col("code"), F.col("signature")
    return rows.select("p_partkey", _sha(code).alias("code_sha"), S.function_name(sig).alias("name"), S.has_signature(code, sig).alias("has_signature"), S.uses_api(code, F.col("api")).alias("uses_api"), _sha(S.enforced_signature(code, sig)).alias("enforced_sha"))


def _dressed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties inside replies: bare, after prose, fenced, in a block of another language, among lines, broken."""
    p, k = F.col("props"), F.col("event_id") % 7
    two = F.concat(F.lit('{\n"a": {"b": 1},\n"p": '), p, F.lit("\n}"))
    reply = (
        F.when(k == 0, p)
        .when(k == 1, F.concat(F.lit("Result: "), two, F.lit(" as {asked}")))
        .when(k == 2, F.concat(F.lit("```json\n"), two, F.lit("\n```")))
        .when(k == 3, F.concat(F.lit("see\n```text\n"), p, F.lit("\n```\nend")))
        .when(k == 4, F.concat(F.lit("first line\n"), two, F.lit("\nlast line")))
        .when(k == 5, F.concat(F.lit("x {unclosed "), p))
        .otherwise(F.lit("nothing here\n  \n"))
    )
    return table(spark, sf_dir, "events").select("event_id", "props", reply.alias("reply"))


def balanced_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dressed_json(spark, sf_dir).select("event_id", F.sha2(J.balanced_object(F.col("reply")), 256).alias("object_sha"))


def markdown_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dressed_json(spark, sf_dir).select("event_id", _sha(J.markdown_json(F.col("reply"))).alias("json_sha"))


def deep_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of one object, its keys swapped, and others that differ in one value, in order or in being JSON."""
    k, n = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    a = F.concat(F.lit('{"k": '), n, F.lit(', "s": "'), "o_orderpriority", F.lit('", "l": [1, {"x": true, "y": null}]}'))
    tail = F.when(k % 4 == 1, F.lit("[{\"y\":null,\"x\":true},1]")).otherwise(F.lit('[1,{"y":null,"x":true}]'))
    b = F.when(k % 4 == 3, F.lit("{k: 1")).otherwise(F.concat(F.lit('{"l":'), tail, F.lit(',"s":"'), "o_orderpriority", F.lit('","k":'), F.when(k % 4 == 2, F.concat(n, F.lit("1"))).otherwise(n), F.lit("}")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", a.alias("a"), b.alias("b"))
    return rows.select("o_orderkey", J.deep_equal(F.col("a"), F.col("b")).alias("equal"), F.sha2(J.canonical(F.col("a")), 256).alias("sha"))


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions as JSON calls, as functional calls with values of all kinds, as broken calls and as plain text."""
    k, n = F.col("l_orderkey") + F.col("l_linenumber"), F.col("l_partkey").cast("string")
    action = (
        F.when(k % 5 == 0, F.concat(F.lit('  {"name": "get_part", "arguments": {"id": '), n, F.lit("}}")))
        .when(k % 5 == 1, F.concat(F.lit("get_part(id="), n, F.lit(", flag='"), "l_returnflag", F.lit("', tags=['a', -1], more={'k': True, 'z': None})")))
        .when(k % 5 == 2, F.concat(F.lit("get_part(id="), n, F.lit(", oops")))
        .when(k % 5 == 3, F.concat(F.lit("Please look at part "), n))
        .otherwise(F.lit("stop()"))
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", action.alias("action"))
    call = J.tool_call(F.col("action"))
    out = rows.select("l_orderkey", "l_linenumber", "action", call.alias("c"))
    return out.select("l_orderkey", "l_linenumber", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.when(F.col("c").isNull(), F.col("action")).alias("content"))


QUERIES = {f.__name__: f for f in (assistant_replies, rust_answers, balanced_objects, markdown_values, deep_equality, tool_calls)}
_STRIP = r"regexp_replace({0}, '^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g')"
_TWO = """'{' || chr(10) || '"a": {"b": 1},' || chr(10) || '"p": ' || props || chr(10) || '}'"""
_DRESSED = f"""d as (select event_id, props, case event_id % 7 when 0 then props when 1 then 'Result: ' || {_TWO} || ' as {{asked}}' when 2 then '```json' || chr(10) || {_TWO} || chr(10) || '```'
 when 3 then 'see' || chr(10) || '```text' || chr(10) || props || chr(10) || '```' || chr(10) || 'end' when 4 then 'first line' || chr(10) || {_TWO} || chr(10) || 'last line'
 when 5 then 'x {{unclosed ' || props else 'nothing here' || chr(10) || '  ' || chr(10) end as t from events)"""
_CODE = r"""
p as (select p_partkey, 'fn part_' || p_partkey || '(a: i32) -> i32 {' || chr(10) || '    let b = a.checked_add(' || p_partkey || ');' || chr(10) || '    b.unwrap()' || chr(10) || '}' as body from part),
a as (select p_partkey, case p_partkey % 5 when 0 then body when 1 then body when 2 then 'use std::fmt;' || chr(10) || body
  when 3 then 'use std::cmp;' || chr(10) || 'use core::Mem;' || chr(10) || 'fn other() {' || chr(10) || '    cmp::max(1, 2);' || chr(10) || '    let z = 3;' || chr(10) || '}' else 'I can''t ' || p_partkey end as code,
  case p_partkey % 3 when 0 then 'checked_add' when 1 then 'mem' else 'Vec<T>' end as base from p)
"""
ORACLES = {
    "assistant_replies": rf"""
with d as (select conv_id, turn, case (conv_id + turn) % 5 when 0 then '<|user|>q<|assistant|>' || text || '<|user|>next question' when 1 then '<|assistant|>first<|user|>more<|assistant|> ' || text || ' </|assistant|>rest'
  when 2 then '<|system|>be' || chr(10) || 'brief</|system|><|user|>q</|user|>' || chr(10) || text when 3 then 'User: why?' || chr(10) || 'Assistant: ' || text else text end as t from conversations),
r as (select conv_id, turn, case when contains(t, '<|assistant|>') then split_part(split_part(string_split(t, '<|assistant|>')[-1], '<|user|>', 1), '</|assistant|>', 1)
  else regexp_replace(regexp_replace(t, '(?s)<\|(system|user)\|>.*?</\|(system|user)\|>', '', 'g'), '(?s)(User|Human):.*?Assistant:', '', 'g') end as x from d)
select conv_id, turn, sha256({_STRIP.format("x")}) as reply_sha from r""",
    "rust_answers": rf"""
with {_CODE}
select p_partkey, sha256(code) as code_sha, 'part_' || p_partkey as name, p_partkey % 5 < 3 as has_signature,
case base when 'checked_add' then contains(code, 'checked_add') when 'mem' then contains(lower(code), 'use core::mem') else false end as uses_api,
sha256(case p_partkey % 5 when 3 then 'use std::cmp;' || chr(10) || 'use core::Mem;' || chr(10) || chr(10) || '#[inline]' || chr(10) || '/// like fn old()' || chr(10) || 'pub fn part_' || p_partkey || '(a: i32) -> i32' || chr(10) || '{{' || chr(10) || 'cmp::max(1, 2);' || chr(10) || '    let z = 3;' || chr(10) || '}}'
  when 4 then '#[inline]' || chr(10) || '/// like fn old()' || chr(10) || 'pub fn part_' || p_partkey || '(a: i32) -> i32' || chr(10) || '{{' || chr(10) || code || chr(10) || '}}' else code end) as enforced_sha from a""",
    "balanced_objects": f"""
with {_DRESSED},
c as (select event_id, t, string_split(t[strpos(t, '{{'):], '}}') as p from d),
e as (select event_id, t, p, list_transform(range(1, len(p)), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x) - length(replace(x, '{{', '')))) - i) as depth from c),
z as (select event_id, t, p, list_position(depth, 0) as stop from e)
select event_id, sha256(case when strpos(t, '{{') > 1 and stop > 0 then array_to_string(p[1:stop], '}}') || '}}' else t end) as object_sha from z""",
    "markdown_values": f"""
with {_DRESSED},
l as (select event_id, t, string_split(t, chr(10)) as p from d),
b as (select event_id, t, p, regexp_replace(regexp_replace(trim(t, ' ' || chr(10)), '^```json\\s*', ''), '\\s*```$', '') as bare, trim(regexp_extract(t, '(?s)```(?:[a-z]+\\n)?(.*?)```', 1), ' ' || chr(10)) as block,
  list_filter(flatten(list_transform(range(1, len(p) + 1), lambda i: list_transform(range(i, len(p) + 1), lambda j: array_to_string(p[i:j], chr(10))))), lambda x: json_valid(x))[1] as ranged from l)
select event_id, sha256(coalesce(case when json_valid(t) then t when json_valid(bare) then bare when json_valid(block) then block else ranged end, '-')) as json_sha from b""",
    "deep_equality": """
select o_orderkey, o_orderkey % 4 = 0 as equal, sha256('{"k":' || o_orderkey || ',"l":[1,{"x":true,"y":null}],"s":"' || o_orderpriority || '"}') as sha from orders""",
    "tool_calls": """
with k as (select *, (l_orderkey + l_linenumber) % 5 as k from lineitem)
select l_orderkey, l_linenumber, case when k in (0, 1) then 'get_part' when k = 4 then 'stop' end as name,
case k when 0 then '{"id":' || l_partkey || '}' when 1 then '{"flag":"' || l_returnflag || '","id":' || l_partkey || ',"more":{"k":true,"z":null},"tags":["a",-1]}' when 4 then '{}' end as arguments,
case k when 2 then 'get_part(id=' || l_partkey || ', oops' when 3 then 'Please look at part ' || l_partkey end as content from k""",
}
