"""Queries on documents: chunks, tokens, cleaning, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators.chunking import chunk_records, pack_paragraphs, tag_documents, word_chunks, word_windows, word_windows
from corpusmill.plans.tables import table


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = word_windows(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return chunks.groupBy("lang").agg(F.count("*").alias("n_chunks"), F.countDistinct("doc_id").alias("n_docs"), F.sum("n_words").alias("n_words"), F.max("idx").alias("max_idx"))


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunk_records(table(spark, sf_dir, "documents"))
    return out.select("chunk_id", "doc_id", "idx", F.sha2("text", 256).alias("text_sha"), "tokens")


def text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.token_count(t).alias("tokens"), X.char_tokens(t).alias("char_tokens"), F.size(X.word_list(t)).alias("words"), F.sha2(X.preview(t), 256).alias("preview_sha"), F.sha2(X.sanitize(t), 256).alias("sanitized_sha"))


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning of texts made untidy on purpose."""
    t = F.concat(F.lit("  \r\n"), F.replace("text", F.lit(". "), F.lit(".  \t\n\n\n")), F.lit("\x01 \n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(X.squeeze_space(t), 256).alias("squeezed"), F.sha2(X.clean_paragraphs(t), 256).alias("cleaned"), F.sha2(X.drop_controls(t), 256).alias("printable"),
        F.sha2(X.fold_behavior(t), 256).alias("folded"), F.sha2(X.letters_digits(F.col("text")), 256).alias("alnum"), X.safe_dir(F.concat(F.lit("/a:"), "source", F.lit("#@b/"))).alias("dir"),
    )


def _tagged(spark: SparkSession, sf_dir: str, head: F.Column, tail: F.Column) -> DataFrame:
    t = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<think>"), head, F.lit("</think>"), tail)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("<think>"), head, F.lit("\n"), tail)).otherwise(F.concat(head, F.lit("<Reasoning>x\ny</Reasoning>"), tail))
    rows = table(spark, sf_dir, "documents").select("doc_id", t.alias("t"))
    return rows.select("doc_id", F.sha2(X.drop_think(F.col("t")), 256).alias("dropped"), F.sha2(X.drop_reasoning(F.col("t")), 256).alias("reasoned"), F.sha2(X.after_think(F.col("t")), 256).alias("after"), X.unclosed_think(F.col("t")).alias("unclosed"))


def think_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of a text stands in the tags, the second half behind them."""
    return _tagged(spark, sf_dir, F.expr("substring(text, 1, length(text) div 2)"), F.expr("substring(text, length(text) div 2 + 1)"))


def code_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.lit("Here:\n```rust\nfn f"), F.col("item_id").cast("string"), F.lit("() {}\n```\n"), "text")
    rows = table(spark, sf_dir, "benchmark").select("item_id", t.alias("t"))
    return rows.select("item_id", X.fenced_code(F.col("t")).alias("code"), F.sha2(X.drop_fences(F.col("t")), 256).alias("bare"), X.alpha_label(F.col("item_id")).alias("label"))


def paragraph_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    packs = pack_paragraphs(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), separator="\n", most=1500, least=400)
    return packs.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(F.length("chunk")).alias("chars"), F.max(F.length("chunk")).alias("longest"))


def tagged_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = word_chunks(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), 100, 0)
    return tag_documents(chunks, "source").select("doc_id", "idx", F.sha2("tagged", 256).alias("tagged_sha"), F.length("tagged").alias("n_chars"))


def average_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.round(F.avg(F.length("text")), 1).alias("avg_chars"), F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (chunk_stats, chunk_rows, text_profile, text_clean, think_tags, code_fences, paragraph_packs, tagged_chunks, average_length)}
_STRIP = r"regexp_replace({0}, '^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g')"
_STRIP_T = _STRIP.format("t")
ORACLES = {
    "chunk_stats": r"""
with d as (select doc_id, lang, len(regexp_extract_all(text, '[^\s]+')) as n from documents),
c as (select doc_id, lang, n, unnest(range(0, n, 320)) as s from d where n > 0)
select lang, count(*) as n_chunks, count(distinct doc_id) as n_docs, sum(least(380, n - s))::bigint as n_words, max(s // 320)::int as max_idx from c group by lang
""",
    "chunk_rows": r"""
with d as (select doc_id, regexp_extract_all(text, '[^\s]+') as w from documents),
c as (select doc_id, w, unnest(range(0, len(w), 320)) as s from d where len(w) > 0),
t as (select doc_id, (s // 320)::int as idx, array_to_string(w[s + 1:s + 380], ' ') as x from c)
select printf('%d_%04d', doc_id, idx) as chunk_id, doc_id, idx, sha256(x) as text_sha, greatest(1, len(regexp_extract_all(x, '[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]')))::int as tokens from t
""",
    "text_profile": r"""
select doc_id, greatest(1, len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]')))::int as tokens, (length(text) // 4)::int as char_tokens, len(regexp_extract_all(text, '[^\s]+'))::int as words,
sha256(case when length(text) > 1200 then substr(text, 1, 1200) || '...' else text end) as preview_sha, sha256(substr(regexp_replace(text, '^\s+|\s+$', '', 'g'), 1, 4096)) as sanitized_sha from documents
""",
    "text_clean": rf"""
with d as (select doc_id, source, text, '  ' || chr(13) || chr(10) || replace(text, '. ', '.  ' || chr(9) || chr(10) || chr(10) || chr(10)) || chr(1) || ' ' || chr(10) as t from documents)
select doc_id, sha256({_STRIP.format(r"regexp_replace(regexp_replace(replace(t, chr(13) || chr(10), chr(10)), '[ \t]+', ' ', 'g'), '\n{2,}', chr(10) || chr(10), 'g')")}) as squeezed,
sha256({_STRIP.format(r"regexp_replace(regexp_replace(t, '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')")}) as cleaned,
sha256(regexp_replace(t, '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g')) as printable,
sha256(regexp_replace(lower({_STRIP_T}), '[\s\x0b\x1c-\x1f]+', ' ', 'g')) as folded,
sha256(lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g'))) as alnum, 'a-' || source || '-b' as dir from d
""",
    "think_tags": rf"""
with d as (select doc_id, substr(text, 1, length(text) // 2) as h, substr(text, length(text) // 2 + 1) as l from documents),
x as (select doc_id, case when doc_id % 3 = 0 then '<think>' || h || '</think>' || l when doc_id % 3 = 1 then '<think>' || h || chr(10) || l else h || '<Reasoning>x' || chr(10) || 'y</Reasoning>' || l end as t from d)
select doc_id, sha256({_STRIP.format(r"regexp_replace(regexp_replace(t, '(?s)<think>.*?</think>', '', 'g'), '\n\s*\n\s*\n', chr(10) || chr(10), 'g')")}) as dropped,
sha256({_STRIP.format("regexp_replace(regexp_replace(t, '(?si)<think>.*?</think>', '', 'g'), '(?si)<reasoning>.*?</reasoning>', '', 'g')")}) as reasoned,
sha256({_STRIP.format("string_split(t, '</think>')[-1]")}) as after, contains(t, '<think>') and not contains(t, '</think>') as unclosed from x
""",
    "code_fences": rf"""
with x as (select item_id, 'Here:' || chr(10) || '```rust' || chr(10) || 'fn f' || item_id || '() {{}}' || chr(10) || '```' || chr(10) || text as t from benchmark)
select item_id, 'fn f' || item_id || '() {{}}' as code, sha256({_STRIP.format("replace(replace(t, '```rust', ''), '```', '')")}) as bare,
case when item_id < 26 then chr((65 + item_id)::int) when item_id < 702 then chr((64 + item_id // 26)::int) || chr((65 + item_id % 26)::int) else chr((64 + (item_id - 26) // 676)::int) || chr((65 + (item_id - 26) // 26 % 26)::int) || chr((65 + item_id % 26)::int) end as label from x
""",
    "paragraph_packs": rf"""
with recursive p as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIP.format("x")}), lambda x: x <> '') as ps from documents),
f as (
  select doc_id, ps, 0 as i, 0 as size, 0 as items, 0 as chars, [0]::bigint[] as done from p
  union all
  select doc_id, ps, i + 1, (case when c then 0 else size end) + length(ps[i + 1]) + 2, (case when c then 0 else items end) + 1, (case when c then 0 else chars end) + length(ps[i + 1]), case when c then list_append(done, (chars + items - 1)::bigint) else done end
  from (select *, size + length(ps[i + 1]) > 1500 and size >= 400 as c from f where i < len(ps))
),
l as (select doc_id, case when items > 0 then list_append(done, (chars + items - 1)::bigint) else done end as done from f where i = len(ps))
select doc_id, (len(done) - 1)::bigint as n_chunks, list_sum(done)::bigint as chars, list_max(done)::int as longest from l where len(done) > 1
""",
    "tagged_chunks": r"""
with d as (select doc_id, source, regexp_extract_all(text, '[^\s]+') as w from documents),
c as (select doc_id, source, w, unnest(range(0, len(w), 100)) as s from d where len(w) > 0),
t as (select doc_id, source, (s // 100)::int as idx, array_to_string(w[s + 1:s + 100], ' ') as x from c),
g as (select doc_id, idx, '<doc>' || chr(10) || 'TITLE: ' || source || chr(10) || 'BODY:' || chr(10) || x as y from t where length(x) >= 200)
select doc_id, idx, sha256(y) as tagged_sha, length(y)::int as n_chars from g
""",
    "average_length": "select lang, round(avg(length(text)), 1) as avg_chars, count(*) as n from documents group by lang",
}
