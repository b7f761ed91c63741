"""Queries that write tables in each format and read them back, and streams over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import resume
from corpusmill.sources import files as S
from corpusmill.sources.scratch import fresh
from corpusmill.plans.tables import table
from corpusmill.streaming import memory, sessions


def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON lines and back."""
    path = fresh(spark, "jsonl")
    S.write_jsonl(table(spark, sf_dir, "conversations"), path)
    out = S.read_jsonl(spark, path, "conv_id long, turn long, role string, text string")
    return out.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha"))


def tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every seventh is cut and every eleventh blank: how many are JSON."""
    path = fresh(spark, "lines")
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    e.select(F.when(k % 11 == 0, "  ").when(k % 7 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props")).alias("value")).write.text(path)
    return S.read_jsonl_tolerant(spark, path).groupBy("ok").agg(F.count("*").alias("n"))


def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as one object with a list under `data`."""
    path = fresh(spark, "doc")
    rows = table(spark, sf_dir, "nation").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("data"))
    rows.coalesce(1).write.json(path)
    return S.read_json_document(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


def result_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as a list under `results`."""
    path = fresh(spark, "results")
    table(spark, sf_dir, "benchmark").agg(F.collect_list(F.struct("item_id", "text")).alias("results")).coalesce(1).write.json(path)
    return S.read_results(spark, path).select("item_id", F.sha2("text", 256).alias("text_sha"))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with commas and line feeds as CSV, every value read as text."""
    path = fresh(spark, "csv")
    table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit('say "a", '), F.replace("text", F.lit("\\"), F.lit("/"))).alias("text")).write.csv(path, header=True, escape='"')
    return S.read_csv(spark, path).select("conv_id", "turn", F.sha2("text", 256).alias("text_sha"))


def routed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by price into two folders in one pass, and both read back."""
    path = fresh(spark, "routed")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_totalprice") >= 250000, "high").otherwise("low").alias("route"))
    S.write_routed(o, path)
    return spark.read.json(path).groupBy("route").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


def appended_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of suppliers that stopped half way and went on with what was left."""
    path = fresh(spark, "append")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    resume.append_results(s.where("s_suppkey % 2 = 0"), path)
    left = s.join(spark.read.parquet(path), "s_suppkey", "left_anti")
    resume.append_results(left, path)
    return spark.read.parquet(path)


def metrics_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "metrics")
    S.write_metrics(table(spark, sf_dir, "orders").agg(F.count("*").alias("count"), F.max("o_orderkey").alias("last")), path)
    return spark.read.json(path)


def text_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' segments as text files below a folder, untidy, one row for each file, cleaned."""
    path = fresh(spark, "texts")
    c = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    one = c.select(F.concat(F.lit("  "), "c_mktsegment", F.lit(" \t x\r\n\r\n\r\n"), F.col("n").cast("string"), F.lit("  ")).alias("value"), F.lower("c_mktsegment").alias("seg"))
    one.repartition("seg").write.partitionBy("seg").text(path)
    return S.clean_texts(S.read_texts(spark, path)).select(F.sha2("text", 256).alias("text_sha"))


def problem_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as problems, line items as samples of twice as many."""
    samples = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("task_id"), "l_quantity")
    return S.problems_with_samples(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("task_id"), "p_brand"), samples).groupBy("p_brand").agg(F.count("*").alias("n"))


def datapoint_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = ('{"options": ["a"], "instruction": "i"}', '{"min": 1, "max": 5}', '{"typ": {}, "text": "t"}', '{"typ": {}}', '{"instruction": "i", "response": true}', '{"instruction": "i", "response": "x"}', "{}")
    v = F.try_parse_json(F.get(F.array(*[F.lit(s) for s in shapes]), (F.col("event_id") % 7).cast("int")))
    return table(spark, sf_dir, "events").groupBy(S.datapoint_kind(v).alias("kind")).agg(F.count("*").alias("n"))


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of results for each nation, some without fields, some broken, with what its name says."""
    path = fresh(spark, "runs")
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation").select(F.when(k % 5 == 0, "{oops").when(k % 3 == 0, '{"info": 1}').otherwise('{"info": 1, "tasks": []}').alias("value"), F.concat(F.lit("m"), (k % 4).cast("string")).alias("model"), k.alias("trial"))
    n.repartition("trial").write.partitionBy("model", "trial").option("compression", "none").text(path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.regexp_extract("_metadata.file_path", "model=(m\\d)/trial=(\\d+)", 1).alias("model"), F.regexp_extract("_metadata.file_path", "trial=(\\d+)", 1).cast("int").alias("trial"), "value")
    v = files.withColumn("v", F.try_parse_json(F.trim("value")))
    return v.select("model", "trial", F.when(F.col("v").isNull(), "json").when(F.try_variant_get("v", "$.tasks", "variant").isNull(), "tasks").otherwise("").alias("missing"))


def accepted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as two streamed files: of each kind and user class only the first row of a run is taken, in either batch."""
    source, out = fresh(spark, "in"), fresh(spark, "accepted")
    e = table(spark, sf_dir, "events").select(F.concat("event_type", (F.col("user_id") % 9).cast("string")).alias("question"), "event_id")
    for half in (0, 1):
        e.where(f"event_id % 2 = {half}").coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema("question string, event_id long").json(source)
        sessions.accept_new(stream, out, f"{out}-state", "question", "event_id").awaitTermination()
    return spark.read.parquet(out).select("question", "event_id")


def remembered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions of a first run; a second one asks them again, some in other words, some by halves. Only what
    resembles nothing accepted is taken."""
    source, out = fresh(spark, "asked"), fresh(spark, "remembered")
    b = table(spark, sf_dir, "benchmark")
    first = b.selectExpr("item_id as question_id", "text as question")
    again = b.selectExpr("item_id + 100000 as question_id", "if(item_id % 2 = 1, concat('Oh ', text), substring(text, 1, cast(length(text) div 2 as int))) as question")
    for run in (first, again):
        run.coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema("question_id long, question string").json(source).selectExpr("*", "lpad(cast(question_id as string), 19, '0') as at")
        memory.accept_unlike(stream, out, f"{out}-state", "question_id", "question", "at").awaitTermination()
    return spark.read.parquet(out).select("question_id", "question")


def logged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task results through a stream into a log, each once, though the query runs twice."""
    source, out = fresh(spark, "tasks"), fresh(spark, "log")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.json(source)
    for _ in range(2):
        sessions.append_log(spark.readStream.schema("o_orderkey long, o_orderstatus string").json(source), out, f"{out}-state").awaitTermination()
    return spark.read.json(out).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


QUERIES = {
    f.__name__: f
    for f in (
        jsonl_scan, tolerant_scan, json_document, result_items, csv_scan, routed_sink, appended_results, metrics_sink, text_folder, problem_samples, datapoint_kinds, run_files, accepted_stream, remembered_stream, logged_stream,
    )
}
ORACLES = {
    "jsonl_scan": "select conv_id, turn, role, sha256(text) as text_sha from conversations",
    "tolerant_scan": "select event_id % 7 <> 0 as ok, count(*) as n from events where event_id % 11 <> 0 group by 1",
    "json_document": "select n_nationkey, n_name from nation",
    "result_items": "select item_id, sha256(text) as text_sha from benchmark",
    "csv_scan": "select conv_id::varchar as conv_id, turn::varchar as turn, sha256('say \"a\", ' || replace(text, chr(92), '/')) as text_sha from conversations",
    "routed_sink": "select case when o_totalprice >= 250000 then 'high' else 'low' end as route, count(*) as n, sum(o_orderkey)::bigint as key_sum from orders group by 1",
    "appended_results": "select s_suppkey, s_name from supplier",
    "metrics_sink": "select count(*) as count, max(o_orderkey) as last from orders",
    "text_folder": "select sha256(c_mktsegment || ' x' || chr(10) || chr(10) || count(*)) as text_sha from customer group by c_mktsegment",
    "problem_samples": "select p_brand, count(*) as n from lineitem join part on p_partkey = l_partkey * 2 group by 1",
    "datapoint_kinds": "select ['classify', 'score', 'parse', 'parse_force', 'binary_classify', 'generate', null][event_id % 7 + 1] as kind, count(*) as n from events group by 1",
    "run_files": "select 'm' || n_nationkey % 4 as model, n_nationkey::int as trial, case when n_nationkey % 5 = 0 then 'json' when n_nationkey % 3 = 0 then 'tasks' else '' end as missing from nation",
    "accepted_stream": "with q as (select event_type || (user_id % 9) as question, event_id, event_id % 2 as half from events) select question, event_id from q qualify row_number() over (partition by question order by half, event_id) = 1",
    "logged_stream": "select o_orderstatus, count(*) as n, sum(o_orderkey)::bigint as key_sum from orders group by 1",
}
