"""Sources, sinks, streaming, folds and small cases of the operators."""

from __future__ import annotations

import json
import math
import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from corpusmill.functions import diff as D
from corpusmill.functions import jsonish as J
from corpusmill.functions import text as X
from corpusmill.functions.scoring import bleu4, comb, pass_at_k
from corpusmill.operators import chunking, joins, packing, qa, resume, similarity, split
from corpusmill.sources import files
from corpusmill.streaming import sessions


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"x": 1}\n{oops\n\n')
    (tmp_path / "doc.json").write_text(json.dumps({"data": [{"q": "a"}, {"q": "b"}]}))
    (tmp_path / "list.json").write_text(json.dumps([{"q": "a"}]))
    (tmp_path / "t.csv").write_text('q,a\n"x ""y"", z",1\n')
    (tmp_path / "docs/sub").mkdir(parents=True)
    (tmp_path / "docs/sub/one.md").write_text("# One\n")
    assert files.read_raw(spark, str(tmp_path / "a.json")).count() == 2
    tolerant = files.read_jsonl_tolerant(spark, str(tmp_path / "bad.jsonl"))
    assert sorted(r[0] for r in tolerant.select("ok").collect()) == [False, True]
    assert files.read_raw(spark, str(tmp_path / "doc.json")).count() == 2
    assert files.read_raw(spark, str(tmp_path / "list.json")).count() == 1
    assert files.read_raw(spark, str(tmp_path / "t.csv")).collect()[0][0] == 'x "y", z'
    assert [tuple(r) for r in files.read_texts(spark, str(tmp_path / "docs")).collect()] == [("one", "# One\n")]
    with pytest.raises(ValueError):
        files.read_raw(spark, str(tmp_path / "x.xml"))
    df = spark.createDataFrame([(1, "high"), (2, "low")], "i int, route string")
    files.write_routed(df, str(tmp_path / "routed"))
    assert spark.read.json(str(tmp_path / "routed/route=high")).count() == 1
    resume.append_results(df, str(tmp_path / "out"))
    resume.append_results(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_config_and_templates(tmp_path):
    (tmp_path / "base.yaml").write_text("a: {x: 1, y: [1, 2]}\nb: 2\n")
    (tmp_path / "run.yaml").write_text("include: base.yaml\na: {y: [3]}\n")
    assert files.load_config(str(tmp_path / "run.yaml")) == {"a": {"x": 1, "y": [3]}, "b": 2}
    assert files.template_sections("z\n## A\none\n## B\n\ntwo\n", ("## A", "## B")) == {"## A": "one", "## B": "two"}


def test_select_tasks(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "task_id string")
    assert [r[0] for r in files.select_tasks(df, limit=2).collect()] == ["a", "b"]
    with pytest.raises(KeyError):
        files.select_tasks(df, ["a", "zz"])


def test_text_functions(spark):
    rows = [(0,), (25,), (26,), (701,), (702,)]
    assert [r[0] for r in values(spark, rows, "i int", X.alpha_label(F.col("i")))] == ["A", "Z", "AA", "ZZ", "AAA"]
    got = values(spark, [("  a\x1c ",)], "s string", X.strip(F.col("s")), X.token_count(F.lit("été, x")), X.longest_prefix(F.lit("abcd"), F.array(F.lit("a"), F.lit("abc"), F.lit("b"))))
    assert got == [("a", 3, "abc")]
    filled = values(spark, [("p",)], "v string", X.fill_placeholders(F.lit("{{K}} <K>\n\n\n\nx"), {"K": F.col("v")}))
    assert filled == [("p p\n\nx",)]
    assert len(values(spark, [("y" * 900,)], "s string", X.budgeted(F.lit("h"), F.col("s"), F.lit("f"), 200))[0][0]) <= 200


def test_json_functions(spark):
    rows = [('{"confidence": 0.4}',), ('x ```json\n{"confidence": 0.5}\n```',), ('bad "confidence": 0.6 {',), ("none",)]
    assert [r[0] for r in values(spark, rows, "s string", J.strict_confidence(F.col("s")))] == [0.4, 0.5, 0.6, 0.0]
    rows = [('{"confidence": 0, "answer": "a", "citations": ["c"]}', "Gemma-2"), ('{"confidence": 0, "answer": "a", "citations": ["c"]}', "other"), (json.dumps({"answer": "y" * 101}), "other"), ("w" * 60, "m"), ("I don't know" + "w" * 60, "m")]
    assert [r[0] for r in values(spark, rows, "s string, m string", J.generous_confidence(F.col("s"), F.col("m")))] == [0.7, 0.75, 0.65, 0.7, 0.0]
    a, b = values(spark, [({"x": "1", "y": "2"},), ({"y": "2", "x": "1"},)], "m map<string,string>", J.canonical_hash(F.col("m")))
    assert a == b


def test_reject_reasons_keep_their_order(spark):
    ok = {"answer": "a", "citations": ["c1"], "confidence": 0.5, "provenance": "from_context"}
    cases = [
        ("plain", "no_json_found"), ("x {}", "non_json_output"), ("{a}", "json_parse_error"), ("{}", "bad_provenance"), (json.dumps({**ok, "disclaimer": None}), "unexpected_disclaimer_for_from_context"),
        (json.dumps({**ok, "provenance": "extrapolated", "disclaimer": " "}), "missing_disclaimer_for_extrapolation"), (json.dumps({**ok, "citations": []}), "no_citations"), (json.dumps({**ok, "citations": "c1"}), "no_citations"),
        (json.dumps({**ok, "confidence": 2}), "bad_confidence"), (json.dumps({**ok, "confidence": True}), None), (json.dumps({**ok, "citations": ["zz"]}), "no_context_citation_overlap"), (" " + json.dumps(ok) + "\n", None),
    ]
    rows = spark.createDataFrame([(i, c, ["c1", "c2"]) for i, (c, _) in enumerate(cases)], "i int, answer_raw string, context_chunk_ids array<string>")
    got = {r["i"]: r["reject_reason"] for r in qa.validate(rows, ("i",)).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_combinatorics(spark):
    rows = [(n, c, k) for n in range(1, 7) for c in range(n + 1) for k in range(1, n + 1)]
    got = values(spark, rows, "n int, c int, k int", comb(F.col("c"), F.col("k")), pass_at_k(F.col("n"), F.col("c"), F.col("k")))
    for (n, c, k), (a, b) in zip(rows, got, strict=True):
        assert a == math.comb(c, k) and abs(b - (1 - math.comb(n - c, k) / math.comb(n, k))) < 1e-12


def test_bleu_bounds(spark):
    got = values(spark, [("a b c d e", "a b c d e"), ("a b c", "a b c"), ("", "x"), ("a b c d e f", "a b c d")], "r string, c string", bleu4(F.col("r"), F.col("c")))
    assert [g[0] for g in got] == [1.0, 0.0, 0.0, round(math.exp(1 - 6 / 4), 4)]


def test_ranks_are_total_whatever_the_cuts(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(500)]
    got = split.global_rank(spark.createDataFrame(rows, "k int, i int").repartition(7), "k", "i").orderBy("rank").collect()
    assert [(r["k"], r["i"]) for r in got] == sorted(rows) and [r["rank"] for r in got] == list(range(1, 501))
    with pytest.raises(ValueError):
        split.ratio_split(spark.range(3), "id", 0.5, 0.2, 0.2)


def test_blocks_are_one_run(spark):
    r = random.Random(1)
    rows = [(i, [r.randrange(99) for _ in range(r.randrange(0, 40))]) for i in range(60)]
    flat = [t for _, ids in rows for t in ids]
    got = packing.pack_blocks(spark.createDataFrame(rows, "i int, ids array<int>"), "i", "ids", 16).orderBy("block_no").collect()
    assert [list(g["input_ids"]) for g in got] == [flat[a : a + 16] for a in range(0, len(flat) - 15, 16)]


def test_paragraphs(spark):
    paras = ["p" * n for n in (500, 800, 3000, 100, 5000, 20)]
    got = chunking.pack_paragraphs(spark.createDataFrame([(1, "\n\n".join(paras)), (2, " ")], "i int, text string")).collect()
    chunks, buf, size = [], [], 0
    for p in paras:
        if size + len(p) > 4000 and size >= 1200:
            chunks.append("\n\n".join(buf))
            buf, size = [], 0
        buf.append(p)
        size += len(p) + 2
    chunks.append("\n\n".join(buf))
    assert [r["chunk"] for r in got] == chunks


def test_greedy_pass_is_sequential(spark):
    r = random.Random(2)
    pairs = {tuple(sorted(r.sample(range(40), 2))) for _ in range(60)}
    kept: list[int] = []
    for i in range(40):
        if not any((j, i) in pairs for j in kept):
            kept.append(i)
    got = similarity.greedy_keep(spark.createDataFrame(sorted(pairs), "a long, b long"), spark.range(40), "id")
    assert sorted(x[0] for x in got.collect()) == kept
    rounds = similarity.greedy_keep(spark.createDataFrame(sorted(pairs), "a long, b long"), spark.range(40), "id", links=3)
    assert sorted(x[0] for x in rounds.collect()) == kept


def test_greedy_pass_makes_its_pairs_once(spark):
    """However many rounds a chain takes."""
    made = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    chain = spark.range(12).selectExpr("id as a", "id + 1 as b").mapInArrow(noted, "a long, b long")
    got = similarity.greedy_keep(chain, spark.range(13), "id", links=0)
    assert sorted(x[0] for x in got.collect()) == list(range(0, 13, 2))
    assert made.value == 12


def test_parts_in_order_meet_by_their_steps(spark):
    """By equal keys: no plan that compares each part with each other."""
    from corpusmill.plans import metrics

    seen = []
    was = similarity.greedy_keep
    try:
        similarity.greedy_keep = lambda pairs, ids, id_col: seen.append(pairs) or ids
        metrics.greedy_dedup(spark, DATA)
    finally:
        similarity.greedy_keep = was
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fuzzy_pairs(spark):
    from difflib import SequenceMatcher

    texts = ["How does the retry work?", "how does the retry work", "How do retries work?", "What is a mandate?", "What's a mandate?", ""]
    want = {(i, j) for i in range(5) for j in range(i + 1, 5) if SequenceMatcher(None, texts[i].lower().strip(), texts[j].lower().strip()).ratio() >= 0.85}
    got = similarity.fuzzy_pairs(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "i", "t")
    assert {tuple(r) for r in got.collect()} == want


def test_diff_chunks_lose_nothing(spark):
    lines = [f"+line {i} " + "x" * (i % 7) for i in range(60)]
    chunks = values(spark, [("\n".join(lines),)], "d string", D.chunk_diff(F.col("d"), 200, 2))[0][0]
    assert all(len(c) <= 200 for c in chunks) and list(dict.fromkeys(x for c in chunks for x in c.split("\n"))) == lines


def test_streams(spark, tmp_path):
    schema = "q string, i int, ts timestamp"
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: sessions.accept_new(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "out"), str(tmp_path / "ck"), "q", "i").awaitTermination()
    (src / "1.json").write_text('{"q": "a", "i": 2, "ts": "2024-01-01T00:00:00"}\n{"q": "a", "i": 1, "ts": "2024-01-01T00:00:00"}\n{"q": "b", "i": 3, "ts": "2024-01-01T00:30:00"}\n')
    run()
    (src / "2.json").write_text('{"q": "b", "i": 4, "ts": "2024-01-01T02:00:00"}\n{"q": "c", "i": 5, "ts": "2024-01-01T02:00:00"}\n')
    run()
    assert sorted((r["q"], r["i"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 1), ("b", 3), ("c", 5)]
    sessions.append_log(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "log"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.json(str(tmp_path / "log")).count() == 5
    q = sessions.windowed_counts(spark.readStream.schema(schema).json(str(src)), "ts", "q").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from counts").first()[0] == 5


def test_orders_of_many_ranges(spark, monkeypatch):
    """Ranges of thirty rows, keys that repeat, nulls: ranks and sums as of one window."""
    r = random.Random(9)
    monkeypatch.setattr(split, "ROWS", 30)
    rows = [(r.choice([None, *range(20)]), r.choice("abc"), i, r.randrange(5)) for i in range(1500)]
    df = spark.createDataFrame(rows, "a int, b string, i int, v long").repartition(7)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    want, before = {}, 0
    for n, (_, _, i, v) in enumerate(order):
        want[i] = (n + 1, before)
        before += v
    ranked = split.global_rank(df, "a", "b", "i")
    sums = split.running_sum(df, "v", "a", "b", "i")
    assert {x["i"]: x["rank"] for x in ranked.collect()} == {i: w[0] for i, w in want.items()}
    assert {x["i"]: x["before"] for x in sums.collect()} == {i: w[1] for i, w in want.items()}
    blocks = packing.pack_blocks(df.select("i", F.array_repeat("i", F.col("v").cast("int")).alias("ids")), "i", "ids", 64)
    flat = [i for i, v in sorted((x[2], x[3]) for x in rows) for _ in range(v)]
    assert {b["block_no"]: b["input_ids"] for b in blocks.collect()} == {k: flat[64 * k : 64 * k + 64] for k in range(len(flat) // 64)}


def test_json_is_strict(spark):
    texts = ['{"a": 1}', '{"a": 1} x', "1], [2", '1}, {"v": 2', "[1, 2]", "1, 2", "null", "", None, ' "t" ', "{a: 1}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(J.is_json(F.col("t")), J.parsed(F.col("t")).isNotNull()).collect()]
    assert got == [(True, True)] + [(False, False)] * 3 + [(True, True), (False, False), (True, False)] + [(False, False)] * 2 + [(True, True), (False, False)]


def test_one_stop_counts_are_those_of_the_pairs(spark):
    """By place, day and time; next-day arrivals, and nulls on either side, too."""
    r = random.Random(4)
    rows = [(i, r.choice([None, *range(3)]), r.choice([None, *range(3)]), r.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]), r.choice([None, "01:00:00", "09:30:00", "22:00:00"]), r.choice([None, "03:00:00", "09:30:00", "01:00:00+1"])) for i in range(300)]
    legs = spark.createDataFrame(rows, "i int, orig int, dest int, day string, dep string, arr string").withColumn("day", F.col("day").cast("date"))
    args = (legs, legs, "orig", "dest", "arr", "dep", "day")
    want = {x.a_day: x.n for x in joins.one_stop(*args).groupBy("a_day").agg(F.count("*").alias("n")).collect()}
    counts = joins.one_stop_counts(*args)
    assert want and {x.a_day: x.n for x in counts.collect()} == want
    assert "Join" not in counts._jdf.queryExecution().executedPlan().toString()
