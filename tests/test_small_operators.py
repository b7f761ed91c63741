"""Operators that no query reaches, by hand, and SARI against a computation of its own."""

from __future__ import annotations

import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from corpusmill.functions import diff, jsonish, rust
from corpusmill.operators import analysis, evaluation, qa, records, resume, similarity, split
from corpusmill.operators.calls import BUILDERS, builder
from corpusmill.sources import files


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_prompts_and_messages(spark):
    assert one(spark, records.fallback_prompt(F.lit("Be brief"), F.lit("Hi"))) == "System: Be brief\nUser: Hi\nAssistant:"
    assert one(spark, records.fallback_prompt(F.lit(None).cast("string"), F.lit("Hi"))) == "User: Hi\nAssistant:"
    chunks = F.array(F.struct(F.lit("d_1").alias("chunk_id"), F.lit("one").alias("text")), F.struct(F.lit("d_2").alias("chunk_id"), F.lit("two").alias("text")))
    assert one(spark, records.chunk_lines(chunks)) == "[d_1] one\n[d_2] two"
    assert one(spark, records.call_text(F.lit("get"), F.create_map(F.lit("z"), F.lit("2"), F.lit("a"), F.lit("1")))) == "get(a=1, z=2)"
    df = spark.createDataFrame([(1, "Q?", "A.", ["c1", "c2"])], "id int, question string, answer string, citations array<string>")
    row = records.export_messages(df, "sys", ("id",)).first()
    assert [m.role for m in row.messages] == ["system", "user", "assistant"] and row.id == 1
    assert row.messages[1].content == "Q?\n\nCITED CONTEXT:\n[c1] (excerpt) ...\n[c2] (excerpt) ..." and row.messages[2].content == "A.\n\nCitations: c1, c2"


def test_names_hashes_and_shares(spark, tmp_path):
    @builder("mine")
    def build(x):
        return x

    assert BUILDERS["mine"] is build
    a, b = one(spark, resume.config_hash(F.lit(1).alias("k"), F.lit("m").alias("n"))), one(spark, resume.config_hash(F.lit(2).alias("k"), F.lit("m").alias("n")))
    assert len(a) == 64 and a != b
    assert one(spark, jsonish.trim_keys(F.create_map(F.lit(" a "), F.lit(1)))) == {"a": 1}
    assert one(spark, jsonish.ndjson_content(F.lit('{"message":{"content":"x"}}\nnone\n{"message":{"content":" y"}}'))) == "x y"
    assert one(spark, qa.grounded(F.lit(0.25), F.lit(0.6))) and not one(spark, qa.grounded(F.lit(0.9), F.lit(0.59)))
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), (None, 4.0)], "kind string, w double")
    assert sorted(r.share for r in split.normalized_weights(df, "w").collect()) == [0.125, 0.125, 0.25, 0.5]
    assert {r.kind: r.percent for r in analysis.fault_distribution(df, "kind").collect()} == {"a": 66.67, "b": 33.33}
    path = str(tmp_path / "run_m1_t2.csv")
    files.write_csv(df.coalesce(1), path)
    assert spark.read.csv(path, header=True).count() == 4
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "model=a_trial=3.txt").write_text("hello")
    named = files.with_run_parameters(spark.read.text(str(tmp_path / "in")), r"model=(\w)_trial=(\d)", ["model", "trial"]).select("value", "model", "trial")
    assert tuple(named.first()) == ("hello", "a", "3")


def test_rust_and_behaviours(spark):
    assert one(spark, rust.wrap_tests(F.lit("#[cfg(test)] mod t {}"))) == "#[cfg(test)] mod t {}"
    assert one(spark, rust.wrap_tests(F.lit("fn f() {}"))) == "#[cfg(test)]\nmod tests {\n    use super::*;\n\nfn f() {}\n}"
    assert one(spark, diff.behavior_gap(F.lit("- Primary behavior change: adds a retry"), F.lit("- Primary behavior change: adds a retry"))) == "OK"


def sari(source: str, pred: str, ref: str) -> float:
    """By counts over every n-gram that occurs in any of the three, as the paper has them for one reference."""
    texts = [t.lower().split() for t in (source, pred, ref)]
    total = Fraction(0)
    for n in range(1, 5):
        grams = [[tuple(t[i : i + n]) for i in range(len(t) - n + 1)] for t in texts]
        every = set().union(*grams)
        s, c, r = ({g: x.count(g) for g in every} for x in grams)
        kept = {g: min(s[g], c[g]) for g in every}
        wanted = {g: min(s[g], r[g]) for g in every}
        dropped = {g: max(s[g] - c[g], 0) for g in every}

        def mean(parts):
            parts = list(parts)
            return sum(parts, Fraction(0)) / len(parts) if parts else Fraction(1)

        keep_p = mean(Fraction(min(kept[g], wanted[g]), kept[g]) for g in every if kept[g])
        keep_r = mean(Fraction(min(kept[g], wanted[g]), wanted[g]) for g in every if wanted[g])
        drop_p = mean(Fraction(min(dropped[g], max(dropped[g] - r[g], 0)), dropped[g]) for g in every if dropped[g])
        new, right = {g for g in every if c[g] and not s[g]}, {g for g in every if r[g] and not s[g]}
        add_p = Fraction(len(new & right), len(new)) if new else Fraction(1)
        add_r = Fraction(len(new & right), len(right)) if right else Fraction(1)
        f = lambda p, q: 2 * p * q / (p + q) if p + q else Fraction(0)
        total += (f(keep_p, keep_r) + drop_p + f(add_p, add_r)) / 3
    return float(100 * total / 4)


def test_sari_and_rouge(spark):
    r = random.Random(2)
    text = lambda: " ".join(r.choice("abcde") for _ in range(r.randrange(1, 12)))
    rows = [(i, text(), text(), text()) for i in range(120)]
    df = spark.createDataFrame(rows, "i int, s string, p string, t string")
    got = {x.i: (x.sari, x.l) for x in df.select("i", similarity.sari(F.col("s"), F.col("p"), F.col("t")).alias("sari"), similarity.rouge_l(F.col("p"), F.col("t")).alias("l")).collect()}

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for i, s, p, t in rows:
        assert abs(got[i][0] - sari(s, p, t)) < 1e-9, (s, p, t)
        a, b = p.split(), t.split()
        assert abs(got[i][1] - 2 * lcs(a, b) / (len(a) + len(b))) < 1e-12


def test_negatives_hold_few_similarities_at_once(spark, monkeypatch):
    """The same rows however few; and a task that gets many rows needs little memory for them."""
    r = random.Random(5)
    e = spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(6)], r.randrange(4)) for i in range(400)], "vec_id long, v array<double>, label int").repartition(2)
    args = (e.where("vec_id % 4 = 0"), e, "vec_id", "v", "label", 3)
    rows = lambda: sorted(map(tuple, similarity.hard_negatives(*args, skip=1, least=-0.5, most=0.95, margin=0.02).collect()))
    want = rows()
    monkeypatch.setattr(similarity, "HELD", 700)
    assert want and rows() == want

    monkeypatch.undo()
    peaks = []

    class Caught:
        """Runs a task's function here, and keeps the largest matrix that it rounds."""

        floor = staticmethod(similarity.np.floor)

    def floor(x):
        peaks.append(x.size)
        return Caught.floor(x)

    many = e.crossJoin(spark.range(30)).selectExpr("vec_id + 1000 * id as vec_id", "v", "label")
    batch = many.toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(similarity.np, "floor", floor)
    seen = []
    monkeypatch.setattr(type(e), "mapInArrow", lambda self, f, shape, *a, **k: seen.append(f) or self.selectExpr("vec_id as anchor", "vec_id as negative", "0D as sim"))
    similarity.hard_negatives(many.where("vec_id % 20 = 0"), many, "vec_id", "v", "label", 3)
    list(seen[-1](iter([batch])))
    assert peaks and max(peaks) <= similarity.HELD


def test_replies_and_calls_are_parsed_once(spark):
    """However many fields are read; a call's parse stands where it is asked for, and not again for each field."""
    scores = evaluation.judge_scores(F.col("o"), F.col("r"), "generation")
    call = jsonish.tool_call(F.col("r"))
    assert [str(c).count("try_parse_json") for c in (scores, call)] == [1, 3]
    rows = spark.createDataFrame([("x", '{"functional_correctness": 0.5, "syntax_validity": "n"}'), ("", '{"task_completion": 1}'), ("x", "no"), ("x", None)], "o string, r string")
    none = {"functional_correctness": 0.0, "task_completion": 0.0, "syntax_validity": 0.0}
    assert [x.s for x in rows.select(scores.alias("s")).collect()] == [none | {"functional_correctness": 0.5}, none, none, none]
    calls = spark.createDataFrame([(' {"name": "f", "arguments": {"b": 1}}',), ("f(a=1)",), ("f(a=1)",), ('["name"]',), ('{"name": "f", "arguments": 3}',), ('{"name": null, "arguments": {}}',), (None,)], "r string")
    assert [x.c and tuple(x.c) for x in calls.select(call.alias("c")).collect()] == [("f", '{"b":1}'), ("f", '{"a":1}'), ("f", '{"a":1}'), None, None, None, None]


def test_words_are_counted_where_their_texts_lie(spark):
    """No words by text cross between tasks."""
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (2, "bb")], "doc_id long, text string")
    out = similarity.tf_idf(docs, "doc_id", "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, term#", plan)
    assert {(x.doc_id, x.term, x.df) for x in out.collect()} == {(1, "aa", 1), (1, "bb", 2), (2, "bb", 2), (2, "cc", 1)}
