"""Fuzzy session memory against a sequential pass."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

from corpusmill.streaming.memory import accept_unlike, keys


def ratio(a, b):
    return SequenceMatcher(None, a.lower().strip(), b.lower().strip()).ratio()


def questions(seed: int, n: int):
    r = random.Random(seed)
    base = ["What does the regulation say about cells?", "How many cells may a site have?", "Who signs the report", "Which form is due by May", "Why"]
    out = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(9)):
            if not w:
                break
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice(["", "x", "zz", w[k], w[k].upper()])
        out.append((i, "".join(w) if i % 13 else r.choice([None, "", " "])))
    return out


def sequential(batches):
    kept: list[tuple[int, str]] = []
    for batch in batches:
        for i, q in batch:
            if q and all(ratio(t, q) < 0.85 for _, t in kept):
                kept.append((i, q))
    return kept


def test_like_a_sequential_pass_over_batches_and_restarts(spark, tmp_path):
    rows = questions(4, 90)
    batches = [rows[:30], rows[30:60], rows[60:]]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for b in batches:  # each a query of its own: it goes on from the state that the one before left
        spark.createDataFrame(b, "id long, q string").coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema("id long, q string").json(source).selectExpr("id", "q", "lpad(cast(id as string), 9, '0') as at")
        accept_unlike(stream, out, state, "id", "q", "at").awaitTermination()
    got = sorted((r.id, r.q) for r in spark.read.parquet(out).collect())
    assert got == sequential(batches)


def test_texts_that_are_alike_have_a_key_in_common():
    rows = [q for _, q in questions(5, 150) if q]
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if ratio(a, b) >= 0.85:
                assert set(keys(a.lower().strip(), 0.85)) & set(keys(b.lower().strip(), 0.85))


def test_query_over_the_benchmark(spark):
    from conftest import DATA

    from corpusmill.plans.registry import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").orderBy("item_id").collect()]
    again = [(i + 100_000, ("Oh " + t) if i % 2 else t[: len(t) // 2]) for i, t in rows]
    want = [i for i, _ in sequential([rows, again])]
    assert sorted(r.question_id for r in QUERIES["remembered_stream"](spark, DATA).collect()) == want
