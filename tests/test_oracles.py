"""Every query of the library against its SQL."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pytest
from conftest import DATA, same_as_oracle

from corpusmill.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    same_as_oracle(spark, QUERIES[name], ORACLES[name])


def test_all_but_these_have_sql():
    assert set(QUERIES) - set(ORACLES) == {"near_dup_keep", "order_ratio", "fuzzy_dups", "grounding", "remembered_stream"}


def benchmark(spark) -> list[tuple[int, str]]:
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]


def test_order_ratio_by_brute_force(spark):
    def lcs(a: list, b: list) -> int:
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    def changed(text: str, n: int) -> str:
        return " ".join(f"{w} {w}" if i % n == 0 else w for i, w in enumerate(text.split(" ")))

    out = {r["item_id"]: r for r in QUERIES["order_ratio"](spark, DATA).collect()}
    rows = benchmark(spark)
    assert len(out) == len(rows)
    for i, text in rows[:12]:
        assert out[i]["ratio"] == round(SequenceMatcher(None, text.lower().strip(), text[::-1].lower().strip()).ratio(), 6)
        a, b = (re.findall("[a-z0-9]+", t.lower()) for t in (text, changed(text, 3)))
        assert abs(out[i]["rouge_l"] - 2 * lcs(a, b) / (len(a) + len(b))) < 2e-6
        assert 0 <= out[i]["sari"] <= 100


def test_near_dup_keep_by_brute_force(spark):
    pairs = {(r["a"], r["b"]) for r in QUERIES["near_dup_pairs"](spark, DATA).collect()}
    kept: list[int] = []
    for (i,) in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").orderBy("doc_id").collect():
        if not any((j, i) in pairs for j in kept):
            kept.append(i)
    assert sorted(r["doc_id"] for r in QUERIES["near_dup_keep"](spark, DATA).collect()) == kept


def test_fuzzy_dups_by_brute_force(spark):
    rows = benchmark(spark)
    rows += [(i + 1000, "Oh " + t) for i, t in rows]
    want = set()
    for n, (i, t) in enumerate(rows):
        for j, u in rows[n + 1 :]:
            m = SequenceMatcher(None, t.lower().strip(), u.lower().strip())
            if m.real_quick_ratio() >= 0.85 and m.quick_ratio() >= 0.85 and m.ratio() >= 0.85:
                want.add((min(i, j), max(i, j)))
    assert {tuple(r) for r in QUERIES["fuzzy_dups"](spark, DATA).collect()} == want
