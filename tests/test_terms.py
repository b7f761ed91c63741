"""Packed batches of term counts and the pairs made of them, against plain counting."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import DATA

from corpusmill.operators import similarity, terms


def bags(rows):
    out = {}
    for i, t in rows:
        out.setdefault(i, Counter()).update(re.findall(r"\b\w\w+\b", (t or "").lower()))
    return out


@pytest.mark.parametrize("repeated", [False, True])
def test_batches_have_all_counts(spark, monkeypatch, repeated):
    monkeypatch.setattr(terms, "BATCH", 500)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += [(9001, None), (9002, "")] + ([(None, "the null one"), (None, "the other"), (rows[0][0], "again the first")] if repeated else [])
    want = bags(rows)
    df = Counter(w for c in want.values() for w in c)
    hashes = {r.w: np.uint64(r.h & (2**64 - 1)) for r in spark.createDataFrame([(w,) for w in df], "w string").selectExpr("w", "xxhash64(w) as h").collect()}
    got, ids = {}, []
    for r in terms.term_batches(spark.createDataFrame(rows, "i long, t string").repartition(3), "i", "t").collect():
        these, word, n, text, code, tf = terms.read_batch(r.ids, r.size, bytes(r.body))
        ids += these
        for x, c, k in zip(text, code, tf, strict=True):
            got[these[x], int(word[c])] = (int(k), int(n[c]))
    assert sorted(map(str, ids)) == sorted(map(str, want))
    assert got == {(i, int(hashes[w])): (k, df[w]) for i, c in want.items() for w, k in c.items()}


def test_pairs_by_brute_force(spark, monkeypatch):
    """Copies, near copies with words changed at either end of rarity, rows that repeat an id, odd texts; few slots for marks."""
    monkeypatch.setattr(terms, "BATCH", 400)
    monkeypatch.setattr(similarity, "SLOTS", 64)
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(r.choices(vocab, weights=[300 / (i + 1) for i in range(300)], k=r.randrange(5, 60))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        for k in range(3):
            v = list(w)
            for _ in range(k):
                v[r.randrange(len(v))] = r.choice([*vocab, f"new{i}{k}"])
            rows.append((100 + 3 * i + k, " ".join(v)))
    rows += [(900, None), (901, ""), (902, "a"), (None, base[0]), (3, "more words w1 w2")]
    want, n = bags(rows), len(rows)
    df = Counter(w for c in want.values() for w in c)
    vec = {}
    for i, c in want.items():
        x = {w: k * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in c.items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        vec[i] = {w: v / size for w, v in x.items()}
    ids = sorted(i for i in vec if i is not None)
    pairs = {(a, b): sum(v * vec[b].get(w, 0) for w, v in vec[a].items()) for a in ids for b in ids if a < b}
    docs = spark.createDataFrame(rows, "i long, t string").repartition(3)
    for threshold in (0.92, 0.6, 0.99):
        got = {(x.a, x.b): x.sim for x in similarity.cosine_pairs(docs, "i", "t", threshold).collect()}
        assert {p for p, s in pairs.items() if s >= threshold + 1e-9} <= set(got) <= {p for p, s in pairs.items() if s >= threshold - 1e-9}
        assert all(abs(s - pairs[p]) < 1e-9 for p, s in got.items())
    assert similarity.cosine_pairs(docs.limit(0), "i", "t").count() == 0
