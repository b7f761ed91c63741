"""The n-gram model and the weighted interleave by their laws."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from corpusmill.operators import ngram_model as N
from corpusmill.operators.split import interleave


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_of_every_context_sum_to_one(spark, order):
    r = random.Random(order)
    vocab = [f"w{i}" for i in range(15)]
    rows = [(i, " ".join(r.choices(vocab, weights=range(1, 16), k=r.randrange(12)))) for i in range(60)] + [(99, None), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = N.fit_ngrams(docs, "text", order=order)
    known = {w for _, t in rows for w in (t or "").split()}
    assert model.words == len(known) + 1
    contexts = ["w14 w13", "<s> <s>", "w1 never", "never never", "<s> w14"] if order == 3 else ["w14", "<s>", "never"] if order == 2 else [""]
    asked = spark.createDataFrame([(c, w) for c in contexts for w in [*known, N.END, "never"]], "context string, word string")
    sums: Counter = Counter()
    for c, w, p in N.gram_probabilities(model, asked).collect():
        assert 0 < p < 1
        sums[c] += p
    assert all(abs(sums[c] - 1) < 1e-9 for c in contexts)
    out = {r.doc_id: r for r in N.text_nll(model, docs, ["doc_id"], "text").collect()}
    assert out[99].n_words == out[98].n_words == 1 and out[99].nll == out[98].nll
    assert all(out[i].n_words == len((t or "").split()) + 1 and out[i].nll > 0 for i, t in rows)


def test_draws_of_an_interleave(spark):
    """Shares within binomial bounds, order within a source, the first exhausted source ends it, any partitioning."""
    sizes, weights = {"a": 9000, "b": 9000, "c": 2000}, {"a": 0.5, "b": 0.3, "c": 0.2}
    rows = [(s, i) for s, n in sizes.items() for i in range(n)] + [("d", 1), (None, 2), ("a", None)]
    df = spark.createDataFrame(rows, "s string, i long")
    merged = [sorted(((r.slot, r.s, r.i) for r in interleave(df.repartition(k), "s", "i", weights).collect())) for k in (1, 7)]
    assert merged[0] == merged[1]
    out = merged[0]
    n, share = len(out), Counter(s for _, s, _ in out)
    assert any(share[s] == sizes[s] and out[-1][1] == s for s in sizes)
    for s, w in weights.items():
        assert [i for _, t, i in out if t == s] == list(range(share[s]))
        assert abs(share[s] - n * w) < 5 * math.sqrt(n * w * (1 - w))
    # A draw doesn't depend on the one before it.
    pairs = Counter(zip((s for _, s, _ in out), (s for _, s, _ in out[1:])))
    for (x, y), m in pairs.items():
        p = weights[x] * weights[y]
        assert abs(m - n * p) < 6 * math.sqrt(n * p * (1 - p))
    other = sorted((r.slot, r.s, r.i) for r in interleave(df, "s", "i", weights, seed=7).collect())
    assert [x[1] for x in other[:200]] != [x[1] for x in out[:200]]
    assert interleave(df.limit(0), "s", "i", weights).count() == 0


@pytest.mark.parametrize("order", [2, 3, 4])
def test_fitted_nll_is_that_of_the_model(spark, order, monkeypatch):
    """Several batches and parts, words beyond the common ones, texts that are null, empty, repeated or held out, null keys."""
    monkeypatch.setattr(N, "COMMON", 5)
    monkeypatch.setattr(N, "BATCH", 150)
    monkeypatch.setattr(N, "PART", 100)
    monkeypatch.setattr(N, "SEEN", 1)
    r = random.Random(order)
    rows = [(i, "x" if i % 3 else None, " ".join(r.choices([f"w{k}" for k in range(30)], weights=range(1, 31), k=r.randrange(20)))) for i in range(80)]
    rows += [(90, "x", None), (91, "x", ""), (7, "x", "w1 w2 never"), (None, "x", "w29 w28"), (None, None, "w29 <s> w3 </s> w4"), (95, "y", "été w29")]
    docs = spark.createDataFrame(rows, "i long, l string, text string").repartition(3)
    fitted = docs.i % 10 != 0
    want = N.text_nll(N.fit_ngrams(docs.where("i % 10 <> 0"), "text", order=order), docs, ["i", "l"], "text").collect()
    got = N.fitted_nll(docs, ["i", "l"], "text", fitted, order=order).collect()
    known = {(x.i, x.l): (x.n_words, x.nll) for x in got}
    assert len(got) == len(known) == len(want)
    assert all(known[x.i, x.l][0] == x.n_words and abs(known[x.i, x.l][1] - x.nll) < 1e-9 for x in want)
    none = N.fitted_nll(docs, ["i"], "text", docs.i < 0, order=order).collect()
    assert none and all(abs(x.nll) < 1e-12 for x in none)
    assert N.fitted_nll(docs.limit(0), ["i"], "text", fitted, order=order).count() == 0
