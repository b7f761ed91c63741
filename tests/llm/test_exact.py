"""Op 11 against plain grouping."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from corpusmill.llm import op11_exact_dedup as op
from corpusmill.llm.op11_exact_dedup import Base, combined, exact_duplicates, normalised, pieces, polynomials

COLUMNS = "doc_id long, text string, f1 int, n int"


def plain(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups: dict = {}
    for at, (i, t, *_) in enumerate(rows):
        groups.setdefault(plain(t), []).append((i is None, i or 0, at))
    out = []
    for i, t, *_ in rows:
        g = groups[plain(t)]
        out.append((i, None if min(g)[0] else min(g)[1], len(g), hashlib.sha256(plain(t).encode()).hexdigest()))
    return out, len(groups)


def check(spark, rows, **how):
    got = exact_duplicates(spark.createDataFrame(rows, COLUMNS), **how).collect()
    want, kept = brute(rows)
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=order) == sorted(want, key=order)
    # One row of each group stays, and it has the group's id.
    assert sum(r.kept for r in got) == kept and all(r.doc_id == r.keep_id for r in got if r.kept)


def corpus(seed: int = 3):
    r = random.Random(seed)
    texts: list[str | None] = [None, "", " ", "\t\n ", "a b", "a  b", "a\nb", " a b", "a b ", "ab", "ba", " a b", "\x00", "\x00\x00", "é", "É"]
    for _ in range(60):
        w = [r.choice(["x", "yy", "zzz", "é"]) for _ in range(r.randrange(1, 6))]
        texts += [" ".join(w), "  ".join(w), "\r\n".join(w)]
    long = "word " * 60_000
    texts += [long, long.replace(" ", "\n"), long + "z", "z" + long, long[: 1 << 16], long[: 1 << 16] + "x"]
    texts += ["the very common text"] * 200
    rows = [(i if i % 17 else None, t, 1, 2) for i, t in enumerate(texts)]
    return rows + rows[5:40] + [(7, "another text", 0, 0), (7, "a b", 0, 0)]


def test_against_grouping(spark):
    check(spark, corpus())


def test_huge_texts_by_pieces(spark):
    check(spark, corpus(), huge=5000)


def test_names_that_clash_go_on(spark):
    """Round 0 sums bytes: texts of the same letters meet, and the comparison tells them apart."""
    weak = lambda r: Base((1, 1, 1, 1)) if r == 0 else Base.of_round(r)
    rows = [(i, t) + (0, 0) for i, t in enumerate(["ab cd", "cd ab", "dcba ", "ab  cd", "x", "y", "abcd ", "ba cd"] * 3)]
    check(spark, rows, base_of=weak)


def test_hot_groups_are_compared_in_shares(spark, monkeypatch):
    monkeypatch.setattr(op, "COPIES", 16)
    check(spark, corpus())
    weak = lambda r: Base((1, 1, 1, 1)) if r == 0 else Base.of_round(r)
    check(spark, [(i, "ab" if i % 50 else "ba", 0, 0) for i in range(300)], base_of=weak)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], COLUMNS)).collect() == []


def test_hashes_compose():
    rng = np.random.default_rng(1)
    base = Base.of_round(0)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        data = rng.integers(0, 256, n).astype(np.uint8)
        whole = polynomials(data, np.array([0, n]), base)[0]
        want = [sum(int(x) * pow(b, n - 1 - i, op.PRIME) for i, x in enumerate(data)) % op.PRIME for b in base.numbers]
        assert whole.tolist() == want
        for cut in (0, n // 3, n):
            a, b = data[:cut], data[cut:]
            both = combined((polynomials(a, np.array([0, len(a)]), base)[0], len(a)), (polynomials(b, np.array([0, len(b)]), base)[0], len(b)), base)
            assert both[0].tolist() == want and both[1] == n


@pytest.mark.parametrize("step", [1, 2, 7, 1000])
def test_pieces_are_normalised_like_the_whole(step):
    text = " a \t b\n\n c  " * 9
    raw = np.frombuffer(text.encode(), np.uint8)
    whole, _ = normalised(raw, np.array([0, len(raw)]))
    assert b"".join(p.tobytes() for p in pieces(memoryview(text.encode()), step)) == whole.tobytes() == plain(text).encode()
