"""Op 13 against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm.op13_spelling_variants import checksums, common_prefix, crc_table, light_entries, spelling_variants, spines

COLUMNS = "doc_id long, text string, word string, n long"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=7, every=31):
    count: Counter = Counter()
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(FOLD)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= least and n >= 2}
    form, close = {}, {}
    for w, n in words.items():
        close[w] = sorted((-words[x], x) for x in words if abs(len(x) - len(w)) < 2 and x != w and near(w, x))
        form[w] = close[w][0][1] if close[w] and -close[w][0][0] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words.get(form[w])))
    return sorted(out)


def corpus(seed: int = 9):
    r = random.Random(seed)
    letters = "abeénÿÀ"
    stems = ["".join(r.choice(letters) for _ in range(r.randrange(6, 12))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "bbbbbbbbb"]
    text = []
    for s in stems:
        text += [s] * r.choice([2, 30, 400, 4000])
        for _ in range(40):
            w = list(s)
            for _ in range(r.choice([1, 1, 2])):
                k = r.randrange(len(w) + 1)
                w[k : k + r.randrange(2)] = r.choice(["", r.choice(letters)])
            text += ["".join(w)] * r.choice([1, 2, 3, 25])
    r.shuffle(text)
    rows = [(i if i % 11 else None, " ".join(text[i * 37 : i * 37 + 37]), "x", 0) for i in range(len(text) // 37 + 1)]
    long = "xy" * 3000
    return [*rows, (1, None, None, None), (2, "", None, None), (3, f"{long} {long}z {long} {long}z Abc12def×÷ß", None, None), rows[0], rows[0]]


@pytest.mark.parametrize("part_words", [50_000, 9])
def test_against_all_pairs(spark, part_words):
    rows = corpus()
    for every in (31, 3):
        got = sorted((tuple(r) for r in spelling_variants(spark.createDataFrame(rows, COLUMNS), part_words=part_words, every=every).collect()), key=lambda r: r[0])
        assert got == brute(rows, every=every)


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], COLUMNS)).collect() == []
    assert spelling_variants(spark.createDataFrame([(1, "no word here", None, None)], COLUMNS)).collect() == []


def test_checksums():
    r = np.random.default_rng(0)
    data = r.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(r.integers(0, 4000, 200))
    ends = starts + r.integers(0, 120, 200)
    before = np.array([zlib.crc32(str(i).encode()) for i in range(200)], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(x)) for a, b, x in zip(starts, ends, before, strict=True)]
    assert checksums(before, data, starts, ends, crc_table()).tolist() == want


def test_light_words_are_few_and_parts_agree():
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(7, 14))).encode() for _ in range(3000)})
    per_word: Counter = Counter()
    heavy: dict = {}
    cuts = [0, 100, 101, 900, 2000, len(words)]
    parts = [words[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if words[a:b]]
    edges = spines([(i, p[0], p[-1]) for i, p in enumerate(parts)])
    for i, p in enumerate(parts):
        off = np.cumsum([0, *map(len, p)])
        for word, d, h in light_entries(np.frombuffer(b"".join(p), np.uint8), off, *edges[i]):
            for w, x in zip(word.tolist(), h.tolist(), strict=True):
                per_word[p[w]] += 1
                assert heavy.setdefault(p[w][:d], x) == x  # a node has one heavy child in all parts
    assert max(per_word.values()) <= np.log2(len(words)) + 3
    assert common_prefix(b"abc", b"abd") == 2 and common_prefix(b"ab", b"ab") == 2 and common_prefix(b"", b"x") == 0 and common_prefix(b"x", b"y") == 0
