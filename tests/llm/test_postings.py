"""Op 8 and op 9 against brute force, on small tables made to be awkward."""

from __future__ import annotations

import random
import re

import pytest

from corpusmill.llm.op8_jaccard_join import jaccard_components
from corpusmill.llm.op9_line_dedup import dedup_lines
from corpusmill.llm.shared import components

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(text: str | None, k: int = 5) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def linked(a: frozenset, b: frozenset) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def find(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def corpus(seed: int = 1) -> list[tuple[int, str | None]]:
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    docs: list[str | None] = [None, "", "  \n\t ", "one two", "ONE  two", "one two three four", "É é", "é É", "x" * 5000]
    passage = prose(30)
    for _ in range(40):
        docs.append(" ".join(prose(20) + passage))
    base = prose(60)
    for _ in range(60):  # near copies of one text, and of one another
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(60)] = f"z{r.randrange(9999)}"
        docs.append(" ".join(w) if r.random() < 0.8 else "\n".join([" ".join(w[:30]), " ".join(w[30:])]))
    docs += [" ".join(base)] * 90
    chain = prose(80)  # each like the next, the ends unlike
    for i in range(6):
        docs.append(" ".join(chain[i * 6 : i * 6 + 50]))
    docs.append(" ".join(passage) + "\n" + " ".join(passage))
    order = list(range(len(docs)))
    r.shuffle(order)
    return [(7 * i, docs[j]) for i, j in enumerate(order)]


def brute_components(rows) -> dict[int, tuple[int, int]]:
    s = {i: sets_of(t) for i, t in rows}
    parent = {i: i for i in s}
    ids = sorted(s)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(s[a], s[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(parent, i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_exact(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(df).collect()}
    assert got == brute_components(rows)


def test_components_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert jaccard_components(spark.createDataFrame([], schema)).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], schema)
    assert sorted(jaccard_components(odd).collect(), key=str) == sorted([(None, None, None), (1, 2, 1), (1, 2, 1), (2, 0, 2)], key=str)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_components_by_rounds_and_by_task(spark, limit):
    r = random.Random(3)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(500, 540)] + [(900, 900)]
    parent = {x: x for ab in links for x in ab}
    for a, b in links:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    got = dict(tuple(x) for x in components(spark.createDataFrame([*links, (None, 1)], "a long, b long"), local_links=limit).collect())
    assert got == {x: find(parent, x) for x in parent}


def words_of(line: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", line.translate(FOLD))


def resembles(a: str, b: str, short: int = 12) -> bool:
    """By words if neither line has more than 4/3 of `short`, by shingles if both have `short` or more."""
    x, y = words_of(a), words_of(b)
    by_words = max(len(x), len(y)) <= short * 4 // 3 and linked(frozenset(x), frozenset(y))
    return by_words or (min(len(x), len(y)) >= short and linked(sets_of(a), sets_of(b)))


def brute_lines(rows) -> dict[int, tuple[str | None, int]]:
    seen: list[str] = []
    out = {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        kept, gone = [], 0
        for line in (t or "").split("\n"):
            if line in seen and words_of(line) or any(resembles(line, o) for o in dict.fromkeys(seen)):
                gone += 1
            else:
                kept.append(line)
            seen.append(line)
        text = "\n".join(kept)
        out[i] = (t if not gone else text if re.search(r"[^\x20\x09-\x0D]", text) else "", gone)
    return out


def short_lines(seed: int) -> list[tuple[int, str]]:
    """Lines of 1 to 40 words out of few, and copies of them with words changed, dropped, put in and moved."""
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)]
    base = [[r.choice(vocab) for _ in range(r.randrange(1, 40))] for _ in range(60)]
    rows = []
    for i in range(70):
        lines = []
        for _ in range(4):
            w = list(r.choice(base)) if r.random() < 0.7 else [r.choice(vocab) for _ in range(r.randrange(1, 30))]
            for _ in range(r.randrange(4)):
                at = r.randrange(len(w))
                match r.randrange(4):
                    case 0:
                        w[at] = r.choice(vocab)
                    case 1 if len(w) > 1:
                        del w[at]
                    case 2:
                        w.insert(at, r.choice(vocab))
                    case _:
                        r.shuffle(w) if len(w) < 9 else None
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [2, 3])
def test_lines_of_few_words_are_exact(spark, seed):
    rows = short_lines(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in dedup_lines(df).collect()}
    assert got == brute_lines(rows)


def test_long_posting_lists_are_cut_into_cells(spark, monkeypatch):
    """Blocks of four sets: the grid of comparisons finds what one list does."""
    from corpusmill.llm import postings

    monkeypatch.setattr(postings, "SPLIT", 4)
    rows = short_lines(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in dedup_lines(df).collect()} == brute_lines(rows)
    docs = corpus(6)
    df = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    assert {r[0]: (r[1], r[2]) for r in jaccard_components(df).collect()} == brute_components(docs)


def test_colliding_tokens_make_no_copies(spark, monkeypatch):
    """All 48 bits of every token are the same: sets are told apart by their digests, and single tokens link nothing."""
    from corpusmill.llm import op8_jaccard_join as op8

    whole = op8.shingles

    def colliding(h, seg, k):
        a, b, owner = whole(h, seg, k)
        return a & op8.np.uint64(0xFFFF), b, owner

    monkeypatch.setattr(op8, "shingles", colliding)
    rows = [(i, f"a{i % 10} b c") for i in range(30)] + [(100 + i, f"only{i}") for i in range(20)]
    out = {r[0]: (r[1], r[2]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == brute_components(rows)


@pytest.mark.parametrize("seed", [1, 4])
def test_lines_are_exact(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, line int")
    got = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in dedup_lines(df).collect()}
    assert got == brute_lines(rows)


def test_lines_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert dedup_lines(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (1, None), (2, "a b c d e f\nx"), (3, "a b c d e f"), (4, "\n\n")]
    got = {r[0]: (r[1], r[2]) for r in dedup_lines(spark.createDataFrame(rows, schema)).collect()}
    assert got == {None: ("a b c d e f", 0), 1: (None, 0), 2: ("a b c d e f\nx", 0), 3: ("", 1), 4: ("\n\n", 0)}


def test_one_id_of_several_texts_keeps_the_links_of_each(spark):
    """Each text of an id has near copies of its own; brute force over rows."""
    r = random.Random(8)
    rows: list[tuple[int, str]] = []
    for g in range(40):
        for k in range(3):
            base = [f"g{g}k{k}w{i}" for i in range(60)]
            rows.append((100 * g, " ".join(base)))
            for c in range(2):
                at = r.randrange(60)
                rows.append((100 * g + 10 * k + c + 1, " ".join(base[:at] + ["x"] + base[at + 1 :])))
    r.shuffle(rows)
    out = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert len(out) == len(rows)
    assert all(x["component_id"] == x["doc_id"] // 100 * 100 for x in out)


def test_unlike_texts_of_one_id_keep_their_own_lines(spark):
    """Brute force over rows: lines in order of id, number and row; a row's hash settles ties."""
    rows = [(3, "alpha beta gamma delta epsilon"), (7, "a line nobody else has at all"), (7, "alpha beta gamma delta epsilon")]
    out = sorted(tuple(r) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text", "n_lines_removed").collect())
    assert out == [(3, rows[0][1], 0), (7, "", 1), (7, rows[1][1], 0)]
    r = random.Random(11)
    rows = [(r.randrange(8), t) for _, t in short_lines(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {t: h for t, h in df.selectExpr("text", "xxhash64(text)").collect()}
    lines = sorted({(i, n, hashes[t], line) for i, t in rows for n, line in enumerate(t.split("\n"))})
    gone = {x[:3] for k, x in enumerate(lines) if words_of(x[3]) and any(resembles(x[3], y[3]) or x[3] == y[3] for y in lines[:k])}
    want = []
    for i, t in rows:
        kept = [line for n, line in enumerate(t.split("\n")) if (i, n, hashes[t]) not in gone]
        n = t.count("\n") + 1 - len(kept)
        text = "\n".join(kept)
        want.append((i, text if re.search(r"[^\x20\x09-\x0D]", text) or not n else "", n))
    assert sorted(tuple(r) for r in dedup_lines(df).select("doc_id", "text", "n_lines_removed").collect()) == sorted(want)


def test_token_lists_are_dealt_once_for_their_labels(spark, monkeypatch, capsys):
    """Whatever joins Spark takes: classes and labels are found without tokens, which take part in one shuffle only."""
    from corpusmill.llm import op8_jaccard_join as op8

    plain, dealt = op8.stored, []

    def watched(df, name, *more):
        if name == "asked":
            capsys.readouterr()
            df.explain("formatted")
            dealt.extend(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*tokens[^\]]*)\]", capsys.readouterr().out))
        return plain(df, name, *more)

    monkeypatch.setattr(op8, "stored", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = corpus(4)
        got = {r[0]: (r[1], r[2]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_components(rows)
    assert len(dealt) == 1, dealt


def test_only_mixed_tokens_are_counted(spark, monkeypatch):
    """Tokens of one label are gone before documents are counted and hubs chosen."""
    from corpusmill.llm import postings

    kept = {}
    plain = postings.stored

    def watched(df, name, *more):
        kept[name] = plain(df, name, *more)
        return kept[name]

    monkeypatch.setattr(postings, "stored", watched)
    sets = [(i, i // 3, 10, [*range(1000 * (i // 3), 1000 * (i // 3) + 9), 7777 + i % 3], float(i)) for i in range(30)]
    out = postings.cross_lists(spark.createDataFrame(sets, "id long, label long, n long, tokens array<long>, weight float"), 1, 10)
    want = {i: [(10, 7777 + i % 3, 27 + i % 3)] for i in range(30)}
    assert {r["id"]: [tuple(x) for x in r["s"]] for r in out.collect()} == want
    assert sorted(r["tok"] for r in kept["entries"].collect()) == sorted(7777 + i % 3 for i in range(30))


def test_keys_of_one_label_are_not_dealt(spark):
    """Most keys are of one set: they are dropped before lists are made, and blocks are counted for the others."""
    from corpusmill.llm.postings import shared_keys

    sets = [(i, i // 2, 4, [100 + i // 2, 200 + i, 300, 301]) for i in range(8)]
    keys = shared_keys(spark.createDataFrame(sets, "id long, label long, n long, tokens array<long>"), 1, 4)
    assert sorted((r["id"], r["tok"], r["pos"], r["blocks"]) for r in keys.collect()) == sorted((i, t, p, 1) for i in range(8) for t, p in ((300, 2), (301, 3)))


def test_line_rounds_deal_no_token_lists_for_keys(spark, monkeypatch, capsys):
    """Keys are made once and carry no tokens into the rounds: only both sides of the last exact count do."""
    from corpusmill.llm import op9_line_dedup as op9

    plain, dealt = op9.stored, []

    def watched(df, name, *more):
        if name == "led":
            capsys.readouterr()
            df.explain("formatted")
            dealt.append(len(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*(?:tokens|ta|tb)#", capsys.readouterr().out)))
        return plain(df, name, *more)

    monkeypatch.setattr(op9, "stored", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = short_lines(9)
        got = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_lines(rows)
    assert len(dealt) == 3 and max(dealt[1:]) <= 3, dealt


@pytest.mark.parametrize("best", [0, 3])
def test_short_lists_together_are_as_by_blocks(monkeypatch, best):
    from corpusmill.llm import postings

    np, pa = postings.np, postings.pa
    r = np.random.default_rng(5)
    n = 3000
    tok, ids = np.unique(np.stack([r.zipf(1.4, n) % 500, r.integers(0, 400, n)]), axis=1)
    m, other = ids % 2, r.integers(0, 2, len(ids))
    size = r.integers(3, 20, 400)[ids]
    cols = {"tok": tok, "id": ids, "label": ids // 2, "n": size, "pos": np.minimum(r.integers(0, 5, len(ids)), size - 1), "open": ids % 3 != 0, "o1": -(ids // 2), "o2": ids % 2, "m": m, "ci": np.minimum(m, other), "cj": np.maximum(m, other)}
    rows = pa.table(cols)
    together = postings._candidates(3, 4, best)(rows)
    monkeypatch.setattr(postings, "PAIRS", 7)
    assert together.equals(postings._candidates(3, 4, best)(rows))
    monkeypatch.setattr(postings, "BLOCK", 1)
    assert together.num_rows and together.equals(postings._candidates(3, 4, best)(rows))
