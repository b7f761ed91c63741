"""Ops 1 to 7 and the pipeline: brute force, exact round trips, held-out accuracy, odd tables."""

from __future__ import annotations

import hashlib
import io
import os
import random
import re
import struct
import wave
import zipfile
import zlib

import numpy as np
import pytest
from conftest import DATA, TABLES, same_as_oracle

import corpus_pipeline
from corpusmill.llm import op1_license_scan as L
from corpusmill.llm import op2_mix_weights as M
from corpusmill.llm import op3_language_id as G
from corpusmill.llm import op4_quality_cotrain as Q
from corpusmill.llm import op5_media_sniff as S
from corpusmill.llm import op6_secret_ledger as K
from corpusmill.llm import op7_piece_tokenizer as P
from corpusmill.llm.oracles import ORACLES
from corpusmill.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: The smallest tables have too few labels to measure accuracy.
LARGER = DATA.replace("sf0.001", "sf0.01")
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n", "en", "a", 2), (4, "é" * 3000, "fr", "b", 3000), (4, "é" * 3000, "fr", "b", 3000), (None, "plain words here", "en", "a", 16), (5, "Wort " * 4000, "de", None, 20000), (6, "a\0b 😀 c", "en", "a", 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 1.5) for r in ODD], DOCS + ", id string, score double")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    same_as_oracle(spark, QUERIES[name], ORACLES[name])


# 1


def test_winnowing_guarantee():
    r = random.Random(0)
    for _ in range(200):
        g = np.array([r.randrange(30) for _ in range(r.randrange(1, 40))], np.uint64)
        at = L.winnow(g, 4)
        for i in range(max(1, len(g) - 3)):
            w = g[i : i + 4]
            assert any(i <= p < i + 4 and g[p] == w.min() for p in at)


def brute_align(a, b, band, shift):
    best = 0.0
    n, m = len(a), len(b)
    t = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            if abs(j - i - shift) > band:
                continue
            x = t[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -0.5)
            if abs(j - i + 1 - shift) <= band:
                x = max(x, t[i - 1][j] - 0.5)
            if abs(j - 1 - i - shift) <= band:
                x = max(x, t[i][j - 1] - 0.5)
            t[i][j] = max(0.0, x)
            best = max(best, t[i][j])
    return best


def test_alignment_scores_as_brute_force():
    r = random.Random(5)
    for _ in range(150):
        a = np.array([r.randrange(5) for _ in range(r.randrange(1, 15))], np.uint64)
        b = np.array([r.randrange(5) for _ in range(r.randrange(1, 20))], np.uint64)
        shift = r.randrange(-3, 4)
        pairs = L.align(a, b, shift, 4)
        score = 0.0
        for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False):
            p, q = k - i - 1, m - j - 1
            score -= 0.5 * (max(p, q))
        assert all(a[i] == b[j] for i, j in pairs)
        assert abs(len(pairs) + score - brute_align(a, b, 4, shift)) < 1e-9


def test_licenses_are_found_and_placed(spark, odd):
    mit = L.TEMPLATES["mit"]
    varied = mit.replace("person", "body").replace("Software", "Program", 1)
    rows = [(1, f"Çode\n/* {varied} */ end"), (2, "x released  UNDER the\nMIT license! y"), (3, "under the license of the city"), (4, "a " * 50 + L.TEMPLATES["apache-2.0-header"]), (5, "All rights reserved. All rights reserved.")]
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    assert {(r["doc_id"], r["license"]) for r in out} == {(1, "mit"), (2, "mit-notice"), (4, "apache-2.0-header"), (5, "all-rights-reserved")}
    assert sum(r["doc_id"] == 5 for r in out) == 2
    for r in out:
        assert text[r["doc_id"]][r["start_pos"] : r["end_pos"]] == r["matched"]
        assert 0.75 <= r["coverage"] <= 1
    assert L.scan_licenses(odd).count() == 0
    assert L.scan_licenses(odd.limit(0)).count() == 0


def test_short_licenses_are_found_with_edits_at_each_place(spark):
    """One word changed, dropped or put in, at each place, as far as coverage allows; brute force over all diagonals."""
    rows, want = [(0, "Released under an MIT License."), (1, "Licensed under the Apache Software License, Version 2.0.")], {(0, "mit-notice"), (1, "apache-2.0")}
    for name, text in L.TEMPLATES.items():
        words = re.findall(r"[A-Za-z0-9]+", text)
        if len(words) > L.SHORT:
            continue
        for at in range(len(words)):
            edits = [words[:at] + ["qq"] + words[at:]]
            if (len(words) - 1) / len(words) >= 0.75:
                edits += [words[:at] + ["qq"] + words[at + 1 :], words[:at] + words[at + 1 :]]
            if (len(words) - 2) / len(words) >= 0.75:
                edits += [[w for i, w in enumerate(words) if i not in (at, (at + 3) % len(words))]]
            for e in edits:
                want.add((len(rows), name))
                rows.append((len(rows), f"some text {' '.join(e)} and more of it"))
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text, got = dict(rows), [(r["doc_id"], r["license"]) for r in out]
    # Nothing but a template that shares the span may stand beside or in place of the one that was edited.
    assert len(set(got)) == len(got)
    missing = sorted(want - set(got))
    index = L.build_index(L.TEMPLATES)
    for i, name in missing:
        rival = max(r["n_matched"] for r in out if r["doc_id"] == i)
        assert rival >= L.needed(len(index.words[index.names.index(name)]), 0.75), text[i]
    assert not {m for m in missing if m[1] in ("mit-notice", "apache-2.0", "all-rights-reserved", "cc-by-nc-4.0")}
    assert all(text[r["doc_id"]][r["start_pos"] : r["end_pos"]] == r["matched"] for r in out)


def test_short_candidates_equal_all_diagonals():
    r = random.Random(9)
    index = L.build_index(L.TEMPLATES)
    hashed = lambda text: L.tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
    for _ in range(300):
        words = ["x", "y"] * 3
        for name in r.choices([n for n, a in zip(index.names, index.words, strict=True) if len(a) <= L.SHORT], k=2):
            w = re.findall(r"[a-z0-9]+", L.TEMPLATES[name].lower())
            words += [x for y in w for x in ([y] if r.random() > 0.12 else r.choice(([], ["q"], [y, "q"], [y, y])))] + ["z"] * r.randrange(4)
        h = hashed(" ".join(words))
        got = L.scan_text(h, index, 0.75)
        pairs = [(t, s) for t, a in enumerate(index.words) if len(a) <= L.SHORT for s in range(-len(a), len(h))]
        every = L.scan_text(h, index, 0.75, tuple(np.array(x) for x in zip(*pairs, strict=True)))
        assert {f[0] for f in every} == {f[0] for f in got}


# 2


def test_raking_meets_marginals_by_both_ways(spark):
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.randrange(1, 60)), r.choice("abc"), r.choice("xyz"), r.choice("pq")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.2, "y": 0.2, "z": 0.6}}
    small = {x["doc_id"]: x for x in M.mix_weights(df, targets, 0.4).collect()}
    assert len(small) == 600
    total = sum(x["n_tokens"] for x in small.values())
    for dim, goal in targets.items():
        for value, share in goal.items():
            got = sum(x["n_tokens"] * x["weight"] for x in small.values() if x[dim] == value) / total
            assert abs(got - share) < 1e-6
    assert abs(sum(x["n_tokens"] * x["prob"] for x in small.values()) / total - 0.4) < 1e-6
    large = {x["doc_id"]: x for x in M.mix_weights(df, targets, 0.4, most_cells=0).collect()}
    assert all(abs(small[i]["prob"] - large[i]["prob"]) < 1e-8 for i in small)
    assert all(small[i]["kept"] == large[i]["kept"] for i in small)
    assert {i for i in small if small[i]["kept"]} == {i for i in small if int(hashlib.sha256(f"17:{i}".encode()).hexdigest()[:13], 16) / 2**52 < small[i]["prob"]}


def test_contradicting_targets_give_a_warning():
    mass, groups = np.array([3.0, 1.0]), [np.array([0, 1]), np.array([0, 1])]
    with pytest.warns(UserWarning, match="contradict"):
        M.rake(mass, groups, [np.array([0.5, 0.5]), np.array([0.9, 0.1])], rounds=20)


def test_mixing_odd_tables(odd):
    out = M.mix_weights(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r["prob"] <= 1 and r["kept"] is not None for r in out)
    assert M.mix_weights(odd.limit(0)).count() == 0


# 3


def test_signs_that_are_no_letters_have_no_language(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(20)] + [(100, "\u00b2", None), (101, "\u00bd 12", None), (102, "\u2460!", None), (103, "\u00aa", None), (104, "\u4e2d", None)]
    out = {r["doc_id"]: r["lang_pred"] for r in G.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[i] for i in range(100, 105)] == ["und", "und", "und", "en", "en"]


def test_sizes_are_those_of_plain_zstandard(spark, docs):
    """The prediction is the name of the least size that the library gives with each dictionary."""
    import zstandard

    d = G.train(docs)
    rows = docs.where("doc_id % 7 = 0").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in G.classify(docs, d).collect()}
    for i, text in rows:
        sizes = {}
        for name, raw in d.items():
            packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[name] = len(packer.compress(G.plain(text)))
        assert got[i]["lang_pred"] == min(sizes, key=lambda k: (sizes[k], k))


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    out = G.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 for r in out)


def test_languages_of_odd_tables(docs, odd):
    d = G.train(docs.where(~G.held_out()))
    out = {r[0]: r for r in G.classify(odd, d).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and out[4]["lang_pred"] in d
    assert all(r["lang_pred"] == "und" for r in G.identify(odd.limit(0).union(odd).where("lang is null")).collect())
    assert G.identify(odd.limit(0)).count() == 0


def test_languages_of_any_length_are_learned(spark):
    """Only short texts, only long ones, a letter after a long run without, a null id, and more than 64 languages."""
    r = random.Random(3)
    vocab = {lang: ["".join(r.choice(letters) for _ in range(r.randrange(3, 9))) for _ in range(60)] for lang, letters in (("short", "abcdefgh"), ("long", "ijklmnop"), ("late", "qrstuvwx"), ("null", "éèàçùôîâ"))}
    say = lambda lang, n: " ".join(r.choice(vocab[lang]) for _ in range(n))
    rows = [(4 * i, say("short", 9)[:90], "short") for i in range(200)] + [(4 * i + 1, say("long", 1500), "long") for i in range(60)]
    rows += [(4 * i + 2, "😀1 " * 3000 + say("late", 300), "late") for i in range(60)] + [(None, say("null", 40), "null")] * 50 + [(9000 + i, "12 34", "digits") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(G.train(df)) == set(vocab)
    out = [(x["lang_pred"], x["lang"]) for x in G.identify(df.where("doc_id is not null and lang <> 'digits'")).join(df, "doc_id").collect() if x["lang"] != "null"]
    assert sum(a == b for a, b in out) / len(out) > 0.95
    got = {x["lang_pred"] for x in G.identify(df).where("doc_id is null").collect()}
    assert got and "null" not in got  # rows of null id are classified, but not learned from
    many = spark.createDataFrame([(i, f"{chr(0x4e00 + i) * 40}", f"l{i}") for i in range(90)], "doc_id long, text string, lang string")
    d = G.train(many)
    assert set(d) == {f"l{i}" for i in range(90)}
    assert all(x["lang_pred"] == f"l{x['doc_id']}" for x in G.classify(many, d).collect())


def test_repeated_rows_do_not_hide_a_language(spark):
    same = spark.range(100_000).selectExpr("1L as doc_id", "'the same words again and again' as text", "'en' as lang")
    few = spark.createDataFrame([(i, f"andere woorden {i} zijn hier", "en") for i in range(2, 12)], "doc_id long, text string, lang string")
    assert b"andere" in G.train(same.union(few))["en"]


# 4


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")
    known, asked = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    out = Q.score_quality(docs, known).join(asked, "doc_id").collect()
    right = sum((r["score"] >= 0.5) == bool(r["quality"]) for r in out)
    assert right / len(out) > 0.9


def test_a_repeated_id_brings_one_row(spark, monkeypatch):
    rows = [(i, f"text {i} of words", "s", "en", 10) for i in range(40)] + [(7, f"again {k}", "s", "en", 9) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    seen = {}
    monkeypatch.setattr(Q, "co_train", lambda xt, xm, y, pt, pm: seen.update(first=len(xt), rest=len(pt)))
    Q.train(df, spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int"))
    assert seen["first"] == 20 and seen["rest"] <= 20


def test_co_training_uses_the_pool():
    rng = np.random.default_rng(0)
    y = (rng.random(3000) < 0.6).astype(float)
    xt = rng.normal(size=(3000, 8)) + 1.2 * y[:, None]
    xm = rng.normal(size=(3000, 4)) + 0.9 * y[:, None]
    m = Q.co_train(xt[:80], xm[:80], y[:80], xt[80:1500], xm[80:1500])
    a, b, c = m.score(xt[1500:], xm[1500:])
    acc = [((p >= 0.5) == y[1500:]).mean() for p in (a, b, c)]
    assert acc[2] >= max(acc) - 0.02 and acc[2] > 0.9


def test_quality_of_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (4, 0), (5, 1), (6, None), (None, 1)], "doc_id long, quality int")
    out = Q.score_quality(odd, labels).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    none = Q.score_quality(odd, labels.where("quality = 1")).collect()
    assert all(r["score"] is None and r["accepted"] for r in none) and len(none) == len(ODD)
    assert Q.score_quality(odd.limit(0), labels).count() == 0


# 5


def media() -> dict[str, bytes]:
    png = b"\x89PNG\r\n\x1a\n"
    for name, body in ((b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(b"\0\x7f")), (b"IEND", b"")):
        png += struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    gif = b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;"
    bmp = b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\0\0\xff\0"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.txt", "hello")
    wav = io.BytesIO()
    with wave.open(wav, "wb") as w:
        w.setparams((1, 2, 8000, 0, "NONE", ""))
        w.writeframes(b"\1\2\3\4")
    jpeg = b"\xff\xd8\xff\xe0\0\x10JFIF\0\1\1\0\0\1\0\1\0\0" + b"\xff\xc0\0\x0b\x08\0\1\0\1\1\1\x11\0" + b"\xff\xda\0\x08\1\1\0\0?\0\x7f\xff\0\x01\xff\xd9"
    gz = zlib.compressobj(wbits=31)
    return {"image/png": png, "image/gif": gif, "image/bmp": bmp, "application/zip": buf.getvalue(), "audio/wav": wav.getvalue(), "image/jpeg": jpeg, "application/gzip": gz.compress(b"x" * 99) + gz.flush(), "application/pdf": b"%PDF-1.4\nstartxref\n0\n%%EOF"}


def test_sniffing_carves_and_refuses(spark):
    kinds = media()
    rows, want = [], {}
    for i, (kind, raw) in enumerate(sorted(kinds.items())):
        rows.append((3 * i, raw, "text/plain"))
        want[3 * i] = (kind, [(kind, 0, len(raw))], True)
        rows.append((3 * i + 1, b"BM RIFF junk" + raw + b"tail \xff\xd8\xff PK\3\4", kind))
        want[3 * i + 1] = ("application/octet-stream", [(kind, 12, 12 + len(raw))], True)
        rows.append((3 * i + 2, raw[: len(raw) * 3 // 4], "application/octet-stream"))
        want[3 * i + 2] = ("application/octet-stream", [], False)
    rows += [(900, None, None), (901, b"", "application/octet-stream")]
    want |= {900: ("application/octet-stream", [], True), 901: ("application/octet-stream", [], False)}
    out = S.sniff_media(spark.createDataFrame(rows, "k long, b binary, t string"), "k", "b", "t").collect()
    raw = {r[0]: r[1] for r in rows}
    assert {r["k"]: (r["true_type"], [(m["kind"], m["start"], m["end"]) for m in r["media"]], r["corrected"]) for r in out} == want
    assert all(m["sha256"] == hashlib.sha256(raw[r["k"]][m["start"] : m["end"]]).hexdigest() for r in out for m in r["media"])


def test_text_media_round_trip(docs, odd):
    for df in (docs, odd):
        texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
        out = S.text_media(df).collect()
        assert len(out) == df.count()
        for r in out:
            raw = (texts[r["doc_id"]] or "").encode()
            size = max(1, -(-len(raw) // 576)) * 576
            body = raw + b"\xff" * (size - len(raw))
            with wave.open(io.BytesIO(S.wrap_wav(body))) as w:
                assert w.readframes(w.getnframes()) == body
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), size, hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]))
            assert (r["media_bytes"], r["media_sha256"]) == (len(S.wrap_wav(body)), hashlib.sha256(S.wrap_wav(body)).hexdigest())
    assert S.text_media(odd.limit(0)).count() == 0


# 6

_BASE = (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 0, 16), ("hex", "[0-9a-f]+", 0, 0, 32))


def brute_spans(text: str) -> list[tuple[str, int, int]]:
    found = [(m.start(), i, kind, m.end()) for i, (kind, p, f, g, least) in enumerate(_BASE) for m in re.finditer(p, text, f) if len(m[g]) >= least]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_secrets_are_exact(spark, odd):
    r = random.Random(6)
    parts = ["token=token:abcdefghijk", "PassWord = 'hunter2hunter2'", "api_key:\"short\"", "AKIA12345678901", "AKIA123456789012", "xAKIAAKIA1234567890", "0123456789abcdef" * 2, "é😀", "deadbeef" * 5 + "g", " ", "\n", "secret==abcdefg", "ſecret=longenough1", "toKen:  =x", "passwd\"=\"a.b-c_d/e+f"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randrange(12)))) for i in range(300)] + [(None, parts[0]), (7000, None)]
    got = K.secret_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for x in got:
        want = brute_spans(text[x["doc_id"]] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert x["spans"] == joined and x["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [x["n_assign"], x["n_access"], x["n_hex"]] == [sum(k == n for k, _, _ in want) for n in ("assign", "access", "hex")]
    assert K.secret_digests(odd.limit(0)).count() == 0 and K.secret_digests(odd).count() == len(ODD)


def test_secrets_of_many_findings(spark):
    """Places run on from one run of findings to the next; time grows with the findings."""
    import time

    took = []
    for n in (2000, 16000):
        text = "".join(f"secret=abcdefg{i} \n" if i % 3 else f"token:short AKIA{i:016d} " for i in range(n))
        start = time.perf_counter()
        row = K.secret_digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        took.append(time.perf_counter() - start)
        want = [f"assign:{m.start()}:{m.end()}" for m in re.finditer(_BASE[0][1], text, re.I | re.A) if len(m[2]) >= 8]
        want += [f"access:{m.start()}:{m.end()}" for m in re.finditer(_BASE[1][1], text) if len(m[0]) >= 16]
        assert sorted(row["spans"].split(",")) == sorted(want) and row["n_access"] == -(-n // 3)
    assert took[1] < 8 * max(took[0], 1)


def test_digests_keep_a_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, "secret=abcdefgh"), (2, "secret=abcdefgh"), (3, None)], "doc_id long, text string")
    assert sorted(tuple(r)[:2] for r in K.secret_digests(docs, path).collect()) == [(1, 1), (2, 1), (3, 0)]
    assert [spark.read.parquet(f"{path}/run={k}").count() for k in (1, 2)] == [2, 0]
    more = docs.union(spark.createDataFrame([(4, "token=12345678")], docs.schema))
    assert sorted(tuple(r)[:2] for r in K.secret_digests(more, path).collect()) == [(1, 1), (2, 1), (3, 0), (4, 1)]
    assert [spark.read.parquet(f"{path}/run={k}").count() for k in (3, 4)] == [1, 0]


def test_ledger_scans_only_what_is_new(spark):
    first = spark.createDataFrame([("a", "token=12345678"), ("b", "token=12345678"), ("c", "AKIA123456789012")], "path string, text string")
    old = K.scan_blobs(first)
    assert old.count() == 2
    # Marked by hand, to see that a blob known to a rule version isn't read again.
    marked = old.withColumn("spans", K.F.expr("transform(spans, s -> struct(s.start + 100 as start, s.rank as rank, s.kind as kind, s.end + 100 as end))"))
    second = first.union(spark.createDataFrame([("d", "new secret=abcdefgh"), ("e", None)], "path string, text string"))
    new = K.scan_blobs(second, marked)
    found = {r["path"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in K.findings_by_path(second, new, "path").collect()}
    assert found == {"a": [("assign", 100)], "b": [("assign", 100)], "c": [("access", 100)], "d": [("assign", 4)], "e": []}
    newer = tuple(K.Rule(r.kind, 2, r.pattern, r.least, r.measured, r.hint) if r.kind == "assign" else r for r in K.RULES)
    again = {r["path"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in K.findings_by_path(second, K.scan_blobs(second, new, rules=newer), "path").collect()}
    assert again == {"a": [("assign", 0)], "b": [("assign", 0)], "c": [("access", 100)], "d": [("assign", 4)], "e": []}


def test_ledger_of_a_folder_grows_by_what_is_new(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = [(i, f"token=secret{i:04d}") for i in range(20)] * 3 + [(50, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert K.read_ledger(spark, path) is None
    assert K.update_ledger(docs, path, 1).count() == 21
    same = K.update_ledger(docs, path, 2)
    assert spark.read.parquet(f"{path}/run=2").count() == 0 and same.count() == 21
    more = docs.union(spark.createDataFrame([(60, "AKIA123456789012")], docs.schema))
    assert K.update_ledger(more, path, 3).count() == 22 and spark.read.parquet(f"{path}/run=3").count() == 1
    newer = tuple(K.Rule(r.kind, 2, "nothing at all", r.least) if r.kind == "assign" else r for r in K.RULES)
    ledger = K.update_ledger(more, path, 4, rules=newer)
    assert spark.read.parquet(f"{path}/run=4").count() == 22
    kinds = {s["kind"] for r in ledger.collect() for s in r["spans"]}
    assert kinds == {"access"}
    os.remove(f"{path}/run=4/_SUCCESS")  # a run that did not end
    assert {s["kind"] for r in K.read_ledger(spark, path).collect() for s in r["spans"]} == {"assign", "access"}
    found = K.findings_by_path(more, K.update_ledger(more, path, 4, rules=newer), "doc_id").where("size(spans) > 0").collect()
    assert [r["doc_id"] for r in found] == [60]


# 7

needs_model = pytest.mark.skipif(not os.path.exists(P.MODEL), reason="vocabulary files aren't here")


@needs_model
def test_viterbi_equals_plain_search_and_the_library():
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = P.load()
    proto = pb.ModelProto()
    proto.ParseFromString(open(P.MODEL, "rb").read())
    proto.trainer_spec.model_type = 1  # the same pieces and scores, segmented by the library's Viterbi
    lib = SentencePieceProcessor(model_proto=proto.SerializeToString())
    r = random.Random(1)
    texts = ["".join(r.choice("abehitnoresé ") for _ in range(r.randrange(1, 25))) for _ in range(400)]
    enc = P.Encoder(m)
    ids, off = enc.encode(texts)
    assert all(ids[a:b].tolist() == lib.encode(t) for t, a, b in zip(texts, off, off[1:], strict=False))
    table = {lib.id_to_piece(i): lib.get_score(i) for i in range(259, lib.get_piece_size())}
    for word in ("▁thereabouts", "▁▁x", "▁né\U0001f600"):
        best = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(max(0, e - 16), e):
                best[e] = max(best[e], best[s] + table.get(word[s:e], m.unknown_score if e - s == 1 else -np.inf))
        got, _, _ = P.viterbi(np.array([[ord(c) for c in word]], np.uint32), m)
        score = {**{lib.piece_to_id(k): v for k, v in table.items()}, m.unknown_id: m.unknown_score}
        assert abs(sum(score[int(i)] for i in got) - best[-1]) < 1e-6


@needs_model
def test_encoding_round_trip(docs, odd):
    for df in (docs, odd):
        out = P.encode_documents(df)
        rows = out.collect()
        assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"] or []) for r in rows) and len(rows) == df.count()
        back = P.decode_documents(out).collect()
        key = lambda x: (str(x[0]), str(x[1]))
        assert sorted([tuple(x) for x in back], key=key) == sorted([tuple(x) for x in df.select("doc_id", "text").collect()], key=key)
    assert P.encode_documents(odd.limit(0)).count() == 0


# Pipeline


@needs_model
def test_pipeline_stages(spark, docs):
    now = docs
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, now, DATA).cache()
        left = {r[0] for r in now.select("doc_id").collect()}
        assert left <= ids and left
        if name != "tokens":
            assert now.columns == corpus_pipeline.COLUMNS
        if name == "quality":
            bad = {r[0] for r in Q.score_quality(docs, spark.read.parquet(f"{DATA}/labels.parquet")).where("not accepted").collect()}
            assert left == ids - bad
        if name == "near_duplicates":
            from test_postings import brute_components

            own = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert left == {c for _, c in brute_components(own).values()}
        ids = left


@needs_model
def test_pipeline_of_odd_tables(spark, odd, tmp_path):
    for t in TABLES:
        os.symlink(f"{DATA}/{t}.parquet", tmp_path / f"{t}.parquet")
    os.remove(tmp_path / "documents.parquet")
    os.remove(tmp_path / "labels.parquet")
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "token_ids", "round_trip"]
    empty = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty if name != "tokens" else empty, str(tmp_path))
        assert empty.count() == 0


def test_pipeline_keeps_rows_of_null_id(spark, odd):
    """The odd tables and one whose hot key is null."""
    key = lambda r: tuple(map(str, r))
    many = odd.unionByName(spark.range(50).selectExpr("cast(null as long) as doc_id", "concat('words of row ', id) as text", "'en' as lang", "'a' as source", "15L as n_chars", "'x' as id", "1.5D as score"))
    for df in (odd, many):
        kept = corpus_pipeline.near_duplicates(spark, df, DATA).where("doc_id is null").collect()
        assert sorted(kept, key=key) == sorted(df.where("doc_id is null").select(*corpus_pipeline.COLUMNS).collect(), key=key)
        assert kept


@needs_model
def test_pipeline_of_odd_tables_keeps_the_null_id(spark, odd, tmp_path, monkeypatch):
    for t in TABLES:
        if t not in ("documents", "labels"):
            os.symlink(f"{DATA}/{t}.parquet", tmp_path / f"{t}.parquet")
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = [s for s in corpus_pipeline.STAGES if s[0] in ("lines", "near_duplicates", "tokens")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r["n_tokens"] > 0 for r in out if r["doc_id"] is None] == [True]


def test_pipeline_keeps_one_of_repeated_rows(spark, odd):
    out = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, odd, DATA).collect()]
    assert sorted(out, key=str) == sorted(set(ODD), key=str)
    first, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(1, 61))
    rows = [(7, first, "en", None, 9)] * 3 + [(7, first, "en", "b", 9), (7, first, "en", "a", 9), (8, near, "en", "a", 9), (8, near, "en", "a", 9), (9, "on its own", "en", "a", 9), (9, "by itself", "en", "a", 9)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, DOCS).repartition(3)
        out = corpus_pipeline.near_duplicates(spark, df, DATA)
        assert out.columns == corpus_pipeline.COLUMNS
        assert sorted(tuple(r) for r in out.collect()) == [(7, first, "en", None, 9), (9, "by itself", "en", "a", 9)]
