"""Queries that take whole texts: what follows the start of a text changes the result."""

from __future__ import annotations

import hashlib

import pytest
from conftest import DATA

from corpusmill.plans.registry import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    to = tmp_path_factory.mktemp("whole")
    start = "a b c d " * 40
    spark.createDataFrame([(3, f"{start}one end"), (4, f"{start}another end"), (5, f"{start}third end")], "doc_id long, text string").write.parquet(str(to / "documents.parquet"))
    spark.createDataFrame([(1, f"{start}xyz")], "item_id long, text string").write.parquet(str(to / "benchmark.parquet"))
    return str(to), start


def test_cited_overlap_of_whole_texts(spark, tables):
    to, start = tables
    (row,) = QUERIES["cited_overlap"](spark, to).collect()
    cited = f"{start}one end"
    answer = f"{start}xyz"
    assert row["cited_sha"] == hashlib.sha256(cited.encode()).hexdigest()
    assert row["lex"] == round(sum(c in cited for c in answer) / len(answer), 6)


def test_think_tags_of_whole_texts(spark, tables):
    to, start = tables
    out = {r["doc_id"]: r for r in QUERIES["think_tags"](spark, to).collect()}
    for i, text in ((3, f"{start}one end"), (5, f"{start}third end")):
        half = len(text) // 2
        want = text[half:] if i % 3 == 0 else text
        assert out[i]["reasoned"] == hashlib.sha256(want.strip().encode()).hexdigest()
    assert out[4]["unclosed"] and not out[3]["unclosed"]


def test_they_read_every_document(spark):
    assert QUERIES["think_tags"](spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
