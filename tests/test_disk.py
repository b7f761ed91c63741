"""What queries leave on disk beside the bytes of their input."""

from __future__ import annotations

import os

import pytest
from conftest import DATA

from corpusmill.plans.registry import QUERIES

#: Bytes shuffled and stored by byte of documents: what the query takes of these small tables, and half as much again.
MOST = {"text_nll": 8, "text_perplexity": 8, "near_dup_pairs": 8, "near_dup_keep": 8}


def moved(spark) -> int:
    """Bytes that stages have written to shuffles and tables so far, kept stages only."""
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteBytes() + stages.apply(i).outputBytes() for i in range(stages.size()))


@pytest.mark.parametrize("name", sorted(MOST))
def test_bytes_on_disk(spark, name):
    docs = f"{DATA}/documents.parquet"
    before = moved(spark)
    QUERIES[name](spark, DATA).write.format("noop").mode("overwrite").save()
    took = (moved(spark) - before) / os.path.getsize(docs)
    assert 0 < took < MOST[name], took
