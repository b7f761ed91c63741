"""Texts as packed batches of term counts, with the number of texts that have a term."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.packed import packed, ranges, runs, unpacked
from corpusmill.sources.scratch import written

#: Terms of two or more word characters, lower case.
WORDS = "(?U)(\\b\\w\\w+\\b)"
#: Tokens of a batch.
BATCH = 2_000_000


def read_batch(ids: pa.Array, size: int, body: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a packed batch: ids, terms as ascending 64-bit hashes, their df; of each entry text number, term number and tf, by
    text and term."""
    steps, df, n, code, tf = unpacked(body, size, [np.uint64, np.int64, np.uint32, np.uint32, np.uint32])
    return ids, np.cumsum(steps, dtype=np.uint64), df, np.repeat(np.arange(len(n)), n), code.astype(np.int64), tf


def term_batches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(batch, ids, size, body) for read_batch, stored. Terms are known by 64-bit hashes. Rows that repeat an id are one text, which
    alone makes it needed to shuffle texts. Of a batch's terms each goes to its range once, and df comes back in its place."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    terms = F.transform(F.regexp_extract_all(F.lower(F.col("text")), F.lit(WORDS), F.lit(1)), lambda t: F.xxhash64(t))
    if texts.groupBy("id").count().where("count > 1").isEmpty():
        hashed = texts.select("id", F.coalesce(terms, F.array().cast("array<bigint>")).alias("terms"))
    else:
        hashed = texts.groupBy("id").agg(F.flatten(F.collect_list(terms)).alias("terms"))
    kind = dict(texts.dtypes)["id"]
    schema = f"part long, batch long, ids array<{kind}>, size long, body binary"
    ids_type, most = texts.limit(0).select("id").toArrow().schema.field("id").type, BATCH
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows_of(rows: list[tuple]) -> pa.Table:
        kinds = (pa.int64(), pa.int64(), pa.list_(ids_type), pa.int64(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], names=["part", "batch", "ids", "size", "body"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()).astype(np.int64))
            for a, b in runs(np.maximum(ends - 1, 0) // most):
                some = batch.slice(a, b - a)
                word, code = np.unique(some.column("terms").flatten().to_numpy(zero_copy_only=False).view(np.uint64), return_inverse=True)
                size = np.diff(some.column("terms").offsets.to_numpy()).astype(np.int64)
                entry, tf = np.unique(np.repeat(np.arange(len(size)), size) * max(1, len(word)) + code, return_counts=True)
                text, term = np.divmod(entry, max(1, len(word)))
                df, steps, at = np.bincount(term, minlength=len(word)), np.diff(word, prepend=np.uint64(0)), ranges(word, parts)
                rows = [(-1 - number, number, some.column("id").to_pylist(), *packed([steps, np.bincount(text, minlength=len(size)).astype(np.uint32), term.astype(np.uint32), tf.astype(np.uint32)]))]
                rows += [(int(at[x]), number, None, *packed([np.diff(word[x:y], prepend=np.uint64(0)), df[x:y]])) for x, y in runs(at)]
                number += 1
                yield from rows_of(rows).to_batches()

    def added(table: pa.Table) -> pa.Table:
        me = table.column("part")[0].as_py()
        if me < 0:
            return rows_of([])
        sent = [unpacked(body, size, [np.uint64, np.int64]) for body, size in zip(table.column("body").to_pylist(), table.column("size").to_pylist(), strict=True)]
        word, code = np.unique(np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in sent]), return_inverse=True)
        total = np.zeros(len(word), np.int64)
        np.add.at(total, code, np.concatenate([n for _, n in sent]))
        cuts = np.cumsum([len(n) for _, n in sent])[:-1]
        return rows_of([(-1 - batch, me, None, *packed([total[c]])) for batch, c in zip(table.column("batch").to_pylist(), np.split(code, cuts), strict=True)])

    def joined(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("part")[0].as_py() >= 0:
            return rows_of([]).drop_columns(["part"])
        steps, n, term, tf = unpacked(table.column("body")[0].as_py(), table.column("size")[0].as_py(), [np.uint64, np.uint32, np.uint32, np.uint32])
        answers = answers.sort_by("batch")
        df = [unpacked(body, size, [np.int64])[0] for body, size in zip(answers.column("body").to_pylist(), answers.column("size").to_pylist(), strict=True)]
        return rows_of([(0, table.column("batch")[0].as_py(), table.column("ids")[0].as_py(), *packed([steps, np.concatenate([np.zeros(0, np.int64), *df]), n, term, tf]))]).drop_columns(["part"])

    # The exchange of the batches is made once, and read for the sums and for the batches that get them.
    pieces = hashed.mapInArrow(pack, schema)
    answers = pieces.groupBy("part").applyInArrow(added, schema)
    return written(pieces.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(joined, schema.removeprefix("part long, ")), "terms")
