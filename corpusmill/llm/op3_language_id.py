"""Language ID by compression: the language whose dictionary packs a text best."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import slices

#: Bounds of training, as documented parameters, for each language: texts, bytes of the dictionary, and characters of a text
#: that go into it, from its first letter on. They bound the sample only; every labelled text with a letter can be drawn.
SAMPLE_TEXTS, SAMPLE_CHARS, TEXT_CHARS = 400, 110_000, 6_000
#: Bytes of all dictionaries together: with more than 152 languages each one's share shrinks, down to LEAST_BYTES.
ALL_BYTES, LEAST_BYTES = 16 << 20, 4_096
#: A dictionary of fewer bytes is repeated up to this size: zstandard doesn't index the last bytes of one.
SHORT_BYTES = 64
#: Bytes that aren't letters of ASCII, in lower case, to spaces.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32) for b in range(256))


def plain(text: str) -> bytes:
    """Lower case, words only: what a dictionary holds and what is measured."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split())


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A raw-content dictionary for each language that has a labelled text with a letter, however short or long its texts are
    and however many languages there are: SAMPLE_TEXTS texts at most, those with the smallest hashes, and of a long one
    TEXT_CHARS characters. Null text or language can't be learned from; a null id can. Counts cover all labelled rows with
    a letter; rows that repeat count once. Executors draw the sample and join it; only dictionaries come to the driver."""
    head = F.regexp_extract(F.col(text_col), rf"(?s)\p{{L}}.{{0,{TEXT_CHARS - 1}}}", 0)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), head.alias("text"), F.col(id_col).cast("string").alias("id")).where("lang is not null and text <> ''")
    rows = rows.select("lang", "text", F.xxhash64("id", "text", F.lit(3)).alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return {}
    # A share of each language's hashes that holds SAMPLE_TEXTS of them, give or take; small languages are taken whole.
    most = SAMPLE_TEXTS + 8 * math.sqrt(SAMPLE_TEXTS)
    below = {k: int(-(2**63) + most / n * 2**64) for k, n in counts.items() if n > most}
    if below:
        cut = F.create_map(*[F.lit(x) for k, v in below.items() for x in (k, v)])
        rows = rows.where(F.coalesce(F.col("h") <= cut[F.col("lang")], F.lit(True)))
    size = max(LEAST_BYTES, min(SAMPLE_CHARS, ALL_BYTES // len(counts)))

    def join(table: pa.Table) -> pa.Table:
        mine = sorted(zip(table.column("h").to_pylist(), table.column("text").to_pylist(), strict=True))[:SAMPLE_TEXTS]
        joined = b" ".join(dict.fromkeys(plain(t) for _, t in mine))[-size:]
        joined = b" ".join([joined] * -(-SHORT_BYTES // len(joined))) if len(joined) < SHORT_BYTES else joined
        return pa.table({"lang": table.column("lang").slice(0, 1), "packed": pa.array([joined], pa.binary())})

    # Rows that repeat are one before they are dealt out, so that a repeated row can't fill a task.
    found = rows.groupBy("lang", "h").agg(F.min("text").alias("text")).groupBy("lang").applyInArrow(join, "lang string, packed binary").collect()
    return {r["lang"]: bytes(r["packed"]) for r in sorted(found)}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", level: int = 3, margin: float = 0.004) -> DataFrame:
    """(id, lang_pred, score, accepted, lang_second, n_bytes) for each row of `docs`, by its whole text.

    The text is packed once with each dictionary; the smallest size wins, ties go to the language first by name. score is
    the share of 2^(-saved bytes / scale) weights, between 0 and 1. accepted is false where the second-best size is within
    `margin` of the best, relative to the text's bytes, plus one byte. Null text or one without a letter: `und`, score 0, not
    accepted. No dictionary at all, which is to say no labelled text with a letter: likewise. Long texts are packed whole; the other columns of `docs` are ignored.
    """
    schema = f"{id_col} long, lang_pred string, score double, accepted boolean, lang_second string, n_bytes long"
    names = sorted(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packers = []
        for name in names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            packers.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                body = plain(text) if text and names and any(map(str.isalpha, text)) else b""
                if not body:
                    rows.append(("und", 0.0, False, None, 0))
                    continue
                sizes = sorted((len(p.compress(body)), name) for p, name in zip(packers, names, strict=True))
                best = sizes[0][0]
                # Bytes saved count for more in short texts, where each one is a larger part of the evidence.
                scale = 1 + math.sqrt(len(body)) / 8
                weight = 1 / sum(2 ** max(-60.0, (best - s) / scale) for s, _ in sizes)
                sure = len(sizes) == 1 or sizes[1][0] - best > 1 + margin * len(body)
                rows.append((sizes[0][1], weight, sure, sizes[1][1] if len(sizes) > 1 else None, len(body)))
            cols = list(zip(*rows, strict=True))
            types = (pa.string(), pa.float64(), pa.bool_(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows that are not held out, classify all; adds held_out. Rows of null id are neither: they are classified, with
    held_out false, but not learned from. A language of which every text is held out or of null id is not learned."""
    learned = docs.where(~held_out(id_col))
    return classify(docs, train(learned, id_col, text_col, lang_col), id_col, text_col).withColumn("held_out", F.coalesce(held_out(id_col), F.lit(False)))
