"""Chunks of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import once
from corpusmill.functions.text import strip, token_count, word_list


def word_chunks(docs: DataFrame, size: int = 380, overlap: int = 60, text_col: str = "text") -> DataFrame:
    """Windows of `size` words, each `overlap` words into the one before; the last may lie wholly inside the one before.
    A document without words has none. Adds idx, chunk, n_words; text_col goes."""
    stride = max(1, size - overlap)
    others = [c for c in docs.columns if c != text_col]
    cut = docs.withColumn("__w", once(word_list(F.col(text_col)))).where(F.size("__w") > 0)
    cut = cut.withColumn("__c", F.transform(F.sequence(F.lit(1), F.size("__w"), F.lit(stride)), lambda i: F.slice("__w", i, size)))
    out = cut.select(*others, F.posexplode("__c").alias("idx", "__p"))
    return out.select(*others, "idx", F.array_join("__p", " ").alias("chunk"), F.size("__p").cast("long").alias("n_words"))


def word_windows(docs: DataFrame, size: int = 380, overlap: int = 60, text_col: str = "text") -> DataFrame:
    """The same windows without their texts: adds idx and n_words, by arithmetic on the number of words; text_col goes."""
    stride = max(1, size - overlap)
    others = [c for c in docs.columns if c != text_col]
    counted = docs.select(*others, once(F.size(word_list(F.col(text_col)))).alias("__n")).where("__n > 0")
    out = counted.select(*others, "__n", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / stride).cast("int"))).alias("idx"))
    return out.select(*others, "idx", F.least(F.lit(size), F.col("__n") - F.col("idx") * stride).cast("long").alias("n_words"))


def chunk_records(docs: DataFrame, id_col: str = "doc_id", size: int = 380, overlap: int = 60, text_col: str = "text") -> DataFrame:
    """(chunk_id, doc_id, idx, text, tokens) with ids `<doc>_<four digits or more>`."""
    out = word_chunks(docs.select(id_col, text_col), size, overlap, text_col)
    return out.select(F.format_string("%s_%04d", F.col(id_col), F.col("idx")).alias("chunk_id"), id_col, "idx", F.col("chunk").alias("text"), token_count(F.col("chunk")).alias("tokens"))


def pack_paragraphs(docs: DataFrame, separator: str = "\n\n", most: int = 4000, least: int = 1200, text_col: str = "text") -> DataFrame:
    """Paragraphs packed greedily: a chunk is closed when the next paragraph would take it past `most` characters and it
    has `least` or more; each paragraph counts two characters more than it has. Adds idx, chunk; text_col goes."""
    others = [c for c in docs.columns if c != text_col]
    paras = F.filter(F.transform(F.split(F.col(text_col), separator, -1), strip), lambda p: p != "")
    shape = "struct<done: array<string>, buf: array<string>, size: int>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("buf"), F.lit(0).alias("size"))

    def step(acc, p):
        full = (acc["size"] + F.length(p) > most) & (acc["size"] >= least)
        done = F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["buf"], separator)))).otherwise(acc["done"])
        buf = F.when(full, F.array(p)).otherwise(F.concat(acc["buf"], F.array(p)))
        return F.struct(done.alias("done"), buf.alias("buf"), (F.when(full, 0).otherwise(acc["size"]) + F.length(p) + 2).alias("size")).cast(shape)

    chunks = F.aggregate(paras, start.cast(shape), step, lambda a: F.when(F.size(a["buf"]) > 0, F.concat(a["done"], F.array(F.array_join(a["buf"], separator)))).otherwise(a["done"]))
    return docs.select(*others, F.posexplode(chunks).alias("idx", "chunk"))


def tag_documents(chunks: DataFrame, title_col: str, chunk_col: str = "chunk", least: int = 200) -> DataFrame:
    """Chunks of `least` characters or more as continued-pretraining records: adds tagged."""
    kept = chunks.where(F.length(chunk_col) >= least)
    return kept.withColumn("tagged", F.concat(F.lit("<doc>\nTITLE: "), F.col(title_col).cast("string"), F.lit("\nBODY:\n"), F.col(chunk_col)))
