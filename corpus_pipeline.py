"""The corpus pipeline: stages that each call one operator and, but for the last, keep the columns of documents.

1. quality: documents that the co-trained classifier rejects go (labels come from the folder of the tables).
2. lines: lines that resemble an earlier line go; documents of which nothing is left go.
3. near_duplicates: of each group of linked documents the one of smallest id stays, once; so does every row of null id.
4. mix: documents are sampled so that source, language and topic weights are tempered.
5. tokens: what is left is encoded to pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.op2_mix_weights import mix_weights
from corpusmill.llm.op4_quality_cotrain import score_quality
from corpusmill.llm.op7_piece_tokenizer import encode_documents
from corpusmill.llm.op8_jaccard_join import jaccard_components
from corpusmill.llm.op9_line_dedup import dedup_lines
from corpusmill.llm.shared import stored
from corpusmill.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of the words that the mixing stage keeps.
MIX_SHARE = 0.9


#: Every stage takes any table with the columns of documents; doc_id is an integer, and a text that is no integer can't be cast.


def _only(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is in `keep` (doc_id alone, distinct). Kept ids are far smaller than texts, but not bounded: a join."""
    return docs.join(keep, "doc_id", "left_semi").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, each row judged by itself: score of its text and metadata at least the threshold.
    Null and empty texts and null metadata are scored as such; rows of null id, and rows that repeat, like any other. Without
    labels of both classes all rows stay. Ties don't arise. An empty table gives none."""
    scores = score_quality(docs, table(spark, sf_dir, "labels"), carry=COLUMNS)
    return scores.where("accepted").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that resemble an earlier line, by id and line; n_chars follows the text. A document of which
    nothing is left goes; one that had no word before, null or empty texts among them, stays as it was, as does a row of
    null id, which is not compared. Rows that repeat an id are told apart by their texts and lose only lines of their own;
    of equal rows each keeps what the first one keeps."""
    out = dedup_lines(docs.select(*COLUMNS))
    out = out.where("not (n_lines_removed > 0 and text = '')")
    return out.withColumn("n_chars", F.when(F.col("n_lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each kept doc_id: of rows that repeat it, the least by the other columns in the order of COLUMNS, nulls
    first. Rows of null doc_id take no part in the join and all stay."""
    first = stored(jaccard_components(docs).where("doc_id = component_id").groupBy("doc_id").count(), "firsts")
    once = _only(docs, first.where("count = 1").select("doc_id"))
    # Few ids repeat: only their texts are grouped, and each task brings one row of an id at most.
    row = F.min(F.struct(*COLUMNS[1:])).alias("row")
    again = _only(docs, first.where("count > 1").select("doc_id")).groupBy("doc_id").agg(row).select("doc_id", "row.*")
    return once.unionByName(again.select(*COLUMNS)).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that are drawn: by a number made of the id, the same for all rows of it, against the probability of their
    source, language and topic. Null values of these are values of their own; rows of null id share one number; null and
    empty texts weigh nothing and are drawn like the others of their cell. An empty table gives none."""
    return mix_weights(docs, share=MIX_SHARE, carry=COLUMNS).where("kept").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip) of every row: null text has null ids, empty text none. Rows that repeat and
    rows of null id are encoded like any other. Ties go to the longest piece."""
    return encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]
#: Training, raking and Viterbi have no form in SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
