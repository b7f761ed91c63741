"""The thin queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.op1_license_scan import scan_licenses
from corpusmill.llm.op2_mix_weights import mix_weights
from corpusmill.llm.op3_language_id import identify
from corpusmill.llm.op4_quality_cotrain import score_quality
from corpusmill.llm.op5_media_sniff import text_media
from corpusmill.llm.op6_secret_ledger import secret_digests
from corpusmill.llm.op7_piece_tokenizer import encode_documents
from corpusmill.llm.op8_jaccard_join import jaccard_components
from corpusmill.llm.op9_line_dedup import dedup_lines
from corpusmill.llm.op10_lattice_neardup import near_duplicates
from corpusmill.llm.op11_exact_dedup import exact_duplicates
from corpusmill.llm.op12_source_divergence import divergence
from corpusmill.llm.op13_spelling_variants import spelling_variants
from corpusmill.sources.tables import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_weights(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_quality_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_media_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(table(spark, sf_dir, "documents"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op7_piece_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", F.col("text")))


def op10_lattice_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_mix_weights, op3_language_id, op4_quality_cotrain, op5_media_sniff, op6_secret_ledger, op7_piece_tokenizer,
        op8_jaccard_join, op9_line_dedup, op10_lattice_neardup, op11_exact_dedup, op12_source_divergence, op13_spelling_variants,
    )
}
