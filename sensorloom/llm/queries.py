"""One query for each operator, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import oracles
from sensorloom.llm.common import table
from sensorloom.llm.conversation_repair import repair_damaged
from sensorloom.llm.decontaminate import contamination
from sensorloom.llm.fingerprint import fingerprints
from sensorloom.llm.language import predict_languages
from sensorloom.llm.length_histogram import length_histogram
from sensorloom.llm.licenses import scan_licenses
from sensorloom.llm.line_dedup import drop_repeated_lines
from sensorloom.llm.minhash_dedup import near_duplicates
from sensorloom.llm.ngram_join import similarity_components
from sensorloom.llm.packing import pack
from sensorloom.llm.quotes import reply_ordered
from sensorloom.llm.spelling import spelling_variants
from sensorloom.llm.toxicity import score_toxicity


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files <source>/<lang>/<doc_id>."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")) \
        .withColumnRenamed("file_id", "doc_id")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_fingerprints": op8_fingerprints,
    "op9_license_scan": op9_license_scan,
    "op10_ngram_join": op10_ngram_join,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": oracles.LINE_DEDUP,
    "op4_decontamination": oracles.DECONTAMINATION,
    "op10_ngram_join": oracles.NGRAM_JOIN,
    "op11_minhash_dedup": oracles.MINHASH_DEDUP,
}
