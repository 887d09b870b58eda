"""A pipeline over the table of documents: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from sensorloom.llm.common import DOCUMENT_COLUMNS, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), DOCUMENT_COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that lose every line with it; n_chars is counted anew."""
    kept = line_dedup.drop_repeated_lines(docs.select(*DOCUMENT_COLUMNS))
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.translate("text", "\n", "")) == "")
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return kept.where(~F.coalesce(emptied, F.lit(False))).select("doc_id", "text", "lang", "source", n_chars)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents connected by a Jaccard similarity of 0.8 or more, the least doc_id stays."""
    return ngram_join.keep_first(docs.select(*DOCUMENT_COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lie in passages of the benchmark go."""
    return decontaminate.drop_contaminated(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 2,048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The learned toxicity score and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
