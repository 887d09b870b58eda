"""Exact histogram of encoded lengths; its suffix sums answer every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import stored
from sensorloom.llm.tokens import default_tokenizer, encoder

BATCH = 500
# Lengths of one slice: the windows below see at most so many rows of one slice.
SLICE = 1024


def token_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every row; a null text has no token."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = encoder(path).counts
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts(part.column(1).to_pylist()), pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per encoded length that occurs, with sums over longer and shorter documents.

    Columns: n_tokens; n_docs of that length; docs_ge and tokens_ge (documents
    at least that long, their tokens); docs_le and tokens_le; truncated_tokens
    (all tokens if documents are cut at this length); quantile_from and
    quantile_to (shares of documents shorter than, and at most, this length).

    Documents are counted per length before the only large shuffle; the sums
    run inside slices of 1,024 lengths and over the slices, so no task gets more
    than one slice or one row per slice.  Null texts count as length 0; an
    empty table gives no rows; repeated rows count each; other columns are
    ignored.
    """
    # stored, since it is read twice below: texts are encoded once
    counts = stored(token_lengths(docs, tokenizer).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    counts = counts.withColumn("slice", F.floor(F.col("n_tokens") / SLICE)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    inside = Window.partitionBy("slice").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    # one row per slice: the longest document bounds their number, not the number of documents
    slices = counts.groupBy("slice").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    slices = slices.select("slice", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("docs_before"),
                           F.coalesce(F.sum("t").over(before), F.lit(0)).alias("tokens_before"),
                           F.sum("d").over(whole).alias("docs_all"), F.sum("t").over(whole).alias("tokens_all"))
    sums = counts.select("slice", "n_tokens", "n_docs", "tokens", F.sum("n_docs").over(inside).alias("docs_in"),
                         F.sum("tokens").over(inside).alias("tokens_in")).join(slices, "slice")
    docs_le = F.col("docs_before") + F.col("docs_in")
    tokens_le = F.col("tokens_before") + F.col("tokens_in")
    return sums.select(
        "n_tokens", "n_docs", (F.col("docs_all") - docs_le + F.col("n_docs")).alias("docs_ge"),
        (F.col("tokens_all") - tokens_le + F.col("tokens")).alias("tokens_ge"),
        docs_le.alias("docs_le"), tokens_le.alias("tokens_le"),
        (tokens_le + F.col("n_tokens") * (F.col("docs_all") - docs_le)).alias("truncated_tokens"),
        ((docs_le - F.col("n_docs")) / F.col("docs_all")).alias("quantile_from"),
        (docs_le / F.col("docs_all")).alias("quantile_to"))


def at_limits(histogram: DataFrame, limits: DataFrame) -> DataFrame:
    """Totals for any context limits (column ``context``), whether or not a document has that length.

    The longest length up to the limit has the sums: documents beyond it give
    ``context`` tokens each.  Limits below every length cut all documents."""
    steps = histogram.select("n_tokens", "docs_le", "tokens_le", F.lit(None).cast("long").alias("context")).unionByName(
        limits.select(F.col("context").alias("n_tokens"), F.lit(None).cast("long").alias("docs_le"),
                      F.lit(None).cast("long").alias("tokens_le"), F.col("context").cast("long").alias("context")))
    # the histogram and the limits are both short: their length is bounded by the longest document
    order = Window.orderBy("n_tokens", F.col("context").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    found = steps.select("context", F.coalesce(F.last("docs_le", True).over(order), F.lit(0)).alias("docs_within"),
                         F.coalesce(F.last("tokens_le", True).over(order), F.lit(0)).alias("tokens_within"),
                         F.max("docs_le").over(whole).alias("docs_all"))
    return found.where("context is not null").select(
        "context", "docs_within", (F.coalesce("docs_all", F.lit(0)) - F.col("docs_within")).alias("docs_cut"),
        (F.col("tokens_within") + F.col("context") * (F.coalesce("docs_all", F.lit(0)) - F.col("docs_within"))).alias("truncated_tokens"))


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed (one row, none if empty)."""
    return histogram.where(F.col("quantile_to") >= share).agg(F.min("n_tokens").alias("n_tokens")).where("n_tokens is not null")
