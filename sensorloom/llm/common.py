"""Small helpers of the corpus operators: tables, types, shared scratch folders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, for a stored intermediate table."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A stored table of a few numbers per row, marked for a broadcast only if it has no more than ``max_rows``."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable.

    Without the binding, a column used several times inside higher-order
    functions would be evaluated again for every use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
