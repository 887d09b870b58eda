"""Tables whose rows lie together by device and day, so that joins on time and daily features need no exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.sinks.tables import ensure_database

DAY = "reading_day"
ROWS_PER_BUCKET = 2_000_000


# Spark's default wants all join keys in the buckets before it leaves an exchange out.
WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def join_by_buckets(spark: SparkSession) -> None:
    """Let joins planned from now on use buckets made of some of their keys; ``configure`` switches it off again.

    Not a setting for all plans: after an aggregate by few keys it would keep
    that coarse partitioning for a join on more keys."""
    spark.conf.set(WHOLE_KEYS, "false")


def bucket_number(spark: SparkSession, table: str) -> int:
    """Buckets of a stored table, 0 without any."""
    path = ".".join(names.quote(p) for p in table.split("."))
    found = spark.sql(f"DESCRIBE EXTENDED {path}").filter("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else 0


def store_by_device(
    df: DataFrame, table: str, time: str = "time", keys: Sequence[str] = ("device_id",),
    buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> int:
    """Append to a table bucketed by the series and the day of a reading, sorted by time; returns the number of buckets.

    A new table gets ``buckets`` of them, by default as many as the counted
    rows need at ``rows_per_bucket``; later appends keep the table's number.
    Tables that are to be joined need the same number.  The day is part of the
    bucket, so a device that sends a third of all rows fills many buckets.
    Each append writes one file per bucket.  Rows without a device or a time
    are kept; they join nothing.
    """
    clean = names.sanitize_columns(df)
    if DAY in clean.columns:
        raise ValueError(f"the column name {DAY} is taken by the day of a reading")
    stamp, by = names.sanitize(time), [*[names.sanitize(k) for k in keys], DAY]
    spark = df.sparkSession
    ensure_database(spark, table)
    n = bucket_number(spark, table) if spark.catalog.tableExists(table) else buckets or -(-max(df.count(), 1) // rows_per_bucket)
    if n == 0:
        raise ValueError(f"table {table} exists without buckets")
    rows = clean.withColumn(DAY, names.col(stamp).cast("date"))
    # dealt like the buckets, so that each bucket is written by one task
    (rows.repartition(n, *[names.col(c) for c in by]).write.mode("append").format("parquet")
     .bucketBy(n, *by).sortBy(*by, stamp).saveAsTable(table))
    return n


def join_stored(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("device_id",), time: str = "time", how: str = "inner") -> DataFrame:
    """Two stored tables joined on series and time; the day is kept for what is grouped by it.

    With equal bucket numbers and after ``join_by_buckets`` neither side is
    exchanged, whatever its size; otherwise both are, with the same result."""
    return left.join(right.hint("merge"), [*keys, DAY, time], how)


def daily(df: DataFrame, aggs: dict[str, Column], keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Features per series and day of a stored table, or of a join of such tables, without an exchange."""
    grouped = df.filter(F.col(DAY).isNotNull()).groupBy(*keys, DAY).agg(*[c.alias(n) for n, c in aggs.items()])
    return grouped.select(*keys, F.col(DAY).cast("timestamp_ntz").alias("time"), *aggs)
