"""Scans of stored tables.

``table`` is a catalog name (``db.table``) or a DataFrame.  Range filters and
column choices are plain predicates and projections, so they reach the Parquet
scan.  Ordering is optional everywhere: a global sort is only worth its
exchange when the caller shows or exports rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.timebucket import local_month

PARTITION = "yyyymm"


def as_frame(spark: SparkSession | None, table: str | DataFrame) -> DataFrame:
    if isinstance(table, DataFrame):
        return table
    return (spark or SparkSession.active()).table(table)


def time_range(df: DataFrame, start=None, end=None, closed: str = "left", time: str = "time") -> DataFrame:
    """Rows in ``[start, end)`` (``closed='left'``) or ``[start, end]``
    (``'both'``).  On a table partitioned by month the same range is also put
    on the partition column, which prunes whole months."""
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    kind = df.schema[time].dataType
    t = F.col(time)
    if start is not None:
        at = F.lit(start).cast(kind)
        df = df.filter(t >= at)
        if PARTITION in df.columns:
            df = df.filter(F.col(PARTITION).cast("string") >= local_month(at))
    if end is not None:
        at = F.lit(end).cast(kind)
        df = df.filter(t < at if closed == "left" else t <= at)
        if PARTITION in df.columns:
            df = df.filter(F.col(PARTITION).cast("string") <= local_month(at))
    return df


def _sorted(df: DataFrame, order: Sequence[str], sort: bool) -> DataFrame:
    return df.orderBy(*order) if sort else df


def scan_table(table, start=None, end=None, time: str = "time", sort: bool = False, spark=None) -> DataFrame:
    """All columns, optional half-open time range."""
    return _sorted(time_range(as_frame(spark, table), start, end, "left", time), [time], sort)


def scan_temple(
    table, temple_id: str, start=None, end=None, time: str = "time", sort: bool = False, spark=None
) -> DataFrame:
    """One temple, optional half-open time range; order device, time."""
    df = time_range(as_frame(spark, table), start, end, "left", time)
    return _sorted(df.filter(F.col("temple_id") == temple_id), ["device_id", time], sort)


def scan_field(
    table, field: str, device_id=None, temple_id=None, start=None, end=None, time: str = "time",
    sort: bool = False, spark=None,
) -> DataFrame:
    """temple, device, time and one field; half-open range."""
    df = time_range(as_frame(spark, table), start, end, "left", time)
    if device_id is not None:
        df = df.filter(F.col("device_id") == device_id)
    if temple_id is not None:
        df = df.filter(F.col("temple_id") == temple_id)
    return _sorted(df.select("temple_id", "device_id", time, names.col(field)), [time], sort)


def scan_id(table, value=None, id_column: str = "device_id", time: str = "time", sort: bool = False, spark=None) -> DataFrame:
    """All history of one id, or of every known id when none is given."""
    df = as_frame(spark, table)
    known = names.col(id_column)
    df = df.filter(known.isNotNull()) if value is None else df.filter(known == value)
    return _sorted(df, [time] if value is not None else [id_column, time], sort)


def distinct_ids(table, id_column: str = "device_id", spark=None) -> DataFrame:
    df = as_frame(spark, table).select(names.col(id_column))
    return df.filter(names.col(id_column).isNotNull()).distinct()


def global_time_range(table, time: str = "time", spark=None) -> DataFrame:
    """Earliest and latest time (one row, NULLs for an empty table)."""
    return as_frame(spark, table).agg(F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def require_time_range(table, time: str = "time", spark=None) -> tuple:
    """The same as values; an empty table is an error."""
    row = global_time_range(table, time, spark).first()
    if row["min_time"] is None:
        raise ValueError("the table has no rows with a time")
    return row["min_time"], row["max_time"]


def scan_fields(
    table, fields: Sequence[str], start=None, end=None, temple_id=None, device_id=None, time: str = "time",
    sort: bool = False, spark=None,
) -> DataFrame:
    """Chosen fields, time always among them; closed range, optional site and
    device."""
    df = time_range(as_frame(spark, table), start, end, "both", time)
    if temple_id is not None:
        df = df.filter(F.col("temple_id") == temple_id)
    if device_id is not None:
        df = df.filter(F.col("device_id") == device_id)
    wanted = [names.unquote(f) for f in fields]
    if time not in wanted:
        wanted = [time, *wanted]
    names.require_columns(df, wanted)
    return _sorted(df.select(*[names.col(f) for f in wanted]), [time], sort)


def run_sql(spark: SparkSession, query: str, database: str | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Ad-hoc SQL over catalog tables and, by name, over DataFrames."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    return spark.sql(query, **(tables or {}))
