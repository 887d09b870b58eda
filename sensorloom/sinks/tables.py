"""Table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.functions.timebucket import local_month
from sensorloom.sources.tables import PARTITION


def _layout(df: DataFrame, order: Sequence[str], partition: bool) -> DataFrame:
    """Even files, sorted inside.

    The rebalance hint lets adaptive execution split a month (or device) that
    holds most of the rows and merge small ones, by actual size.
    """
    hint = [PARTITION] if partition else []
    return df.hint("rebalance", *hint).sortWithinPartitions(*hint, *[names.quote(c) for c in order])


def store_table(
    df: DataFrame,
    table: str,
    time: str | None = "time",
    order: Sequence[str] = (),
    by_month: bool = True,
    rows_per_file: int = 0,
    fmt: str = "parquet",
) -> None:
    """Append to a table, creating it from the frame's schema if needed.

    Column names are cleaned; with a time column the table is partitioned by
    month and sorted by ``order`` (default: time) inside each file, which is
    what range filters prune on.  Files follow the session's target size;
    ``rows_per_file`` caps them by rows if positive.
    """
    clean = names.sanitize_columns(df)
    stamp = names.sanitize(time) if time else None
    spark = df.sparkSession
    ensure_database(spark, table)
    by_month = by_month and stamp in clean.columns
    if by_month:
        clean = clean.withColumn(PARTITION, local_month(F.col(stamp)))
    order = [names.sanitize(c) for c in order] or [stamp if stamp in clean.columns else clean.columns[0]]
    laid = _layout(clean, order, by_month)
    # appending this way matches columns by name
    writer = laid.write.mode("append").format(fmt).option("maxRecordsPerFile", rows_per_file)
    if by_month:
        writer = writer.partitionBy(PARTITION)
    writer.saveAsTable(table)


def append_by_name(df: DataFrame, table: str, time: str = "time", order: Sequence[str] = ()) -> None:
    """Append rows, columns matched by name; columns the rows lack become
    NULL.

    For a table partitioned by month the month comes from ``time``; rows
    without it would be lost to range scans, so a frame without that column is
    refused.  ``order`` sorts the rows inside each file.
    """
    target = df.sparkSession.table(table)
    by_month = PARTITION in target.columns
    if by_month and PARTITION not in df.columns:
        if time not in df.columns:
            raise ValueError(f"table {table} is partitioned by month, and the rows have no column {time!r} to take it from")
        df = df.withColumn(PARTITION, local_month(names.col(time)))
    unknown = [c for c in df.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"table {table} has no columns {unknown}")
    columns = [
        (names.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    rows = df.select(*columns)
    if by_month or order:
        rows = _layout(rows, list(order) or [time], by_month)
    rows.write.mode("append").insertInto(table)


def write_month_partitions(
    df: DataFrame, path: str, time: str = "time", order: Sequence[str] = (), mode: str = "append"
) -> None:
    """Parquet folder partitioned by month."""
    out = df.withColumn(PARTITION, local_month(F.col(time)))
    _layout(out, list(order) or [time], True).write.mode(mode).partitionBy(PARTITION).parquet(path)


def ensure_database(spark: SparkSession, table: str) -> None:
    parts = table.replace("`", "").split(".")
    if len(parts) > 1:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.quote(parts[-2])}")


# Type names of the column store the exported definitions are written for.
_DDL_TYPES = {
    "tinyint": "Int8",
    "smallint": "Int16",
    "int": "Int32",
    "bigint": "Int64",
    "float": "Float32",
    "double": "Float64",
    "boolean": "UInt8",
    "timestamp": "DateTime",
    "timestamp_ntz": "DateTime",
}


def column_definitions(df: DataFrame) -> list[tuple[str, str]]:
    """Cleaned column names with their exchange type, String by default."""
    return [(names.sanitize(c), _DDL_TYPES.get(t, "String")) for c, t in df.dtypes]


def create_table_sql(schema: T.StructType, table: str, by_month: str | None = None, fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a schema; ``by_month`` names the time
    column whose month partitions the table."""
    columns = [f"{names.quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    tail = ""
    if by_month:
        columns.append(f"{names.quote(PARTITION)} string")
        tail = f" PARTITIONED BY ({names.quote(PARTITION)})"
    path = ".".join(names.quote(p) for p in table.split("."))
    return f"CREATE TABLE IF NOT EXISTS {path} ({', '.join(columns)}) USING {fmt}{tail}"


def create_table_if_missing(
    spark: SparkSession, table: str, schema: T.StructType, by_month: str | None = None, fmt: str = "parquet"
) -> None:
    ensure_database(spark, table)
    spark.sql(create_table_sql(schema, table, by_month, fmt))


def create_raw_tables(spark: SparkSession, database: str) -> list[str]:
    """The raw sensor tables the ingest job appends to."""
    from sensorloom.schemas import SENSOR_ROUTES, TABLES

    made = []
    for route in SENSOR_ROUTES.values():
        table = f"{database}.{route['table']}"
        create_table_if_missing(spark, table, TABLES[route["table"]], by_month="time")
        made.append(table)
    return made


SYSTEM_DATABASES = ("information_schema", "system")


def export_catalog(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """One row per table: database, table, definition.  Only metadata."""
    rows = []
    found = [d.name for d in spark.catalog.listDatabases()]
    for database in databases or [d for d in found if d.lower() not in SYSTEM_DATABASES]:
        for t in spark.catalog.listTables(database):
            if t.isTemporary:
                continue
            path = f"{names.quote(database)}.{names.quote(t.name)}"
            ddl = spark.sql(f"SHOW CREATE TABLE {path}").first()[0]
            rows.append((database, t.name, ddl))
    return spark.createDataFrame(rows, "database string, table string, ddl string")
