"""Ingest of exported workbooks (as sheet folders) into raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import cleaning
from sensorloom.schemas import CHECKPOINT_MAP, EXPORT_NAME_PATTERN, RECEPTION_MAP, SENSOR_ROUTES, SHEET_YEARS, TABLES
from sensorloom.sinks.tables import append_by_name, create_raw_tables, create_table_if_missing
from sensorloom.sources.files import FILE, file_metadata, is_year_sheet, read_sheets, route_sensors, year_sheets


def skipped_rows(sheets: DataFrame, years: tuple[int, int | None] = SHEET_YEARS) -> DataFrame:
    """What ``sensor_tables`` leaves out: sheet, file, reason and number of rows."""
    name = F.col(FILE)
    reason = F.when(~is_year_sheet(F.col("sheet"), years), F.lit("sheet is not a year of the range")) \
        .when(~name.rlike(EXPORT_NAME_PATTERN), F.lit("file name carries no device, temple and sensor kind"))
    rows = sheets.withColumn("reason", F.coalesce(reason, F.when(F.col("sheet").isNull() | name.isNull(), F.lit("no sheet or file name"))))
    return rows.filter("reason is not null").groupBy("sheet", name.alias("file"), "reason").agg(F.count(F.lit(1)).alias("rows"))


def sensor_tables(
    sheets: DataFrame, created_at: Column | None = None, years: tuple[int, int | None] = SHEET_YEARS
) -> dict[str, DataFrame]:
    """Sheet rows to one frame per raw sensor table.

    Keeps sheets named by a year of ``years`` (from, to; open if None) and files
    whose name carries device, temple and sensor kind; ``skipped_rows`` counts
    the others; values are coerced and incomplete rows dropped; columns
    come in table order.
    """
    rows = file_metadata(year_sheets(sheets, years))
    out = {}
    for keyword, route in SENSOR_ROUTES.items():
        table, mapping = route["table"], route["columns"]
        part = route_sensors(rows)[table]
        values = [c for c in mapping.values() if c != "time"]
        keep = {**mapping, "device_id": "device_id", "temple_id": "temple_id"}
        part = cleaning.apply_column_map(part, keep, created_at)
        part = cleaning.coerce_numeric(part, [c for c in values if c in part.columns])
        schema = TABLES[table]
        out[table] = part.select(
            *[(F.col(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
    return out


def checkpoint_counts(sheets: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Visitor counters: lenient time, missing counts 0, whole numbers."""
    out = cleaning.apply_column_map(sheets, CHECKPOINT_MAP, created_at)
    counts = [c for c in CHECKPOINT_MAP.values() if c != "time" and c in out.columns]
    return cleaning.fill_as_integer(out, counts)


def reception_stats(sheets: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Visitor flow per temple; the temple number stays text."""
    out = cleaning.apply_column_map(sheets, RECEPTION_MAP, created_at)
    return out.withColumn("temple_id", F.col("temple_id").cast("string")) if "temple_id" in out.columns else out


def ingest_sensor_exports(
    spark: SparkSession, path: str, database: str, fmt: str = "csv", encoding: str = "utf-8",
    years: tuple[int, int | None] = SHEET_YEARS, skip_corrupt: bool = False,
) -> DataFrame:
    """One glob read over the whole export folder, one append per table.

    Returns the counts of the rows left out.  A damaged file fails the job
    unless ``skip_corrupt`` asks to read what can be read of it."""
    create_raw_tables(spark, database)
    sheets = read_sheets(spark, path, fmt, encoding, skip_corrupt=skip_corrupt)
    for table, df in sensor_tables(sheets, years=years).items():
        append_by_name(df, f"{database}.{table}", "time", ["temple_id", "device_id", "time"])
    return skipped_rows(sheets, years)


def ingest_checkpoint_counts(spark: SparkSession, path: str, database: str, fmt: str = "csv", encoding: str = "utf-8") -> None:
    table = f"{database}.zcp_checkpoint_g1"
    create_table_if_missing(spark, table, TABLES["zcp_checkpoint_g1"], by_month="time")
    append_by_name(checkpoint_counts(read_sheets(spark, path, fmt, encoding)), table)


def ingest_reception_stats(spark: SparkSession, path: str, database: str,
                           table: str = "temple_reception_stats", fmt: str = "csv", encoding: str = "utf-8") -> None:
    create_table_if_missing(spark, f"{database}.{table}", TABLES[table], by_month="time")
    sheets = read_sheets(spark, path, fmt, encoding, text_columns=["洞窟号"])
    append_by_name(reception_stats(sheets), f"{database}.{table}")
