"""Scans of exported files: CSV folders, Parquet series, sheet folders.

Workbooks are expected as one CSV or Parquet file per sheet, laid out as
``.../sheet=<NAME>/<original workbook name>.csv``: Spark then lists, splits and
prunes them like any partitioned folder.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.operators.cleaning import lenient_time
from sensorloom.operators.slices import small_side
from sensorloom.schemas import EXPORT_NAME_PATTERN, RAW_TIME_COLUMN, SENSOR_ROUTES, SHEET_YEARS
from sensorloom.session import stored
from sensorloom.sources.tables import time_range

logger = logging.getLogger(__name__)

FILE = "_file"


def _raw_lines(spark: SparkSession, path: str, encoding: str, pattern: str, skip_corrupt: bool) -> DataFrame:
    """(file, at_start, place, line) of all files; the CSV reader knows encodings that the text reader does not.

    ``place`` grows along a file's block, so the least one at the start of a file is its first line."""
    lines = (
        spark.read.option("encoding", encoding).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").option("ignoreCorruptFiles", str(skip_corrupt).lower())
        .option("header", "false").option("sep", "\u0001").option("quote", "")
        .csv(path, schema=T.StructType([T.StructField("line", T.StringType())]))
    )
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        (F.col("_metadata.file_block_start") == 0).alias("at_start"), F.monotonically_increasing_id().alias("place"), F.ltrim("line", F.lit("\ufeff")).alias("line"))


def read_csv_folder(
    spark: SparkSession,
    path: str,
    time: str = RAW_TIME_COLUMN,
    encoding: str = "GBK",
    pattern: str = "*.csv",
    same_header: bool = False,
    sort: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """All CSV files of a folder as one frame, columns united by name.

    The header of each file stays in a table keyed by file; only the distinct
    headers (layouts) come to the driver.  Lines are joined with their file's
    header and taken apart once, whatever the number of layouts, so file names
    may hold any character.  ``same_header=True`` promises equal headers and
    spares that pass.  ``time`` is parsed and rows without are dropped when the
    column exists.  Values with line breaks need ``same_header=True``.
    ``read_csv_folder_checked`` tells what is wrong with which file.
    """
    if same_header:
        reader = (
            spark.read.option("header", "true").option("encoding", encoding).option("mode", "PERMISSIVE")
            .option("ignoreCorruptFiles", str(skip_corrupt).lower())
            .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        )
        frame = reader.csv(path)
        df = frame.toDF(*[c.lstrip("\ufeff") for c in frame.columns])
        if time in df.columns:
            df = df.withColumn(time, lenient_time(names.col(time)))
    else:
        df = _parsed_folder(spark, path, time, encoding, pattern, skip_corrupt)[0].drop(FILE, "_reason")
        if not df.columns:
            raise ValueError(f"no {pattern} files with content in {path}")
    if time in df.columns:
        df = df.filter(names.col(time).isNotNull())
        if sort:
            df = df.orderBy(names.col(time))
    return df


# What may be wrong with a file or a line of it.
NO_HEADER, UNDECODABLE, TOO_WIDE, BAD_TIME = "no header", "undecodable characters", "more fields than the header", "time can't be read"


def read_csv_folder_checked(
    spark: SparkSession, path: str, time: str = RAW_TIME_COLUMN, encoding: str = "GBK", pattern: str = "*.csv", skip_corrupt: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a folder of CSV files.

    Rows are those of ``read_csv_folder`` less the rejected lines, with the
    file's path in ``_file``.  Rejects have one row (file, reason, n_lines) for
    each reason a file gives: it has no header (an empty file, n_lines 0), or
    has lines with characters that are not of the encoding, with more fields
    than the header, or with a time that can't be read.  A folder without any
    header gives rows without columns but ``_file``.
    """
    parsed, headers = _parsed_folder(spark, path, time, encoding, pattern, skip_corrupt)
    # scans leave out empty files, the listing names them
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).inputFiles()
    listed = spark.createDataFrame([(f,) for f in listing], "file string")
    slashes = F.regexp_replace("file", r"^(\w+):/+", "$1:/").alias("f")  # file:/ and file:/// are one place
    empty = listed.select("file", slashes).join(headers.select(slashes), "f", "left_anti").select("file", F.lit(NO_HEADER).alias("reason"), F.lit(0).cast("long").alias("n_lines"))
    lines = parsed.filter(F.col("_reason").isNotNull()).groupBy(F.col(FILE).alias("file"), F.col("_reason").alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))
    rows = parsed.filter(F.col("_reason").isNull()).drop("_reason")
    if time in rows.columns:
        rows = rows.filter(names.col(time).isNotNull())
    return rows, lines.unionByName(empty)


def _layout(header: str) -> list[str]:
    """Column names of a header line, parsed as CSV; a repeated or empty name gets its place."""
    out: list[str] = []
    for at, name in enumerate(next(csv.reader([header]))):
        name = name.strip()
        out.append(name if name and name not in out else f"{name}_{at}")
    return out


def _parsed_folder(spark: SparkSession, path: str, time: str, encoding: str, pattern: str, skip_corrupt: bool) -> tuple[DataFrame, DataFrame]:
    """(all lines but headers as columns united by name, with _file and _reason; the header of each file)."""
    lines = _raw_lines(spark, path, encoding, pattern, skip_corrupt)
    headers = stored(
        lines.filter("at_start").groupBy("file").agg(F.min(F.struct("place", "line")).alias("h")).filter("h.line <> ''")
        .select("file", F.col("h.line").alias("header"), F.col("h.place").alias("header_place")), "headers")
    layouts = {r["header"]: _layout(r["header"]) for r in headers.select("header").distinct().orderBy("header").collect()}
    columns = list(dict.fromkeys(c for layout in layouts.values() for c in layout))
    width = max(map(len, layouts.values()), default=0)
    known = spark.createDataFrame([(k, v) for k, v in layouts.items()], "header string, layout array<string>")
    of_file = small_side(headers.join(F.broadcast(known), "header"), headers.count())  # layouts are on the driver anyway
    rows = lines.join(of_file, "file").filter(~F.col("at_start") | (F.col("place") != F.col("header_place")))
    ddl = ", ".join(f"c{k} string" for k in range(width + 1))
    rows = rows.select("file", "line", "layout", F.from_csv("line", ddl).alias("r")) \
        .select("file", "line", "layout", F.array(*[F.col(f"r.c{k}") for k in range(width + 1)]).alias("v"))
    values = {c: F.get("v", F.array_position("layout", F.lit(c)).cast("int") - 1) for c in columns}
    out = {c: lenient_time(v) if c == time else v for c, v in values.items()}
    reason = F.when(F.col("line").contains("\ufffd"), UNDECODABLE).when(F.get("v", F.size("layout")).isNotNull(), TOO_WIDE)
    if time in columns:
        reason = reason.when((F.trim(values[time]) != "") & lenient_time(values[time]).isNull(), BAD_TIME)
    return rows.select(F.col("file").alias(FILE), reason.alias("_reason"), *[v.alias(c) for c, v in out.items()]), headers


def read_csv_series(
    spark: SparkSession,
    path: str,
    time: str = "time",
    encoding: str = "utf-8",
    schema: T.StructType | None = None,
    required: Sequence[str] = (),
    infer: bool = True,
) -> DataFrame:
    """Time series CSV: checks columns, parses the time.

    Pass ``schema`` for large inputs, or ``infer=False`` for text columns;
    inference costs an extra pass.
    """
    reader = spark.read.option("header", "true").option("encoding", encoding)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", str(infer).lower()).csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    names.require_columns(df, [time, *required])
    if dict(df.dtypes)[time] not in ("timestamp", "timestamp_ntz"):
        df = df.withColumn(time, F.to_timestamp(names.col(time).cast("string")))
    return df


def read_parquet_series(
    spark: SparkSession, path: str, column: str, start=None, end=None, time: str = "time"
) -> DataFrame:
    """One column of a Parquet series, inclusive date slice."""
    df = spark.read.parquet(path)
    names.require_columns(df, [time, column])
    if dict(df.dtypes)[time] not in ("timestamp", "timestamp_ntz"):
        df = df.withColumn(time, F.to_timestamp(F.col(time).cast("string")))
    return time_range(df, start, end, "both", time).select(
        *[c for c in ("temple_id", "device_id") if c in df.columns], time, names.col(column)
    )


# --- sheet folders -------------------------------------------------------


def read_sheets(
    spark: SparkSession, path: str, fmt: str = "csv", encoding: str = "utf-8", text_columns: Sequence[str] = (),
    skip_corrupt: bool = False,
) -> DataFrame:
    """All sheets below ``path`` with ``sheet`` and the file name; rows without
    any value are dropped.  CSV values stay text, ``text_columns`` says which
    Parquet columns are to be text too.  Damaged files fail the read unless
    ``skip_corrupt`` is set; then their readable part is kept."""
    reader = spark.read.option("basePath", path).option("recursiveFileLookup", "false")
    if fmt == "csv":
        reader = reader.option("header", "true").option("encoding", encoding).option("enforceSchema", "false")
    df = reader.option("ignoreCorruptFiles", str(skip_corrupt).lower()).format(fmt).load(path)
    values = [c for c in df.columns if c != "sheet"]
    df = df.select(*[names.col(c) for c in df.columns], F.col("_metadata.file_name").alias(FILE))
    for c in text_columns:
        df = df.withColumn(c, names.col(c).cast("string"))
    df = df.na.drop("all", subset=values)
    return df.withColumn("sheet", F.col("sheet").cast("string")) if "sheet" in df.columns else df


def is_year_sheet(sheet: Column, years: tuple[int, int | None] = SHEET_YEARS) -> Column:
    """Is the sheet named by a year of the range?  An end of None is open."""
    year = sheet.try_cast("int")
    inside = year >= years[0] if years[1] is None else year.between(*years)
    return F.coalesce(sheet.rlike(r"^\d+$") & inside, F.lit(False))


def year_sheets(df: DataFrame, years: tuple[int, int | None] = SHEET_YEARS, sheet: str = "sheet") -> DataFrame:
    """Rows of sheets named by a year of the range."""
    return df.filter(is_year_sheet(F.col(sheet), years))


def file_metadata(df: DataFrame, file: str | Column = FILE, pattern: str = EXPORT_NAME_PATTERN) -> DataFrame:
    """device_id, temple_id and sensor keyword from the file name; rows of
    files with other names are dropped."""
    name = F.col(file) if isinstance(file, str) else file
    return df.filter(name.rlike(pattern)).withColumns(
        {
            "device_id": F.regexp_extract(name, pattern, 1),
            "temple_id": F.regexp_extract(name, pattern, 2),
            "sensor": F.regexp_extract(name, pattern, 3),
        }
    )


def route_sensors(df: DataFrame, routes: dict = SENSOR_ROUTES, sensor: str = "sensor") -> dict[str, DataFrame]:
    """Rows per target table, by sensor keyword."""
    return {
        route["table"]: df.filter(F.col(sensor) == keyword)
        for keyword, route in routes.items()
    }

