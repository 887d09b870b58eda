"""JSON time series: rows ``{"data": [{...}]}`` or ``[{...}]``, and columns
``{"data": {"time": [...], "field": [...]}}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.operators.cleaning import special_number

# Error types of rejected requests.
PARSE_ERROR, VALIDATION_ERROR = "JSONParseError", "ValidationError"


def _has_key(name: str):
    return lambda m: F.map_contains_key(m, name)


def _once(df: DataFrame, keep: Sequence[str], *parsed) -> DataFrame:
    """Select through a generator of one row: filters and projections above
    are not merged into it, so that each document is parsed once and not once
    per use of a parsed column."""
    return df.select(*keep, F.inline(F.array(F.struct(*parsed))))


def parse_documents(
    df: DataFrame,
    fields: Sequence[str],
    column: str = "data_json",
    time: str = "time",
    ids: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Explode one JSON document per row into readings.

    Returns (readings, rejects).  A document becomes one reject row with
    ``type``, ``message`` and ``details`` instead of failing the job if it is no
    JSON, is empty, lacks a field, has columns of different lengths, or holds a
    time or a field value that can't be read.  ``details`` is JSON: the missing
    fields, the lengths, or row (from 0), column and text of the first value
    that can't be read and the number of such values.  NULL times and values,
    and the spellings of infinities and NaN, are no errors.  All three layouts
    are accepted; the time may also be called ``index``.
    """
    text = F.col(column)
    blank = text.isNull() | (F.trim(text) == "")
    docs = _once(df, [*ids], blank.alias("_blank"), F.try_parse_json(text).alias("_v"))
    body = F.coalesce(F.try_variant_get("_v", "$.data", "variant"), F.col("_v"))
    docs = _once(
        docs, [*ids], "_blank", F.col("_v").isNull().alias("_broken"),
        F.try_variant_get(body, "$", "array<map<string,string>>").alias("_rows"),
        F.try_variant_get(body, "$", "map<string,array<string>>").alias("_columns"),
    )
    at = F.try_element_at
    rows, columns = F.col("_rows"), F.col("_columns")
    from_rows = F.transform(
        rows,
        lambda m: F.struct(
            F.coalesce(at(m, F.lit(time)), at(m, F.lit("index"))).alias("time"),
            *[at(m, F.lit(f)).alias(f) for f in fields],
        ),
    )
    stamps = F.coalesce(at(columns, F.lit(time)), at(columns, F.lit("index")))
    from_columns = F.transform(
        F.arrays_zip(stamps.alias("time"), *[at(columns, F.lit(f)).alias(f) for f in fields]),
        lambda r: F.struct(r["time"].alias("time"), *[r[f].alias(f) for f in fields]),
    )
    absent = []
    for f in fields:
        in_rows = F.exists(rows, _has_key(f))
        present = F.coalesce(in_rows, F.map_contains_key(columns, f), F.lit(False))
        absent.append(F.when(~present, F.lit(f)))
    docs = docs.withColumn("_absent", F.array_compact(F.array(*absent)))
    docs = docs.withColumn("_records", F.coalesce(from_rows, from_columns))
    # texts are parsed once; what can't be read is noted beside the value
    docs = _once(
        docs, [*ids], "_blank", "_broken", "_absent",
        F.coalesce(F.size("_rows"), F.size(stamps), F.lit(0)).alias("_n"),
        F.when(F.col("_rows").isNull(), F.transform_values(columns, lambda _, v: F.size(v))).alias("_lengths"),
        F.transform("_records", lambda r, i: _parsed(r, i, fields)).alias("_parsed"),
    )
    docs = docs.withColumn("_wrong", F.filter(F.flatten(F.transform("_parsed", lambda r: r["wrong"])), lambda w: w.isNotNull()))
    broken = F.col("_broken") | F.col("_blank")
    no_rows = F.col("_n") < 1
    lacking = F.size("_absent") > 0
    ragged = F.coalesce(F.size(F.array_distinct(F.map_values("_lengths"))) > 1, F.lit(False))
    unread = F.coalesce(F.size("_wrong") > 0, F.lit(False))
    rejected = broken | no_rows | lacking | ragged | unread
    first = F.get("_wrong", 0)
    plain = ~(broken | no_rows)

    def said(condition: Column, value: Column) -> Column:
        return F.when(plain & condition, value)

    rejects = docs.filter(rejected).select(
        *ids,
        F.lit(False).alias("success"),
        F.when(broken, PARSE_ERROR).otherwise(VALIDATION_ERROR).alias("type"),
        F.when(F.col("_blank"), "the document is empty")
        .when(broken, "the document is not JSON")
        .when(no_rows, "the document has no rows")
        .when(lacking, F.concat(F.lit("Field not found: "), F.array_join("_absent", ", ")))
        .when(ragged, "columns differ in length")
        .when(first["column"] == "time", "a time can't be read")
        .otherwise(F.concat(F.lit("not a number in field: "), first["column"]))
        .alias("message"),
        F.to_json(F.struct(
            said(lacking, F.col("_absent")).alias("missing_fields"),
            said(~lacking & ragged, F.col("_lengths")).alias("lengths"),
            *[said(~lacking & ~ragged, first[c]).alias(c) for c in ("row", "column", "value")],
            said(~lacking & ~ragged, F.size("_wrong")).alias("count"),
        )).alias("details"),
    )
    good = docs.filter(~rejected).select(*ids, F.explode("_parsed").alias("_r"))
    readings = good.select(*ids, F.col("_r.time").alias("time"), *[F.col("_r.values")[at].alias(f) for at, f in enumerate(fields)])
    return readings, rejects


def _parsed(record: Column, row: Column, fields: Sequence[str]) -> Column:
    """Time and values of one record, and for each of them NULL or what can't be read."""

    def wrong(column: str, text: Column, value: Column) -> Column:
        nan = F.trim(text) == "NaN"
        return F.when(text.isNotNull() & value.isNull() & ~nan, F.struct(
            row.alias("row"), F.lit(column).alias("column"), text.alias("value")))

    stamp = F.try_to_timestamp(record["time"])
    values = [special_number(record[f]) for f in fields]
    return F.struct(
        stamp.alias("time"),
        F.array(*values).alias("values"),
        F.array(wrong("time", record["time"], stamp), *[wrong(f, record[f], v) for f, v in zip(fields, values)]).alias("wrong"),
    )


def read_json_series(
    spark: SparkSession, path: str, fields: Sequence[str], time: str = "time", one_per_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """JSON files, one document each or one per line, as (readings, rejects)."""
    docs = spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "data_json")
    return parse_documents(docs, fields, "data_json", time)


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Line-wise JSON with a declared schema: (rows, rejects); malformed lines
    go to the rejects with their text."""
    corrupt = "_malformed"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    df = lines.select(F.from_json("value", full, {"columnNameOfCorruptRecord": corrupt}).alias("_r")).select("_r.*")
    rejects = df.filter(F.col(corrupt).isNotNull()).select(
        F.lit(False).alias("success"),
        F.lit(PARSE_ERROR).alias("type"),
        F.lit("the document is not JSON").alias("message"),
        F.col(corrupt).alias("details"),
    )
    return df.filter(F.col(corrupt).isNull()).select(*[names.col(c) for c in schema.names]), rejects
