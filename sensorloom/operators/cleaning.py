"""Cleaning of raw exports: renaming, lenient parsing, dropping, metadata."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names

logger = logging.getLogger(__name__)


def apply_column_map(df: DataFrame, mapping: Mapping[str, str], created_at: Column | None = None) -> DataFrame:
    """Rename by map and keep the mapped columns; absent ones are skipped.

    Adds ``created_at`` and parses ``time`` leniently, dropping rows without.
    """
    present = {src: dst for src, dst in mapping.items() if src in df.columns}
    for dst in mapping.values():  # already carries the target name
        if dst in df.columns and dst not in present.values():
            present[dst] = dst
    missing = [dst for dst in mapping.values() if dst not in present.values()]
    if missing:
        logger.warning("mapped columns %s are not in the data and are skipped", missing)
    out = df.select(*[names.col(src).alias(dst) for src, dst in present.items()])
    out = out.withColumn("created_at", created_at if created_at is not None else F.current_timestamp())
    return drop_without_time(parse_time(out)) if "time" in out.columns else out


def lenient_time(col: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def parse_time(df: DataFrame, time: str = "time", fmt: str | None = None) -> DataFrame:
    """Text times to timestamps, NULL where unreadable."""
    if dict(df.dtypes)[time] != "string":
        return df
    return df.withColumn(time, lenient_time(F.col(time), fmt))


def drop_without_time(df: DataFrame, time: str = "time") -> DataFrame:
    return df.na.drop(subset=[time])


def coerce_numeric(df: DataFrame, columns: Sequence[str], drop_incomplete: bool = True) -> DataFrame:
    """Lenient conversion to double; rows with any NULL are then dropped."""
    casts = {c: F.expr(f"try_cast({names.quote(c)} as double)") for c in columns}
    out = df.select(*[casts[c].alias(c) if c in casts else names.col(c) for c in df.columns])
    out = out.select(*[F.when(~F.isnan(names.col(c)), names.col(c)).alias(c) if c in casts else names.col(c)
                       for c in out.columns])
    return out.na.drop("any") if drop_incomplete else out


def fill_as_integer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing becomes 0, fractions are cut off."""
    todo = set(columns)
    return df.select(*[
        F.coalesce(F.expr(f"try_cast({names.quote(c)} as double)"), F.lit(0.0)).cast("int").alias(c)
        if c in todo else names.col(c)
        for c in df.columns
    ])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def add_metadata(df: DataFrame, **values) -> DataFrame:
    """Constant columns such as device_id, temple_id, created_at."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def add_source_label(df: DataFrame, database: str, table: str, out: str = "data_source") -> DataFrame:
    return df.withColumn(out, F.lit(f"{database}.{table}"))


def special_number(col: Column) -> Column:
    """Text to double with the spellings of infinities and NaN; NULL if the
    text is no number."""
    text = F.trim(col.cast("string"))
    return (
        F.when(text.isin("Infinity", "inf"), F.lit(float("inf")))
        .when(text.isin("-Infinity", "-inf"), F.lit(float("-inf")))
        .when(text == "NaN", F.lit(None))
        .otherwise(text.try_cast("double"))
    )


def to_utc(df: DataFrame, tz: str, time: str = "time") -> DataFrame:
    """Local wall time to UTC."""
    return df.withColumn(time, F.to_utc_timestamp(F.col(time).cast("timestamp"), tz))


def to_local(df: DataFrame, tz: str, time: str = "time") -> DataFrame:
    return df.withColumn(time, F.from_utc_timestamp(F.col(time).cast("timestamp"), tz))


def strip_zone(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn(time, F.col(time).cast("timestamp_ntz"))
