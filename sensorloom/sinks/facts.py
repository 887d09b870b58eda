"""The long feature fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.sinks.tables import append_by_name, create_table_if_missing
from sensorloom.schemas import TABLES

FACT_TABLE = "sensor_feature_data"
FACT_COLUMNS = tuple(TABLES[FACT_TABLE].names)


def to_facts(
    long: DataFrame,
    stats_cycle: str | None = None,
    created_at: Column | None = None,
    numeric_copy: bool = False,
) -> DataFrame:
    """Long features in the fact layout: eight columns in fixed order, the
    value as text.

    Text of a double differs between engines, so ``numeric_copy`` keeps the
    number as ``feature_number`` too.
    """
    out = long
    if "stats_cycle" not in out.columns:
        out = out.withColumn("stats_cycle", F.lit(stats_cycle if stats_cycle else "unknown"))
    out = out.withColumn("created_at", created_at if created_at is not None else F.current_timestamp())
    out = out.withColumnsRenamed(
        {"time": "stats_start_time", "field_name": "monitored_variable", "value": "feature_value"}
    )
    number = [F.col("feature_value").cast("double").alias("feature_number")] if numeric_copy else []
    columns = [F.col(c).cast("string") if c == "feature_value" else F.col(c) for c in FACT_COLUMNS]
    return out.select(*[c.alias(n) for c, n in zip(columns, FACT_COLUMNS)], *number)


def load_facts(long: DataFrame, table: str, stats_cycle: str | None = None) -> None:
    """Append long features to the fact table, creating it if missing."""
    create_table_if_missing(long.sparkSession, table, TABLES[FACT_TABLE], by_month="stats_start_time")
    append_by_name(to_facts(long, stats_cycle), table, "stats_start_time", ["temple_id", "device_id", "stats_start_time"])
