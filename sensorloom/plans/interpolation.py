"""Interpolation job: readings to a gap-filled minute grid."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorloom.operators.interpolate import resample_and_interpolate
from sensorloom.sinks.tables import store_table
from sensorloom.sources.tables import as_frame

LOCAL_TZ = "Asia/Shanghai"


def interpolated_readings(
    table, freq: str = "1min", gap_hours: float = 2.0, local_tz: str | None = LOCAL_TZ, spark=None
) -> DataFrame:
    """All devices and local months at once, in the layout of the
    interpolated table."""
    df = as_frame(spark, table)
    keys = [c for c in ("temple_id", "device_id") if c in df.columns]
    values = [c for c in ("humidity", "temperature") if c in df.columns]
    out = resample_and_interpolate(df.select(*keys, "time", *values), freq, gap_hours, keys, "time", local_tz)
    return out.select("time", *values, *reversed(keys))


def run_interpolation_job(table, target: str, freq: str = "1min", gap_hours: float = 2.0,
                          local_tz: str | None = LOCAL_TZ, spark=None) -> None:
    out = interpolated_readings(table, freq, gap_hours, local_tz, spark)
    store_table(out, target, "time", ["temple_id", "device_id", "time"])
