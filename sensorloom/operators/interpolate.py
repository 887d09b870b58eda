"""Gap-limited linear interpolation on a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.timebucket import from_micros, local_month, micros, parse_duration_micros
from sensorloom.operators.stats import numeric_columns, resample_numeric_mean

MONTH = "_month"


def interpolate_gaps(
    df: DataFrame,
    columns: Sequence[str],
    freq: str = "1min",
    gap_hours: float = 2.0,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
) -> DataFrame:
    """Fill the grid between the first and last row of each key.

    ``df`` has at most one row per key and grid point.  A missing value is
    interpolated by time when its known neighbours are at most ``gap_hours``
    apart and stays NULL otherwise, also at the edges.  One sort per key: each
    row knows its neighbours and is expanded up to the next row.
    """
    keys = list(keys)
    dtype = df.schema[time].dataType
    step = parse_duration_micros(freq)
    gap = int(gap_hours * 3_600_000_000)
    order = Window.partitionBy(*keys).orderBy("_us")
    rows = df.select(*keys, micros(F.col(time)).alias("_us"), *[names.col(c) for c in columns])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_end", F.coalesce(F.lead("_us").over(order) - step, F.col("_us")))
    for at, c in enumerate(columns):
        known = F.when(names.col(c).isNotNull(), F.struct(F.col("_us").alias("t"), names.col(c).alias("v")))
        rows = rows.withColumn(f"_known{at}", known)
    for at in range(len(columns)):
        rows = rows.withColumn(f"_prev{at}", F.last(f"_known{at}", ignorenulls=True).over(upto))
        rows = rows.withColumn(f"_next{at}", F.expr(f"lead(_known{at}) ignore nulls").over(order))
    grid = rows.withColumn("_t", F.explode(F.sequence("_us", "_end", F.lit(step))))
    out = []
    for at, c in enumerate(columns):
        prev, nxt = F.col(f"_prev{at}"), F.col(f"_next{at}")
        width = nxt["t"] - prev["t"]
        filled = prev["v"] + (nxt["v"] - prev["v"]) * ((F.col("_t") - prev["t"]) / F.nullif(width, F.lit(0)))
        out.append(
            F.when(F.col("_t") == prev["t"], prev["v"]).when(width <= gap, filled).alias(c)
        )
    return grid.select(*keys, from_micros(F.col("_t"), dtype).alias(time), *out)


def resample_and_interpolate(
    df: DataFrame,
    freq: str = "1min",
    gap_hours: float = 2.0,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    local_tz: str | None = None,
) -> DataFrame:
    """Mean of the numeric columns on the grid, then gap-limited filling.

    Work is keyed by device and local calendar month; nothing is filled across
    a month edge, and a month of grid points bounds each window partition.
    """
    keys = list(keys)
    columns = numeric_columns(df, (*keys, time))
    rows = df.withColumn(MONTH, local_month(F.col(time), local_tz))
    means = resample_numeric_mean(rows, freq, [*keys, MONTH], time, fill=False)
    return interpolate_gaps(means, columns, freq, gap_hours, [*keys, MONTH], time).drop(MONTH)
