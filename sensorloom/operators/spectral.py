"""Amplitude spectrum of detrended series and their main periods."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.functions.timebucket import micros
from sensorloom.operators.sequence import detrend
from sensorloom.operators.slices import number, series_rows, split_hot
from sensorloom.operators.transforms import transform_products, with_sizes

# Series up to this many points are transformed in one task each (32 MB).
ONE_TASK_POINTS = 4_194_304


def _spectrum_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    fields = [df.schema[k] for k in keys]
    fields += [
        T.StructField("k", T.LongType()),
        T.StructField("period_hours", T.DoubleType()),
        T.StructField("amplitude", T.DoubleType()),
    ]
    return T.StructType(fields)


def _short_spectrum(rows: DataFrame, keys: list[str]) -> DataFrame:
    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_us")
        v, us = pdf["_v"].to_numpy(), pdf["_us"].to_numpy()
        n = len(v)
        index = np.arange(n) - (n - 1) / 2.0
        spread = float(index @ index)
        slope = float(index @ v) / spread if spread else 0.0
        amplitude = 2.0 / n * np.abs(np.fft.rfft(v - v.mean() - slope * index))[: n // 2]
        k = np.arange(n // 2)
        step = (us[1] - us[0]) / 3.6e9 if n > 1 else np.nan
        with np.errstate(divide="ignore"):
            periods = np.where(k > 0, n * step / k, np.inf)
        out = pd.DataFrame({"k": k, "period_hours": periods, "amplitude": amplitude})
        for at, key in enumerate(keys):
            out.insert(at, key, pdf[key].iloc[0])
        return out

    return rows.groupBy(*keys).applyInPandas(transform, _spectrum_schema(rows, keys))


# --- series too long for one task -----------------------------------------
#
# The transform of length N becomes a convolution with a chirp, done with
# split transforms of a power-of-two length M >= 2N.


def _chirp_phase(n: Column, length: Column) -> Column:
    """pi * n^2 / N, reduced exactly before it becomes a double."""
    square = n.cast("decimal(19,0)") * n.cast("decimal(19,0)")
    reduced = F.pmod(square, (length * 2).cast("decimal(38,0)")).cast("double")
    return F.lit(math.pi) * reduced / length


def _long_spectrum(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    flat = detrend(rows, "_v", keys, time, "_x").withColumnRenamed("row_index", "_i")
    meta = flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_N"),
        (F.max(F.when(F.col("_i") == 1, F.col("_us"))) - F.max(F.when(F.col("_i") == 0, F.col("_us")))).alias("_step"),
    )
    points = flat.join(with_sizes(meta), keys)
    phase = _chirp_phase(F.col("_i"), F.col("_N"))
    points = points.select(*keys, "_N", "_M", "_R", "_i", "_x", F.cos(phase).alias("_c"), F.sin(phase).alias("_s"))
    zero = F.lit(0.0)
    here = F.struct(
        F.col("_i").alias("_pos"),
        (F.col("_x") * F.col("_c")).alias("re0"), (-F.col("_x") * F.col("_s")).alias("im0"),
        F.col("_c").alias("re1"), F.col("_s").alias("im1"),
    )
    mirrored = F.struct(
        (F.col("_M") - F.col("_i")).alias("_pos"), zero.alias("re0"), zero.alias("im0"),
        F.col("_c").alias("re1"), F.col("_s").alias("im1"),
    )
    placed = points.select(
        *keys, "_N", "_M", "_R",
        F.explode(F.when(F.col("_i") == 0, F.array(here)).otherwise(F.array(here, mirrored))).alias("_e"),
    ).select(*keys, "_N", "_M", "_R", "_e.*")

    def load(*parts: np.ndarray) -> list[np.ndarray]:
        return [parts[0] + 1j * parts[1], parts[2] + 1j * parts[3]]

    def multiply(signal: np.ndarray, chirp: np.ndarray) -> list[np.ndarray]:
        return [signal * chirp]

    convolved = transform_products(placed, keys, ["re0", "im0", "re1", "im1"], load, multiply, 1)
    wanted = convolved.filter(F.col("_pos") < F.floor(F.col("_N") / 2))
    k, n = F.col("_pos"), F.col("_N")
    return wanted.join(meta.select(*keys, "_step"), keys).select(
        *keys,
        k.alias("k"),
        F.when(k > 0, n * (F.col("_step") / 3.6e9) / F.when(k > 0, k)).otherwise(float("inf")).alias("period_hours"),
        # the last chirp factor has modulus one
        (F.lit(2.0) / n * F.hypot("re0", "im0")).alias("amplitude"),
    )


def amplitude_spectrum(
    df: DataFrame,
    field: str,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    one_task_points: int = ONE_TASK_POINTS,
) -> DataFrame:
    """One-sided amplitude spectrum per series: ``k``, ``period_hours``,
    ``amplitude`` for k = 0 .. N/2 - 1; k = 0 has an infinite period.

    Rows without value are dropped; the sampling step is that of the first two
    rows.
    """
    keys = list(keys)
    rows = series_rows(df, keys, time).select(
        *keys, time, micros(F.col(time)).alias("_us"), number(names.col(field)).alias("_v")
    ).filter(F.col("_v").isNotNull())
    short, long = split_hot(rows, keys, one_task_points)
    return _short_spectrum(short, keys).unionByName(_long_spectrum(long, keys, time))


def main_periods(
    df: DataFrame,
    field: str,
    top_n: int = 1,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    one_task_points: int = ONE_TASK_POINTS,
) -> DataFrame:
    """Strongest periods per series as long features stamped with the last
    time: ``main_period_<i>_hours`` and ``main_period_<i>_strength``."""
    keys = list(keys)
    spectrum = amplitude_spectrum(df, field, keys, time, one_task_points)
    # the rank filter is applied map-side too
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("amplitude"), F.asc("k")))
    top = spectrum.withColumn("_rank", rank).filter(F.col("_rank") <= top_n)
    last = series_rows(df, keys, time).groupBy(*keys).agg(F.max(time).alias(time))
    name = F.concat(F.lit("main_period_"), F.col("_rank").cast("string"))
    pairs = F.array(
        F.struct(F.concat(name, F.lit("_hours")).alias("feature_key"), F.col("period_hours").alias("value")),
        F.struct(F.concat(name, F.lit("_strength")).alias("feature_key"), F.col("amplitude").alias("value")),
    )
    return (
        top.select(*keys, F.explode(pairs).alias("_p"))
        .join(last, keys)
        .select(*keys, time, "_p.feature_key", "_p.value")
    )
