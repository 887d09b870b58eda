"""Autocorrelation at all lags of a series with missing values, by transforms.

The correlation at a lag needs six sums over the pairs of readings that are
both known: their number, both sums, both sums of squares and the sum of
products.  With the value, its square and the mask of known readings as arrays,
each sum is a correlation of two arrays at that lag, and all lags come from one
product of transforms.  Two sums share a transform as real and imaginary part.

Series of ordinary length are transformed in one task each.  Longer ones go
through split transforms, whose groups are bounded whatever the length of the
series; a reading is placed once, and what joins a series by its key is one
row.  Lags that only the first and last readings reach have few pairs, where
rounding of a transform would show; they are summed directly.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.operators.sequence import lag_sums
from sensorloom.operators.slices import number, row_index, small_side
from sensorloom.operators.transforms import partitions_for, transform_products, with_sizes

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
ONE_TASK_READINGS = 1_048_576
PARTITION_READINGS = 262_144  # of series that take one task each
DIRECT = 256  # the last lags, summed pair by pair


def _transformed(x: np.ndarray) -> dict[str, np.ndarray]:
    """The six sums at the lags 1 .. len(x) - 1; NaN is missing."""
    size = 1 << (2 * len(x) - 1).bit_length()
    mask = ~np.isnan(x)
    v = np.where(mask, x, 0.0)
    fm, fv, fq = (np.fft.rfft(a, size) for a in (mask.astype(float), v, v * v))

    def at_lags(early: np.ndarray, late: np.ndarray) -> np.ndarray:
        return np.fft.irfft(np.conj(early) * late, size)[1:len(x)]

    return {"n": np.round(at_lags(fm, fm)), "sx": at_lags(fv, fm), "sy": at_lags(fm, fv),
            "sxx": at_lags(fq, fm), "syy": at_lags(fm, fq), "sxy": at_lags(fv, fv)}


def _schema(df: DataFrame, keys: list[str]) -> T.StructType:
    fields = [df.schema[k] for k in keys] + [T.StructField("lag", T.LongType())]
    return T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in SUMS])


def _with_keys(sums: pd.DataFrame, pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    for at, k in enumerate(keys):
        sums.insert(at, k, pdf[k].iloc[0] if len(pdf) else None)
    return sums


def _short(rows: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("_i")["_v"].to_numpy(float)
        direct = min(DIRECT, len(x))
        sums = pd.DataFrame({"lag": np.arange(1, len(x), dtype=np.int64), **_transformed(x)})
        sums = sums[sums["lag"] < len(x) - direct + 1]
        last = lag_sums(x[:direct], x[len(x) - direct:], len(x) - direct, len(x) - 1)
        return _with_keys(pd.concat([sums, last[last["lag"] > len(x) - direct]], ignore_index=True), pdf, keys)

    return rows.repartition(partitions, *keys).groupBy(*keys).applyInPandas(run, _schema(rows, keys))


def _long(rows: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    known = ~F.isnan("_v")
    points = rows.withColumn("_pos", F.col("_i")).withColumn("_known", F.when(known, 1.0).otherwise(0.0))

    def load(v: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        return [v, v * v, mask]

    def multiply(v: np.ndarray, q: np.ndarray, m: np.ndarray) -> list[np.ndarray]:
        # two real sums share a transform
        return [np.conj(v) * m + 1j * np.conj(q) * m, np.conj(m) * v + 1j * np.conj(m) * q, np.conj(m) * m + 1j * np.conj(v) * v]

    sums = transform_products(points.withColumn("_v", F.when(known, F.col("_v")).otherwise(0.0)), keys, ["_v", "_known"], load, multiply, 3, partitions)
    sums = sums.filter((F.col("_pos") >= 1) & (F.col("_pos") <= F.col("_N") - DIRECT))
    wide = sums.select(
        *keys, F.col("_pos").alias("lag"), F.round("re2").alias("n"), F.col("re0").alias("sx"), F.col("re1").alias("sy"),
        F.col("im0").alias("sxx"), F.col("im1").alias("syy"), F.col("im2").alias("sxy"))
    ends = rows.filter((F.col("_i") < DIRECT) | (F.col("_i") >= F.col("_N") - DIRECT))

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, n = pdf.sort_values("_i"), int(pdf["_N"].iloc[0])
        x = pdf["_v"].to_numpy(float)
        direct = min(DIRECT, n)
        sums = lag_sums(x[:direct], x[len(x) - direct:], n - direct, n - 1)
        return _with_keys(sums[sums["lag"] > n - direct], pdf, keys)

    return wide.unionByName(ends.groupBy(*keys).applyInPandas(last, _schema(rows, keys)))


def all_lag_sums(
    df: DataFrame, value: str, series: DataFrame, n_series: int, keys: Sequence[str] = ("device_id",), time: str = "time",
    tie: Sequence[str] = (), one_task_readings: int = ONE_TASK_READINGS,
) -> DataFrame:
    """(keys, lag, n, sx, sy, sxx, syy, sxy) at all lags from 1 to the length of each series less one.

    ``series`` has one row for each of ``n_series`` series, with its ``_len``, ``_mean`` and ``_sd``.  Values are
    centred and scaled by the deviation of their series, which a correlation does not notice."""
    keys = list(keys)
    by = keys or ["_all"]
    rows = row_index(df, keys, time, "_i", tie).select(*keys, "_i", number(names.col(value)).alias("_v"))
    if not keys:
        rows, series = rows.withColumn("_all", F.lit(1)), series.withColumn("_all", F.lit(1))
    series = with_sizes(series.filter(F.col("_len") > 0).withColumnRenamed("_len", "_N"))
    hot = F.col("_N") > one_task_readings
    # two numbers: readings in series of ordinary length, points of the transforms of the others
    few, many = series.agg(F.sum(F.when(~hot, F.col("_N"))), F.sum(F.when(hot, F.col("_M")))).first()
    unit = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)
    rows = rows.join(small_side(series, n_series), by).select(
        *by, "_N", "_M", "_R", "_i", F.coalesce((F.col("_v") - F.col("_mean")) / unit, F.lit(float("nan"))).alias("_v"))
    out = _short(rows.filter(~hot).select(*by, "_i", "_v"), by, -(-(few or 1) // PARTITION_READINGS))
    if many:
        long = _long(rows.filter(hot), by, partitions_for(many))
        out = out.unionByName(long) if few else long
    return out if keys else out.drop("_all")
