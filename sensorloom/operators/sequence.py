"""Sequence operators over a series: stable periods, autocorrelation,
differences, linear trend."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import names
from sensorloom.operators.slices import number, previous_values, row_index, series_rows, small_side
from sensorloom.session import stored


def stable_periods(
    volatility: DataFrame,
    threshold: float,
    std: str = "std",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
) -> DataFrame:
    """Longest run of consecutive rows whose deviation is below the threshold,
    the earliest one on ties; (NULL, NULL, 0) where there is none.

    Input is one row per key and bucket, so the calendar bounds a key's rows.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(time)
    stable = F.coalesce(names.col(std) < F.lit(float(threshold)), F.lit(False)).cast("long")
    rows = volatility.select(*keys, time, stable.alias("_ok"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_run", F.row_number().over(order) - F.sum("_ok").over(running))
    runs = (
        rows.filter(F.col("_ok") == 1)
        .groupBy(*keys, "_run")
        .agg(
            F.min(time).cast("date").alias("start_date"),
            F.max(time).cast("date").alias("end_date"),
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("_from"),
        )
    )
    best = runs.groupBy(*keys).agg(
        F.min_by(F.struct("start_date", "end_date", "n"), F.struct(-F.col("n"), F.col("_from"))).alias("b")
    )
    if not keys:
        return best.select(
            "b.start_date", "b.end_date", F.coalesce(F.col("b.n"), F.lit(0)).alias("length")
        )
    return (
        volatility.select(*keys).distinct().join(best, keys, "left")
        .select(*keys, "b.start_date", "b.end_date", F.coalesce(F.col("b.n"), F.lit(0)).alias("length"))
    )


def first_difference(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    out: str = "diff",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Change against the previous reading, undefined rows dropped."""
    rows = previous_values(df, keys, [value], time, tie, prefix="_prev_")
    change = number(names.col(value)) - number(names.col(f"_prev_{value}"))
    return rows.withColumn(out, change).drop(f"_prev_{value}").filter(F.col(out).isNotNull())


def detrend(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    out: str = "detrended",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Residual of the least-squares line over the row index of each series.

    Adds ``row_index`` as well.  The fit combines map-side; the join back is
    against one row per series.
    """
    keys = list(keys)
    rows = row_index(df, keys, time, "row_index", tie)
    v = number(names.col(value))
    fit = rows.groupBy(*keys).agg(
        F.regr_slope(v, F.col("row_index")).alias("_slope"),
        F.avg(v).alias("_mean"),
        F.avg(F.when(v.isNotNull(), F.col("row_index"))).alias("_center"),
    )
    rows = rows.join(fit, keys) if keys else rows.crossJoin(F.broadcast(fit))  # one row
    slope = F.coalesce(F.col("_slope"), F.lit(0.0))
    return rows.withColumn(
        out, v - F.col("_mean") - slope * (F.col("row_index") - F.col("_center"))
    ).drop("_slope", "_mean", "_center")


_BLOCK = 2048


def lag_sums(left: np.ndarray, right: np.ndarray, offset: int, max_lag: int) -> pd.DataFrame:
    """Sums over all pairs (right[j], left[i]) by lag = offset + j - i."""
    known_l, known_r = ~np.isnan(left), ~np.isnan(right)
    l, r = np.where(known_l, left, 0.0), np.where(known_r, right, 0.0)
    ml, mr = known_l.astype(float), known_r.astype(float)

    def cross(a, b):
        return np.correlate(b, a, "full")

    lags = offset + np.arange(-(len(left) - 1), len(right))
    keep = (lags >= 1) & (lags <= max_lag)
    sums = {
        "n": cross(ml, mr),
        "sx": cross(ml, r),
        "sy": cross(l, mr),
        "sxx": cross(ml, r * r),
        "syy": cross(l * l, mr),
        "sxy": cross(l, r),
    }
    return pd.DataFrame({"lag": lags[keep], **{k: v[keep] for k, v in sums.items()}})


def _blocked_sums(df: DataFrame, value: str, max_lag: int, keys: list[str], time: str, tie: Sequence[str], block: int, center: DataFrame) -> DataFrame:
    """Sums per lag up to ``max_lag`` over pairs of blocks of consecutive rows."""
    rows = row_index(df, keys, time, "_i", tie).select(
        *keys, F.col("_i"), number(names.col(value)).alias("_v")
    )
    centered = rows.join(center, keys) if keys else rows.crossJoin(F.broadcast(center))  # one row
    # a correlation does not change under a shift; centering keeps the sums small
    centered = centered.select(
        *keys, F.col("_i"), F.coalesce(F.col("_v") - F.col("_mean"), F.lit(float("nan"))).alias("_v")
    )
    own = F.floor(F.col("_i") / block)
    reach = -(-max_lag // block)  # how many blocks a lag can span
    placed = centered.select(
        *keys, "_i", "_v", own.alias("_block"), F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("_gap")
    ).select(
        *keys, "_i", "_v", "_gap",
        F.explode(
            # as the earlier block of its pair, and as the later one
            F.when(F.col("_gap") == 0, F.array(F.struct(F.col("_block").alias("a"), F.lit(True).alias("early"))))
            .otherwise(
                F.array(
                    F.struct(F.col("_block").alias("a"), F.lit(True).alias("early")),
                    F.struct((F.col("_block") - F.col("_gap")).alias("a"), F.lit(False).alias("early")),
                )
            )
        ).alias("_p"),
    ).select(*keys, "_i", "_v", "_gap", F.col("_p.a").alias("_a"), F.col("_p.early").alias("_early"))
    placed = placed.filter(F.col("_a") >= 0)

    fields = [df.schema[k] for k in keys] + [T.StructField("lag", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    schema = T.StructType(fields)

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        gap = int(pdf["_gap"].iloc[0])
        early = pdf.loc[pdf["_early"], "_v"].to_numpy()
        late = early if gap == 0 else pdf.loc[~pdf["_early"], "_v"].to_numpy()
        if len(early) == 0 or len(late) == 0:
            sums = pd.DataFrame({f.name: [] for f in fields[len(keys):]})
        else:
            sums = lag_sums(early, late, gap * block, max_lag)
        for at, k in enumerate(keys):
            sums.insert(at, k, pdf[k].iloc[0])
        return sums

    partial = placed.groupBy(*keys, "_a", "_gap").applyInPandas(pair, schema)
    return partial.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def autocorrelation(
    df: DataFrame,
    value: str,
    max_lag: int | None = None,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    tie: Sequence[str] = (),
    block: int = _BLOCK,
) -> DataFrame:
    """Autocorrelation for lags 0..max_lag, ending before the first undefined
    lag, as rows ``(keys, lag, autocorrelation)``.

    Without ``max_lag`` all lags of each series come from transforms, see
    ``correlogram``.  With it, the series is cut into blocks of consecutive rows; a task sees two blocks
    at a time and emits partial sums per lag, so any series length and any
    maximum lag work with bounded groups.  A lag never exceeds the length of
    its series minus one.
    """
    keys = list(keys)
    plain = series_rows(df, keys, time)
    v = number(names.col(value))
    center = stored(
        plain.groupBy(*keys).agg(F.avg(v).alias("_mean"), F.stddev_pop(v).alias("_sd"), F.count(F.lit(1)).alias("_len")),
        "series",
    )
    n_series = center.count()
    if max_lag is None:
        from sensorloom.operators.correlogram import all_lag_sums

        by_lag, noise = all_lag_sums(df, value, center, n_series, keys, time, tie), 1e-11
    else:
        by_lag, noise = _blocked_sums(df, value, max_lag, keys, time, tie, block, small_side(center.select(*keys, "_mean"), n_series)), 1e-13
    n = F.col("n")
    some = F.when(n > 0, n)
    vx = F.col("sxx") / some - (F.col("sx") / some) * (F.col("sx") / some)
    vy = F.col("syy") / some - (F.col("sy") / some) * (F.col("sy") / some)
    cov = F.col("sxy") / some - (F.col("sx") / some) * (F.col("sy") / some)
    # relative guard: what cancellation leaves of a constant stretch is not variance
    flat = (n < 2) | (vx <= F.col("sxx") / some * noise) | (vy <= F.col("syy") / some * noise)
    acf = by_lag.select(
        *keys, "lag", F.when(~flat, cov / F.sqrt(vx * vy)).alias("autocorrelation")
    )
    undefined = acf.filter(F.col("autocorrelation").isNull()).groupBy(*keys).agg(F.min("lag").alias("_stop"))
    kept = acf.join(small_side(undefined, n_series), keys, "left") if keys else acf.crossJoin(F.broadcast(undefined))
    kept = kept.filter(F.col("_stop").isNull() | (F.col("lag") < F.col("_stop"))).select(
        *keys, "lag", "autocorrelation"
    )
    zero = center.filter(F.col("_len") >= 2).select(
        *keys, F.lit(0).cast("long").alias("lag"), F.lit(1.0).alias("autocorrelation")
    )
    return zero.unionByName(kept)
