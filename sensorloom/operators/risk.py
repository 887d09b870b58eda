"""Risk features: humidity exposure, rainfall intensity, vapor pressure
gradient and the correlation of two feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.physics import above, diffusion_direction, vapor_pressure
from sensorloom.functions.significance import pearson_p_value
from sensorloom.functions.timebucket import micros, parse_duration_micros, parse_freq, with_bucket
from sensorloom.operators.slices import SLICE, number, pearson, series_rows, slice_micros, with_slice

HOUR_US = 3_600_000_000

_RUN_FIELDS = ("n", "high", "best", "runs", "head", "tail")
_TIMES = ("t1", "t2")


def _append_runs(a: Column, b: Column) -> Column:
    """Run-length summary of slice ``a`` followed by slice ``b``.

    head/tail are the lengths of the high runs touching the slice edges; a
    slice that is high throughout has head = tail = n.
    """
    bridge = a["tail"] + b["head"]
    touching = (a["tail"] > 0) & (b["head"] > 0)
    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        (a["high"] + b["high"]).alias("high"),
        F.greatest(a["best"], b["best"], bridge).alias("best"),
        (a["runs"] + b["runs"] - touching.cast("long")).alias("runs"),
        F.when(a["head"] == a["n"], a["n"] + b["head"]).otherwise(a["head"]).alias("head"),
        F.when(b["tail"] == b["n"], a["tail"] + b["n"]).otherwise(b["tail"]).alias("tail"),
    )


def _step_hours(slices: Column) -> Column:
    """Sampling step in hours from the first two times of a bucket, given the
    first two (``t1``, ``t2``) of each of its slices; 1 h for a single time."""
    times = F.array_compact(F.flatten(F.transform(slices, lambda s: F.array(s["t1"], s["t2"]))))
    first_two = F.slice(F.array_sort(times), 1, 2)
    return F.when(
        F.size(first_two) > 1, (first_two[1] - first_two[0]) / F.lit(float(HOUR_US))
    ).otherwise(F.lit(1.0))


def humidity_exposure(
    df: DataFrame,
    humidity: str = "humidity",
    threshold: float = 62.0,
    freq: str = "D",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    tie: Sequence[str] = (),
    slice_us: int | None = None,
) -> DataFrame:
    """Hours above a humidity threshold, longest stretch, number of stretches
    and share of readings, per key and non-empty bucket.

    Stretches are found inside time slices and the slice summaries of a bucket
    are appended in order, so a bucket is never sorted as a whole.
    """
    keys = list(keys)
    rows = series_rows(df, keys, time).select(
        *keys, time, *[c for c in tie if c not in (*keys, time)],
        above(number(names.col(humidity)), threshold).cast("long").alias("_high"),
    )
    rows = with_slice(with_bucket(rows, parse_freq(freq), keys, time, "_bucket"), time, slice_us)
    part = [*keys, "_bucket", SLICE]
    inside = Window.partitionBy(*part).orderBy(time, *tie)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_pos", F.row_number().over(inside)).withColumn(
        # constant along a stretch and the low reading before it
        "_run", F.col("_pos") - F.sum("_high").over(running)
    )
    us = micros(F.col(time))
    runs = rows.groupBy(*part, "_run").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_high").alias("_len"),
        F.min(F.when(F.col("_pos") == 1, us)).alias("t1"),
        F.min(F.when(F.col("_pos") == 2, us)).alias("t2"),
    )
    # a leading low reading opens run 1, so run 0 exists only when the slice
    # starts high
    slices = runs.groupBy(*part).agg(
        F.sum("_n").alias("n"),
        F.sum("_len").alias("high"),
        F.max("_len").alias("best"),
        F.count_if(F.col("_len") > 0).alias("runs"),
        F.coalesce(F.sum(F.when(F.col("_run") == 0, F.col("_len"))), F.lit(0)).alias("head"),
        F.max_by("_len", "_run").alias("tail"),
        F.min("t1").alias("t1"),
        F.min("t2").alias("t2"),
    )
    # one entry per slice: the calendar bounds the list
    entry = F.struct(F.col(SLICE), *[F.col(f) for f in (*_RUN_FIELDS, *_TIMES)])
    buckets = slices.groupBy(*keys, "_bucket").agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    empty = F.struct(*[F.lit(0).cast("long").alias(f) for f in _RUN_FIELDS])
    buckets = buckets.select(
        *keys,
        F.col("_bucket").alias(time),
        F.aggregate("_s", empty, _append_runs).alias("r"),
        _step_hours(F.col("_s")).alias("_step"),
    )
    return buckets.select(
        *keys,
        time,
        (F.col("r.high") * F.col("_step")).alias("total_exposure_hours"),
        (F.col("r.best") * F.col("_step")).alias("max_continuous_hours"),
        F.col("r.runs").alias("exposure_episodes"),
        (F.col("r.high") / F.col("r.n")).alias("exposure_ratio"),
    )


def rolling_sum(
    df: DataFrame,
    value: str,
    window: str = "1h",
    out: str = "rolling_sum",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    slice_us: int | None = None,
) -> DataFrame:
    """Sum over ``(t - window, t]`` of each reading's series, NULL where the
    window holds no known value.

    A series is cut into steps as long as the window.  A window is the end of
    one step and the beginning of the next: running sums backwards through the
    one and forwards through the other meet in it.  So the cost does not depend
    on the number of readings in a window, nothing is subtracted, and each
    reading sends one running sum to the next step.
    """
    return _rolled_slices(df, value, window, out, list(keys), time, slice_us).drop("_us", SLICE)


def _rolled_slices(
    df: DataFrame, value: str, window: str, out: str, keys: list[str], time: str, slice_us: int | None
) -> DataFrame:
    width = parse_duration_micros(window)
    length = max(slice_us or slice_micros(df.sparkSession), width)
    rows = series_rows(df, keys, time).withColumn("_us", micros(F.col(time)))
    rows = rows.withColumn("_step", F.col("_us") - F.pmod(F.col("_us"), F.lit(width)))
    step = Window.partitionBy(*keys, "_step")
    forwards = step.orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    backwards = step.orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, 0)
    v = number(names.col(value))
    rows = rows.withColumn("_head", F.sum(v).over(forwards)).withColumn("_tail", F.sum(v).over(backwards))
    # what a window still holds of the step before: the running sum of its first reading there
    passed = rows.select(*keys, (F.col("_step") + width).alias("_step"), (F.col("_us") + width).alias("_us"), F.col("_tail").alias("_passed"))
    both = rows.drop("_tail").withColumn("_own", F.lit(True)).unionByName(passed, allowMissingColumns=True)
    later = step.orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("_passed", F.last("_passed", ignorenulls=True).over(later)).filter("_own")
    total = F.coalesce(F.col("_head") + F.col("_passed"), "_head", "_passed")
    return both.withColumn(out, total).withColumn(SLICE, F.col("_us") - F.pmod(F.col("_us"), F.lit(length))).drop("_step", "_head", "_passed", "_own")


def rainfall_intensity(
    df: DataFrame,
    rainfall: str = "rainfall",
    window: str = "1h",
    freq: str = "6h",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    slice_us: int | None = None,
) -> DataFrame:
    """Peak and mean of the rolling sum (mean over positive sums, 0 if none),
    total and wet hours per key and non-empty bucket.

    The rolling sum runs over the whole series before bucketing.
    """
    keys = list(keys)
    rows = series_rows(df, keys, time).select(*keys, time, number(names.col(rainfall)).alias("_rain"))
    rows = _rolled_slices(rows, "_rain", window, "_rolled", keys, time, slice_us)
    rows = with_bucket(rows, parse_freq(freq), keys, time, "_bucket")
    # within a slice the buckets follow each other, so the second reading of a
    # bucket is the first one whose predecessor lies in the same bucket
    before = F.lag("_bucket").over(Window.partitionBy(*keys, SLICE).orderBy("_us"))
    rows = rows.withColumn("_again", F.when(before == F.col("_bucket"), F.col("_us")))
    positive = F.when(F.col("_rolled") > 0, F.col("_rolled"))
    slices = rows.groupBy(*keys, "_bucket", SLICE).agg(
        F.max("_rolled").alias("_peak"),
        F.sum(positive).alias("_sum"),
        F.count(positive).alias("_cnt"),
        F.coalesce(F.sum("_rain"), F.lit(0.0)).alias("_total"),
        F.count_if(F.col("_rain") > 0).alias("_wet"),
        F.min("_us").alias("t1"),
        F.min("_again").alias("t2"),
    )
    buckets = slices.groupBy(*keys, "_bucket").agg(
        F.max("_peak").alias("rainfall_peak"),
        F.sum("_sum").alias("_sum"),
        F.sum("_cnt").alias("_cnt"),
        F.sum("_total").alias("rainfall_total"),
        F.sum("_wet").alias("_wet"),
        # one entry per slice: the calendar bounds the list
        F.collect_list(F.struct(*_TIMES)).alias("_s"),
    )
    return buckets.select(
        *keys,
        F.col("_bucket").alias(time),
        "rainfall_peak",
        F.coalesce(F.col("_sum") / F.nullif(F.col("_cnt"), F.lit(0)), F.lit(0.0)).alias("rainfall_mean"),
        "rainfall_total",
        (F.col("_wet") * _step_hours(F.col("_s"))).alias("rainfall_hours"),
    )


def vapor_pressure_gradient(
    inside: DataFrame,
    outside: DataFrame,
    temperature: str = "temperature",
    humidity: str = "humidity",
    outside_pressure: str = "avg_vapor_pressure",
    on: Sequence[str] = ("time",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Outside minus inside vapor pressure (hPa) at common times, with class.

    The inside pressure follows from temperature and humidity, the outside one
    is measured in kPa.  ``carry`` names inside columns to keep (device ids).
    """
    names.require_columns(inside, [*on, temperature, humidity])
    names.require_columns(outside, [*on, outside_pressure])
    left = inside.select(
        *on,
        *[c for c in carry if c not in on],
        vapor_pressure(number(names.col(temperature)), number(names.col(humidity))).alias("VP_in"),
    )
    right = outside.select(*on, (number(names.col(outside_pressure)) * 10).alias("VP_out"))
    delta = F.col("VP_out") - F.col("VP_in")
    return (
        left.join(right, list(on), "inner")
        .withColumn("delta_VP", delta)
        .withColumn("diffusion_direction", diffusion_direction(F.col("delta_VP")))
    )


def inward_share(gradient: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows in which vapor moves inward."""
    inward = F.count_if(F.col("diffusion_direction") == "向内")
    return gradient.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (inward / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("inward_share"),
    )


def correlate(
    left: DataFrame,
    right: DataFrame,
    x: str = "total_exposure_hours",
    y: str = "rainfall_peak",
    on: Sequence[str] = ("time",),
    keys: Sequence[str] = (),
    p_value: bool = True,
) -> DataFrame:
    """Pearson correlation, regression y on x and p-value at common times.

    Fewer than three common rows give NULLs and ``n_samples`` 0.  All sums
    combine map-side; only one row per key reaches the p-value function.
    """
    joined = left.select(*on, number(names.col(x)).alias("_x"), *[k for k in keys if k not in on]).join(
        right.select(*on, number(names.col(y)).alias("_y")), list(on), "inner"
    )
    stats = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        pearson(F.col("_x"), F.col("_y")).alias("_r"),
        F.regr_slope("_y", "_x").alias("_slope"),
        F.regr_intercept("_y", "_x").alias("_intercept"),
    )
    enough = F.col("_n") >= 3
    out = stats.select(
        *keys,
        F.when(enough, F.col("_r")).alias("correlation"),
        F.when(enough, F.col("_slope")).alias("slope"),
        F.when(enough, F.col("_intercept")).alias("intercept"),
        F.when(enough, F.col("_r") * F.col("_r")).alias("r_squared"),
        F.when(enough, F.col("_n")).otherwise(0).alias("n_samples"),
    )
    if p_value:
        out = out.withColumn("p_value", pearson_p_value(F.col("correlation"), F.col("n_samples").cast("double")))
    return out
