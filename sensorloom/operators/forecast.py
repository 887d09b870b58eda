"""Forecasts of daily series, all devices at once.

A daily series is bounded by the calendar, so its lags come from one window per
device; everything else is plain joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.linear import dot, solve
from sensorloom.functions.timebucket import with_bucket
from sensorloom.operators.reshape import split_by_date
from sensorloom.operators.slices import number, series_rows


def daily_mean(
    df: DataFrame, field: str, keys: Sequence[str] = ("device_id",), time: str = "time", out: str = "value"
) -> DataFrame:
    """Mean per day, days without a known value left out."""
    rows = series_rows(df, keys, time).select(*keys, time, number(names.col(field)).alias("_v"))
    rows = with_bucket(rows, "D", list(keys), time, "_day")
    means = rows.groupBy(*keys, "_day").agg(F.avg("_v").alias(out)).filter(F.col(out).isNotNull())
    return means.withColumnRenamed("_day", time)


def seasonal_naive(
    daily: DataFrame,
    split,
    season: int = 7,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    value: str = "value",
) -> DataFrame:
    """For each holdout day after the split: the last train value of the same
    phase of the season."""
    train, test = split_by_date(daily, F.lit(split).cast("timestamp").cast(daily.schema[time].dataType), time)
    origin = F.lit(split).cast("timestamp").cast("date")
    day = F.col(time).cast("date")
    ahead = F.datediff(day, origin)
    future = test.select(*keys, time, F.col(value).alias("actual"), day.alias("_d"), ahead.alias("_h")).filter("_h > 0")
    future = future.withColumn(
        "_d", F.date_sub("_d", (F.ceil(F.col("_h") / season) * season).cast("int"))
    )
    past = train.select(*keys, day.alias("_d"), F.col(value).alias("forecast"))
    return future.join(past, [*keys, "_d"], "left").select(*keys, time, "actual", "forecast")


def autoregressive(
    daily: DataFrame,
    split,
    order: int = 5,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    value: str = "value",
) -> DataFrame:
    """AR model on first differences, fitted by least squares up to the split
    and run forward over the holdout, with 95 % bounds.

    Differences are between consecutive calendar days, and the horizon of a
    holdout day is its distance in days from the last train day; missing days
    count.  Of several values of a day the last one is taken.  The fit uses the
    differences that have all ``order`` differences before them; a series with
    fewer than ``order + 2`` of those gets NULL forecasts.  A missing one among
    the latest differences is taken as the mean.

    The normal equations are aggregates (covariances of the lagged differences,
    mergeable and without a sum of squares), solved per series; a lag that
    depends on the ones before it gets no weight.  Every holdout row stays, also
    of a series without a train day; rows without a time or a key belong to none.
    """
    keys = list(keys)
    rows = series_rows(daily, keys, time)
    day = F.col(time).cast("date")
    until = F.lit(split).cast("timestamp").cast("date")
    equations = _normal_equations(rows, until, order, keys, time, value)
    test = rows.filter(day > until).select(*keys, time, number(F.col(value)).alias("actual"), day.alias("_day"))
    fitted = _fitted(equations, order, keys)
    paths = fitted.select(*keys, "_last_day", "_sigma", _path(order, F.datediff("_end", "_last_day")).alias("_path"))
    joined = test.join(paths, keys, "left").select(
        *keys, time, "actual", "_sigma", F.get("_path", F.datediff("_day", "_last_day")).alias("_point")
    )
    level = F.col("_point.level")
    width = F.lit(1.959963984540054) * F.col("_sigma") * F.sqrt("_point.variance")
    return joined.select(
        *keys, time, "actual", level.alias("forecast"), (level - width).alias("lower"), (level + width).alias("upper")
    )


def _normal_equations(rows: DataFrame, until: Column, order: int, keys: list[str], time: str, value: str) -> DataFrame:
    """One row per series with days up to ``until`` and later ones: moments of the lagged differences, the last
    level and the latest differences of the former, the last day of the latter."""
    series = Window.partitionBy(*keys)
    w = series.orderBy(time)
    day = F.col(time).cast("date")
    train = day <= until
    number_ = number(F.col(value))
    known = rows.select(*keys, time, day.alias("_day"), train.alias("_train"), number_.alias("_v")).filter("_v is not null or not _train")
    last = known.withColumn("_next", F.lead("_day").over(w)).filter("_next is null or _next > _day")
    # the values of the days before; without a missing day the last of them lies order + 1 days back
    lags = [F.lag("_v", i).over(w).alias(f"_v{i}") for i in range(1, order + 2)]
    lagged = last.select(
        *keys, "_day", "_train", F.col("_v").alias("_v0"), *lags,
        F.datediff("_day", F.lag("_day", order + 1).over(w)).alias("_back"),
        F.datediff("_day", F.lag("_day").over(w)).alias("_step"),
        F.datediff(F.max(F.when(F.col("_train"), F.col("_day"))).over(series), "_day").alias("_ago"),
    )
    x = [F.when(F.col("_train") & (F.col("_back") == order + 1), F.col(f"_v{i}") - F.col(f"_v{i + 1}")) for i in range(order + 1)]
    change = F.when(F.col("_train") & (F.col("_step") == 1), F.col("_v0") - F.col("_v1"))
    moments = [F.covar_pop(x[i], x[j]).alias(f"_s{i}_{j}") for i in range(order + 1) for j in range(i, order + 1)]
    means = [F.avg(c).alias(f"_m{i}") for i, c in enumerate(x)]
    latest = [F.max(F.when(F.col("_ago") == i, change)).alias(f"_h{i}") for i in range(order)]
    return lagged.groupBy(*keys).agg(
        *moments, *means, *latest, F.count(x[0]).alias("_n"), F.avg(change).alias("_mean"),
        F.max(F.when(F.col("_train"), F.col("_day"))).alias("_last_day"),
        F.max(F.when(~F.col("_train"), F.col("_day"))).alias("_end"),
        F.max_by("_v0", F.when(F.col("_train"), F.col("_day"))).alias("_level"),
    ).filter("_end is not null")


def _fitted(equations: DataFrame, order: int, keys: list[str]) -> DataFrame:
    """Weights of the lags, constant and standard error of each series that is long enough, with its latest state."""

    def moment(i: int, j: int) -> Column:
        return F.col(f"_s{min(i, j)}_{max(i, j)}")

    lags = range(1, order + 1)
    system = F.array(*[F.array(*[moment(i, j) for j in lags], moment(i, 0)) for i in lags])
    means = F.array(*[F.col(f"_m{i}") for i in lags]).cast("array<double>")
    covariances = F.array(*[moment(i, 0) for i in lags]).cast("array<double>")
    history = F.array(*[F.coalesce(F.col(f"_h{i}"), F.col("_mean")) for i in range(order)]).cast("array<double>")
    solved = equations.filter(F.col("_n") >= order + 2).withColumn("_coef", solve(system, order))
    rest = F.greatest(moment(0, 0) - dot(F.col("_coef"), covariances), F.lit(0.0))
    return solved.select(
        *keys, "_coef", "_level", "_last_day", "_end", history.alias("_history"),
        (F.col("_m0") - dot(F.col("_coef"), means)).alias("_constant"),
        F.sqrt(rest * F.col("_n") / F.greatest(F.col("_n") - order - 1, F.lit(1))).alias("_sigma"),
    )


def _path(order: int, days: Column) -> Column:
    """(level, variance of the level in units of the error's) today and on each of the coming ``days``."""
    coef, constant = F.col("_coef"), F.col("_constant")

    def extended(history: Column) -> Column:
        return F.concat(F.array(constant + dot(coef, history)), history)

    # changes and responses (of the differences to one error) lie latest first, with the coming day's in front
    start = F.struct(
        extended(F.col("_history")).alias("changes"),
        F.array(F.lit(1.0)).alias("responses"),
        F.col("_level").alias("level"),
        F.lit(0.0).alias("response"),  # of the level
        F.lit(0.0).alias("variance"),
        F.array().cast("array<struct<level:double,variance:double>>").alias("path"),
    )

    def step(state: Column, _: Column) -> Column:
        response = state["response"] + F.get(state["responses"], F.lit(0))
        return F.struct(
            extended(F.slice(state["changes"], 1, order)).alias("changes"),
            F.slice(F.concat(F.array(dot(coef, state["responses"])), state["responses"]), 1, max(order, 1)).alias("responses"),
            (state["level"] + F.get(state["changes"], F.lit(0))).alias("level"),
            response.alias("response"),
            (state["variance"] + F.pow(response, F.lit(2))).alias("variance"),
            F.concat(state["path"], F.array(F.struct(state["level"].alias("level"), state["variance"].alias("variance")))).alias("path"),
        )

    return F.aggregate(F.sequence(F.lit(0), days), start, step, lambda state: state["path"])


def forecast_errors(forecast: DataFrame, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    error = F.col("actual") - F.col("forecast")
    return forecast.groupBy(*keys).agg(
        F.count(error).alias("n_days"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
