"""Descriptive summaries of result tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.physics import BALANCED, INWARD, OUTWARD
from sensorloom.operators.order_stats import group_stats
from sensorloom.operators.slices import number
from sensorloom.operators.stats import numeric_columns

SUMMARY = ("feature", "section", "item", "metric")
DESCRIBE = ("count", "mean", "std", "min", "q1", "median", "q3", "max")


def describe(df: DataFrame, columns: Sequence[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column.

    Columns become rows first, so all of them share one pass and a long
    column is handled like any other large group.
    """
    columns = list(columns or numeric_columns(df))
    long = df.select(*[number(names.col(c)).alias(c) for c in columns]).unpivot(
        [], [names.quote(c) for c in columns], "column_name", "_v"
    )
    stats = group_stats(long, ["column_name"], "_v", ["count", "mean", "std", "min", "q1", "median", "q3", "max"], hot_rows)
    return stats.select("column_name", *DESCRIBE)


def value_distribution(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    """Count and share of all rows per value; NULLs count for the share only."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    counts = df.filter(names.col(column).isNotNull()).groupBy(names.col(column)).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    out = counts.crossJoin(F.broadcast(total)).select(  # one row
        column, "n_rows", (F.col("n_rows") / F.col("_total")).alias("share")
    )
    return out.orderBy(F.desc("n_rows"), names.col(column)) if sort else out


def extent(df: DataFrame, time: str = "time", keys: Sequence[str] = ()) -> DataFrame:
    """Row count and time span."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )


def exposure_kpis(exposure: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return exposure.groupBy(*keys).agg(
        F.avg("total_exposure_hours").alias("mean_exposure_hours"),
        F.max("total_exposure_hours").alias("max_exposure_hours"),
        F.count_if(F.col("exposure_ratio") > 0.5).alias("high_risk_periods"),
    )


def rainfall_kpis(rainfall: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rainfall.groupBy(*keys).agg(
        F.sum("rainfall_total").alias("total_rainfall"),
        F.avg("rainfall_total").alias("mean_rainfall"),
        F.max("rainfall_peak").alias("max_peak"),
    )


def _metrics(df: DataFrame, time: str) -> list[tuple[str, str, str, Column]]:
    """(section, item, metric, aggregate as text) of a result table: all that one pass can combine."""
    rows = F.count(F.lit(1))
    out = [("extent", "", "n_rows", rows)]
    if time in df.columns:
        out += [("extent", "", "first_time", F.min(time)), ("extent", "", "last_time", F.max(time))]
    for name in numeric_columns(df):
        v = number(names.col(name))
        out += [("describe", name, m, f(v)) for m, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    if "diffusion_direction" in df.columns:
        for kind in (INWARD, OUTWARD, BALANCED):
            n = F.count_if(F.col("diffusion_direction") == kind)
            out += [("distribution", kind, "n_rows", F.nullif(n, F.lit(0))), ("distribution", kind, "share", F.nullif(n, F.lit(0)) / rows)]
        out.append(("kpi", "", "inward_share", F.count_if(F.col("diffusion_direction") == INWARD) / F.nullif(rows, F.lit(0))))
    if "total_exposure_hours" in df.columns:
        out += [("kpi", "", "mean_exposure_hours", F.avg("total_exposure_hours")), ("kpi", "", "max_exposure_hours", F.max("total_exposure_hours")),
                ("kpi", "", "high_risk_periods", F.count_if(F.col("exposure_ratio") > 0.5))]
    if "rainfall_total" in df.columns:
        out += [("kpi", "", "total_rainfall", F.sum("rainfall_total")), ("kpi", "", "mean_rainfall", F.avg("rainfall_total")),
                ("kpi", "", "max_peak", F.max("rainfall_peak"))]
    return [(section, item, metric, c.cast("string")) for section, item, metric, c in out]


def observe_results(df: DataFrame, time: str = "time") -> tuple[DataFrame, Observation]:
    """The frame, and the metrics of its summary taken in passing while it is written.

    To be written as it is: behind an exchange, a task that runs again after
    a lost executor would be counted twice."""
    watch = Observation()
    return df.observe(watch, *[c.alias(f"m{k}") for k, (*_, c) in enumerate(_metrics(df, time))]), watch


def summary(results: dict[str, DataFrame], time: str = "time", observed: dict[str, Observation] | None = None) -> DataFrame:
    """One long table ``(feature, section, item, metric, value)`` over all
    result tables: extent, columns, describe, class shares and KPIs.

    What ``observed`` holds of a table is not computed again; a table without
    an observation gives its mergeable metrics in one aggregate.  Quartiles
    take one pass over all numeric columns of a table together.  A table
    without rows has counts of 0, no classes and no quartiles.
    """
    first = next(iter(results.values()))
    parts, known = [], []
    for feature, df in results.items():
        metrics = _metrics(df, time)
        known.append((feature, "columns", "", "columns", ", ".join(df.columns)))
        if observed and feature in observed:
            values = observed[feature].get
            # as many rows as the table has columns, whatever its length
            known += [(feature, *m[:3], values[f"m{k}"]) for k, m in enumerate(metrics)]
        else:
            row = df.agg(*[c.alias(f"m{k}") for k, (*_, c) in enumerate(metrics)])
            each = [F.struct(*[F.lit(x).alias(n) for n, x in zip(SUMMARY, (feature, *m[:3]))], F.col(f"m{k}").alias("value")) for k, m in enumerate(metrics)]
            parts.append(row.select(F.inline(F.array(*each))))
        columns = numeric_columns(df)
        if columns:
            long = df.select(*[number(names.col(c)).alias(c) for c in columns]).unpivot([], [names.quote(c) for c in columns], "item", "_v")
            quartiles = group_stats(long, ["item"], "_v", ["q1", "median", "q3"])
            parts.append(quartiles.select(F.lit(feature).alias("feature"), F.lit("describe").alias("section"), "item",
                                          *[F.col(q).cast("string").alias(q) for q in ("q1", "median", "q3")])
                         .unpivot(["feature", "section", "item"], ["q1", "median", "q3"], "metric", "value"))
    start = first.sparkSession.createDataFrame(known, ", ".join(f"{c} string" for c in (*SUMMARY, "value")))
    return reduce(DataFrame.unionByName, parts, start).filter("section <> 'distribution' or value is not null")
