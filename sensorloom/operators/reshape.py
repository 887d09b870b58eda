"""Wide to long, long to wide, unions and comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names


def to_long(
    wide: DataFrame,
    ids: Sequence[str] = ("device_id", "time"),
    cycle: str | None = None,
    value_type: str = "double",
) -> DataFrame:
    """One row per (ids, feature): ``feature_key``, ``value``, ``stats_cycle``."""
    values = [c for c in wide.columns if c not in ids]
    same = wide.select(*ids, *[names.col(c).cast(value_type).alias(c) for c in values])
    return same.unpivot(list(ids), [names.quote(c) for c in values], "feature_key", "value").withColumn(
        "stats_cycle", F.lit(cycle if cycle else "unknown")
    )


def to_wide(
    long: DataFrame,
    variable: str | None = None,
    features: Sequence[str] = (),
    ids: Sequence[str] = ("stats_start_time",),
    key: str = "feature_key",
    value: str = "feature_value",
    variable_column: str = "monitored_variable",
    order: Sequence[str] = (),
) -> DataFrame:
    """First value per (ids, feature) as one column per feature.

    Passing ``features`` spares the job that looks the distinct names up;
    ``order`` decides which of several values is the first.
    """
    if variable is not None:
        long = long.filter(F.col(variable_column) == variable)
    number = F.expr(f"try_cast({names.quote(value)} as double)")
    if order:
        pick: Column = F.min_by(number, F.when(number.isNotNull(), F.struct(*[F.col(c) for c in order])))
    else:
        pick = F.first(number, ignorenulls=True)
    return long.groupBy(*ids).pivot(key, list(features) or None).agg(pick)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union with columns matched by name, missing ones NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_times(left: DataFrame, right: DataFrame, on: Sequence[str] = ("time",)) -> DataFrame:
    return left.select(*on).intersect(right.select(*on))


def compare_to_benchmark(
    result: DataFrame,
    benchmark: DataFrame,
    column: str,
    on: Sequence[str] = ("time",),
    rtol: float = 0.05,
    atol: float = 0.01,
) -> DataFrame:
    """Side by side at common times, rows with a missing side dropped, with
    the verdict ``|a - b| <= atol + rtol * |b|``."""
    a = result.select(*on, names.col(column).cast("double").alias("new_value"))
    b = benchmark.select(*on, names.col(column).cast("double").alias("old_value"))
    both = a.join(b, list(on), "inner").na.drop("any")
    near = F.abs(F.col("new_value") - F.col("old_value")) <= atol + rtol * F.abs(F.col("old_value"))
    return both.withColumn("within_tolerance", near)


def split_by_date(df: DataFrame, split, time: str = "time") -> tuple[DataFrame, DataFrame]:
    """Train up to and test from the split time; the split row is in both."""
    at = F.lit(split)
    return df.filter(F.col(time) <= at), df.filter(F.col(time) >= at)


def flatten_names(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested struct columns as flat ``outer_inner`` columns."""
    out = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "struct":
            for inner in field.dataType.names:
                column = names.col(field.name).getField(inner)
                out.append(column.alias(separator.join(x for x in (field.name, inner) if x)))
        else:
            out.append(names.col(field.name))
    return df.select(*out)
