"""Ordered work on long series without one task per device.

A window partitioned by device alone puts a whole series into one task.  Here
a series is cut into time slices of fixed length; ordered work runs per
``(device, slice)``, and what crosses a slice edge travels in a summary with
one row per slice.  The window that chains the summaries of a device sees one
row per slice, which the calendar bounds whatever the number of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.functions.timebucket import micros
from sensorloom.session import hot_group_rows, slice_micros, stored

SLICE = "_slice"


def series_rows(df: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    """Rows that belong to a series: key and time are known."""
    for name in (*keys, time):
        df = df.filter(F.col(name).isNotNull())
    return df


def number(col: Column) -> Column:
    """Value as double with NaN turned into NULL."""
    value = col.cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of fractional columns as NULL; to be applied right after a scan."""
    kinds = dict(df.dtypes)

    def clean(name: str) -> Column:
        c = names.col(name)
        return F.when(~F.isnan(c), c).alias(name) if kinds[name] in ("double", "float") else c

    return df.select(*[clean(c) for c in df.columns])


def with_slice(df: DataFrame, time: str = "time", slice_us: int | None = None) -> DataFrame:
    """Add the start (epoch microseconds) of the slice a row lies in."""
    length = slice_us or slice_micros(df.sparkSession)
    us = micros(F.col(time))
    return df.withColumn(SLICE, us - F.pmod(us, F.lit(length)))


_SLICE_CHOICES = (86_400, 3_600, 600, 60, 10, 1)


def suggest_slice_seconds(
    df: DataFrame, keys: Sequence[str] = ("device_id",), time: str = "time", max_rows: int | None = None
) -> int:
    """Longest slice of which no device fills more than ``max_rows`` rows.

    One pass over key and time columns, combined to counts per second; four
    numbers come back.  Use the result as ``spark.sensorloom.sliceSeconds``
    when the fastest device is not known.
    """
    limit = max_rows or hot_group_rows(df.sparkSession)
    seconds = with_slice(series_rows(df, keys, time), time, 1_000_000)
    counts = seconds.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    lengths = F.explode(F.array(*[F.lit(s) for s in _SLICE_CHOICES]))
    grown = counts.select(*keys, SLICE, "_rows", lengths.alias("_seconds"))
    start = F.col(SLICE) - F.pmod(F.col(SLICE), F.col("_seconds").cast("long") * 1_000_000)
    filled = grown.groupBy(*keys, "_seconds", start.alias("_start")).agg(F.sum("_rows").alias("_rows"))
    worst = {r[0]: r[1] for r in filled.groupBy("_seconds").agg(F.max("_rows")).collect()}
    fits = next((s for s in _SLICE_CHOICES if worst.get(s, 0) <= limit), None)
    if fits is None:
        raise ValueError(f"a device has more than {limit} rows in a second; raise the limit for one slice")
    return fits


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "time",
    out: str = "row_index",
    tie: Sequence[str] = (),
    slice_us: int | None = None,
) -> DataFrame:
    """0-based position of every row in its series."""
    keys = list(keys)
    base = with_slice(series_rows(df, keys, time), time, slice_us)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        base.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, SLICE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(time, *tie)
    numbered = base.withColumn("_pos", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [*keys, SLICE])
        .withColumn(out, (F.col("_before") + F.col("_pos")).cast("long"))
        .drop("_before", "_pos", SLICE)
    )


def previous_values(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    time: str = "time",
    tie: Sequence[str] = (),
    slice_us: int | None = None,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prev_<column>``: the value one row earlier in the series."""
    keys = list(keys)
    base = with_slice(series_rows(df, keys, time), time, slice_us)
    record = F.struct(*[F.col(c) for c in columns])
    # one value per slice, combined map-side; a plain number as order keeps the
    # aggregation hash-based
    order = F.struct(F.col(time), *[F.col(c) for c in tie]) if tie else micros(F.col(time))
    lasts = base.groupBy(*keys, SLICE).agg(*[F.max_by(c, order).alias(c) for c in columns])
    chain = Window.partitionBy(*keys).orderBy(SLICE)
    carried = lasts.select(*keys, SLICE, F.lag(record).over(chain).alias("_carry"))
    inside = Window.partitionBy(*keys, SLICE).orderBy(time, *tie)
    stepped = base.select(
        "*", F.row_number().over(inside).alias("_pos"), F.lag(record).over(inside).alias("_local")
    )
    joined = stepped.join(carried, [*keys, SLICE])
    prev = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_local"))
    joined = joined.withColumns({prefix + c: prev.getField(c) for c in columns})
    return joined.drop("_pos", "_local", "_carry", SLICE)


def successive_pairs(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    time: str = "time",
    tie: Sequence[str] = (),
    slice_us: int | None = None,
) -> DataFrame:
    """(current, previous) value pairs of each series as ``x``, ``y``.

    Every reading yields one pair inside its slice, with an unknown previous
    value for the first one; every slice adds the pair across its leading edge,
    taken from its first and its predecessor's last value, so no row is joined.
    """
    keys = list(keys)
    base = with_slice(series_rows(df, keys, time), time, slice_us).select(
        *keys, SLICE, time, *[c for c in tie if c not in (time, value)], value
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(time, *tie)
    inner = base.select(*keys, F.col(value).alias("x"), F.lag(value).over(inside).alias("y"))
    # combined map-side, hash-based as long as the order is a plain number
    order = F.struct(F.col(time), *[F.col(c) for c in tie]) if tie else micros(F.col(time))
    ends = base.groupBy(*keys, SLICE).agg(
        F.min_by(value, order).alias("x"), F.max_by(value, order).alias("_last")
    )
    chain = Window.partitionBy(*keys).orderBy(SLICE)
    edges = ends.select(*keys, "x", F.lag("_last").over(chain).alias("y"))
    return inner.unionByName(edges)


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation over pairs where both are known; NULL when one
    side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    vx, vy = F.var_pop(F.when(both, x)), F.var_pop(F.when(both, y))
    return F.when((vx > 0) & (vy > 0), F.covar_pop(x, y) / (F.sqrt(vx) * F.sqrt(vy)))


def split_hot(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split rows into those of ordinary groups and those of groups with more
    than ``limit`` rows.

    The list of hot groups has at most (rows / limit) entries; whether it is
    small enough for a broadcast is left to Spark.  When it turns out empty, adaptive execution drops the hot
    branch and both joins.
    """
    keys = list(keys)
    limit = limit or hot_group_rows(df.sparkSession)
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select(*keys)
    )
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


MAX_BROADCAST_GROUPS = 100_000


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> tuple[DataFrame, int] | None:
    """The keys of groups with more than ``limit`` rows and how many they are (counted up to
    MAX_BROADCAST_GROUPS + 1), or None without any.

    One counting pass decides, so that plans of ordinary data have one branch.
    """
    limit = limit or hot_group_rows(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > limit).select(*keys)
    n = hot.limit(MAX_BROADCAST_GROUPS + 1).count()
    return (stored(hot, "hot-groups"), n) if n else None


def small_side(df: DataFrame, groups: int) -> DataFrame:
    """A table of a few rows for each of ``groups`` counted groups: marked for a broadcast if these are not too many."""
    return F.broadcast(df) if groups <= MAX_BROADCAST_GROUPS else df
