"""Resampling frequencies as Column expressions.

A frequency is given in the usual offset notation (``10min``, ``h``, ``6h``,
``D``, ``W``, ``M``/``ME``, ``MS``).  Fixed lengths are left-closed and
left-labelled, weeks run Monday to Sunday and carry the Sunday as label,
months carry their last (``M``/``ME``) or first day (``MS``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_US = 86_400_000_000
_UNIT_US = {
    "s": 1_000_000,
    "min": 60_000_000,
    "t": 60_000_000,
    "h": 3_600_000_000,
    "d": DAY_US,
}


@dataclass(frozen=True)
class Freq:
    kind: str  # "fixed", "week", "month_end", "month_start"
    micros: int = 0  # length, fixed kind only

    @property
    def aligned(self) -> bool:
        """True when midnight is always a bucket edge, so that buckets do not
        depend on where the series starts."""
        return self.kind != "fixed" or DAY_US % self.micros == 0

    @property
    def max_micros(self) -> int:
        """Upper bound of a bucket's length."""
        return {"fixed": self.micros, "week": 7 * DAY_US}.get(self.kind, 31 * DAY_US)

    @property
    def step(self) -> str:
        """Distance of two bucket labels as an interval literal."""
        if self.kind == "fixed":
            return f"interval {self.micros} microseconds"
        return "interval 7 days" if self.kind == "week" else "interval 1 month"


def parse_freq(text: str) -> Freq:
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", str(text))
    if not match:
        raise ValueError(f"cannot read frequency {text!r}")
    count, unit = int(match.group(1) or 1), match.group(2)
    if unit == "m":
        raise ValueError("frequency unit 'm' is ambiguous: use 'min' for minutes or 'ME' for months")
    if count < 1:
        raise ValueError(f"frequency {text!r} must be positive")
    calendar = {"W": "week", "M": "month_end", "ME": "month_end", "MS": "month_start"}.get(unit)
    if calendar:
        if count != 1:
            raise ValueError(f"only single weeks and months are supported, got {text!r}")
        return Freq(calendar)
    if unit.lower() not in _UNIT_US:
        raise ValueError(f"unknown frequency unit in {text!r}")
    return Freq("fixed", count * _UNIT_US[unit.lower()])


def parse_duration_micros(text: str) -> int:
    freq = parse_freq(text)
    if freq.kind != "fixed":
        raise ValueError(f"{text!r} is not a fixed duration")
    return freq.micros


def micros(col: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column, dtype: T.DataType) -> Column:
    return F.timestamp_micros(col).cast(dtype)


def bucket_of(col: Column, freq: Freq, dtype: T.DataType, origin_us: Column | None = None) -> Column:
    """Label of the bucket ``col`` falls into, in the type of the time column."""
    if freq.kind == "week":
        return F.date_add(F.date_trunc("week", col).cast("date"), 6).cast(dtype)
    if freq.kind == "month_end":
        return F.last_day(col).cast(dtype)
    if freq.kind == "month_start":
        return F.date_trunc("month", col).cast(dtype)
    us = micros(col)
    if origin_us is not None:
        return from_micros(us - F.pmod(us - origin_us, F.lit(freq.micros)), dtype)
    return from_micros(us - F.pmod(us, F.lit(freq.micros)), dtype)


def with_bucket(
    df: DataFrame, freq: Freq | str, keys: list[str], time: str = "time", out: str = "bucket"
) -> DataFrame:
    """Add the bucket label; rows without time are dropped.

    Lengths that do not divide a day are counted from midnight of the first
    day of each series, which takes one small aggregate joined back by key.
    """
    freq = parse_freq(freq) if isinstance(freq, str) else freq
    dtype = df.schema[time].dataType
    df = df.filter(F.col(time).isNotNull())
    if freq.aligned:
        return df.withColumn(out, bucket_of(F.col(time), freq, dtype))
    first = df.groupBy(*keys).agg(F.min(time).alias("_first"))
    first = first.withColumn("_origin", micros(F.date_trunc("day", F.col("_first")))).drop("_first")
    joined = df.join(first, keys) if keys else df.crossJoin(F.broadcast(first))  # one row
    return joined.withColumn(out, bucket_of(F.col(time), freq, dtype, F.col("_origin"))).drop("_origin")


# Buckets of one chunk of a gap, and of one slice of a finely bucketed series.
_CHUNK = 4096
# Shorter buckets are looked at slice by slice: a year of one device has millions of them.
FINE_US = 600_000_000


def slice_length(freq: Freq) -> int | None:
    """Microseconds of a slice of a series of short buckets; None where a series is worked on as a whole."""
    return freq.micros * _CHUNK if freq.kind == "fixed" and freq.micros < FINE_US else None


def neighbour(
    df: DataFrame, keys: list[str], column: str, out: str, time: str = "time", slice_us: int | None = None, ahead: bool = True
) -> DataFrame:
    """Add ``column`` of the next (``ahead``) or previous row of the series; times are unique per key.

    With ``slice_us`` a window holds one slice of a series: each slice gets the
    first row of the one after it (or the last row of the one before it) as an
    extra row, which one row per slice decides and which is left out again.
    """
    step = F.lead if ahead else F.lag
    if not slice_us:
        return df.withColumn(out, step(column).over(Window.partitionBy(*keys).orderBy(time)))
    us = micros(F.col(time))
    base = df.withColumns({"_part": us - F.pmod(us, F.lit(slice_us)), "_guest": F.lit(False)})
    # a plain number as order keeps the aggregation hash-based
    edge = F.min_by if ahead else F.max_by
    row = F.struct(F.col(time), F.col(column).alias("_value"))
    edges = base.groupBy(*keys, "_part").agg(edge(row, us).alias("_edge"))
    carried = step("_edge").over(Window.partitionBy(*keys).orderBy("_part"))
    guests = edges.select(*keys, "_part", F.lit(True).alias("_guest"), carried.alias("_edge")).filter("_edge is not null")
    at, value = F.col("_edge").getField(time), F.col("_edge").getField("_value")
    guests = guests.select(*keys, "_part", "_guest", at.alias(time), *([] if column == time else [value.alias(column)]))
    both = base.unionByName(guests, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_part").orderBy(time)
    return both.withColumn(out, step(column).over(inside)).filter(~F.col("_guest")).drop("_part", "_guest")


def fill_missing_buckets(
    df: DataFrame, freq: Freq | str, keys: list[str], time: str = "time", zero: tuple[str, ...] = ()
) -> DataFrame:
    """Emit the empty buckets between the first and the last one of each key.

    ``df`` has one row per key and bucket, so a key holds at most as many rows
    as the calendar has buckets.  Every row is expanded up to its successor,
    which needs one exchange of the aggregated rows and no join.  Series of
    short buckets are looked at in slices, and their gaps are dealt anew in
    chunks before they are expanded, so that neither a series nor a gap lies in
    one task.  ``zero`` names columns that are 0 instead of NULL in an empty
    bucket.
    """
    freq = parse_freq(freq) if isinstance(freq, str) else freq
    values = [c for c in df.columns if c not in (*keys, time)]
    dtype = df.schema[time].dataType
    fine = slice_length(freq)
    step = F.expr(freq.step)
    if freq.kind == "month_end":
        start = F.date_trunc("month", F.col(time)).cast(dtype)
        nxt = F.date_trunc("month", F.col("_next")).cast(dtype)
    else:
        start, nxt = F.col(time), F.col("_next")
    # a long gap is expanded in chunks, so that no row holds more than one chunk of labels
    chunk = F.expr(f"{freq.step} * {_CHUNK}")
    last = F.coalesce(nxt - step, start)
    grown = neighbour(df, keys, time, "_next", time, fine).select(
        *keys, *values, last.alias("_last"), F.posexplode(F.sequence(start, last, chunk)).alias("_chunk", "_from")
    )
    if fine:
        # a stated number of partitions: few bytes become many rows, so they must not be coalesced by size
        grown = grown.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_from")
    labels = F.sequence(F.col("_from"), F.least(F.col("_last"), F.col("_from") + chunk - step), step)
    if freq.kind == "month_end":
        labels = F.transform(labels, lambda x: F.last_day(x).cast(dtype))
    grown = grown.select(*keys, *values, "_chunk", F.posexplode(labels).alias("_pos", "_label"))
    here = (F.col("_pos") == 0) & (F.col("_chunk") == 0)
    return grown.select(
        *keys,
        F.col("_label").cast(dtype).alias(time),
        *[
            F.when(here, F.col(f"`{c}`")).otherwise(F.lit(0) if c in zero else F.lit(None)).alias(c)
            for c in values
        ],
    )


def local_month(col: Column, tz: str | None = None) -> Column:
    """``yyyyMM`` of a stored UTC time, in the given local zone."""
    shifted = F.from_utc_timestamp(col.cast("timestamp"), tz) if tz else col
    return F.date_format(shifted, "yyyyMM")


def month_range(df: DataFrame, time: str = "time", tz: str | None = None) -> DataFrame:
    """First days of all months from the earliest to the latest time (local)."""
    t = F.from_utc_timestamp(F.col(time).cast("timestamp"), tz) if tz else F.col(time)
    span = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    return span.select(
        F.explode(
            F.sequence(F.trunc("lo", "month"), F.col("hi").cast("date"), F.expr("interval 1 month"))
        ).alias("month_start")
    )
