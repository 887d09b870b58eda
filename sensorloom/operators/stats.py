"""Per-bucket statistical and volatility features, resampling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import features as feat
from sensorloom.functions import names
from sensorloom.functions.timebucket import Freq, fill_missing_buckets, micros, neighbour, parse_freq, slice_length, with_bucket
from sensorloom.operators.order_stats import MOMENT_FEATURES, ORDER_FEATURES, group_stats
from sensorloom.operators.slices import nan_to_null, number, pearson, series_rows, successive_pairs

# Further aggregates a user registers: name -> function(value column) -> Column
_REGISTERED: dict[str, Callable[[Column], Column]] = {}


def register_feature(name: str, aggregate: Callable[[Column], Column]) -> None:
    """Add a per-bucket aggregate to the registry."""
    _REGISTERED[name] = aggregate


def feature_names() -> list[str]:
    return [*feat.FEATURES, *_REGISTERED]


def _resolve(names_: Sequence[str]) -> dict[str, str]:
    out = {}
    for n in names_:
        known = feat.canonical(n) or (n if n in _REGISTERED else None)
        if known:
            out[n] = known
    return out


def _empty(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Result for unusable requests: no rows, only the key columns."""
    present = [k for k in (*keys, time) if k in df.columns]
    return df.select(*present).limit(0)


def lag1_autocorrelation(
    df: DataFrame, keys: Sequence[str], value: str, time: str = "time", tie: Sequence[str] = ()
) -> DataFrame:
    pairs = successive_pairs(df, keys, value, time, tie)
    return pairs.groupBy(*keys).agg(pearson(F.col("x"), F.col("y")).alias("lag1_autocorr"))


def bucket_features(
    df: DataFrame,
    field: str,
    wanted: Sequence[str],
    freq: Freq | str,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    tie: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Registry features per (key, non-empty bucket); time column = label."""
    keys = list(keys)
    carried = list(dict.fromkeys(c for c in tie if c not in (*keys, time)))
    rows = series_rows(df, keys, time).select(
        *keys, time, number(names.col(field)).alias("_v"), *carried
    )
    rows = with_bucket(rows, freq, keys, time, "_bucket")
    group = [*keys, "_bucket"]
    plain = [w for w in dict.fromkeys(wanted) if w in ORDER_FEATURES | MOMENT_FEATURES]
    own = [w for w in dict.fromkeys(wanted) if w in _REGISTERED]
    parts = []
    if plain:
        parts.append(group_stats(rows, group, "_v", plain, hot_rows))
    if own:
        parts.append(rows.groupBy(*group).agg(*[_REGISTERED[w](F.col("_v")).alias(w) for w in own]))
    if "lag1_autocorr" in wanted:
        parts.append(lag1_autocorrelation(rows, group, "_v", time, tie))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, group, "left")
    return out.select(*keys, F.col("_bucket").alias(time), *[F.col(w) for w in dict.fromkeys(wanted)])


def with_percent_change(
    df: DataFrame, keys: Sequence[str], value: str, out: str, time: str = "time", slice_us: int | None = None
) -> DataFrame:
    """Relative change against the previous row, 0 where undefined.  Meant for
    bucketed rows (the calendar bounds the rows per key); ``slice_us`` cuts
    series of short buckets into slices."""
    rows = neighbour(df, list(keys), value, "_prev", time, slice_us, ahead=False)
    prev, cur = F.col("_prev"), F.col(value)
    change = (
        F.when(cur.isNull() | prev.isNull(), 0.0)
        .when((prev == 0) & (cur == 0), 0.0)
        .when(prev == 0, F.when(cur > 0, float("inf")).otherwise(float("-inf")))
        .otherwise(cur / F.when(prev != 0, prev) - 1.0)
    )
    return rows.withColumn(out, change).drop("_prev")


def statistical_features(
    df: DataFrame,
    field: str,
    features: Sequence[str],
    freq: str = "h",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    tie: Sequence[str] = (),
    auto_range: bool = True,
    fill: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Wide frame: one row per key and bucket, one column per feature.

    Unknown feature names are ignored.  With ``auto_range`` a request for both
    maximum and minimum also yields the range and its rate of change.  Empty
    buckets between the first and the last one are emitted with NULLs (the
    share above Q3 is 0 there).
    """
    requested = _resolve(features)
    if field not in df.columns or not requested:
        return _empty(df, keys, time)
    parsed = parse_freq(freq)
    wanted = list(requested.values())
    ranged = auto_range and {"max", "min"} <= set(wanted)
    if ranged and "range" not in wanted:
        wanted.append("range")
    wide = bucket_features(df, field, wanted, parsed, keys, time, tie, hot_rows)
    if fill:
        wide = fill_missing_buckets(wide, parsed, list(keys), time, zero=("share_above_q3",))
    localized = "最大值" in requested
    labels = {canon: asked for asked, canon in requested.items()}
    if ranged:
        labels.setdefault("range", "极差" if localized else "range")
        wide = with_percent_change(wide, keys, "range", feat.RANGE_RATE, time, slice_length(parsed))
        labels[feat.RANGE_RATE] = feat.RANGE_RATE_ALIAS if localized else feat.RANGE_RATE
    return wide.select(*keys, time, *[F.col(c).alias(a) for c, a in labels.items()])


def volatility_features(
    df: DataFrame,
    field: str,
    features: Sequence[str] | None = None,
    freq: str = "D",
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    tie: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Like :func:`statistical_features`, keeping only buckets in which every
    requested feature is defined."""
    features = list(features) if features is not None else list(feat.VOLATILITY_DEFAULT)
    out = statistical_features(
        df, field, features, freq, keys, time, tie, auto_range=False, fill=False, hot_rows=hot_rows
    )
    return out.na.drop("any", subset=[c for c in out.columns if c not in (*keys, time)])


def single_window(
    df: DataFrame,
    field: str,
    start=None,
    end=None,
    keys: Sequence[str] = ("device_id",),
    time: str = "time",
    hot_rows: int | None = None,
) -> DataFrame:
    """Nine features over one closed time window per key."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(time) <= F.lit(end))
    rows = series_rows(df, keys, time).select(*keys, number(names.col(field)).alias("_v"))
    wanted = list(feat.SINGLE_WINDOW)
    return group_stats(rows, keys, "_v", wanted, hot_rows).select(*keys, *wanted)


AGG_METHODS = ("mean", "sum", "max", "min", "first", "last", "median", "std")


def _simple_aggregate(method: str, col: Column, order: Column) -> Column:
    if method == "first":
        return F.min_by(col, F.when(col.isNotNull(), order))
    if method == "last":
        return F.max_by(col, F.when(col.isNotNull(), order))
    if method in ("max", "min"):
        return {"max": F.max, "min": F.min}[method](col)
    value = number(col)
    return {
        "mean": F.avg(value),
        "sum": F.coalesce(F.sum(value), F.lit(0.0)),
        "std": F.stddev_samp(value),
    }[method]


def resample(
    df: DataFrame,
    freq: str = "10min",
    agg: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    time: str = "time",
    tie: Sequence[str] = (),
    fill: bool = True,
) -> DataFrame:
    """Per-column aggregation to a time grid.

    Without ``agg`` the method of each column follows from its name.  Quoted
    names are accepted; columns the frame does not have are ignored.
    """
    keys = list(keys)
    if time not in df.columns:
        return df
    parsed = parse_freq(freq)
    methods = {names.unquote(k): m for k, m in (agg or {}).items()}
    methods = {k: m for k, m in methods.items() if k in df.columns and k not in (*keys, time)}
    if not methods:
        methods = {c: names.default_aggregate(c) for c in df.columns if c not in (*keys, time)}
    bad = {m for m in methods.values() if m not in AGG_METHODS}
    if bad:
        raise ValueError(f"unknown aggregate {sorted(bad)}, use one of {AGG_METHODS}")
    needed = dict.fromkeys([*keys, time, *tie, *methods])
    rows = nan_to_null(series_rows(df, keys, time).select(*[names.col(c) for c in needed]))
    rows = with_bucket(rows, parsed, keys, time, "_bucket")
    group = [*keys, "_bucket"]
    # a plain number keeps the aggregation hash-based
    order = F.struct(F.col(time), *[F.col(t) for t in tie]) if tie else micros(F.col(time))
    kinds = dict(rows.dtypes)
    texts = {c: m for c, m in methods.items() if m in ("first", "last") and kinds[c] == "string" and c not in tie}
    simple = {c: m for c, m in methods.items() if m != "median" and c not in texts}
    # the row count is there for the case that no column is simple
    out = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_simple_aggregate(m, names.col(c), order).alias(c) for c, m in simple.items()],
    )
    for c, m in texts.items():
        # texts cannot be aggregated by hash: first combine the times of equal
        # texts, then pick among what is left
        pick, best = (F.min_by, F.min) if m == "first" else (F.max_by, F.max)
        seen = rows.filter(names.col(c).isNotNull()).groupBy(*group, names.col(c)).agg(best(order).alias("_o"))
        out = out.join(seen.groupBy(*group).agg(pick(names.col(c), F.col("_o")).alias(c)), group, "left")
    for c in (c for c, m in methods.items() if m == "median"):
        part = group_stats(rows.select(*group, number(names.col(c)).alias("_v")), group, "_v", ["median"])
        out = out.join(part.withColumnRenamed("median", c), group, "left")
    out = out.select(*keys, F.col("_bucket").alias(time), *[names.col(c) for c in methods])
    if fill:
        sums = tuple(c for c, m in methods.items() if m == "sum")
        out = fill_missing_buckets(out, parsed, keys, time, zero=sums)
    return out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in exclude and (t in kinds or t.startswith("decimal"))]


def resample_numeric_mean(
    df: DataFrame, freq: str, keys: Sequence[str], time: str = "time", fill: bool = True
) -> DataFrame:
    """Mean of all numeric columns per key and bucket."""
    cols = numeric_columns(df, (*keys, time))
    return resample(df.select(*keys, time, *[names.col(c) for c in cols]), freq,
                    {c: "mean" for c in cols}, keys, time, fill=fill)
