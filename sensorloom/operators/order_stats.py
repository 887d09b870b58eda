"""Exact per-group statistics, also for groups too large for one task.

Two plans with the same result:

* ordinary groups: one exchange on the group key, windows sorted by value
  (they spill), one aggregate on the same partitioning;
* hot groups: radix selection.  A histogram of each group's values, in 2**14
  bins of equal width and combined map-side, tells in which bin each wanted
  rank lies; the next round cuts only that bin, between the least and the
  greatest value found in it, until a bin holds one value.  Rows are neither
  sorted nor sent anywhere: what is exchanged are bins with their counts.
  Two rounds are common, because a round divides a range by 2**14.  Each round
  is stored, so the next one plans with a small table of ranks.

Expressions are written as SQL text: the plans are wide, and text keeps the
time to build them on the driver short.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.names import quote
from sensorloom.operators.slices import MAX_BROADCAST_GROUPS, hot_groups, small_side
from sensorloom.session import stored

QUANTILES = {"median": 0.5, "q1": 0.25, "q3": 0.75, "p10": 0.10}
ORDER_FEATURES = frozenset((*QUANTILES, "share_above_q3", "mad_mean", "mad_median"))
MOMENT_FEATURES = frozenset(("count", "mean", "max", "min", "std", "range", "cv"))

_MOMENTS = {
    "count": "count({v})",
    "mean": "avg({v})",
    "max": "max({v})",
    "min": "min({v})",
    "std": "stddev_samp({v})",
    "range": "max({v}) - min({v})",
    "cv": "case when avg({v}) <> 0 then stddev_samp({v}) / avg({v}) end",
}

_BINS = 1 << 14


def _moments(value: str, wanted: Iterable[str]) -> list[str]:
    return [f"{_MOMENTS[w].format(v=value)} as `{w}`" for w in wanted]


def _agg(df: DataFrame, keys: Sequence[str], exprs: Iterable[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(e) for e in exprs])


def moment_stats(df: DataFrame, keys: Sequence[str], value: str, wanted: Iterable[str]) -> DataFrame:
    """Features that combine map-side: one small exchange, indifferent to skew."""
    return _agg(df, keys, _moments(quote(value), wanted))


def _quantiles_needed(wanted: set[str]) -> dict[str, float]:
    need = {q for q in QUANTILES if q in wanted}
    if "share_above_q3" in wanted:
        need.add("q3")
    if "mad_median" in wanted:
        need.add("median")
    return {q: QUANTILES[q] for q in sorted(need)}


# 1-based ranks of the two neighbours of a quantile among _n sorted values
def _low_rank(p: float) -> str:
    return f"(floor({p}D * (_n - 1)) + 1)"


def _high_rank(p: float) -> str:
    return f"least({_low_rank(p)} + 1, _n)"


def _interpolate(low: str, high: str, p: float) -> str:
    position = f"{p}D * (_n - 1)"
    return f"({low} + ({high} - {low}) * ({position} - floor({position})))"


def _finish(stats: DataFrame, keys: list[str], wanted: set[str]) -> DataFrame:
    out = [quote(k) for k in keys]
    for w in sorted(wanted):
        if w in QUANTILES:
            out.append(f"{_interpolate(f'_lo_{w}', f'_hi_{w}', QUANTILES[w])} as `{w}`")
        elif w == "share_above_q3":
            out.append("case when _rows < 4 then 0.0D else _above / _rows end as share_above_q3")
        else:
            out.append(f"`{w}`")
    return stats.selectExpr(*out)


def _ordinary(df: DataFrame, keys: list[str], value: str, wanted: set[str]) -> DataFrame:
    v, key = quote(value), [quote(k) for k in keys]
    # whole-group frames carry the same order, so that one sort serves all
    ordered = f"partition by {', '.join(key)} order by {v} asc nulls last"
    whole = f"({ordered} rows between unbounded preceding and unbounded following)"
    ranks = [f"count({v}) over {whole} as _n", f"row_number() over ({ordered}) as _rank"]
    if "mad_mean" in wanted:
        ranks.append(f"avg({v}) over {whole} as _mean")
    rows = df.selectExpr(*key, v, *ranks)
    picked = {}
    for q, p in _quantiles_needed(wanted).items():
        picked[q] = tuple(f"max(case when _rank = {rank} then {v} end)" for rank in (_low_rank(p), _high_rank(p)))
    centers = [q for feature, q in (("share_above_q3", "q3"), ("mad_median", "median")) if feature in wanted]
    if centers:
        over = {q: [f"{pick} over {whole}" for pick in picked[q]] for q in centers}
        rows = rows.selectExpr("*", *[f"{_interpolate(*over[q], QUANTILES[q])} as _{q}" for q in centers])
    aggs = ["max(_n) as _n", "count(1) as _rows"]
    for q, (low, high) in picked.items():
        aggs += [f"{low} as _lo_{q}", f"{high} as _hi_{q}"]
    if "share_above_q3" in wanted:
        aggs.append(f"count_if({v} > _q3) as _above")
    if "mad_mean" in wanted:
        aggs.append(f"avg(abs({v} - _mean)) as mad_mean")
    if "mad_median" in wanted:
        aggs.append(f"avg(abs({v} - _median)) as mad_median")
    aggs += _moments(v, sorted(wanted & MOMENT_FEATURES))
    return _finish(_agg(rows, keys, aggs), keys, wanted)


def bin_of(v: str, lo: str, hi: str) -> str:
    """SQL text of the bin of a value between two different finite bounds.

    Every step keeps the order, the bounds fall in the first and the last bin;
    a range that overflows is halved first."""
    share = f"if({hi} - {lo} = double('inf'), ({v} / 2 - {lo} / 2) / ({hi} / 2 - {lo} / 2), ({v} - {lo}) / ({hi} - {lo}))"
    return f"cast(floor({share} * {_BINS - 1}) as int)"


def select_ranks(rows: DataFrame, keys: list[str], value: str, targets: DataFrame, groups: int = MAX_BROADCAST_GROUPS + 1) -> DataFrame:
    """(keys, _pick, value) for ``targets`` (keys, _pick, _rank, _lo, _hi): the value with that 1-based rank among
    the values of its group that lie between _lo and _hi, all finite.

    ``groups`` is the counted number of groups; the wanted ranks of not too many are broadcast."""
    key = [quote(k) for k in keys]
    rows = rows.selectExpr(*key, f"{quote(value)} as _v")
    done, targets = [], stored(targets.selectExpr(*key, "_pick", "_rank", "_lo", "_hi"), "ranks")
    while True:
        done.append(targets.filter("_lo = _hi"))
        targets = targets.filter("_lo < _hi")
        if targets.isEmpty():
            break
        ranges = small_side(targets.select(*keys, "_lo", "_hi").distinct(), groups)
        binned = rows.join(ranges, keys).filter("_v >= _lo and _v <= _hi").selectExpr(*key, "_lo", "_hi", f"{bin_of('_v', '_lo', '_hi')} as _bin", "_v")
        counts = _agg(binned, [*keys, "_lo", "_hi", "_bin"], ["count(1) as _c", "min(_v) as _least", "max(_v) as _most"]).selectExpr(
            "*", f"sum(_c) over (partition by {', '.join(key)}, _lo, _hi order by _bin) as _upto")
        found = counts.join(small_side(targets, groups), [*keys, "_lo", "_hi"]).filter("_upto >= _rank and _upto - _c < _rank")
        targets = stored(found.selectExpr(*key, "_pick", "_rank - (_upto - _c) as _rank", "_least as _lo", "_most as _hi"), "ranks")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.selectExpr(*key, "_pick", f"_lo as `{value}`")


def _hot(df: DataFrame, keys: list[str], value: str, wanted: set[str], groups: int = MAX_BROADCAST_GROUPS + 1) -> DataFrame:
    v, key = quote(value), [quote(k) for k in keys]
    quantiles = _quantiles_needed(wanted)
    moments = wanted & MOMENT_FEATURES | ({"mean"} if "mad_mean" in wanted else set())
    finite = f"case when abs({v}) < double('inf') then {v} end"
    stats = stored(_agg(df, keys, [
        f"count({v}) as _n", "count(1) as _rows", f"count_if({v} = double('-inf')) as _below", f"count({finite}) as _finite",
        f"min({finite}) as _lo", f"max({finite}) as _hi", *_moments(v, sorted(moments))]), "moments")
    if quantiles:
        ranks = ", ".join(f"struct('{side}_{q}' as _pick, cast({rank(p)} as bigint) as _rank)" for q, p in quantiles.items()
                          for side, rank in (("_lo", _low_rank), ("_hi", _high_rank)))
        targets = stats.filter("_n > 0").selectExpr(*key, "_below", "_finite", "_lo", "_hi", f"inline(array({ranks}))")
        endless = targets.filter("_rank <= _below or _rank > _below + _finite").selectExpr(
            *key, "_pick", f"if(_rank <= _below, double('-inf'), double('inf')) as {v}")
        inner = targets.filter("_rank > _below and _rank <= _below + _finite").withColumn("_rank", F.expr("_rank - _below"))
        picked = select_ranks(df, keys, value, inner, groups).unionByName(endless)
        picked = _agg(picked, keys, [f"max(case when _pick = '{side}_{q}' then {v} end) as {side}_{q}" for q in quantiles for side in ("_lo", "_hi")])
        stats = stats.drop("_lo", "_hi").join(small_side(picked, groups), keys, "left").selectExpr(
            "*", *[f"{_interpolate(f'_lo_{q}', f'_hi_{q}', p)} as _{q}" for q, p in quantiles.items()])
    second = [f"avg(abs({v} - {center})) as {feature}" for feature, center in (("mad_mean", "mean"), ("mad_median", "_median")) if feature in wanted]
    if "share_above_q3" in wanted:
        second.append(f"count_if({v} > _q3) as _above")
    if second:
        centers = small_side(stats.selectExpr(*key, *[c for c in ("mean", "_median", "_q3") if c in stats.columns]), groups)
        stats = stats.join(_agg(df.join(centers, keys), keys, second), keys, "left")
    return _finish(stats, keys, wanted)


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Iterable[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per group with the wanted features (registry names)."""
    keys, wanted = list(keys), set(wanted)
    unknown = wanted - ORDER_FEATURES - MOMENT_FEATURES
    if unknown:
        raise ValueError(f"not a group statistic: {sorted(unknown)}")
    if not keys:  # one group over everything
        df = df.select(F.lit(1).alias("_all"), value)
        return group_stats(df, ["_all"], value, wanted, hot_rows).drop("_all")
    df = df.select(*keys, value)
    if not wanted & ORDER_FEATURES:
        return moment_stats(df, keys, value, sorted(wanted))
    found = hot_groups(df, keys, hot_rows)
    if found is None:
        return _ordinary(df, keys, value, wanted)
    hot, groups = found
    rest = _ordinary(df.join(small_side(hot, groups), keys, "left_anti"), keys, value, wanted)
    return rest.unionByName(_hot(df.join(small_side(hot, groups), keys, "left_semi"), keys, value, wanted, groups))
