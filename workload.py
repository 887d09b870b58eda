"""The queries of the correctness check and the benchmark.

Each entry pairs a query built from the library with SQL that gives the same
rows from the same tables.  All of them run over whole tables: events serve as
readings of five devices, orders and lineitem as daily series.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions import features as feat
from sensorloom.functions import names, physics
from sensorloom.functions.timebucket import month_range
from sensorloom.operators import (
    cleaning,
    forecast,
    interpolate,
    merge,
    order_stats,
    report,
    reshape,
    risk,
    sequence,
    slices,
    spectral,
    stats,
)
from sensorloom.plans import device_features, fetch, ingest, interpolation, metrics, requests, risk_job
from sensorloom.session import configure, ensure_checkpoint_dir
from sensorloom.sinks import bucketed, facts, files as file_sinks, tables as table_sinks
from sensorloom.sources import files as file_sources
from sensorloom.sources import json_records, points, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(Inputs(configure(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Six decimals, nudged so that both engines round ties alike."""
    return df.select(
        *[
            F.round(names.col(c) + 1e-9, 6).alias(c) if t in ("double", "float") else names.col(c)
            for c, t in df.dtypes
        ]
    )


def r(sql: str) -> str:
    """The same rounding in SQL."""
    return f"round(cast({sql} as double) + 1e-9, 6)"


class Inputs:
    """Sensor-shaped views of the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def readings(self) -> DataFrame:
        return self.table("events").select(
            F.col("ts").alias("time"),
            F.col("event_type").alias("device_id"),
            (F.col("user_id") % 10).cast("string").alias("temple_id"),
            F.col("value").alias("humidity"),
            F.get_json_object("props", "$.k").cast("double").alias("temperature"),
        )

    @property
    def gappy(self) -> DataFrame:
        """Readings with high values unknown and the small hours missing."""
        value = F.col("humidity")
        return self.readings.filter(F.hour("time") >= 5).withColumn("humidity", F.when(value <= 120, value))

    @property
    def holes(self) -> DataFrame:
        """All readings, high values unknown."""
        value = F.col("humidity")
        return self.readings.withColumn("humidity", F.when(value <= 120, value))

    @property
    def rain(self) -> DataFrame:
        v = F.col("humidity")
        return self.readings.select("device_id", "time", F.when(v > 50, v).otherwise(0.0).alias("rainfall"))

    @property
    def inside(self) -> DataFrame:
        return stats.resample(self.readings.select("time", "temperature", "humidity"), "h", fill=False)

    @property
    def outside(self) -> DataFrame:
        """All readings again, as of a station that reports five hours later."""
        part = self.readings.select(
            (F.col("time") + F.expr("interval 5 hours")).alias("time"), (F.col("humidity") / 10).alias("avg_vapor_pressure"))
        return stats.resample(part, "h", fill=False)

    @property
    def hourly(self) -> DataFrame:
        return stats.statistical_features(self.readings, "humidity", ["mean"], "h", fill=False)

    @property
    def shipments(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_shipdate").alias("time"),
            F.col("l_returnflag").alias("device_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
        )

    @property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderdate").alias("time"),
            F.col("o_orderpriority").alias("device_id"),
            F.col("o_totalprice").alias("price"),
        )

    def folder(self, name: str) -> str:
        """A new folder all executors share."""
        return f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"


READINGS = """readings as (
  select ts as time, event_type as device_id, cast(user_id % 10 as varchar) as temple_id,
         value as humidity, cast(json_extract_string(props, '$.k') as double) as temperature
  from events)"""
GAPPY = READINGS + """, gappy as (
  select time, device_id, temple_id, temperature, case when humidity <= 120 then humidity end as humidity
  from readings where hour(time) >= 5)"""
HOLES = READINGS + """, holes as (
  select time, device_id, temple_id, temperature, case when humidity <= 120 then humidity end as humidity from readings)"""
SHIPMENTS = """shipments as (
  select l_shipdate as time, l_returnflag as device_id, l_extendedprice as price, l_quantity as quantity
  from lineitem)"""
ORDERS = """o as (
  select o_orderdate as time, o_orderpriority as device_id, o_totalprice as price from orders)"""
INOUT = READINGS + """, inside as (
  select date_trunc('hour', time) as time, avg(temperature) as temperature, avg(humidity) as humidity
  from readings group by 1),
outside as (
  select date_trunc('hour', time + interval 5 hours) as time, avg(humidity / 10) as avg_vapor_pressure
  from readings group by 1)"""
HOURLY = READINGS + """, hourly as (
  select device_id, date_trunc('hour', time) as time, avg(humidity) as mean from readings group by 1, 2)"""

Q = {
    "mean": "avg(v)",
    "median": "quantile_cont(v, 0.5)",
    "max": "max(v)",
    "min": "min(v)",
    "q1": "quantile_cont(v, 0.25)",
    "q3": "quantile_cont(v, 0.75)",
    "p10": "quantile_cont(v, 0.1)",
    "range": "max(v) - min(v)",
    "std": "stddev_samp(v)",
    "cv": "case when avg(v) <> 0 then stddev_samp(v) / avg(v) end",
}


def agg_sql(ctes: str, source: str, value: str, bucket: str, wanted, key: str = "device_id") -> str:
    cols = ", ".join(f"{r(Q[w])} as {w}" for w in wanted)
    return (
        f"with {ctes}, b as (select {key}, {bucket} as time, {value} as v from {source}) "
        f"select {key}, time, {cols} from b group by {key}, time"
    )


def spine_sql(ctes: str, inner: str, interval: str, cols: dict[str, str]) -> str:
    """Outer frame that adds the empty buckets to ``inner`` (device_id, time)."""
    out = ", ".join(f"{e} as {c}" for c, e in cols.items())
    return (
        f"with {ctes}, agg as ({inner}), span as (select device_id, min(time) lo, max(time) hi from agg group by 1), "
        f"spine as (select device_id, unnest(generate_series(lo, hi, interval {interval})) as time from span) "
        f"select s.device_id, s.time, {out} from spine s left join agg a on a.device_id = s.device_id and a.time = s.time"
    )


# The event types of the test tables, in order.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
DAY, HOUR = "date_trunc('day', time)", "date_trunc('hour', time)"

# --- per-bucket statistics -------------------------------------------------


@query("stat_hourly_mean", spine_sql(
    READINGS, f"select device_id, {HOUR} as time, {r('avg(humidity)')} as mean from readings group by 1, 2",
    "1 hour", {"mean": "a.mean"}))
def _(d):
    return stats.statistical_features(d.readings, "humidity", ["mean"], "h")


@query("stat_daily_core", agg_sql(READINGS, "readings", "humidity", DAY, ["mean", "max", "min", "median"]))
def _(d):
    return stats.statistical_features(d.readings, "humidity", ["mean", "max", "min", "median"], "D", auto_range=False)


@query("stat_daily_quantiles", agg_sql(READINGS, "readings", "temperature", DAY, ["q1", "q3", "p10"]))
def _(d):
    return stats.statistical_features(d.readings, "temperature", ["q1", "q3", "p10"], "D")


@query("stat_weekly", agg_sql(
    SHIPMENTS, "shipments", "price", "cast(date_trunc('week', time) + interval 6 days as timestamp)",
    ["mean", "median", "range", "std"]))
def _(d):
    return stats.statistical_features(d.shipments, "price", ["mean", "median", "range", "std"], "W", fill=False)


@query("stat_monthly_me", agg_sql(
    SHIPMENTS, "shipments", "price", "cast(last_day(time) as timestamp)", ["mean", "q1", "q3", "max"]))
def _(d):
    return stats.statistical_features(d.shipments, "price", ["mean", "q1", "q3", "max"], "ME", fill=False)


@query("stat_monthly_ms", agg_sql(
    ORDERS, "o", "price", "cast(date_trunc('month', time) as timestamp)", ["mean", "p10", "cv"]))
def _(d):
    return stats.statistical_features(d.orders, "price", ["mean", "p10", "cv"], "MS", fill=False)


@query("stat_anchored_7h", f"""
with {READINGS}, f as (select device_id, date_trunc('day', min(time)) as d0 from readings group by 1),
b as (select r.device_id, f.d0 + to_microseconds(25200000000 * ((epoch_us(r.time) - epoch_us(f.d0)) // 25200000000)) as time,
             r.humidity as v from readings r join f on f.device_id = r.device_id)
select device_id, time, {r('avg(v)')} as mean, {r('max(v)')} as max from b group by 1, 2""")
def _(d):
    return stats.statistical_features(d.readings, "humidity", ["mean", "max"], "7h", fill=False)


SHARE = """sh as (select *, quantile_cont(v, 0.75) over (partition by device_id, time) as q3v,
  count(*) over (partition by device_id, time) as n from b)"""


@query("stat_share_above_q3", f"""
with {SHIPMENTS}, b as (select device_id, cast(date_trunc('month', time) as timestamp) as time, price as v from shipments), {SHARE}
select device_id, time, {r('case when count(*) < 4 then 0 else count(*) filter (v > q3v) / count(*) end')} as share_above_q3
from sh group by 1, 2""")
def _(d):
    return stats.statistical_features(d.shipments, "price", ["share_above_q3"], "MS", fill=False)


@query("stat_range_and_rate", f"""
with {READINGS}, b as (select device_id, {DAY} as time, max(humidity) as mx, min(humidity) as mn from readings group by 1, 2),
g as (select *, mx - mn as rg, lag(mx - mn) over (partition by device_id order by time) as pr from b)
select device_id, time, {r('mx')} as max, {r('mn')} as min, {r('rg')} as range,
  {r('case when pr is null or rg is null or (pr = 0 and rg = 0) then 0 else rg / pr - 1 end')} as range_rate from g""")
def _(d):
    return stats.statistical_features(d.readings, "humidity", ["max", "min"], "D")


@query("stat_with_empty_buckets", spine_sql(
    GAPPY, f"select device_id, {HOUR} as time, {r('avg(humidity)')} as mean, {r('median(humidity)')} as median, "
    f"{r('stddev_samp(humidity)')} as std from gappy group by 1, 2", "1 hour",
    {"mean": "a.mean", "median": "a.median", "std": "a.std"}))
def _(d):
    return stats.statistical_features(d.gappy, "humidity", ["mean", "median", "std"], "h")


# Buckets of five minutes are worked on in slices.  An infinite rate (after a range of 0) is given as unknown.
@query("stat_short_buckets", f"""
with {READINGS}, agg as (select device_id, time_bucket(interval 5 minutes, time) as time, avg(humidity) as mean, max(humidity) as mx, min(humidity) as mn
  from readings group by 1, 2), span as (select device_id, min(time) lo, max(time) hi from agg group by 1),
spine as (select device_id, unnest(generate_series(lo, hi, interval 5 minutes)) as time from span),
g as (select s.device_id, s.time, mean, mx, mn, mx - mn as rg, lag(mx - mn) over (partition by s.device_id order by s.time) as pr
  from spine s left join agg a on a.device_id = s.device_id and a.time = s.time)
select device_id, time, {r('mean')} as mean, {r('mx')} as max, {r('mn')} as min, {r('rg')} as range,
  {r('case when pr is null or rg is null or (pr = 0 and rg = 0) then 0 when pr <> 0 then rg / pr - 1 end')} as range_rate from g""")
def _(d):
    out = stats.statistical_features(d.readings, "humidity", ["mean", "max", "min"], "5min")
    return out.withColumn("range_rate", F.when(F.abs("range_rate") < float("inf"), F.col("range_rate")))


@query("vol_daily_std_cv", agg_sql(READINGS, "readings", "humidity", DAY, ["std", "cv"]))
def _(d):
    return stats.volatility_features(d.readings, "humidity", ["std", "cv"], "D")


MADS = """m as (select *, avg(v) over (partition by device_id, time) as mu,
  quantile_cont(v, 0.5) over (partition by device_id, time) as md from b)"""


@query("vol_daily_mads", f"""
with {SHIPMENTS}, b as (select device_id, time, price as v from shipments), {MADS}
select device_id, time, {r('avg(abs(v - mu))')} as mad_mean, {r('avg(abs(v - md))')} as mad_median from m group by 1, 2""")
def _(d):
    return stats.volatility_features(d.shipments, "price", ["mad_mean", "mad_median"], "D")


def corr_sql(x: str, y: str) -> str:
    both = f"({x} is not null and {y} is not null)"
    vx, vy = f"var_pop({x}) filter {_where(both)}", f"var_pop({y}) filter {_where(both)}"
    return f"case when {vx} > 0 and {vy} > 0 then covar_pop({x}, {y}) / (sqrt({vx}) * sqrt({vy})) end"


def _where(cond: str) -> str:
    return f"(where {cond})"


@query("vol_lag1_autocorr", f"""
with {HOLES}, b as (select device_id, {DAY} as time, humidity as x,
  lag(humidity) over (partition by device_id, {DAY} order by time) as y from holes)
select device_id, time, {r(corr_sql('x', 'y'))} as lag1_autocorr from b group by 1, 2""")
def _(d):
    return stats.statistical_features(d.holes, "humidity", ["lag1_autocorr"], "D", fill=False)


@query("vol_job", f"""
with {HOLES}, b as (select device_id, {DAY} as time, humidity as v,
  lag(humidity) over (partition by device_id, {DAY} order by time) as y from holes), {MADS},
s as (select device_id, time, stddev_samp(v) as sd, {Q['cv']} as cv, {corr_sql('v', 'y')} as ac,
  avg(abs(v - mu)) as m1, avg(abs(v - md)) as m2 from m group by 1, 2)
select device_id, time, {r('sd')} as std, {r('cv')} as cv, {r('ac')} as lag1_autocorr, {r('m1')} as mad_mean,
  {r('m2')} as mad_median from s
where sd is not null and cv is not null and ac is not null and m1 is not null and m2 is not null""")
def _(d):
    return stats.volatility_features(d.holes, "humidity")


@query("single_window", f"""
with {SHIPMENTS}, b as (select device_id, price as v from shipments
  where time between timestamp '1996-01-01' and timestamp '1998-06-30 12:00:00'),
sh as (select *, quantile_cont(v, 0.75) over (partition by device_id) as q3v from b)
select device_id, {', '.join(f'{r(Q[w])} as {w}' for w in ('mean', 'median', 'max', 'min', 'q1', 'q3', 'p10', 'range'))},
  {r('case when count(*) < 4 then 0 else count(*) filter (v > q3v) / count(*) end')} as share_above_q3
from sh group by 1""")
def _(d):
    start, end = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-06-30 12:00:00").cast("timestamp_ntz")
    return stats.single_window(d.shipments, "price", start, end)


@query("hot_group_quantiles", f"""
with {SHIPMENTS}, b as (select device_id, price as v from shipments), {MADS.replace(', time', '')},
sh as (select *, quantile_cont(v, 0.75) over (partition by device_id) as q3v from m)
select device_id, {', '.join(f'{r(Q[w])} as {w}' for w in ('mean', 'median', 'q1', 'q3', 'p10', 'std', 'cv', 'range'))},
  {r('avg(abs(v - mu))')} as mad_mean, {r('avg(abs(v - md))')} as mad_median,
  {r('count(*) filter (v > q3v) / count(*)')} as share_above_q3 from sh group by 1""")
def _(d):
    # the plan for groups that do not fit one task, forced by a low limit
    wanted = ["mean", "median", "q1", "q3", "p10", "std", "cv", "range", "mad_mean", "mad_median", "share_above_q3"]
    return order_stats.group_stats(d.shipments, ["device_id"], "price", wanted, hot_rows=1000)


# --- resampling --------------------------------------------------------------


@query("resample_multi_agg", f"""
with {READINGS} select device_id, {HOUR} as time, {r('avg(humidity)')} as humidity,
  {r('sum(temperature)')} as temperature, arg_min(temple_id, time) as temple_id
from readings group by 1, 2""")
def _(d):
    how = {"humidity": "mean", "`temperature`": "sum", "temple_id": "first"}
    return stats.resample(d.readings, "1h", how, ["device_id"], fill=False)


@query("resample_first_last_std", f"""
with {HOLES} select device_id, time_bucket(interval 30 minutes, time) as time,
  {r('arg_min(humidity, time) filter (where humidity is not null)')} as opening,
  {r('arg_max(humidity, time) filter (where humidity is not null)')} as closing,
  {r('stddev_samp(humidity)')} as spread, {r('max(humidity)')} as top, {r('min(humidity)')} as low,
  {r('median(humidity)')} as middle
from holes group by 1, 2""")
def _(d):
    v = F.col("humidity")
    wide = d.holes.select("device_id", "time", *[v.alias(a) for a in ("opening", "closing", "spread", "top", "low", "middle")])
    how = {"opening": "first", "closing": "last", "spread": "std", "top": "max", "low": "min", "middle": "median"}
    return stats.resample(wide, "30min", how, ["device_id"], fill=False)


@query("resample_default_aggs", spine_sql(
    READINGS, f"""select device_id, time_bucket(interval 10 minutes, time) as time, {r('avg(humidity)')} as humidity,
    {r('sum(humidity)')} as total_rain, arg_min(temple_id, time) as temple_id, {r('avg(temperature)')} as other
    from readings group by 1, 2""", "10 minutes",
    {"humidity": "a.humidity", "total_rain": "coalesce(a.total_rain, 0)", "temple_id": "a.temple_id", "other": "a.other"}))
def _(d):
    wide = d.readings.select(
        "device_id", "time", "humidity", F.col("humidity").alias("total_rain"), "temple_id", F.col("temperature").alias("other"))
    return stats.resample(wide, "10min", None, ["device_id"])


@query("resample_numeric_mean", f"""
with {SHIPMENTS} select device_id, {DAY} as time, {r('avg(price)')} as price, {r('avg(quantity)')} as quantity
from shipments group by 1, 2""")
def _(d):
    return stats.resample_numeric_mean(d.shipments, "D", ["device_id"], fill=False)


# --- scans -------------------------------------------------------------------


@query("scan_range_half_open", f"""
with {READINGS} select * from readings where time >= timestamp '2024-01-03' and time < timestamp '2024-01-20'""")
def _(d):
    return tables.scan_table(d.readings, "2024-01-03", "2024-01-20")


@query("scan_temple_range", f"""
with {READINGS} select * from readings
where temple_id = '7' and time >= timestamp '2024-01-03' and time < timestamp '2024-01-20'""")
def _(d):
    return tables.scan_temple(d.readings, "7", "2024-01-03", "2024-01-20", sort=True)


@query("scan_device_field", f"""
with {READINGS} select temple_id, device_id, time, humidity from readings
where temple_id = '3' and device_id = 'view' and time >= timestamp '2024-01-02' and time < timestamp '2024-01-29'""")
def _(d):
    return tables.scan_field(d.readings, "humidity", "view", "3", "2024-01-02", "2024-01-29")


@query("scan_id_history", f"with {READINGS} select * from readings where device_id = 'signup'")
def _(d):
    return tables.scan_id(d.readings, "signup", sort=True)


@query("scan_closed_multi", f"""
with {READINGS} select time, humidity, temple_id from readings
where time between timestamp '2024-01-05' and timestamp '2024-01-25' and device_id = 'error'""")
def _(d):
    return tables.scan_fields(d.readings, ["`humidity`", "temple_id"], "2024-01-05", "2024-01-25", device_id="error")


@query("distinct_devices", f"with {READINGS} select distinct device_id from readings where device_id is not null")
def _(d):
    return tables.distinct_ids(d.readings)


@query("global_time_range", "select min(ts) as min_time, max(ts) as max_time from events")
def _(d):
    return tables.global_time_range(d.readings)


@query("parquet_date_slice", """
select o_orderdate as time, o_totalprice from orders
where o_orderdate between timestamp '1996-01-01' and timestamp '1997-12-31'""")
def _(d):
    df = d.table("orders").withColumnRenamed("o_orderdate", "time")
    return tables.time_range(df, "1996-01-01", "1997-12-31", "both").select("time", "o_totalprice")


@query("adhoc_sql", """
select l_returnflag, l_linestatus, count(*) as n, """ + r("sum(l_extendedprice * (1 - l_discount))") + """ as revenue
from lineitem group by 1, 2""")
def _(d):
    return tables.run_sql(
        d.spark,
        "select l_returnflag, l_linestatus, count(*) as n, sum(l_extendedprice * (1 - l_discount)) as revenue "
        "from {lineitem} group by 1, 2",
        tables={"lineitem": d.table("lineitem")},
    )


@query("months_covered", """
select cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), interval 1 month)) as date) as month_start
from orders""")
def _(d):
    return month_range(d.orders)


# --- points ------------------------------------------------------------------


@query("csv_to_points", f"""
with {READINGS}, p as (
  select time, device_id, 'humidity' as field, try_cast(case when humidity > 200 then 'bad' else cast(humidity as varchar) end as double) as value from readings
  union all select time, device_id, 'temperature', temperature from readings)
select time - interval 8 hours as time, 'cave' as measurement, device_id, field, {r('value')} as value from p where value is not null""")
def _(d):
    v = F.col("humidity")
    raw = d.readings.select(
        F.date_format("time", "yyyy/MM/dd HH:mm:ss.SSSSSS").alias("stamp"), "device_id",
        F.when(v > 200, "bad").otherwise(v.cast("string")).alias("humidity"), F.col("temperature").cast("string").alias("temperature"))
    out = points.to_points(raw, "cave", ["humidity", "temperature", "absent"], ["device_id"], "stamp",
                           "yyyy/MM/dd HH:mm:ss.SSSSSS", "Asia/Shanghai")
    return out.select(F.col("time").cast("timestamp_ntz").alias("time"), "measurement",
                      F.col("tags")["device_id"].alias("device_id"), "field", "value")


@query("points_pivot", f"""
with {READINGS} select time, device_id, {r('humidity')} as humidity from readings
where time >= timestamp '2024-01-02' and time < timestamp '2024-01-28' and humidity is not null""")
def _(d):
    pts = points.to_points(d.readings, "cave", ["humidity", "temperature"], ["device_id"])
    out = points.scan_points(pts, "cave", "humidity", "2024-01-02", "2024-01-28", ["device_id"])
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


# --- cleaning ----------------------------------------------------------------


@query("clean_coerce_dropany", f"""
with {READINGS}, t as (select device_id, time, try_cast(case when humidity > 150 then '-' else cast(humidity as varchar) end as double) as humidity,
  case when temperature > 5 then temperature end as temperature from readings)
select device_id, time, {r('humidity')} as humidity, {r('temperature')} as temperature from t
where humidity is not null and temperature is not null""")
def _(d):
    v, t = F.col("humidity"), F.col("temperature")
    raw = d.readings.select("device_id", "time", F.when(v > 150, "-").otherwise(v.cast("string")).alias("humidity"),
                            F.when(t > 5, t.cast("string")).alias("temperature"))
    return cleaning.coerce_numeric(raw, ["humidity", "temperature"])


@query("fillna_int", f"""
with {READINGS} select device_id, time, cast(trunc(case when humidity <= 100 then humidity else 0 end) as integer) as headcount from readings""")
def _(d):
    v = F.col("humidity")
    raw = d.readings.select("device_id", "time", F.when(v <= 100, v).alias("headcount"))
    return cleaning.fill_as_integer(raw, ["headcount"])


@query("rename_map", f"""
with {READINGS} select time, {r('temperature')} as temperature, {r('humidity')} as humidity,
  timestamp '2026-01-01' as created_at from readings where humidity <= 250""")
def _(d):
    v = F.col("humidity")
    stamp = F.when(v > 250, "#####").otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    raw = d.readings.select(stamp.alias("采集时间"), F.col("temperature").alias("空气温度（℃）"), v.alias("空气湿度（%）"), "device_id")
    out = cleaning.apply_column_map(
        raw, {**ingest.SENSOR_ROUTES["无线温湿度传感器"]["columns"], "电量": "battery"}, F.lit("2026-01-01").cast("timestamp_ntz"))
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("drop_empty_rows", f"""
with {READINGS}, t as (select case when humidity > 60 then humidity end as a, case when temperature > 60 then temperature end as b from readings)
select {r('a')} as a, {r('b')} as b from t where a is not null or b is not null""")
def _(d):
    a, b = F.col("humidity"), F.col("temperature")
    return cleaning.drop_empty_rows(d.readings.select(F.when(a > 60, a).alias("a"), F.when(b > 60, b).alias("b")))


NAMED = """named as (select event_id, event_type || '_' || lpad(cast(user_id as varchar), 4, '0') || '窟_' ||
  case when event_type in ('click', 'view') then '无线温湿度传感器' when event_type = 'error' then '无线二氧化碳传感器' else '电池' end
  || '_导出.xlsx' as file, value from events)"""


def _named(d: Inputs) -> DataFrame:
    kind = F.col("event_type")
    sensor = F.when(kind.isin("click", "view"), "无线温湿度传感器").when(kind == "error", "无线二氧化碳传感器").otherwise("电池")
    return d.table("events").select(
        "event_id",
        F.concat(kind, F.lit("_"), F.lpad(F.col("user_id").cast("string"), 4, "0"), F.lit("窟_"), sensor, F.lit("_导出.xlsx")).alias("_file"),
        "value",
    )


@query("filename_meta", f"""
with {NAMED} select event_id, regexp_extract(file, '^([^_]+)_', 1) as device_id, regexp_extract(file, '_(\\d+)窟', 1) as temple_id,
  regexp_extract(file, '(无线温湿度传感器|无线二氧化碳传感器)', 1) as sensor from named where file not like '%电池%'""")
def _(d):
    return file_sources.file_metadata(_named(d)).drop("_file", "value")


@query("sensor_routes", f"""
with {NAMED} select case when file like '%无线温湿度%' then 'sensor_temp_humidity' else 'sensor_co2' end as target, event_id, {r('value')} as value
from named where file not like '%电池%'""")
def _(d):
    routed = file_sources.route_sensors(file_sources.file_metadata(_named(d)))
    return reshape.union_by_name([df.select(F.lit(t).alias("target"), "event_id", "value") for t, df in routed.items()])


ALIASES = {"humidity": ["click", "view"], "temperature": ["purchase", "view"], "signup": ["join"]}


@query("alias_resolve", """
select event_type as term, case when event_type in ('click', 'view') then 'humidity' when event_type = 'purchase' then 'temperature'
  when event_type = 'signup' then 'signup' end as field, count(*) as n from events group by 1, 2""")
def _(d):
    terms = d.table("events").select(F.col("event_type").alias("term"))
    return terms.withColumn("field", names.resolve_alias_column(F.col("term"), ALIASES)).groupBy("term", "field").agg(F.count(F.lit(1)).alias("n"))


@query("special_values", f"""
with {READINGS} select device_id, time, case when humidity > 300 then null when humidity > 200 then cast('infinity' as double)
  when humidity > 100 then cast('-infinity' as double) else humidity end as value from readings""")
def _(d):
    v = F.col("humidity")
    text = F.when(v > 300, "NaN").when(v > 200, "Infinity").when(v > 100, "-inf").otherwise(v.cast("string"))
    return d.readings.select("device_id", "time", cleaning.special_number(text).alias("value"))


@query("zone_roundtrip", f"""
with {READINGS} select device_id, time + interval 8 hours as time, date_trunc('day', time + interval 8 hours) as local_day from readings""")
def _(d):
    out = cleaning.to_local(d.readings.select("device_id", "time"), "Asia/Shanghai")
    out = cleaning.strip_zone(out)
    return out.withColumn("local_day", F.date_trunc("day", "time").cast("timestamp_ntz"))


@query("sanitize_names", "select l_orderkey as order_key, " + r("l_quantity") + " as total_10min, l_returnflag as flag from lineitem")
def _(d):
    raw = d.table("lineitem").select(
        F.col("l_orderkey").alias("order (key)"), F.col("l_quantity").alias("total(10min)"), F.col("l_returnflag").alias("flag"))
    return names.sanitize_columns(raw)


@query("sheets_by_year", f"""
with {SHIPMENTS} select cast(year(time) as varchar) as sheet, count(*) as n, {r('sum(price)')} as price
from shipments where year(time) between 1996 and 1999 group by 1""")
def _(d):
    sheets = d.shipments.withColumn("sheet", F.year("time").cast("string"))
    sheets = reshape.union_by_name([sheets, d.orders.withColumn("sheet", F.lit("说明"))])
    kept = file_sources.year_sheets(sheets, (1996, 1999))
    return kept.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("union_sheets", """
select o_orderdate as time, """ + r("o_totalprice") + """ as price, cast(null as double) as quantity from orders
union all select l_shipdate, """ + r("l_extendedprice") + """, """ + r("l_quantity") + """ from lineitem""")
def _(d):
    return reshape.union_by_name([d.orders.select("time", "price"), d.shipments.select("quantity", "price", "time")])


@query("ingest_sensor_tables", f"""
with {NAMED} select regexp_extract(file, '_(\\d+)窟', 1) as temple_id, regexp_extract(file, '^([^_]+)_', 1) as device_id,
  ts as time, {r('cast(e.value as float)')} as humidity, {r('cast(json_extract_string(e.props, $$$.k$$) as float)')} as temperature
from named n join events e on e.event_id = n.event_id where file like '%无线温湿度%' and e.value <= 200""")
def _(d):
    ev = d.table("events")
    v = F.col("value")
    sheet = _named(d).drop("value").join(ev, "event_id").select(
        "_file", F.lit("2024").alias("sheet"), F.col("ts").alias("采集时间"),
        F.get_json_object("props", "$.k").alias("空气温度（℃）"), F.when(v > 200, "坏").otherwise(v.cast("string")).alias("空气湿度（%）"))
    out = ingest.sensor_tables(sheet)["sensor_temp_humidity"].drop("created_at")
    return out.withColumn("time", F.col("time").cast("timestamp_ntz")).withColumns(
        {c: F.col(c).cast("double") for c in ("humidity", "temperature")})


# --- JSON --------------------------------------------------------------------


def _documents(d: Inputs, columnar: bool) -> DataFrame:
    v = F.col("value")
    shown = F.when(v > 300, F.lit(None)).otherwise(v)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    if columnar:
        body = F.struct(F.struct(F.array(stamp, stamp).alias("time"), F.array(shown, v + 1).alias("humidity")).alias("data"))
    else:
        body = F.struct(F.array(F.struct(stamp.alias("time"), shown.alias("humidity"), F.lit("x").alias("note"))).alias("data"))
    text = F.to_json(body, {"ignoreNullFields": "false"})
    broken = F.when(v > 250, F.when(v > 270, F.lit('{"data": [')).otherwise(F.lit('{"data": [{"time": "2024-01-01"}]}')))
    return d.table("events").select("event_id", F.coalesce(broken, text).alias("data_json") if not columnar else text.alias("data_json"))


@query("json_records", f"""
select event_id, ts as time, {r('value')} as humidity from events where value <= 250""")
def _(d):
    good, _bad = json_records.parse_documents(_documents(d, False), ["humidity"], ids=["event_id"])
    return good.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("json_rejects", """
select event_id, false as success, case when value > 270 then 'JSONParseError' else 'ValidationError' end as type,
  case when value > 270 then 'the document is not JSON' else 'Field not found: humidity' end as message,
  case when value > 270 then '{}' else '{"missing_fields":["humidity"]}' end as details from events where value > 250""")
def _(d):
    _good, bad = json_records.parse_documents(_documents(d, False), ["humidity"], ids=["event_id"])
    return bad


@query("json_content_errors", """
with k as (select event_id, event_id % 7 as kind, strftime(ts, '%Y-%m-%dT%H:%M:%S') as stamp, cast(value as varchar) as v from events)
select event_id, false as success, case when kind in (0, 1) then 'JSONParseError' else 'ValidationError' end as type,
  case kind when 0 then 'the document is not JSON' when 1 then 'the document is empty' when 2 then 'the document has no rows'
    when 3 then 'Field not found: humidity' when 4 then 'columns differ in length' when 5 then 'a time can''t be read'
    else 'not a number in field: humidity' end as message,
  case kind when 3 then '{"missing_fields":["humidity"]}' when 4 then '{"lengths":{"humidity":1,"time":2}}'
    when 5 then '{"row":1,"column":"time","value":"at ' || stamp || '","count":1}'
    when 6 then '{"row":0,"column":"humidity","value":"about ' || v || '","count":2}' else '{}' end as details from k""")
def _(d):
    at, v = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("value").cast("string")
    kinds = ['{"data": [', "", '{"data": []}', '{"data": [{"time": "%1$s"}]}', '{"data": {"time": ["%1$s", "%1$s"], "humidity": [%2$s]}}',
             '[{"time": "%1$s", "humidity": %2$s}, {"time": "at %1$s", "humidity": null}]',
             '{"time": ["%1$s", "%1$s"], "humidity": ["about %2$s", "%1$s"]}']
    text = F.coalesce(*[F.when(F.col("event_id") % len(kinds) == k, F.format_string(body, at, v)) for k, body in enumerate(kinds)])
    _good, bad = json_records.parse_documents(d.table("events").select("event_id", text.alias("data_json")), ["humidity"], ids=["event_id"])
    return bad


@query("json_columnar", f"""
select event_id, ts as time, {r('case when value <= 300 then value end')} as humidity from events
union all select event_id, ts, {r('value + 1')} from events""")
def _(d):
    good, _bad = json_records.parse_documents(_documents(d, True), ["humidity"], ids=["event_id"])
    return good.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("json_export", f"""
with {READINGS} select '{{"device_id": "' || device_id || '", "time": "' || strftime(time, '%Y-%m-%dT%H:%M:%S') || '", "k": ' ||
  case when temperature > 90 then '"Infinity"' when temperature < 5 then 'null' else cast(cast(temperature as integer) as varchar) || '.0' end || '}}' as feature
from readings""")
def _(d):
    t = F.col("temperature")
    k = F.when(t > 90, float("inf")).when(t < 5, float("nan")).otherwise(t)
    return file_sinks.to_json_rows(d.readings.select("device_id", "time", k.alias("k")))


@query("request_documents", """
select event_id, '{"features": [{"time": "' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00", "mean": ' || cast(value as varchar) || '}]}' as features_json
from events where value <= 250""")
def _(d):
    answers, _rejects = requests.answer_documents(_documents(d, False), "humidity", ["mean"], "h", ids=["event_id"])
    return answers


# --- requests: one feature each ----------------------------------------------

for _name, _request in requests.REQUESTS.items():
    _feature = {"percent_above_q3": "share_above_q3"}.get(_name.removeprefix("calculate_"), _name.removeprefix("calculate_"))
    if _feature in Q and _feature != "range":
        QUERY_SQL = agg_sql(SHIPMENTS, "shipments", "quantity", "cast(date_trunc('month', time) as timestamp)", [_feature])
    elif _feature == "share_above_q3":
        QUERY_SQL = ORACLES["stat_share_above_q3"].replace("price as v", "quantity as v")
    else:
        QUERY_SQL = f"""
with {SHIPMENTS}, b as (select device_id, cast(date_trunc('month', time) as timestamp) as time, max(quantity) - min(quantity) as rg from shipments group by 1, 2),
g as (select *, lag(rg) over (partition by device_id order by time) as pr from b)
select device_id, time, {r('rg')} as range, {r('case when pr is null or (pr = 0 and rg = 0) then 0 else rg / pr - 1 end')} as range_rate from g"""

    @query(f"request_{_name}", QUERY_SQL)
    def _(d, _request=_request):
        return _request(d.shipments, "quantity", "MS")


@query("request_batch", agg_sql(
    SHIPMENTS, "shipments", "price", "cast(date_trunc('month', time) as timestamp)", ["mean", "median", "std", "p10"]))
def _(d):
    out = requests.feature_request(d.shipments, "price", ["均值", "中位数", "标准差", "P10"], "MS")
    return out.toDF("device_id", "time", "mean", "median", "std", "p10")


# --- vapor pressure ----------------------------------------------------------

VP = "(humidity / 100.0) * (6.112 * exp((17.67 * temperature) / (temperature + 243.5)))"
GRADIENT = INOUT + f""", g as (select i.time, {VP} as vi, o.avg_vapor_pressure * 10 as vo from inside i join outside o on i.time = o.time),
gr as (select time, vi, vo, vo - vi as dv, case when vo - vi > 0.1 then '向内' when vo - vi < -0.1 then '向外' when abs(vo - vi) <= 0.1 then '平衡' end as dir from g)"""


@query("vapor_pressure", f"with {READINGS} select device_id, time, {r(VP)} as vp from readings")
def _(d):
    return d.readings.select("device_id", "time", physics.vapor_pressure(F.col("temperature"), F.col("humidity")).alias("vp"))


@query("vp_gradient", f"""
with {GRADIENT} select time, {r('vi')} as VP_in, {r('vo')} as VP_out, {r('dv')} as delta_VP, dir as diffusion_direction from gr""")
def _(d):
    return risk.vapor_pressure_gradient(d.inside, d.outside)


@query("vp_gradient_all_devices", f"""
with {INOUT}, every as (select device_id, {HOUR} as time, avg(temperature) as temperature, avg(humidity) as humidity from readings group by 1, 2),
g as (select e.device_id, e.time, {VP} as vi, o.avg_vapor_pressure * 10 as vo from every e join outside o on e.time = o.time)
select device_id, time, {r('vi')} as VP_in, {r('vo')} as VP_out, {r('vo - vi')} as delta_VP,
  case when vo - vi > 0.1 then '向内' when vo - vi < -0.1 then '向外' when abs(vo - vi) <= 0.1 then '平衡' end as diffusion_direction from g""")
def _(d):
    every = stats.resample(d.readings.select("device_id", "time", "temperature", "humidity"), "h", None, ["device_id"], fill=False)
    return risk.vapor_pressure_gradient(every, d.outside, carry=["device_id"])


@query("vp_distribution", f"""
with {GRADIENT} select dir as diffusion_direction, count(*) as n_rows, {r('count(*) / (select count(*) from gr)')} as share
from gr where dir is not null group by 1""")
def _(d):
    return report.value_distribution(risk.vapor_pressure_gradient(d.inside, d.outside), "diffusion_direction")


@query("vp_inward_share", f"""
with {GRADIENT} select count(*) as n_rows, {r("count(*) filter (dir = '向内') / count(*)")} as inward_share from gr""")
def _(d):
    return risk.inward_share(risk.vapor_pressure_gradient(d.inside, d.outside))


# --- exposure and rainfall ---------------------------------------------------

EXPOSURE = READINGS + f""", er as (
  select device_id, {DAY} as day, time, humidity > 60 as high,
    row_number() over (partition by device_id, {DAY} order by time) as rn,
    sum(case when humidity > 60 then 0 else 1 end) over (partition by device_id, {DAY} order by time) as run from readings),
eruns as (select device_id, day, run, count(*) filter (high) as len from er group by 1, 2, 3),
ebest as (select device_id, day, max(len) as best, count(*) filter (len > 0) as episodes from eruns group by 1, 2),
etot as (select device_id, day, count(*) as n, count(*) filter (high) as hi,
  case when count(*) > 1 then (max(epoch_us(time)) filter (rn = 2) - max(epoch_us(time)) filter (rn = 1)) / 3600000000.0 else 1.0 end as step
  from er group by 1, 2),
exposure as (select t.device_id, t.day as time, hi * step as total_exposure_hours, best * step as max_continuous_hours,
  episodes as exposure_episodes, hi / n as exposure_ratio from etot t join ebest b on t.device_id = b.device_id and t.day = b.day)"""


def rain_sql(window_us: int, bucket: str) -> str:
    return f""", rain as (select device_id, time, case when humidity > 50 then humidity else 0 end as rainfall from readings),
rr as (select device_id, {bucket} as bucket, time, rainfall, row_number() over (partition by device_id, {bucket} order by time) as rn,
  sum(rainfall) over (partition by device_id order by time range between interval {window_us - 1} microseconds preceding and current row) as rolled from rain),
rainfall as (select device_id, bucket as time, max(rolled) as rainfall_peak, coalesce(avg(rolled) filter (rolled > 0), 0) as rainfall_mean,
  sum(rainfall) as rainfall_total, count(*) filter (rainfall > 0) * case when count(*) > 1
    then (max(epoch_us(time)) filter (rn = 2) - max(epoch_us(time)) filter (rn = 1)) / 3600000000.0 else 1.0 end as rainfall_hours
  from rr group by 1, 2)"""


EXPOSURE_COLS = ("total_exposure_hours", "max_continuous_hours", "exposure_ratio")
RAIN_COLS = ("rainfall_peak", "rainfall_mean", "rainfall_total", "rainfall_hours")


def _exposure(d: Inputs) -> DataFrame:
    return risk.humidity_exposure(d.readings, "humidity", 60.0, "D")


@query("exposure_daily", f"""
with {EXPOSURE} select device_id, time, {', '.join(f'{r(c)} as {c}' for c in EXPOSURE_COLS)}, exposure_episodes from exposure""")
def _(d):
    return _exposure(d)


@query("exposure_kpis", f"""
with {EXPOSURE} select device_id, {r('avg(total_exposure_hours)')} as mean_exposure_hours, {r('max(total_exposure_hours)')} as max_exposure_hours,
  count(*) filter (exposure_ratio > 0.5) as high_risk_periods from exposure group by 1""")
def _(d):
    return report.exposure_kpis(_exposure(d), ["device_id"])


@query("rolling_sum_1h", f"""
with {HOLES} select device_id, time, {r('sum(humidity) over (partition by device_id order by time range between interval 3599999999 microseconds preceding and current row)')} as rolling_sum from holes""")
def _(d):
    return risk.rolling_sum(d.holes.select("device_id", "time", "humidity"), "humidity", "1h").drop("humidity")


@query("rainfall_6h", f"""
with {READINGS}{rain_sql(3_600_000_000, "time_bucket(interval 6 hours, time)")}
select device_id, time, {', '.join(f'{r(c)} as {c}' for c in RAIN_COLS)} from rainfall""")
def _(d):
    return risk.rainfall_intensity(d.rain)


@query("rainfall_daily", f"""
with {READINGS}{rain_sql(600_000_000, DAY)} select device_id, time, {', '.join(f'{r(c)} as {c}' for c in RAIN_COLS)} from rainfall""")
def _(d):
    return risk.rainfall_intensity(d.rain, "rainfall", "10min", "D")


@query("rainfall_kpis", f"""
with {READINGS}{rain_sql(600_000_000, DAY)} select device_id, {r('sum(rainfall_total)')} as total_rainfall, {r('avg(rainfall_total)')} as mean_rainfall,
  {r('max(rainfall_peak)')} as max_peak from rainfall group by 1""")
def _(d):
    return report.rainfall_kpis(risk.rainfall_intensity(d.rain, "rainfall", "10min", "D"), ["device_id"])


@query("correlation_exposure_rain", f"""
with {EXPOSURE}{rain_sql(3_600_000_000, DAY)},
j as (select e.device_id, e.total_exposure_hours as x, f.rainfall_peak as y from exposure e join rainfall f on e.device_id = f.device_id and e.time = f.time),
s as (select device_id, count(*) as n, {corr_sql('x', 'y')} as c, regr_slope(y, x) as sl, regr_intercept(y, x) as ic from j group by 1)
select device_id, {r('c')} as correlation, {r('sl')} as slope, {r('ic')} as intercept, {r('c * c')} as r_squared, n as n_samples from s""")
def _(d):
    rain = risk.rainfall_intensity(d.rain, "rainfall", "1h", "D")
    return risk.correlate(_exposure(d), rain, on=["device_id", "time"], keys=["device_id"], p_value=False)


# The density of r under independence is proportional to (1 - r^2)^((n - 4) / 2): Simpson's rule, both tails over the whole.
P_VALUE = """(select sum(case when k in (0, 2000) then 1 when k % 2 = 1 then 4 else 2 end * pow(1 - pow(abs(c) + (1 - abs(c)) * k / 2000.0, 2), (n - 4) / 2.0)) * (1 - abs(c))
  / sum(case when k in (0, 2000) then 1 when k % 2 = 1 then 4 else 2 end * pow(1 - pow(k / 2000.0, 2), (n - 4) / 2.0)) from range(0, 2001) x(k))"""


@query("correlation_p_value", f"""
with {EXPOSURE}{rain_sql(3_600_000_000, DAY)},
j as (select e.device_id, e.total_exposure_hours as x, f.rainfall_peak as y from exposure e join rainfall f on e.device_id = f.device_id and e.time = f.time),
s as (select device_id, count(*) as n, {corr_sql('x', 'y')} as c, regr_slope(y, x) as sl, regr_intercept(y, x) as ic from j group by 1)
select device_id, {r('c')} as correlation, {r(P_VALUE)} as p_value, {r('sl')} as slope, {r('ic')} as intercept, {r('c * c')} as r_squared, n as n_samples from s""")
def _(d):
    rain = risk.rainfall_intensity(d.rain, "rainfall", "1h", "D")
    return risk.correlate(_exposure(d), rain, on=["device_id", "time"], keys=["device_id"])


# --- sequences ---------------------------------------------------------------


@query("stable_period", f"""
with {READINGS}, v as (select device_id, {DAY} as time, stddev_samp(humidity) as sd from readings group by 1, 2),
x as (select *, sum(case when sd < 52 then 0 else 1 end) over (partition by device_id order by time) as run from v where sd is not null),
runs as (select device_id, run, cast(min(time) as date) as start_date, cast(max(time) as date) as end_date, count(*) as length from x where sd < 52 group by 1, 2),
best as (select *, row_number() over (partition by device_id order by length desc, start_date) as k from runs)
select d.device_id, b.start_date, b.end_date, coalesce(b.length, 0) as length from (select distinct device_id from x) d
left join best b on b.device_id = d.device_id and b.k = 1""")
def _(d):
    return sequence.stable_periods(stats.volatility_features(d.readings, "humidity", ["std"], "D"), 52.0)


@query("acf_lags", f"""
with {READINGS}, s as (select device_id, humidity as v, row_number() over (partition by device_id order by time) as rn from readings),
p as (select a.device_id, a.rn - b.rn as lag, a.v as x, b.v as y from s a join s b on a.device_id = b.device_id and a.rn - b.rn between 1 and 24),
c as (select device_id, lag, {corr_sql('x', 'y')} as ac from p group by 1, 2)
select device_id, lag, {r('ac')} as autocorrelation from c
union all select distinct device_id, 0, 1.0 from readings""")
def _(d):
    return sequence.autocorrelation(d.readings, "humidity", 24)


@query("acf_all_lags", f"""
with {READINGS}, s as (select device_id, humidity as v, row_number() over (partition by device_id order by time) as rn from readings),
p as (select a.device_id, a.rn - b.rn as lag, a.v as x, b.v as y from s a join s b on a.device_id = b.device_id and a.rn > b.rn),
c as (select device_id, lag, {corr_sql('x', 'y')} as ac from p group by 1, 2),
e as (select device_id, min(lag) as stop from c where ac is null group by 1)
select c.device_id, lag, round(ac, 6) as autocorrelation from c left join e on c.device_id = e.device_id where stop is null or lag < stop
union all select device_id, 0, 1.0 from s group by 1 having count(*) >= 2""")
def _(d):
    out = sequence.autocorrelation(d.readings, "humidity")
    return out.withColumn("autocorrelation", F.round("autocorrelation", 6))


@query("first_difference", f"""
with {READINGS}, x as (select device_id, time, humidity - lag(humidity) over (partition by device_id order by time) as diff from readings)
select device_id, time, {r('diff')} as diff from x where diff is not null""")
def _(d):
    return sequence.first_difference(d.readings.select("device_id", "time", "humidity"), "humidity").drop("humidity")


@query("percent_change", f"""
with {HOURLY}, x as (select device_id, time, mean, lag(mean) over (partition by device_id order by time) as p from hourly)
select device_id, time, {r('mean')} as mean, {r('case when p is null or (p = 0 and mean = 0) then 0 else mean / p - 1 end')} as change from x""")
def _(d):
    return stats.with_percent_change(d.hourly, ["device_id"], "mean", "change")


@query("row_positions", f"""
with {READINGS} select device_id, time, row_number() over (partition by device_id order by time) - 1 as row_index from readings""")
def _(d):
    return slices.row_index(d.readings.select("device_id", "time"), ["device_id"])


DETREND = """ix as (select device_id, time, mean as v, row_number() over (partition by device_id order by time) - 1 as i from hourly),
fit as (select device_id, regr_slope(v, i) as sl, avg(v) as mu, avg(i) as ci, count(*) as n from ix group by 1),
dt as (select ix.device_id, time, i, n, v - mu - sl * (i - ci) as x from ix join fit on ix.device_id = fit.device_id)"""


@query("detrend", f"with {HOURLY}, {DETREND} select device_id, time, i as row_index, {r('x')} as detrended from dt")
def _(d):
    return sequence.detrend(d.hourly, "mean").drop("mean")


SPECTRUM = DETREND + """, ks as (select device_id, n, unnest(range(0, n // 2)) as k from fit),
sp as (select ks.device_id, k, ks.n, 2.0 / ks.n * sqrt(power(sum(x * cos(2 * pi() * ((k * i) % ks.n) / ks.n)), 2) + power(sum(x * sin(2 * pi() * ((k * i) % ks.n) / ks.n)), 2)) as amp
  from ks join dt on ks.device_id = dt.device_id group by 1, 2, 3),
st as (select device_id, (max(epoch_us(time)) filter (i = 1) - max(epoch_us(time)) filter (i = 0)) / 3600000000.0 as step from ix group by 1),
spectrum as (select sp.device_id, k, case when k > 0 then n * step / k else cast('infinity' as double) end as period_hours, amp as amplitude
  from sp join st on st.device_id = sp.device_id)"""


@query("spectrum_dft", f"with {HOURLY}, {SPECTRUM} select device_id, k, {r('period_hours')} as period_hours, {r('amplitude')} as amplitude from spectrum")
def _(d):
    return spectral.amplitude_spectrum(d.hourly, "mean")


@query("spectrum_long_series", ORACLES["spectrum_dft"])
def _(d):
    # the plan for series that do not fit one task, forced by a low limit
    return spectral.amplitude_spectrum(d.hourly, "mean", one_task_points=100)


@query("main_periods", f"""
with {HOURLY}, {SPECTRUM}, rk as (select *, row_number() over (partition by device_id order by amplitude desc, k) as p from spectrum),
t as (select device_id, max(time) as time from hourly group by 1), top as (select rk.*, t.time from rk join t on rk.device_id = t.device_id where p <= 3)
select device_id, time, 'main_period_' || p || '_hours' as feature_key, {r('period_hours')} as value from top
union all select device_id, time, 'main_period_' || p || '_strength', {r('amplitude')} from top""")
def _(d):
    return spectral.main_periods(d.hourly, "mean", 3)


@query("interpolate_gap_limited", f"""
with {GAPPY}, m as (select device_id, strftime(time, '%Y%m') as mo, time_bucket(interval 10 minutes, time) as time, avg(humidity) as v from gappy group by 1, 2, 3),
span as (select device_id, mo, min(time) lo, max(time) hi from m group by 1, 2),
spine as (select device_id, mo, unnest(generate_series(lo, hi, interval 10 minutes)) as time from span),
g as (select s.device_id, s.mo, s.time, m.v, case when m.v is not null then s.time end as kt from spine s
  left join m on m.device_id = s.device_id and m.mo = s.mo and m.time = s.time),
w as (select *, last_value(kt ignore nulls) over p as t0, last_value(v ignore nulls) over p as v0,
  first_value(kt ignore nulls) over f as t1, first_value(v ignore nulls) over f as v1 from g
  window p as (partition by device_id, mo order by time rows between unbounded preceding and current row),
         f as (partition by device_id, mo order by time rows between current row and unbounded following))
select device_id, time, {r('case when v is not null then v when epoch_us(t1) - epoch_us(t0) <= 7200000000 then v0 + (v1 - v0) * (epoch_us(time) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0)) end')} as humidity from w""")
def _(d):
    return interpolate.resample_and_interpolate(d.gappy.select("device_id", "time", "humidity"), "10min", 2.0)


@query("interpolation_job", f"""
with {READINGS}, m as (select temple_id, device_id, strftime(time + interval 8 hours, '%Y%m') as mo, date_trunc('minute', time) as time, avg(humidity) as v, avg(temperature) as t from readings group by 1, 2, 3, 4),
n as (select *, lead(time) over w as t1, lead(v) over w as v1, lead(t) over w as u1 from m window w as (partition by temple_id, device_id, mo order by time)),
e as (select *, unnest(generate_series(time, coalesce(t1 - interval 1 minute, time), interval 1 minute)) as tick from n)
select tick as time, {r('case when tick = time then v when epoch_us(t1) - epoch_us(time) <= 7200000000 then v + (v1 - v) * (epoch_us(tick) - epoch_us(time)) / (epoch_us(t1) - epoch_us(time)) end')} as humidity,
  {r('case when tick = time then t when epoch_us(t1) - epoch_us(time) <= 7200000000 then t + (u1 - t) * (epoch_us(tick) - epoch_us(time)) / (epoch_us(t1) - epoch_us(time)) end')} as temperature,
  device_id, temple_id from e""")
def _(d):
    return interpolation.interpolated_readings(d.readings)


# --- joins and merges --------------------------------------------------------


@query("merge_outer", f"""
with {INOUT} select coalesce(i.time, o.time) as time, {r('i.temperature')} as temperature, {r('i.humidity')} as humidity, {r('o.avg_vapor_pressure')} as avg_vapor_pressure
from inside i full join outside o on i.time = o.time""")
def _(d):
    return merge.merge_on_time([d.inside, d.outside.withColumn("humidity", F.lit(-1.0))], "time", "outer")


@query("merge_five_sources", f"""
with {READINGS}, h as (select device_id, {HOUR} as time, avg(humidity) as v from readings group by 1, 2)
select time, {", ".join(r(f"max(case when device_id = '{t}' then v end)") + f" as {t}" for t in EVENT_TYPES)} from h group by time""")
def _(d):
    hourly = stats.resample(d.readings.select("device_id", "time", "humidity"), "h", keys=["device_id"], fill=False)
    return merge.merge_on_time([hourly.filter(F.col("device_id") == t).select("time", F.col("humidity").alias(t)) for t in EVENT_TYPES], "time", "outer")


@query("merge_inner", f"""
with {INOUT}, e as (select {HOUR} as time, max(humidity) as top from readings group by 1)
select i.time, {r('i.temperature')} as temperature, {r('i.humidity')} as humidity, {r('o.avg_vapor_pressure')} as avg_vapor_pressure, {r('e.top')} as top
from inside i join outside o on i.time = o.time join e on e.time = i.time""")
def _(d):
    tops = d.readings.select("time", F.col("humidity").alias("top"))
    return merge.merge_on_time([d.inside, d.outside, stats.resample(tops, "h", {"top": "max"}, fill=False)], "time", "inner")


@query("intersect_times", f"""
with {INOUT} select time from inside intersect select time from outside""")
def _(d):
    return reshape.common_times(d.inside, d.outside)


@query("benchmark_compare", f"""
with {READINGS}, a as (select device_id, {HOUR} as time, avg(humidity) as new_value, median(humidity) as old_value from readings group by 1, 2)
select device_id, time, {r('new_value')} as new_value, {r('old_value')} as old_value, abs(new_value - old_value) <= 0.01 + 0.05 * abs(old_value) as within_tolerance
from a""")
def _(d):
    old = stats.statistical_features(d.readings, "humidity", ["median"], "h", fill=False).withColumnRenamed("median", "mean")
    return reshape.compare_to_benchmark(d.hourly, old, "mean", ["device_id", "time"])


SOURCES = [
    {"database": "raw", "table": "inside", "fields": ["temple_id", "device_id", "time", "humidity"],
     "agg_method": {"temple_id": "first", "device_id": "first", "humidity": "mean"}, "use_device_id": True, "use_temple_id": False},
    {"database": "raw", "table": "station", "fields": ["`rain(10min)`", "temperature"], "use_temple_id": False, "use_device_id": False,
     "agg_method": {"rain(10min)": "sum", "temperature": "mean"}, "add_source_label": True},
]
FETCH_SQL = f"""
with {READINGS}, raw as (select * from readings where time between timestamp '2024-01-02' and timestamp '2024-01-29'),
a as (select time_bucket(interval 30 minutes, time) as time, arg_min(temple_id, time) as temple_id, arg_min(device_id, time) as device_id, {r('avg(humidity)')} as humidity from raw where device_id = 'click' group by 1),
sa as (select unnest(generate_series(min(time), max(time), interval 30 minutes)) as time from a),
fa as (select sa.time, a.temple_id, a.device_id, a.humidity from sa left join a on a.time = sa.time),
b as (select time_bucket(interval 30 minutes, time) as time, {r('sum(humidity)')} as rain, {r('avg(temperature)')} as temperature from raw group by 1),
sb as (select unnest(generate_series(min(time), max(time), interval 30 minutes)) as time from b),
fb as (select sb.time, coalesce(b.rain, 0) as rain, b.temperature from sb left join b on b.time = sb.time)
select coalesce(fa.time, fb.time) as time, temple_id, device_id, humidity, rain as "rain(10min)", temperature,
  case when fb.time is not null then 'raw.station' end as data_source from fa full join fb on fa.time = fb.time"""


def _lookup(d: Inputs):
    station = d.readings.select("time", F.col("humidity").alias("rain(10min)"), "temperature")
    return lambda database, table: {"inside": d.readings, "station": station}[table]


@query("multi_table_fetch", FETCH_SQL)
def _(d):
    return fetch.fetch(SOURCES, "2024-01-02", "2024-01-29", device_id="click", freq="30min", lookup=_lookup(d))


@query("fetch_job", FETCH_SQL)
def _(d):
    config = {"data_sources": SOURCES, "default_resample": "30min", "merge_how": "outer"}
    return fetch.fetch_from_config(d.spark, config, "2024-01-02", "2024-01-29", device_id="click", lookup=_lookup(d))


@query("fetch_per_device", f"""
with {READINGS}, a as (select device_id, {HOUR} as time, {r('avg(humidity)')} as humidity from readings group by 1, 2),
b as (select {HOUR} as time, {r('avg(temperature)')} as temperature from readings group by 1),
sa as (select device_id, unnest(generate_series(min(time), max(time), interval 1 hour)) as time from a group by 1),
sb as (select unnest(generate_series(min(time), max(time), interval 1 hour)) as time from b)
select sa.device_id, sa.time, a.humidity, b.temperature from sa left join a on a.device_id = sa.device_id and a.time = sa.time
left join sb on sb.time = sa.time left join b on b.time = sb.time""")
def _(d):
    sources = [
        {"database": "raw", "table": "readings", "fields": ["device_id", "humidity"], "agg_method": {"humidity": "mean"}},
        {"database": "raw", "table": "station", "fields": ["temperature"], "agg_method": {"temperature": "mean"}},
    ]
    source = {"readings": d.readings, "station": d.readings.select("time", "temperature")}
    return fetch.fetch(sources, freq="h", how="left", keys=["device_id"], lookup=lambda _db, t: source[t])


# --- reshaping, facts, reports -----------------------------------------------

LONG = f"""with {READINGS}, w as (select device_id, {DAY} as time, avg(humidity) as mean, max(humidity) as mx from readings group by 1, 2),
long as (select device_id, time, 'mean' as feature_key, {r('mean')} as value, 'D' as stats_cycle from w
union all select device_id, time, 'max', {r('mx')}, 'D' from w)"""


def _daily_long(d: Inputs) -> DataFrame:
    return reshape.to_long(stats.statistical_features(d.readings, "humidity", ["mean", "max"], "D"), cycle="D")


@query("features_long", LONG + " select * from long")
def _(d):
    return _daily_long(d)


@query("features_wide_pivot", f"""
with {READINGS} select device_id, {DAY} as stats_start_time, {r('avg(humidity)')} as mean, {r('max(humidity)')} as max from readings group by 1, 2""")
def _(d):
    long = rounded(_daily_long(d)).withColumnsRenamed({"time": "stats_start_time", "value": "feature_value"})
    long = long.withColumn("monitored_variable", F.lit("humidity"))
    return reshape.to_wide(long, "humidity", ["mean", "max"], ["device_id", "stats_start_time"])


@query("feature_fact_load", f"""
with {READINGS}, n as (select device_id, {DAY} as time, count(*) as n, arg_min(temple_id, time) as temple_id from readings group by 1, 2)
select temple_id, device_id, time as stats_start_time, 'humidity' as monitored_variable, 'D' as stats_cycle, 'n' as feature_key,
  cast(n as varchar) as feature_value, timestamp '2026-01-01' as created_at from n""")
def _(d):
    rows = stats.resample(d.readings.select("device_id", "time", "temple_id", F.lit(1.0).alias("n")), "D",
                          {"temple_id": "first", "n": "sum"}, ["device_id"], fill=False)
    long = rows.select("temple_id", "device_id", "time", F.lit("humidity").alias("field_name"), F.lit("D").alias("stats_cycle"),
                       F.lit("n").alias("feature_key"), F.col("n").cast("long").alias("value"))
    return facts.to_facts(long, created_at=F.lit("2026-01-01").cast("timestamp_ntz"))


@query("train_test_split", f"""
with {ORDERS}, s as (select device_id, time, avg(price) as value from o group by 1, 2)
select 'train' as part, device_id, time, {r('value')} as value from s where time <= timestamp '1999-06-01'
union all select 'test', device_id, time, {r('value')} from s where time >= timestamp '1999-06-01'""")
def _(d):
    train, test = reshape.split_by_date(forecast.daily_mean(d.orders, "price"), F.lit("1999-06-01").cast("timestamp_ntz"))
    parts = [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    return reshape.union_by_name(parts)


NAIVE = f"""with {ORDERS}, s as (select device_id, time, avg(price) as value from o group by 1, 2),
f as (select device_id, time, value as actual, date_diff('day', timestamp '2001-03-01', time) as h from s where time > timestamp '2001-03-01'),
fc as (select f.device_id, f.time, actual, p.value as forecast from f left join s p on p.device_id = f.device_id
  and p.time = f.time - to_days(cast(ceil(h / 7.0) * 7 as integer)) and p.time <= timestamp '2001-03-01')"""


@query("forecast_seasonal_naive", NAIVE + f" select device_id, time, {r('actual')} as actual, {r('forecast')} as forecast from fc")
def _(d):
    return forecast.seasonal_naive(forecast.daily_mean(d.orders, "price"), "2001-03-01")


@query("forecast_errors", NAIVE + f""" select device_id, count(actual - forecast) as n_days, {r('avg(abs(actual - forecast))')} as mae,
  {r('sqrt(avg((actual - forecast) * (actual - forecast)))')} as rmse from fc group by 1""")
def _(d):
    return forecast.forecast_errors(forecast.seasonal_naive(forecast.daily_mean(d.orders, "price"), "2001-03-01"))


# Normal equations by sums of products, elimination and forecast as recursive steps over one list per device.
AR_SUMS = ", ".join(f"sum({x} * {y})" for x in ("1", *(f"x{i}" for i in range(1, 6))) for y in ("1", *(f"x{i}" for i in range(1, 6)), "y"))


@query("forecast_autoregressive", f"""
with recursive {ORDERS}, s as (select device_id, cast(time as date) as day, avg(price) as v from o group by 1, 2),
train as (select * from s where day <= date '2001-03-01'),
df as (select x.device_id, x.day, x.v - y.v as d from train x join train y on x.device_id = y.device_id and x.day = y.day + 1),
p as (select a.device_id, a.d as y, b.d as x1, c.d as x2, e.d as x3, f.d as x4, g.d as x5 from df a
  join df b on b.device_id = a.device_id and b.day = a.day - 1 join df c on c.device_id = a.device_id and c.day = a.day - 2
  join df e on e.device_id = a.device_id and e.day = a.day - 3 join df f on f.device_id = a.device_id and f.day = a.day - 4
  join df g on g.device_id = a.device_id and g.day = a.day - 5),
el as (select device_id, 0 as k, [{AR_SUMS}] as m, count(*) as n from p group by 1 having count(*) >= 7
  union all select device_id, k + 1, list_transform(range(0, 42), lambda i: case
    when i // 7 = k then m[i + 1] / m[k * 8 + 1]
    else m[i + 1] - m[(i // 7) * 7 + k + 1] / m[k * 8 + 1] * m[k * 7 + i % 7 + 1] end), n from el where k < 6),
f as (select device_id, list_transform(range(0, 6), lambda i: m[i * 7 + 7]) as c, n from el where k = 6),
e as (select p.device_id, sqrt(sum(pow(y - c[1] - c[2] * x1 - c[3] * x2 - c[4] * x3 - c[5] * x4 - c[6] * x5, 2)) / (any_value(n) - 6)) as sigma
  from p join f on p.device_id = f.device_id group by 1),
l as (select device_id, max(day) as last_day, arg_max(v, day) as last_v from train group by 1),
g as (select device_id, avg(d) as d from df group by 1),
b as (select l.device_id, i, coalesce(df.d, g.d) as d from l cross join range(0, 5) t(i) join g on g.device_id = l.device_id
  left join df on df.device_id = l.device_id and df.day = l.last_day - cast(i as integer)),
path as (select f.device_id, 0 as h, f.c, e.sigma, l.last_day, l.last_v as level, (select list(b.d order by i) from b where b.device_id = f.device_id) as x,
    [1.0::double, 0, 0, 0, 0] as r, 0.0::double as response, 0.0::double as variance
    from f join e on e.device_id = f.device_id join l on l.device_id = f.device_id
  union all select device_id, h + 1, c, sigma, last_day, level + c[1] + list_dot_product(c[2:6], x),
    [c[1] + list_dot_product(c[2:6], x), x[1], x[2], x[3], x[4]], [list_dot_product(c[2:6], r), r[1], r[2], r[3], r[4]],
    response + r[1], variance + pow(response + r[1], 2) from path where h < 400)
select s.device_id, cast(s.day as timestamp) as time, {r('s.v')} as actual, {r('round(level, 3)')} as forecast,
  {r('round(level - 1.959963984540054 * sigma * sqrt(variance), 3)')} as lower, {r('round(level + 1.959963984540054 * sigma * sqrt(variance), 3)')} as upper
from s left join path on path.device_id = s.device_id and s.day = last_day + cast(h as integer) where s.day > date '2001-03-01'""")
def _(d):
    out = forecast.autoregressive(forecast.daily_mean(d.orders, "price"), "2001-03-01")
    return out.withColumns({c: F.round(c, 3) for c in ("forecast", "lower", "upper")})


# Order 1 in closed form: d[t] = a + b d[t-1], so the h-th change is m + b^h (d - m) with m = a / (1 - b).
@query("forecast_ar_first_order", f"""
with {ORDERS}, s as (select device_id, cast(time as date) as day, avg(price) as v from o group by 1, 2),
train as (select * from s where day <= date '2001-03-01'),
df as (select x.device_id, x.day, x.v - y.v as d from train x join train y on x.device_id = y.device_id and x.day = y.day + 1),
p as (select x.device_id, x.d as y, y.d as x from df x join df y on x.device_id = y.device_id and x.day = y.day + 1),
f as (select device_id, regr_slope(y, x) as b, regr_intercept(y, x) as a, count(*) as n from p group by 1),
e as (select p.device_id, sqrt(sum(pow(y - a - b * x, 2)) / greatest(any_value(n) - 2, 1)) as sigma from p join f on p.device_id = f.device_id group by 1),
l as (select device_id, max(day) as last_day, arg_max(v, day) as last_v from train group by 1),
m as (select l.*, f.a, f.b, f.n, e.sigma, coalesce(df.d, g.d) as d from l join f on l.device_id = f.device_id join e on l.device_id = e.device_id
  join (select device_id, avg(d) as d from df group by 1) g on l.device_id = g.device_id left join df on df.device_id = l.device_id and df.day = l.last_day),
h as (select s.device_id, s.day, s.v, date_diff('day', m.last_day, s.day) as h, m.* exclude (device_id) from s join m on s.device_id = m.device_id where s.day > date '2001-03-01'),
w as (select *, last_v + h * a / (1 - b) + (d - a / (1 - b)) * b * (1 - pow(b, h)) / (1 - b) as fc,
  1.959963984540054 * sigma * sqrt(list_sum(list_transform(range(1, h + 1), lambda j: pow((1 - pow(b, j)) / (1 - b), 2)))) as width from h)
select device_id, cast(day as timestamp) as time, {r('v')} as actual, {r('case when n >= 3 then round(fc, 3) end')} as forecast,
  {r('case when n >= 3 then round(fc - width, 3) end')} as lower, {r('case when n >= 3 then round(fc + width, 3) end')} as upper from w""")
def _(d):
    out = forecast.autoregressive(forecast.daily_mean(d.orders, "price"), "2001-03-01", order=1)
    return out.withColumns({c: F.round(c, 3) for c in ("forecast", "lower", "upper")})  # sums of hundreds of steps


def describe_sql(source: str, columns) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count({c}) as count, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std, {r(f'min({c})')} as min, "
        f"{r(f'quantile_cont({c}, 0.25)')} as q1, {r(f'median({c})')} as median, {r(f'quantile_cont({c}, 0.75)')} as q3, {r(f'max({c})')} as max from {source}"
        for c in columns)


@query("describe_features", f"with {EXPOSURE} " + describe_sql("exposure", [*EXPOSURE_COLS, "exposure_episodes"]))
def _(d):
    return report.describe(_exposure(d))


@query("describe_table", describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def _(d):
    return report.describe(d.table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("extent_per_device", f"with {READINGS} select device_id, count(*) as n_rows, min(time) as first_time, max(time) as last_time from readings group by 1")
def _(d):
    return report.extent(d.readings, keys=["device_id"])


# --- jobs --------------------------------------------------------------------


def _catalog() -> dict:
    catalog = {k: dict(m) for k, m in metrics.CATALOG.items()}
    for m in catalog.values():
        m["data_field"] = "humidity" if m["data_field"] == "空气湿度（%）" else "temperature"
    return catalog


@query("metric_catalog_run", f"""
with {READINGS} select device_id, {DAY} as time, {r('avg(temperature)')} as "均值", {r('max(temperature)')} as "最大值", {r('min(temperature)')} as "最小值",
  {r('max(temperature) - min(temperature)')} as "极差"
from readings where temple_id = '4' and time between timestamp '2024-01-02' and timestamp '2024-01-28' group by 1, 2""")
def _(d):
    intent = {"site_id": "4", "start_date": "2024-01-02", "end_date": "2024-01-28", "freq": None}
    out = metrics.run_metric(d.readings, "temperature_daily", intent, _catalog(), site="temple_id")
    return out.drop("极差的时间变化率").na.drop("all", subset=["均值"])


@query("intents_batch", f"""
with {READINGS}, a as (select device_id, {DAY} as time, avg(humidity) as v from readings group by 1, 2),
b as (select device_id, cast(date_trunc('week', time) + interval 6 days as timestamp) as time, avg(temperature) as v from readings where time >= timestamp '2024-01-10' group by 1, 2)
select device_id, time, '均值' as feature_key, {r('v')} as value, 'humidity_trend' as metric_id, 0 as intent from a
union all select device_id, time, '均值', {r('v')}, 'temperature_trend', 1 from b""")
def _(d):
    intents = [{"metric_id": "humidity_trend", "freq": "D"}, {"metric_id": "temperature_trend", "freq": "W", "start_date": "2024-01-10"}]
    return metrics.run_intents(d.readings, intents, _catalog(), site="temple_id")


@query("hourly_field_features", f"""
with {READINGS}, b as (select {HOUR} as time, humidity as v from readings where time >= timestamp '2024-01-02' and time < timestamp '2024-01-28')
select time, {r('avg(v)')} as mean, {r('median(v)')} as median from b group by 1""")
def _(d):
    pts = points.to_points(d.readings, "cave", ["humidity", "temperature"], ["device_id"])
    out = metrics.hourly_field_features(pts, "cave", "湿度", {"humidity": ["湿度", "RH"]}, ["mean", "median"], "2024-01-02", "2024-01-28")
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("etl_device_features", f"""
with {READINGS}, t as (select device_id, arg_min(temple_id, time) as temple_id from readings group by 1),
w as (select device_id, {DAY} as time, avg(humidity) as h, avg(temperature) as t, stddev_samp(humidity) as sd from readings group by 1, 2),
l as (select device_id, time, 'humidity' as field_name, 'D' as stats_cycle, '均值' as feature_key, {r('h')} as value from w
union all select device_id, time, 'temperature', 'D', '均值', {r('t')} from w
union all select device_id, time, 'humidity', '1d', '标准差', {r('sd')} from w where sd is not null)
select t.temple_id, l.* from l join t on t.device_id = l.device_id""")
def _(d):
    pipes = [*device_features.DEFAULT_PIPELINES, {"processor": "volatility", "fields": ["humidity", "absent"], "params": {"metrics": ["标准差"]}},
             {"processor": "unknown", "fields": ["humidity"]}]
    return device_features.device_features(d.readings, pipes)


@query("etl_risk_features", f"""
with {EXPOSURE}, t as (select device_id, arg_min(temple_id, time) as temple_id from readings group by 1)
select t.temple_id, e.device_id, e.time, 'humidity' as field_name, 'daily' as stats_cycle, k.feature_key,
  {r('case k.feature_key when $$total_exposure_hours$$ then total_exposure_hours when $$max_continuous_hours$$ then max_continuous_hours when $$exposure_episodes$$ then exposure_episodes else exposure_ratio end')} as value
from exposure e join t on t.device_id = e.device_id
cross join (values ('total_exposure_hours'), ('max_continuous_hours'), ('exposure_episodes'), ('exposure_ratio')) k(feature_key)""")
def _(d):
    pipes = [{"processor": "high_humidity_exposure", "fields": ["humidity"], "params": {"threshold": 60.0, "cycle_label": "daily"}}]
    return device_features.device_features(d.readings, pipes)


def _risk(d: Inputs) -> dict[str, DataFrame]:
    source = {"in": d.inside, "out": d.outside, "humidity": d.readings.drop("temperature"), "rain": d.rain}
    config = {
        "vapor_pressure_gradient": {"enabled": True, "cave_inside_file": "in", "cave_outside_file": "out"},
        "high_humidity_exposure": {"enabled": True, "data_file": "humidity", "threshold": 60.0, "freq": "D"},
        "rainfall_intensity": {"enabled": True, "data_file": "rain", "window": "1h", "freq": "6h"},
        "correlation_analysis": {"enabled": True},
    }
    return risk_job.risk_features(config, lambda name, _cfg: source[name], ["device_id"])


@query("risk_job_correlation", f"""
with {EXPOSURE}{rain_sql(3_600_000_000, "time_bucket(interval 6 hours, time)")},
j as (select e.total_exposure_hours as x, f.rainfall_peak as y from exposure e join rainfall f on e.device_id = f.device_id and e.time = f.time),
s as (select count(*) as n, {corr_sql('x', 'y')} as c, regr_slope(y, x) as sl, regr_intercept(y, x) as ic from j)
select {r('c')} as correlation, {r('sl')} as slope, {r('ic')} as intercept, {r('c * c')} as r_squared, n as n_samples from s""")
def _(d):
    return _risk(d)["correlation_analysis"].drop("p_value")


def summary_sql(feature: str, source: str, columns: str, values, kpis: dict[str, str]) -> str:
    """All lines of the summary of one result table."""
    head = f"select '{feature}' as feature"
    lines = [f"{head}, 'columns' as section, '' as item, 'columns' as metric, cast(null as double) as number, '{columns}' as text",
             f"{head}, 'extent', '', 'n_rows', count(*), null from {source}"]
    lines += [f"{head}, 'extent', '', '{m}_time', null, cast({f}(time) as varchar) from {source}" for m, f in (("first", "min"), ("last", "max"))]
    for c in values:
        spread = {"count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "max": f"max({c})",
                  "q1": f"quantile_cont({c}, 0.25)", "median": f"median({c})", "q3": f"quantile_cont({c}, 0.75)"}
        lines += [f"{head}, 'describe', '{c}', '{m}', {r(e)}, null from {source}" for m, e in spread.items()]
    lines += [f"{head}, 'kpi', '', '{m}', {r(e)}, null from {source}" for m, e in kpis.items()]
    return " union all ".join(lines)


@query("risk_job_summary", f"""
with {EXPOSURE}{rain_sql(3_600_000_000, "time_bucket(interval 6 hours, time)")}{GRADIENT[len(READINGS):]},
named as (select time, vi as VP_in, vo as VP_out, dv as delta_VP, dir from gr), shares as (select dir, count(*) as n from gr where dir is not null group by 1)
{summary_sql("vapor_pressure_gradient", "named", "time, VP_in, VP_out, delta_VP, diffusion_direction", ["VP_in", "VP_out", "delta_VP"],
             {"inward_share": "count(*) filter (dir = '向内') / count(*)"})}
union all select 'vapor_pressure_gradient', 'distribution', dir, 'n_rows', n, null from shares
union all select 'vapor_pressure_gradient', 'distribution', dir, 'share', {r("n / (select count(*) from gr)")}, null from shares
union all {summary_sql("high_humidity_exposure", "exposure", "device_id, time, total_exposure_hours, max_continuous_hours, exposure_episodes, exposure_ratio",
                       ["total_exposure_hours", "max_continuous_hours", "exposure_episodes", "exposure_ratio"],
                       {"mean_exposure_hours": "avg(total_exposure_hours)", "max_exposure_hours": "max(total_exposure_hours)",
                        "high_risk_periods": "count(*) filter (exposure_ratio > 0.5)"})}
union all {summary_sql("rainfall_intensity", "rainfall", "device_id, time, rainfall_peak, rainfall_mean, rainfall_total, rainfall_hours", RAIN_COLS,
                       {"total_rainfall": "sum(rainfall_total)", "mean_rainfall": "avg(rainfall_total)", "max_peak": "max(rainfall_peak)"})}""")
def _(d):
    results = _risk(d)
    del results["correlation_analysis"]  # checked by risk_job_correlation
    _, lines = risk_job.store_results(d.spark, results, d.folder("risk-job"))
    number = ~F.col("metric").isin("columns", "first_time", "last_time")
    return lines.select("feature", "section", "item", "metric", F.when(number, F.col("value").cast("double")).alias("number"),
                        F.when(~number, F.col("value")).alias("text"))


# --- sinks -------------------------------------------------------------------


@query("sink_month_partitions", f"""
with {ORDERS} select strftime(time, '%Y%m') as yyyymm, device_id, count(*) as n, {r('sum(price)')} as price from o
where time >= timestamp '1996-02-15' and time < timestamp '1999-03-10' group by 1, 2""")
def _(d):
    path = d.folder("orders-by-month")
    table_sinks.write_month_partitions(d.orders, path, order=["device_id", "time"])
    stored = d.spark.read.parquet(path).withColumn("yyyymm", F.col("yyyymm").cast("string"))
    part = tables.time_range(stored, "1996-02-15", "1999-03-10")
    return part.groupBy("yyyymm", "device_id").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("result_csv_bom", f"""
with {ORDERS} select 'by_priority' as result, device_id, 'true' as marked, count(*) as n, {r('sum(price)')} as price from o group by device_id""")
def _(d):
    path = d.folder("results")
    file_sinks.save_results({"by_priority": d.orders.select("device_id", "price", "time")}, path)
    marked = d.spark.read.format("binaryFile").load(f"{path}/by_priority").select(
        F.min(F.startswith(F.hex("content"), F.lit("EFBBBF"))).cast("string").alias("marked"))
    schema = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("time", T.TimestampNTZType())])
    rows = file_sources.read_csv_series(d.spark, f"{path}/by_priority", "time", schema=schema).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))
    return rows.crossJoin(F.broadcast(marked)).select(F.lit("by_priority").alias("result"), "device_id", "marked", "n", "price")  # one row


@query("merged_export", f"""
with {ORDERS} select '045_19920101_19990101' as folder, device_id, count(*) as n, {r('sum(price)')} as price from o group by device_id""")
def _(d):
    path = file_sinks.save_merged(d.orders, d.folder("merged"), "1992-01-01", "1999-01-01", temple_id="045")
    rows = d.spark.read.option("header", "true").schema("time timestamp_ntz, device_id string, price double").csv(path)
    return rows.groupBy(F.lit(path.rsplit("/", 1)[1]).alias("folder"), "device_id").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("sheet_folder_read", f"""
with {ORDERS} select cast(year(time) as varchar) as sheet, device_id, count(*) as n, count(case when price <= 200000 then 1 end) as priced,
  {r('sum(case when price <= 200000 then price end)')} as price from o where year(time) >= 1994 group by 1, 2""")
def _(d):
    path = d.folder("sheets")
    price = F.when(F.col("price") <= 200000, F.col("price"))
    whole = d.orders.select("time", "device_id", price.alias("price"))
    empty = whole.select(*[F.lit(None).cast(t).alias(c) for c, t in whole.dtypes])  # rows without any value are dropped
    sheets = whole.withColumn("sheet", F.year("time").cast("string")).unionByName(empty.withColumn("sheet", F.lit("1995")))
    sheets.unionByName(whole.withColumn("sheet", F.lit("说明"))).write.partitionBy("sheet").option("header", "true").csv(path)
    read = file_sources.year_sheets(file_sources.read_sheets(d.spark, path), (1994, None))
    price = F.col("price").cast("double")
    return read.groupBy("sheet", "device_id").agg(F.count(F.lit(1)).alias("n"), F.count(price).alias("priced"), F.sum(price).alias("price"))


@query("sheet_union_layouts", """
select o_orderdate as time, """ + r("o_totalprice") + """ as price, cast(null as double) as quantity from orders
union all select l_shipdate, """ + r("l_extendedprice") + """, """ + r("l_quantity") + """ from lineitem""")
def _(d):
    frames = []
    for name, rows in (("orders", d.orders.select("time", "price")), ("shipments", d.shipments.select("quantity", "price", "time"))):
        path = d.folder(f"union-{name}")
        rows.withColumn("sheet", F.lit("2024")).write.partitionBy("sheet").option("header", "true").csv(path)
        frames.append(file_sources.read_sheets(d.spark, path).drop("sheet", "_file"))
    both = reshape.union_by_name(frames)
    return both.select(F.col("time").cast("timestamp_ntz").alias("time"), *[F.col(c).cast("double").alias(c) for c in ("price", "quantity")])


@query("parquet_series_slice", f"""
with {ORDERS} select device_id, time, price from o where time between timestamp '1996-01-01' and timestamp '1997-12-31'""")
def _(d):
    path = d.folder("series")
    d.orders.withColumn("note", F.lit("x")).write.parquet(path)
    return file_sources.read_parquet_series(d.spark, path, "price", "1996-01-01", "1997-12-31")


@query("table_definitions", """
select * from (select 'order_key' as column_name, 'Int64' as kind, count(o_orderkey) as n from orders
union all select 'total_10min', 'Float64', count(o_totalprice) from orders
union all select 'status', 'String', count(o_orderstatus) from orders
union all select 'time', 'DateTime', count(o_orderdate) from orders)""")
def _(d):
    rows = d.table("orders").select(F.col("o_orderkey").alias("order (key)"), F.col("o_totalprice").alias("total(10min)"),
                                    F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("time"))
    kinds = table_sinks.column_definitions(rows)
    clean = names.sanitize_columns(rows)
    table = f"defined_{uuid.uuid4().hex}"
    table_sinks.create_table_if_missing(d.spark, f"default.{table}", clean.schema, by_month="time")
    table_sinks.append_by_name(clean, f"default.{table}")
    counts = d.spark.table(table).select(*[F.count(names.col(c)).alias(c) for c, _ in kinds])
    kind = F.coalesce(*[F.when(F.col("column_name") == c, F.lit(k)) for c, k in kinds])
    return counts.unpivot([], [names.quote(c) for c, _ in kinds], "column_name", "n").select("column_name", kind.alias("kind"), "n")


@query("catalog_export", f"""
with {ORDERS} select 'orders' as table_kind, device_id, true as defined, count(*) as n from o group by device_id""")
def _(d):
    table = f"catalog_{uuid.uuid4().hex}"
    table_sinks.store_table(d.orders, table, order=["device_id", "time"])
    listed = table_sinks.export_catalog(d.spark, ["default"]).filter(F.col("table") == table)
    defined = listed.select((F.col("ddl").contains("device_id STRING") & F.col("ddl").contains("price DOUBLE")).alias("defined"))
    counts = d.spark.table(table).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(defined)).select(F.lit("orders").alias("table_kind"), "device_id", "defined", "n")  # one row


@query("flatten_struct_names", f"""
with {SHIPMENTS} select device_id, {r('avg(price)')} as price_mean, {r('max(price)')} as price_max, {r('min(quantity)')} as quantity_min from shipments group by 1""")
def _(d):
    nested = d.shipments.groupBy("device_id").agg(
        F.struct(F.avg("price").alias("mean"), F.max("price").alias("max")).alias("price"), F.struct(F.min("quantity").alias("min")).alias("quantity"))
    return reshape.flatten_names(nested)


@query("hourly_preview", f"""
with {READINGS}, b as (select {HOUR} as time, temperature as v from readings)
select time, {r('max(v)')} as max, {r('median(v)')} as median from b group by 1 order by 1 limit 48""")
def _(d):
    pts = points.to_points(d.readings, "cave", ["humidity", "temperature"], ["device_id"])
    out = metrics.hourly_field_features(pts, "cave", "温度", {"temperature": ["温度"]}, ["max", "median"], preview=48)
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("reception_ingest", f"""
with {READINGS} select strftime(time, '%Y%m') as yyyymm, temple_id, count(*) as n, sum(cast(floor(humidity) as integer)) as headcount,
  count(distinct device_id) as kinds from readings group by 1, 2""")
def _(d):
    path, database = d.folder("reception"), f"visits_{uuid.uuid4().hex}"
    d.readings.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("采集时间"), F.floor("humidity").cast("int").alias("实时人数"),
                      F.col("device_id").alias("逗留时长"), F.col("temple_id").alias("洞窟号")).write.parquet(path)
    ingest.ingest_reception_stats(d.spark, path, database, fmt="parquet")
    return d.spark.table(f"{database}.temple_reception_stats").groupBy(F.col("yyyymm").cast("string").alias("yyyymm"), "temple_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("real_time_headcount").alias("headcount"), F.countDistinct("dwell_time_range").alias("kinds"))


@query("checkpoint_counts", f"""
with {READINGS} select time, cast(floor(humidity) as integer) as inspected, case when temperature > 50 then 0 else cast(floor(temperature) as integer) end as en_route from readings""")
def _(d):
    t = F.floor("temperature").cast("string")
    sheet = d.readings.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("采集时间"), F.floor("humidity").cast("string").alias("已检票（人）"),
                              F.when(F.col("temperature") <= 50, t).otherwise("缺").alias("在途中（人）"))
    out = ingest.checkpoint_counts(sheet).select("time", "inspected", "en_route")
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("table_append_scan", f"""
with {READINGS} select device_id, {DAY} as time, count(*) as n, {r('sum(humidity)')} as humidity from readings
where time >= timestamp '2024-01-10' and time < timestamp '2024-02-20' group by 1, 2""")
def _(d):
    table = f"append_{uuid.uuid4().hex}"
    rows = d.readings.select("device_id", "time", "humidity")
    table_sinks.store_table(rows.filter("device_id < 'm'"), table, order=["device_id", "time"])
    table_sinks.append_by_name(rows.filter("device_id >= 'm'"), table, order=["device_id", "time"])
    part = tables.scan_table(table, "2024-01-10", "2024-02-20", spark=d.spark)
    return part.groupBy("device_id", F.date_trunc("day", "time").alias("time")).agg(F.count(F.lit(1)).alias("n"), F.sum("humidity").alias("humidity"))


@query("stored_by_device", f"""
with {READINGS}, j as (select a.device_id, a.time, a.humidity, b.temperature from readings a join readings b on a.device_id = b.device_id and a.time = b.time)
select device_id, {DAY} as time, count(*) as n, {r('avg(humidity)')} as humidity, {r('max(temperature)')} as temperature from j group by 1, 2""")
def _(d):
    left, right = (f"by_device_{uuid.uuid4().hex}" for _ in range(2))
    n = bucketed.store_by_device(d.readings.select("device_id", "time", "humidity"), left)
    bucketed.store_by_device(d.readings.select("device_id", "time", "temperature"), right, buckets=n)
    bucketed.join_by_buckets(d.spark)
    both = bucketed.join_stored(d.spark.table(left), d.spark.table(right))
    return bucketed.daily(both, {"n": F.count(F.lit(1)), "humidity": F.avg("humidity"), "temperature": F.max("temperature")})


@query("csv_folder_union", f"""
with {ORDERS} select device_id, count(*) as n, {r('sum(case when year(time) % 2 = 0 then price end)')} as price,
  count(case when year(time) % 2 = 1 then 1 end) as labelled from o group by 1""")
def _(d):
    path = d.folder("csv layouts")
    stamped = d.orders.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    even = F.year("time") % 2 == 0
    for name, rows in (("even years 50%20 a", stamped.filter(even).select("time", "device_id", "price")),
                       ("odd years", stamped.filter(~even).select("device_id", F.lit("x").alias("label"), "time"))):
        rows.write.option("header", "true").option("encoding", "GBK").csv(f"{path}/{name}")
    got = file_sources.read_csv_folder(d.spark, path, time="time")
    return got.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("double")).alias("price"),
                                        F.count("label").alias("labelled"))


@query("csv_folder_rejects", f"""
with {ORDERS}, o2 as (select *, month(time) as m from o)
select case when m % 3 = 0 then 'wide' when m % 3 = 1 then 'late' else 'good' end as folder,
  count(case when m % 3 = 2 or day(time) > 10 then 1 end) as n_rows,
  case when m % 3 = 0 then 'more fields than the header' when m % 3 = 1 then 'time can''t be read' end as reason,
  count(case when m % 3 <> 2 and day(time) <= 10 then 1 end) as n_lines
from o2 group by all""")
def _(d):
    path = d.folder("csv rejects")
    lines = d.orders.withColumn("m", F.month("time") % 3).withColumn("stamp", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    early, stamp = F.dayofmonth("time") <= 10, F.col("stamp")
    for k, (name, head, body) in enumerate((
            ("wide", "time,device_id", F.concat_ws(",", "stamp", "device_id", F.when(early, "9"))),
            ("late", "device_id,time,note", F.concat_ws(",", "device_id", F.when(early, F.concat(F.lit("about "), stamp)).otherwise(stamp), F.lit("n"))),
            ("good", "time,note,device_id", F.concat_ws(",", "stamp", F.lit("g"), "device_id")))):
        lines.filter(F.col("m") == k).select(body.alias(head)).write.option("header", "true").option("quote", "").option("sep", "\u0001").csv(f"{path}/{name}")
    rows, rejects = file_sources.read_csv_folder_checked(d.spark, path, "time")
    folder = F.regexp_extract(F.col("file"), r"csv[^/]*rejects[^/]*/(\w+)/", 1).alias("folder")
    n = rows.select(F.col("_file").alias("file")).groupBy(folder).agg(F.count(F.lit(1)).alias("n_rows"))
    wrong = rejects.groupBy(folder, "reason").agg(F.sum("n_lines").alias("n_lines"))
    return n.join(wrong, "folder", "left").select("folder", "n_rows", "reason", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))


@query("csv_export_roundtrip", f"""
with {READINGS} select device_id, {DAY} as time, {r('avg(humidity)')} as mean from readings group by 1, 2""")
def _(d):
    path = d.folder("features-csv")
    long = rounded(stats.statistical_features(d.readings, "humidity", ["mean"], "D"))
    out = file_sinks.save_per_device(long, path, ["mean"], "D")
    schema = T.StructType([T.StructField("time", T.TimestampNTZType()), T.StructField("mean", T.DoubleType()), T.StructField("device_id", T.StringType())])
    return file_sources.read_csv_series(d.spark, out, "time", schema=schema).select("device_id", "time", "mean")
