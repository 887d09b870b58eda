"""Metric catalog: named metrics answered from structured intents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.operators import stats
from sensorloom.operators.reshape import to_long, union_by_name
from sensorloom.sources.points import scan_points

# Ids, fields, features and frequencies of the stock metrics.
_HUMIDITY, _TEMPERATURE = "空气湿度（%）", "空气温度（℃）"
CATALOG: dict[str, dict] = {
    "humidity_trend": {"data_field": _HUMIDITY, "calculation_logic": ["均值"], "default_freq": "h"},
    "temperature_daily": {"data_field": _TEMPERATURE, "calculation_logic": ["均值", "最大值", "最小值"], "default_freq": "D"},
    "humidity_daily": {"data_field": _HUMIDITY, "calculation_logic": ["均值", "最大值", "最小值"], "default_freq": "D"},
    "temperature_trend": {"data_field": _TEMPERATURE, "calculation_logic": ["均值"], "default_freq": "h"},
}


def catalog_frame(spark: SparkSession, catalog: Mapping[str, dict] = CATALOG) -> DataFrame:
    """The catalog as a table, for lookups by id; titles and display hints of a configured catalog stay with it."""
    rows = [(k, m.get("name", k), m.get("description"), m["data_field"], list(m["calculation_logic"]), m["default_freq"],
             m.get("viz_type")) for k, m in catalog.items()]
    return spark.createDataFrame(
        rows,
        "id string, name string, description string, data_field string, calculation_logic array<string>, "
        "default_freq string, viz_type string",
    )


def filter_intent(df: DataFrame, intent: Mapping, site: str = "site_id", time: str = "time") -> DataFrame:
    """Optional site and inclusive date range of an intent."""
    if intent.get("site_id") and site in df.columns:
        df = df.filter(F.col(site) == intent["site_id"])
    kind = df.schema[time].dataType
    if intent.get("start_date"):
        df = df.filter(F.col(time) >= F.lit(intent["start_date"]).cast(kind))
    if intent.get("end_date"):
        df = df.filter(F.col(time) <= F.lit(intent["end_date"]).cast(kind))
    return df


def run_metric(
    df: DataFrame,
    metric_id: str,
    intent: Mapping | None = None,
    catalog: Mapping[str, dict] = CATALOG,
    keys: Sequence[str] = ("device_id",),
    site: str = "site_id",
) -> DataFrame:
    """Features of one metric; the intent's frequency wins over the default."""
    if metric_id not in catalog:
        raise ValueError(f"unknown metric {metric_id!r}, known: {sorted(catalog)}")
    metric, intent = catalog[metric_id], intent or {}
    names.require_columns(df, [metric["data_field"]])
    rows = filter_intent(df, intent, site)
    freq = intent.get("freq") or metric["default_freq"]
    return stats.statistical_features(rows, metric["data_field"], metric["calculation_logic"], freq, keys)


def run_intents(
    df: DataFrame, intents: Sequence[Mapping], catalog: Mapping[str, dict] = CATALOG,
    keys: Sequence[str] = ("device_id",), site: str = "site_id",
) -> DataFrame:
    """Several intents as one long table with the intent's position."""
    parts = []
    for at, intent in enumerate(intents):
        wide = run_metric(df, intent["metric_id"], intent, catalog, keys, site)
        long = to_long(wide, [*keys, "time"]).drop("stats_cycle")
        parts.append(long.withColumn("metric_id", F.lit(intent["metric_id"])).withColumn("intent", F.lit(at)))
    return union_by_name(parts)


def hourly_field_features(
    points: DataFrame,
    measurement: str,
    term: str,
    aliases: Mapping[str, Sequence[str]],
    features: Sequence[str],
    start=None,
    end=None,
    preview: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Hourly features of the field a user's term stands for."""
    field = names.resolve_alias(term, aliases)
    if field is None:
        raise ValueError(f"unknown field name {term!r}")
    rows = scan_points(points, measurement, field, start, end, keys)
    out = stats.statistical_features(rows, field, features, "h", keys)
    return out.orderBy("time").limit(preview) if preview else out
