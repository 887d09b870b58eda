"""Risk job: gradient, exposure, rainfall and their correlation by config."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from sensorloom.functions import names
from sensorloom.operators import risk
from sensorloom.operators.report import observe_results, summary
from sensorloom.sinks.files import save_results
from sensorloom.sources.files import read_csv_series

logger = logging.getLogger(__name__)

SECTIONS = ("vapor_pressure_gradient", "high_humidity_exposure", "rainfall_intensity", "correlation_analysis")

# The job's own defaults differ from the library's.
JOB_DEFAULTS = {
    "high_humidity_exposure": {"threshold": 62.0, "freq": "D"},
    "rainfall_intensity": {"window": "10min", "freq": "D"},
}


def default_config(
    inside: str | None = None, outside: str | None = None, humidity: str | None = None, rainfall: str | None = None
) -> dict:
    """Config from input paths; a section is enabled when its input is given."""
    return {
        "vapor_pressure_gradient": {
            "enabled": bool(inside and outside), "cave_inside_file": inside, "cave_outside_file": outside,
        },
        "high_humidity_exposure": {"enabled": bool(humidity), "data_file": humidity},
        "rainfall_intensity": {"enabled": bool(rainfall), "data_file": rainfall},
        "correlation_analysis": {"enabled": bool(humidity and rainfall)},
    }


def risk_features(
    config: dict,
    load: Callable[[str, dict], DataFrame],
    keys: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Result tables by name.

    ``load(source, section)`` turns a configured source into a frame.  ``keys``
    are the series columns of exposure and rainfall inputs (none for one
    station per file).  A section that cannot be planned is logged and left
    out; the correlation needs both of its inputs.
    """
    results: dict[str, DataFrame] = {}

    def section(name: str) -> dict | None:
        cfg = config.get(name) or {}
        return {**JOB_DEFAULTS.get(name, {}), **cfg} if cfg.get("enabled") else None

    def attempt(name: str, build: Callable[[dict], DataFrame]) -> None:
        cfg = section(name)
        if cfg is None:
            return
        try:
            results[name] = build(cfg)
        except Exception:
            logger.exception("section %s failed and is left out", name)

    def gradient(cfg: dict) -> DataFrame:
        return risk.vapor_pressure_gradient(
            load(cfg["cave_inside_file"], cfg),
            load(cfg["cave_outside_file"], cfg),
            cfg.get("temp_col_in", "temperature"),
            cfg.get("humidity_col_in", "humidity"),
            cfg.get("vapor_pressure_col_out", "avg_vapor_pressure"),
        )

    def exposure(cfg: dict) -> DataFrame:
        df, column = load(cfg["data_file"], cfg), cfg.get("humidity_column", "humidity")
        names.require_columns(df, [column])
        return risk.humidity_exposure(df, column, cfg["threshold"], cfg["freq"], keys)

    def rainfall(cfg: dict) -> DataFrame:
        df, column = load(cfg["data_file"], cfg), cfg.get("rainfall_column", "rainfall")
        names.require_columns(df, [column])
        return risk.rainfall_intensity(df, column, cfg["window"], cfg["freq"], keys)

    attempt("vapor_pressure_gradient", gradient)
    attempt("high_humidity_exposure", exposure)
    attempt("rainfall_intensity", rainfall)
    if {"high_humidity_exposure", "rainfall_intensity"} <= set(results):
        attempt(
            "correlation_analysis",
            lambda cfg: risk.correlate(
                results["high_humidity_exposure"],
                results["rainfall_intensity"],
                cfg.get("humidity_col", "total_exposure_hours"),
                cfg.get("rainfall_col", "rainfall_peak"),
                on=[*keys, "time"],
            ),
        )
    return results


def csv_loader(spark: SparkSession) -> Callable[[str, dict], DataFrame]:
    def load(path: str, cfg: dict) -> DataFrame:
        stamp = cfg.get("time_column", "time")
        df = read_csv_series(spark, path, stamp, cfg.get("encoding", "utf-8"), infer=False)
        # readings are numbers; what is none becomes NULL
        values = [names.col(c).try_cast("double").alias(c) for c in df.columns if c != stamp]
        return df.select(names.col(stamp).alias("time"), *values)

    return load


def job_status(spark: SparkSession, config: dict, results: dict[str, DataFrame]) -> DataFrame:
    """One row per section: is it enabled, and is its result there?"""
    rows = [(name, bool((config.get(name) or {}).get("enabled")), name in results) for name in SECTIONS]
    return spark.createDataFrame(rows, "section string, enabled boolean, done boolean")


def store_results(spark: SparkSession, results: dict[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Each table written once, its summary metrics observed on the way; the tables as read back, and the summary.

    A table that cannot be computed is logged and left out."""
    stored: dict[str, DataFrame] = {}
    observed = {}
    for name, df in results.items():
        path = f"{folder}/{name}"
        try:
            watched, watch = observe_results(df)
            watched.write.mode("overwrite").parquet(path)
            stored[name], observed[name] = spark.read.schema(df.schema).parquet(path), watch
        except Exception:
            logger.exception("section %s failed and is left out", name)
    return stored, summary(stored, observed=observed) if stored else None


def run_risk_job(spark: SparkSession, config: dict, output: str, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Compute, save each table and the summary; returns the tables as read
    back, so that nothing is computed twice."""
    stored, lines = store_results(spark, risk_features(config, csv_loader(spark), keys), f"{output}/tables")
    save_results(stored, output)
    job_status(spark, config, stored).write.mode("overwrite").option("header", "true").csv(f"{output}/status")
    if stored:
        lines.write.mode("overwrite").option("header", "true").csv(f"{output}/summary_report")
    return stored
