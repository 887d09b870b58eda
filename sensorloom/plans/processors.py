"""Named processors: readings and a field in, long features out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators import risk, spectral, stats
from sensorloom.operators.reshape import to_long

Processor = Callable[[DataFrame, str, dict, Sequence[str]], DataFrame]


def _ids(keys: Sequence[str]) -> list[str]:
    return [*keys, "time"]


def statistical(df: DataFrame, field: str, params: dict, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    freq = params.get("freq", "h")
    wide = stats.statistical_features(
        df, field, params.get("metrics", []), freq, keys, tie=params.get("tie", ()),
        auto_range=params.get("auto_range", True),
    )
    return to_long(wide, _ids(keys), params.get("cycle_label", freq))


def volatility(df: DataFrame, field: str, params: dict, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    wide = stats.volatility_features(
        df, field, params.get("metrics"), params.get("freq", "D"), keys, tie=params.get("tie", ())
    )
    return to_long(wide, _ids(keys), params.get("cycle_label", "1d"))


def spectrum(df: DataFrame, field: str, params: dict, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    long = spectral.main_periods(df, field, params.get("top_n", 1), keys)
    return long.withColumn("stats_cycle", F.lit(params.get("cycle_label", "batch")))


def humidity_exposure(df: DataFrame, field: str, params: dict, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    freq = params.get("freq", "D")
    wide = risk.humidity_exposure(df, field, params.get("threshold", 62.0), freq, keys, tie=params.get("tie", ()))
    return to_long(wide, _ids(keys), params.get("cycle_label", freq))


def rainfall_intensity(df: DataFrame, field: str, params: dict, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    freq = params.get("freq", "D")
    wide = risk.rainfall_intensity(df, field, params.get("window", "10min"), freq, keys)
    return to_long(wide, _ids(keys), params.get("cycle_label", freq))


def vapor_pressure_gradient(
    inside: DataFrame, outside: DataFrame, params: dict, carry: Sequence[str] = ()
) -> DataFrame:
    """Long form of the gradient; values are text, since one of them is the
    direction."""
    wide = risk.vapor_pressure_gradient(
        inside,
        outside,
        params.get("temp_col_in", "temperature"),
        params.get("humidity_col_in", "humidity"),
        params.get("vapor_pressure_col_out", "avg_vapor_pressure"),
        carry=carry,
    )
    return to_long(wide, ["time", *carry], params.get("cycle_label", "raw"), value_type="string")


PROCESSORS: dict[str, Processor] = {
    "statistical": statistical,
    "volatility": volatility,
    "spectral": spectrum,
    "high_humidity_exposure": humidity_exposure,
    "rainfall_intensity": rainfall_intensity,
}


def register_processor(name: str, processor: Processor) -> None:
    PROCESSORS[name] = processor
