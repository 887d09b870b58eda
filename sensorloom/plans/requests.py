"""Feature requests: validation, computation, JSON answer.

The same entry points work on a DataFrame of documents (one JSON request body
per row, any number) and on a frame of readings.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sensorloom.functions import features as feat
from sensorloom.operators import stats
from sensorloom.sinks.files import to_feature_documents
from sensorloom.sources.json_records import PARSE_ERROR, VALIDATION_ERROR, parse_documents


class RequestError(ValueError):
    """A request that cannot be answered, with its structured form."""

    def __init__(self, kind: str, message: str, details: dict | None = None):
        super().__init__(message)
        self.kind, self.message, self.details = kind, message, details or {}

    def as_json(self) -> str:
        return json.dumps(
            {"success": False, "error": {"type": self.kind, "message": self.message, "details": self.details}},
            ensure_ascii=False,
        )


# What a request must satisfy, in the order of the checks: the part of the
# request that is wrong, when it is, and what to say.
_RULES = (
    ("feature_list", lambda r: not isinstance(r["feature_list"], list), "must be a list of feature names"),
    ("feature_list", lambda r: not r["feature_list"], "names no feature"),
    ("feature_list", lambda r: any(feat.canonical(f) not in feat.REQUEST_FEATURES for f in r["feature_list"]), "has unknown features"),
    ("freq", lambda r: r["freq"] not in feat.REQUEST_FREQUENCIES, "is not one of " + ", ".join(feat.REQUEST_FREQUENCIES)),
    ("field_name", lambda r: r["columns"] is not None and r["field_name"] not in r["columns"], "not found among the columns"),
)


def check_request(features, freq: str, field: str, columns: Sequence[str] | None = None) -> None:
    """Raise the first rule that a request breaks; ``columns`` None leaves the field unchecked."""
    request = {"feature_list": features, "freq": freq, "field_name": field, "columns": columns}
    for part, broken, message in _RULES:
        if broken(request):
            raise RequestError(VALIDATION_ERROR, f"{part} {request[part]!r} {message}", {part: request[part]})


def feature_request(
    df: DataFrame, field: str, features: list[str], freq: str = "h", keys: Sequence[str] = ("device_id",)
) -> DataFrame:
    """Validated batch request."""
    check_request(features, freq, field, df.columns)
    return stats.statistical_features(df, field, features, freq, keys)


def _single(name: str):
    def request(df: DataFrame, field: str, freq: str = "h", keys: Sequence[str] = ("device_id",)) -> DataFrame:
        return feature_request(df, field, [name], freq, keys)

    request.__name__ = f"calculate_{name}"
    request.__doc__ = f"{name} of a field per bucket."
    return request


calculate_mean = _single("mean")
calculate_median = _single("median")
calculate_max = _single("max")
calculate_min = _single("min")
calculate_std = _single("std")
calculate_q1 = _single("q1")
calculate_q3 = _single("q3")
calculate_p10 = _single("p10")
calculate_percent_above_q3 = _single("share_above_q3")
calculate_statistical_features = feature_request


def calculate_range(
    df: DataFrame, field: str, freq: str = "h", keys: Sequence[str] = ("device_id",)
) -> DataFrame:
    """Range and its rate of change per bucket."""
    out = feature_request(df, field, ["max", "min"], freq, keys)
    return out.select(*keys, "time", "range", feat.RANGE_RATE)


REQUESTS = {
    f.__name__: f
    for f in (
        calculate_mean, calculate_median, calculate_max, calculate_min, calculate_std, calculate_q1,
        calculate_q3, calculate_p10, calculate_percent_above_q3, calculate_range,
    )
}


def answer_documents(
    docs: DataFrame, field: str, features: list[str], freq: str = "h",
    ids: Sequence[str] = ("request_id",), column: str = "data_json",
) -> tuple[DataFrame, DataFrame]:
    """Answer many JSON documents at once: (answers, rejects), both by id."""
    check_request(features, freq, field)
    readings, rejects = parse_documents(docs, [field], column, ids=ids)
    wide = stats.statistical_features(readings, field, features, freq, ids)
    return to_feature_documents(wide, ids), rejects


def answer_json(spark: SparkSession, data_json, field: str, features: list[str], freq: str = "h") -> str:
    """One request in, one JSON answer or structured error out."""
    try:
        if not isinstance(data_json, str):
            raise RequestError(PARSE_ERROR, f"the request body is of type {type(data_json).__name__}, not text")
        docs = spark.createDataFrame([(0, data_json)], "request_id int, data_json string")
        answers, rejects = answer_documents(docs, field, features, freq)
        bad = rejects.first()
        if bad is not None:
            raise RequestError(bad["type"], bad["message"], {"field_name": field, **json.loads(bad["details"])})
        found = answers.first()
        return found["features_json"] if found else '{"features": []}'
    except RequestError as error:
        return error.as_json()
