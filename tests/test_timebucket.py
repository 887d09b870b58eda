import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.functions import timebucket
from sensorloom.functions.timebucket import bucket_of, month_range, parse_duration_micros, parse_freq
from sensorloom.operators import stats


@pytest.mark.parametrize("text,kind,micros", [
    ("h", "fixed", 3600), ("1H", "fixed", 3600), ("10min", "fixed", 600), ("6h", "fixed", 21600), ("D", "fixed", 86400),
    ("d", "fixed", 86400), ("W", "week", 0), ("M", "month_end", 0), ("ME", "month_end", 0), ("MS", "month_start", 0), ("30s", "fixed", 30)])
def test_parse(text, kind, micros):
    freq = parse_freq(text)
    assert (freq.kind, freq.micros) == (kind, micros * 1_000_000)


@pytest.mark.parametrize("text", ["10m", "m", "", "INVALID", "0h", "2W", "h1"])
def test_rejected(text):
    with pytest.raises(ValueError):
        parse_freq(text)


def test_duration_must_be_fixed():
    assert parse_duration_micros("1h") == 3_600_000_000
    with pytest.raises(ValueError):
        parse_duration_micros("MS")


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(pd.Timestamp("1965-01-01").to_pydatetime(), pd.Timestamp("2040-01-01").to_pydatetime()), min_size=20, max_size=20))
def test_labels_equal_pandas(spark, stamps):
    pdf = pd.DataFrame({"time": pd.to_datetime(stamps).astype("datetime64[us]")})
    for ntz in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(pdf).select(F.col("time").cast(ntz).alias("time"))
        kind = df.schema["time"].dataType
        freqs = ["10min", "h", "6h", "D", "W", "ME", "MS"]
        got = df.select("time", *[bucket_of(F.col("time"), parse_freq(f), kind).alias(f) for f in freqs])
        assert all(got.schema[f].dataType == kind for f in freqs)
        got = got.toPandas()
        one = pd.Series(1, index=pdf.time)
        for f in freqs:
            for t, label in zip(got["time"], got[f]):
                assert one[[t]].resample(f).count().index[0] == label


def test_month_range(spark):
    df = spark.sql("select explode(array(timestamp'2023-11-30 20:00:00', timestamp'2024-02-01 00:00:00')) as time")
    utc = [str(r[0]) for r in month_range(df).collect()]
    assert utc == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    local = [str(r[0]) for r in month_range(df, tz="Asia/Shanghai").collect()]
    assert local[0] == "2023-12-01"


@pytest.mark.parametrize("freq", ["1s", "7s", "5min"])
def test_short_buckets_in_slices(spark, monkeypatch, freq):
    """Slices give what one window gives: gaps over several slices, one row, a NULL key, a NULL value, no row."""
    start = pd.Timestamp("2024-01-01")
    step = pd.Timedelta(freq)
    places = {"a": [0, 1, 2, 5, 6, 40, 41, 90], "b": [7], None: [3, 4, 9], "c": list(range(8, 33))}
    rows = [(k, start + i * step, None if i == 41 else float(i % 5)) for k, at in places.items() for i in at]
    schema = "device_id string, time timestamp_ntz, v double"
    df = spark.createDataFrame([(k, t.to_pydatetime(), v) for k, t, v in rows], schema)

    def run(rows):
        parsed = timebucket.parse_freq(freq)
        filled = timebucket.fill_missing_buckets(rows, parsed, ["device_id"], "time")
        changed = stats.with_percent_change(filled, ["device_id"], "v", "rate", "time", timebucket.slice_length(parsed))
        return sorted(map(tuple, changed.collect()), key=repr)

    monkeypatch.setattr(timebucket, "_CHUNK", 8)
    sliced = run(df)
    assert run(df.limit(0)) == []
    monkeypatch.setattr(timebucket, "FINE_US", 0)
    assert sliced == run(df)
    assert len(sliced) == 91 + 1 + 7 + 25


def test_year_of_seconds_of_one_device(spark):
    """A gap of a year between two seconds is expanded by many tasks."""
    rows = [("a", pd.Timestamp("2023-01-01").to_pydatetime(), 1.0), ("a", pd.Timestamp("2023-12-31 23:59:59").to_pydatetime(), 2.0)]
    df = spark.createDataFrame(rows, "device_id string, time timestamp_ntz, v double")
    filled = timebucket.fill_missing_buckets(df, "1s", ["device_id"])
    parts = filled.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 365 * 86_400
    assert len(parts) > 1 and max(r["count"] for r in parts) < 365 * 86_400 / 2
