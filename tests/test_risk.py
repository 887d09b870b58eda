"""Exposure, rainfall, gradient and correlation against plain loops."""

import math

import time

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of

from sensorloom.functions.significance import pearson_p
from sensorloom.operators import risk

MINUTE = 60_000_000


def exposure_loop(pdf, threshold, freq):
    out = []
    for device, part in pdf.groupby("device_id"):
        for bucket, g in part.set_index("time").resample(freq):
            if g.empty:
                continue
            high = (g.humidity > threshold).tolist()
            step = (g.index[1] - g.index[0]).total_seconds() / 3600 if len(g) > 1 else 1.0
            runs, length = [], 0
            for flag in [*high, False]:
                if flag:
                    length += 1
                elif length:
                    runs.append(length)
                    length = 0
            out.append((device, bucket, sum(high) * step, max(runs, default=0) * step, len(runs), sum(high) / len(high)))
    return out


@pytest.mark.parametrize("slice_us", [None, 7 * MINUTE, 400 * MINUTE])
@pytest.mark.parametrize("freq", ["D", "6h", "ME"])
def test_exposure(readings, readings_pdf, freq, slice_us):
    got = rows_of(risk.humidity_exposure(readings, "humidity", 60.0, freq, slice_us=slice_us), "device_id", "time")
    want = exposure_loop(readings_pdf, 60.0, freq)
    assert len(got) == len(want)
    for row, w in zip(got.itertuples(index=False), want):
        assert row[0] == w[0] and row[1] == w[1] and row[4] == w[4]
        np.testing.assert_allclose([row[2], row[3], row[5]], [w[2], w[3], w[5]], rtol=1e-12)


def test_exposure_all_high_and_none_high(readings, readings_pdf):
    for threshold in (-1.0, 1000.0):
        got = rows_of(risk.humidity_exposure(readings.na.drop(), "humidity", threshold, "W"), "device_id", "time")
        want = exposure_loop(readings_pdf.dropna(), threshold, "W")
        np.testing.assert_allclose(got.iloc[:, 2:].astype(float).values, np.array([w[2:] for w in want], dtype=float))


@pytest.mark.parametrize("slice_us", [None, 5 * MINUTE, 1000 * MINUTE])
def test_rolling_sum(readings, readings_pdf, slice_us):
    got = rows_of(risk.rolling_sum(readings, "humidity", "1h", slice_us=slice_us), "device_id", "time")
    want = pd.concat(
        p.set_index("time").humidity.rolling("1h").sum().rename("r").reset_index()
        for _, p in readings_pdf.groupby("device_id")
    )
    assert len(got) == len(readings_pdf)
    np.testing.assert_allclose(got["rolling_sum"].values.astype(float), want["r"].values, atol=1e-9)


@pytest.mark.parametrize("slice_us", [None, 3 * MINUTE])
@pytest.mark.parametrize("window,freq", [("1h", "6h"), ("10min", "D")])
def test_rainfall(spark, readings_pdf, window, freq, slice_us):
    pdf = readings_pdf.assign(rain=(readings_pdf.humidity - 62).clip(lower=0).round(1))
    df = spark.createDataFrame(pdf[["device_id", "time", "rain"]])
    df = df.withColumn("time", df.time.cast("timestamp_ntz"))
    got = rows_of(risk.rainfall_intensity(df, "rain", window, freq, slice_us=slice_us), "device_id", "time")
    want = []
    for device, part in pdf.groupby("device_id"):
        part = part.set_index("time")
        part["rolled"] = part.rain.rolling(window).sum()
        for bucket, g in part.resample(freq):
            if g.empty:
                continue
            positive = g.rolled[g.rolled > 0]
            step = (g.index[1] - g.index[0]).total_seconds() / 3600 if len(g) > 1 else 1.0
            want.append((g.rolled.max(), positive.mean() if len(positive) else 0.0, g.rain.sum(), (g.rain > 0).sum() * step))
    np.testing.assert_allclose(got.iloc[:, 2:].astype(float).values, np.array(want, dtype=float), atol=1e-9)


def test_gradient(spark):
    inside = spark.sql(
        "select * from values (timestamp'2024-01-01 00:00:00', 25.0D, 60.0D), (timestamp'2024-01-01 01:00:00', 10.0D, 50.0D),"
        " (timestamp'2024-01-01 02:00:00', 5.0D, null), (timestamp'2024-01-01 03:00:00', 5.0D, 1.0D) t(time, temperature, humidity)"
    )
    outside = spark.sql(
        "select * from values (timestamp'2024-01-01 00:00:00', 2.5D), (timestamp'2024-01-01 01:00:00', 0.1D),"
        " (timestamp'2024-01-01 02:00:00', 0.1D), (timestamp'2024-01-01 09:00:00', 0.1D) t(time, avg_vapor_pressure)"
    )
    got = rows_of(risk.vapor_pressure_gradient(inside, outside), "time")
    vp = 0.6 * 6.112 * math.exp(17.67 * 25 / (25 + 243.5))
    assert got["VP_in"][0] == pytest.approx(vp)
    assert got["delta_VP"][0] == pytest.approx(25 - vp)
    assert got["diffusion_direction"].tolist() == ["向内", "向外", None]
    shares = risk.inward_share(risk.vapor_pressure_gradient(inside, outside)).collect()[0]
    assert shares["inward_share"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="missing columns"):
        risk.vapor_pressure_gradient(inside.drop("humidity"), outside)


# Published results: r and p of 785 common days.
PUBLISHED = [
    (0.25432226089032284, 4.707976839144831e-13),
    (0.010657127527707713, 0.765609691011428),
    (0.3090864317169542, 7.713234085039846e-19),
]


def test_p_value_against_published_results():
    r, p = np.array(PUBLISHED).T
    np.testing.assert_allclose(pearson_p(r, np.full(3, 785)), p, rtol=1e-9)
    assert np.isnan(pearson_p(np.array([np.nan, 0.3]), np.array([10, 2]))).all()
    assert pearson_p(np.array([1.0, 0.0]), np.array([10, 10])).tolist() == [0.0, 1.0]


def test_correlation(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=50)
    y = 0.5 * x + rng.normal(size=50)
    t = pd.date_range("2024-01-01", periods=50, freq="D")
    a = spark.createDataFrame(pd.DataFrame({"time": t, "total_exposure_hours": x}))
    b = spark.createDataFrame(pd.DataFrame({"time": t, "rainfall_peak": y}))
    got = risk.correlate(a, b).collect()[0]
    slope, intercept = np.polyfit(x, y, 1)
    r = np.corrcoef(x, y)[0, 1]
    np.testing.assert_allclose(
        [got["correlation"], got["slope"], got["intercept"], got["r_squared"], got["n_samples"]],
        [r, slope, intercept, r * r, 50],
    )
    few = risk.correlate(a.limit(2), b).collect()[0]
    assert few["n_samples"] == 0 and few["correlation"] is None and few["p_value"] is None


def test_rolling_sum_of_a_crowded_window(spark):
    """100,000 readings in one window take about as long as in many; edges are exact, missing values are left out."""
    n = 100_000
    df = spark.range(n).selectExpr("'A' as device_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id / 100) as time",
                                   "case when id % 7 <> 0 then cast(id % 13 as double) end as v")
    start = time.monotonic()
    got = rows_of(risk.rolling_sum(df, "v", "1h"), "time")["rolling_sum"].to_numpy(float)
    assert time.monotonic() - start < 60
    v = np.where(np.arange(n) % 7 != 0, np.arange(n) % 13, 0).astype(float)
    np.testing.assert_array_equal(got[1:], np.cumsum(v)[1:])
    short = rows_of(risk.rolling_sum(df, "v", "10s"), "time")["rolling_sum"].to_numpy(float)
    want = np.cumsum(v) - np.concatenate((np.zeros(1000), np.cumsum(v)[:-1000]))
    np.testing.assert_array_equal(short[1:], want[1:])


def test_rolling_sum_of_empty_null_and_single_series(spark):
    rows = [("one", "2024-01-01 00:00:00", 2.0), ("none", "2024-01-01 00:00:00", None), ("none", "2024-01-01 00:59:59", None),
            ("two", "2024-01-01 00:30:00", None), ("two", "2024-01-01 01:29:59", 4.0), ("two", "2024-01-01 01:30:00", None), ("two", "2024-01-01 02:30:00", None)]
    df = spark.createDataFrame(rows, "device_id string, t string, v double").selectExpr("device_id", "cast(t as timestamp_ntz) as time", "v")
    got = [(r["device_id"], r["rolling_sum"]) for r in risk.rolling_sum(df, "v", "1h").orderBy("device_id", "time").collect()]
    assert got == [("none", None), ("none", None), ("one", 2.0), ("two", None), ("two", 4.0), ("two", 4.0), ("two", None)]
    assert risk.rolling_sum(df.limit(0), "v", "1h").count() == 0
