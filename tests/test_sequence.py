import re

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sensorloom.operators import correlogram, forecast, interpolate, sequence, slices, spectral, transforms

MINUTE = 60_000_000


@pytest.mark.parametrize("slice_us", [None, 11 * MINUTE])
def test_row_index_and_previous(readings, readings_pdf, slice_us):
    got = rows_of(slices.row_index(readings, ["device_id"], slice_us=slice_us), "device_id", "time")
    assert (got["row_index"].values == readings_pdf.groupby("device_id").cumcount().values).all()
    prev = rows_of(slices.previous_values(readings, ["device_id"], ["humidity"], slice_us=slice_us), "device_id", "time")
    np.testing.assert_allclose(prev["prev_humidity"].astype(float), readings_pdf.groupby("device_id").humidity.shift().values)
    diff = rows_of(sequence.first_difference(readings, "humidity"), "device_id", "time")
    want = readings_pdf.groupby("device_id").humidity.diff().dropna()
    np.testing.assert_allclose(diff["diff"].values, want.values, atol=1e-9)


def test_suggested_slice(readings, readings_pdf):
    def worst(freq):
        return max(p.set_index("time").temperature.resample(freq).size().max() for _, p in readings_pdf.groupby("device_id"))

    suggest = slices.suggest_slice_seconds
    assert suggest(readings, max_rows=10_000) == 86_400
    assert suggest(readings, max_rows=int(worst("D")) - 1) == 3_600
    assert suggest(readings, max_rows=int(worst("h")) - 1) == 600
    assert suggest(readings.limit(0), max_rows=1) == 86_400


def test_detrend(readings, readings_pdf):
    got = rows_of(sequence.detrend(readings, "temperature"), "device_id", "time")
    for device, part in got.groupby("device_id"):
        y = readings_pdf[readings_pdf.device_id == device].temperature.values
        i = np.arange(len(y))
        a, b = np.polyfit(i, y, 1)
        np.testing.assert_allclose(part["detrended"].values, y - a * i - b, atol=1e-9)


def test_stable_periods(spark):
    days = pd.date_range("2024-01-01", periods=10, freq="D")
    std = {"a": [1, 1, 9, 1, 1, 9, 1, 1, 9, 9], "b": [9] * 10, "c": [1] * 10}
    pdf = pd.concat(pd.DataFrame({"device_id": d, "time": days, "std": np.array(v, float)}) for d, v in std.items())
    got = rows_of(sequence.stable_periods(spark.createDataFrame(pdf), 2.0), "device_id")
    assert got["length"].tolist() == [2, 0, 10]
    assert str(got["start_date"][0]) == "2024-01-01" and str(got["end_date"][0]) == "2024-01-02"
    assert got["start_date"][1] is None


@pytest.mark.parametrize("block,max_lag", [(2048, 10), (16, 10), (16, 50), (100, 399)])
@pytest.mark.filterwarnings("ignore")
def test_autocorrelation(readings, readings_pdf, block, max_lag):
    got = rows_of(sequence.autocorrelation(readings, "humidity", max_lag, block=block), "device_id", "lag")
    for device, part in got.groupby("device_id"):
        s = readings_pdf[readings_pdf.device_id == device].humidity.reset_index(drop=True)
        want = [1.0]
        for lag in range(1, min(max_lag, len(s) - 1) + 1):
            value = s.autocorr(lag)
            if np.isnan(value):
                break
            want.append(value)
        if max_lag < 300:
            assert len(part) == len(want)
        m = min(len(part), len(want)) - 3
        np.testing.assert_allclose(part["autocorrelation"].values[:m], want[:m], atol=1e-9)


def test_autocorrelation_of_constant_stops(spark):
    df = spark.range(20).select(F.lit("a").alias("device_id"), F.timestamp_seconds(F.col("id") * 60).alias("time"), F.lit(5.0).alias("v"))
    assert sequence.autocorrelation(df, "v", 5).collect()[0]["lag"] == 0
    assert sequence.autocorrelation(df, "v", 5).count() == 1


def test_interpolation(spark):
    t = pd.to_datetime(["2024-01-31 23:00", "2024-01-31 23:05", "2024-01-31 23:58", "2024-02-01 00:02", "2024-02-01 05:00", "2024-02-01 05:04"])
    pdf = pd.DataFrame({"device_id": "a", "time": t, "humidity": [1.0, 2.0, 5.0, 7.0, 9.0, 11.0], "temperature": [1.0, np.nan, 3.0, np.nan, 1.0, 2.0]})
    df = spark.createDataFrame(pdf)
    got = rows_of(interpolate.resample_and_interpolate(df), "time").set_index("time")
    assert len(got) == 59 + 303
    want = []
    for _, part in pdf.groupby(pdf.time.dt.to_period("M")):
        grid = part.set_index("time")[["humidity", "temperature"]].resample("1min").mean()
        filled = grid.interpolate(method="time", limit_area="inside")
        for c in grid.columns:
            known = grid[c].notna()
            stamp = pd.Series(grid.index, index=grid.index)
            prev, nxt = stamp.where(known).ffill(), stamp.where(known).bfill()
            filled.loc[(nxt - prev) > pd.Timedelta(hours=2), c] = np.nan
        want.append(filled)
    want = pd.concat(want)
    for c in ("humidity", "temperature"):
        np.testing.assert_allclose(got[c].astype(float).values, want[c].values, atol=1e-9)


@pytest.fixture(scope="module")
def hourly(spark):
    n = {"a": 300, "b": 241, "c": 64}
    frames = []
    for d, size in n.items():
        i = np.arange(size)
        v = 10 + 0.01 * i + 3 * np.sin(2 * np.pi * i / 24) + np.sin(2 * np.pi * i / 8)
        frames.append(pd.DataFrame({"device_id": d, "time": pd.date_range("2024-01-01", periods=size, freq="h"), "v": v}))
    return pd.concat(frames)


@pytest.mark.parametrize("limit", [spectral.ONE_TASK_POINTS, 100])
def test_spectrum(spark, hourly, limit):
    df = spark.createDataFrame(hourly)
    got = rows_of(spectral.amplitude_spectrum(df, "v", one_task_points=limit), "device_id", "k")
    for device, part in got.groupby("device_id"):
        y = hourly[hourly.device_id == device].v.values
        i, n = np.arange(len(y)), len(y)
        a, b = np.polyfit(i, y, 1)
        want = 2 / n * np.abs(np.fft.fft(y - a * i - b))[: n // 2]
        np.testing.assert_allclose(part["amplitude"].values, want, atol=1e-9)
        np.testing.assert_allclose(part["period_hours"].values[1:], n / np.arange(1, n // 2))
        assert np.isinf(part["period_hours"].values[0])


def test_main_periods(spark, hourly):
    df = spark.createDataFrame(hourly[hourly.device_id == "a"].iloc[:288])
    got = {r["feature_key"]: r for r in spectral.main_periods(df, "v", top_n=2).collect()}
    assert got["main_period_1_hours"]["value"] == pytest.approx(24)
    assert got["main_period_2_hours"]["value"] == pytest.approx(8)
    assert set(got) == {f"main_period_{i}_{s}" for i in (1, 2) for s in ("hours", "strength")}
    assert got["main_period_1_hours"]["time"] == pd.Timestamp("2024-01-12 23:00:00")


def test_forecasts(spark):
    days = pd.date_range("2024-01-01", periods=60, freq="D")
    v = 5 + np.arange(60) * 0.1 + np.tile([0, 1, 2, 3, 2, 1, 0], 9)[:60]
    df = spark.createDataFrame(pd.DataFrame({"device_id": "a", "time": days, "value": v}))
    naive = rows_of(forecast.seasonal_naive(df, "2024-02-10"), "time")
    at = list(days).index(pd.Timestamp("2024-02-10"))
    want = [v[at - 6 + h % 7] for h in range(60 - at - 1)]
    np.testing.assert_allclose(naive["forecast"].values, want)
    ar = rows_of(forecast.autoregressive(df, "2024-02-10"), "time")
    assert len(ar) == len(want) and (ar["lower"] <= ar["forecast"]).all() and (ar["upper"] >= ar["forecast"]).all()
    line = spark.createDataFrame(pd.DataFrame({"device_id": "a", "time": days, "value": np.arange(60) * 2.0}))
    exact = forecast.forecast_errors(forecast.autoregressive(line, "2024-02-10")).collect()[0]
    assert exact["mae"] < 1e-6 and exact["n_days"] == 60 - at - 1


def _least_squares(days, v, at, order):
    """Forecast of every day after ``at`` (a number of days) by least squares on lagged differences, by plain loops."""
    level = dict(zip(days, v))
    diff = {d: level[d] - level[d - 1] for d in level if d <= at and d - 1 in level}
    rows = [(diff[d], [diff[d - i] for i in range(1, order + 1)]) for d in sorted(diff) if all(d - i in diff for i in range(1, order + 1))]
    if len(rows) < order + 2:  # also without a train day
        return {d: None for d in level if d > at}
    coef = np.linalg.lstsq(np.array([[1.0, *x] for _, x in rows]), np.array([y for y, _ in rows]), rcond=None)[0]
    last = max(d for d in level if d <= at)
    mean = np.mean(list(diff.values()))
    recent = [diff.get(last - i, mean) for i in range(order)]
    out, now = {}, level[last]
    for d in range(last + 1, max(level) + 1):
        recent.insert(0, coef[0] + sum(c * x for c, x in zip(coef[1:], recent)))
        now += recent[0]
        out[d] = now
    return {d: out[d] for d in level if d > at}


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_autoregression_by_normal_equations(spark, order):
    """Gaps, a series that ends before the holdout, one that begins in it, a short, a flat and a missing one."""
    rng = np.random.default_rng(order)
    walk = np.cumsum(rng.normal(0.2, 1, 120)) + 500
    series = {
        "walk": dict(enumerate(walk)), "gaps": {i: x for i, x in enumerate(walk * 2) if i % 29 not in (3, 4, 17)},
        "ends": {i: walk[i] for i in range(60)}, "late": {i: walk[i] for i in range(105, 120)},
        "short": {i: walk[i] for i in (97, 98, 101, 102)}, "flat": dict.fromkeys(range(120), 7.0),
        "one": {100: 1.0}, "none": dict.fromkeys(range(95, 110), float("nan")),
    }
    start = pd.Timestamp("2024-01-01")
    rows = [(k, start + pd.Timedelta(days=i), float(x)) for k, s in series.items() for i, x in s.items()]
    rows.append((None, start, 1.0))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["device_id", "time", "value"]))
    out = forecast.autoregressive(df, start + pd.Timedelta(days=100), order=order)
    got = {(r["device_id"], (r["time"] - start).days): r for r in out.collect()}
    want = {(k, d): f for k, s in series.items() if k not in ("none", "flat")
            for d, f in _least_squares(list(s), list(s.values()), 100, order).items()}
    assert {k for k in got if k[0] not in ("none", "flat")} == set(want)
    for key, f in want.items():
        if f is None:
            assert got[key]["forecast"] is None and got[key]["lower"] is None, key
        else:
            assert got[key]["forecast"] == pytest.approx(f, rel=1e-6), key
            assert got[key]["lower"] <= got[key]["forecast"] <= got[key]["upper"], key
    flat = [r for (k, _), r in got.items() if k == "flat"]
    assert len(flat) == 19 and all(r["forecast"] == r["lower"] == r["upper"] == 7.0 for r in flat)
    none = [r for (k, _), r in got.items() if k == "none"]
    assert len(none) == 9 and all(r["forecast"] is None and r["actual"] is None for r in none)
    assert forecast.autoregressive(df.limit(0), "2024-02-01", order=order).count() == 0


def test_autoregression_runs_without_python(spark):
    df = spark.createDataFrame(pd.DataFrame({"device_id": ["a"], "time": [pd.Timestamp("2024-01-01")], "value": [1.0]}))
    plan = forecast.autoregressive(df, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan


def _pairwise(x):
    """Autocorrelation at every lag, pair by pair, up to the first undefined one."""
    out = [1.0] if len(x) >= 2 else []
    for lag in range(1, len(x)):
        a, b = x[:-lag], x[lag:]
        known = ~(np.isnan(a) | np.isnan(b))
        a, b = a[known], b[known]
        if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
            break
        out.append(np.corrcoef(a, b)[0, 1])
    return out


@pytest.mark.parametrize("one_task", [10 ** 6, 3])
def test_autocorrelation_at_all_lags(spark, monkeypatch, one_task):
    """One-task and split transforms; missing values, an empty, a single and a constant series."""
    monkeypatch.setattr(correlogram.all_lag_sums, "__defaults__", (("device_id",), "time", (), one_task))
    monkeypatch.setattr(correlogram, "DIRECT", 16)
    rng = np.random.default_rng(8)
    walk = np.cumsum(rng.normal(0, 1, 300)) + 1e4
    walk[rng.random(300) < .1] = np.nan
    series = {"walk": walk, "few": np.array([1.0, 4.0, 2.0, 9.0, 3.0, 3.5]), "one": np.array([5.0]), "flat": np.full(40, 2.0), "none": np.full(20, np.nan)}
    rows = [(k, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i), float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["device_id", "time", "v"]))
    got = rows_of(sequence.autocorrelation(df, "v"), "device_id", "lag")
    for name, x in series.items():
        part = got[got["device_id"] == name]
        want = _pairwise(x)
        assert part["lag"].tolist() == list(range(len(want))), name
        np.testing.assert_allclose(part["autocorrelation"], want, atol=1e-8)
    assert sequence.autocorrelation(df.limit(0), "v").count() == 0


def test_split_transforms_in_bundles(spark, monkeypatch):
    """Tiles of several columns and rows; a series of a length beside a power of two, one of two readings, readings of an unknown key."""
    monkeypatch.setattr(correlogram.all_lag_sums, "__defaults__", (("device_id",), "time", (), 1))
    monkeypatch.setattr(correlogram, "DIRECT", 4)
    monkeypatch.setattr(transforms, "BUNDLE", 64)
    rng = np.random.default_rng(9)
    series = {"long": np.cumsum(rng.normal(0, 1, 513)), "gaps": np.where(rng.random(200) < .3, np.nan, rng.normal(0, 1, 200)), "two": np.array([1.0, 2.0]), None: np.arange(9.0)}
    rows = [(k, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i), float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["device_id", "time", "v"]))
    got = rows_of(sequence.autocorrelation(df, "v"), "device_id", "lag")
    assert set(got["device_id"]) == {"long", "gaps", "two"}
    for name, part in got.groupby("device_id"):
        want = _pairwise(series[name])
        assert part["lag"].tolist() == list(range(len(want))), name
        np.testing.assert_allclose(part["autocorrelation"], want, atol=1e-8)
    whole = sequence.autocorrelation(df.filter("device_id = 'long'").drop("device_id"), "v", keys=[])
    np.testing.assert_allclose(rows_of(whole, "lag")["autocorrelation"], _pairwise(series["long"]), atol=1e-8)


@pytest.mark.parametrize("max_lag", [None, 5])
def test_autocorrelation_sorts_no_whole_series(spark, monkeypatch, max_lag):
    """Rows of a long series meet what is known of the series without being sorted or dealt by its key; no reading is copied."""
    monkeypatch.setattr(correlogram.all_lag_sums, "__defaults__", (("device_id",), "time", (), 3))
    df = spark.range(50).select(F.lit("a").alias("device_id"), F.timestamp_seconds(F.col("id") * 60).alias("time"), F.sin("id").alias("v"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables whose size is not known
    try:
        plan = sequence.autocorrelation(df, "v", max_lag)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin [device_id" in plan
    assert not re.findall(r"SortMergeJoin \[device_id#\w+\],", plan)
    assert max_lag or "Generate" not in plan
