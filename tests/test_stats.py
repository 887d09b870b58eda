"""Differential tests of the feature registry against plain pandas."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sensorloom.functions import features as feat
from sensorloom.operators import order_stats, stats


def _share(s):
    if len(s) < 4:
        return 0.0
    return float((s > s.quantile(0.75)).sum() / len(s))


PANDAS = {
    "mean": lambda s: s.mean(),
    "median": lambda s: s.median(),
    "max": lambda s: s.max(),
    "min": lambda s: s.min(),
    "q1": lambda s: s.quantile(0.25),
    "q3": lambda s: s.quantile(0.75),
    "p10": lambda s: s.quantile(0.10),
    "share_above_q3": _share,
    "range": lambda s: s.max() - s.min(),
    "std": lambda s: s.std(),
    "mad_mean": lambda s: (s - s.mean()).abs().mean(),
    "mad_median": lambda s: (s - s.median()).abs().mean(),
    "cv": lambda s: s.std() / s.mean() if len(s) else np.nan,
    "lag1_autocorr": lambda s: s.autocorr(1) if s.notna().sum() > 1 else np.nan,
}


def expected(pdf, freq, names):
    out = []
    for device, part in pdf.groupby("device_id"):
        series = part.set_index("time")["humidity"]
        groups = series.resample(freq)
        wide = pd.DataFrame({n: groups.apply(PANDAS[n]) for n in names})
        wide.insert(0, "device_id", device)
        out.append(wide.rename_axis("time").reset_index())
    return pd.concat(out).sort_values(["device_id", "time"]).reset_index(drop=True)


def assert_close(got, want, names):
    assert len(got) == len(want)
    assert (got["device_id"].values == want["device_id"].values).all()
    assert (pd.to_datetime(got["time"]).values == pd.to_datetime(want["time"]).values).all()
    for n in names:
        np.testing.assert_allclose(
            got[n].astype(float).values, want[n].astype(float).values, rtol=1e-9, atol=1e-9, err_msg=n
        )


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("hot_rows", [None, 5])
@pytest.mark.parametrize("freq", ["D", "6h"])
def test_all_features_equal_pandas(readings, readings_pdf, freq, hot_rows):
    names = list(feat.FEATURES)
    got = stats.statistical_features(readings, "humidity", names, freq, auto_range=False, hot_rows=hot_rows)
    assert_close(rows_of(got, "device_id", "time"), expected(readings_pdf, freq, names), names)


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("freq", ["W", "ME", "MS", "7h", "h"])
def test_bucket_labels_equal_pandas(readings, readings_pdf, freq):
    names = ["mean", "q1"]
    got = stats.statistical_features(readings, "humidity", names, freq)
    assert_close(rows_of(got, "device_id", "time"), expected(readings_pdf, freq, names), names)


def test_hot_and_ordinary_groups_mix(readings, readings_pdf):
    names = ["median", "share_above_q3", "mad_median", "std"]
    # daily groups have about 20 to 80 rows: some are hot, some are not
    got = stats.statistical_features(readings, "humidity", names, "D", hot_rows=60)
    assert_close(rows_of(got, "device_id", "time"), expected(readings_pdf, "D", names), names)


def test_plan_has_no_hot_branch_when_nothing_is_hot(readings):
    df = stats.statistical_features(readings, "humidity", ["median"], "D")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "approx" not in final


def test_auto_range_and_rate(readings):
    got = rows_of(stats.statistical_features(readings, "humidity", ["max", "min"], "D"), "device_id", "time")
    assert list(got.columns) == ["device_id", "time", "max", "min", "range", "range_rate"]
    for _, part in got.groupby("device_id"):
        np.testing.assert_allclose(part["range"], part["max"] - part["min"])
        want = part["range"].pct_change(fill_method=None).fillna(0)
        np.testing.assert_allclose(part["range_rate"], want)
    plain = stats.statistical_features(readings, "humidity", ["max", "min"], "D", auto_range=False)
    assert plain.columns == ["device_id", "time", "max", "min"]


def test_localized_names_and_unknown_features(readings):
    got = stats.statistical_features(readings, "humidity", ["最大值", "nonsense", "最小值"], "D")
    assert got.columns == ["device_id", "time", "最大值", "最小值", "极差", "极差的时间变化率"]
    assert stats.statistical_features(readings, "humidity", ["nonsense"], "D").count() == 0
    assert stats.statistical_features(readings, "absent", ["mean"], "D").count() == 0


def test_empty_input_gives_empty_result(readings):
    empty = readings.limit(0)
    assert stats.statistical_features(empty, "humidity", list(feat.FEATURES), "D").count() == 0
    assert stats.volatility_features(empty, "humidity").count() == 0


@pytest.mark.filterwarnings("ignore")
def test_volatility_drops_undefined_buckets(readings, readings_pdf):
    names = list(feat.VOLATILITY_DEFAULT)
    got = rows_of(stats.volatility_features(readings, "humidity"), "device_id", "time")
    want = expected(readings_pdf, "D", names).dropna().reset_index(drop=True)
    assert_close(got, want, names)


def test_single_window(readings, readings_pdf):
    a, b = pd.Timestamp("2024-01-02"), pd.Timestamp("2024-01-04 12:00:00")
    got = rows_of(stats.single_window(readings, "humidity", a, b), "device_id")
    for _, row in got.iterrows():
        part = readings_pdf[(readings_pdf.device_id == row.device_id) & readings_pdf.time.between(a, b)].humidity
        for n in feat.SINGLE_WINDOW:
            np.testing.assert_allclose(row[n], PANDAS[n](part), rtol=1e-12, err_msg=n)
    total = stats.single_window(readings, "humidity", keys=()).toPandas()
    np.testing.assert_allclose(total["q3"][0], readings_pdf.humidity.quantile(0.75))
    hot = stats.single_window(readings, "humidity", keys=(), hot_rows=10).toPandas()
    np.testing.assert_allclose(hot[total.columns].values, total.values)


def test_registered_feature(readings, readings_pdf):
    stats.register_feature("total", lambda v: F.sum(v))
    got = rows_of(stats.statistical_features(readings, "humidity", ["total", "mean"], "D", fill=False), "device_id", "time")
    assert got["total"].sum() == pytest.approx(readings_pdf.humidity.sum())


@pytest.mark.filterwarnings("ignore")
def test_resample_methods_equal_pandas(readings, readings_pdf):
    for method in stats.AGG_METHODS:
        got = rows_of(stats.resample(readings, "6h", {"humidity": method}, ["device_id"]), "device_id", "time")
        want = []
        for device, part in readings_pdf.groupby("device_id"):
            r = part.set_index("time")[["humidity"]].resample("6h").agg({"humidity": method})
            r.insert(0, "device_id", device)
            want.append(r.reset_index())
        assert_close(got, pd.concat(want).reset_index(drop=True), ["humidity"])


def test_resample_defaults_follow_names(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:05:00' as time, 'x' as device_id, 1.0D as temperature, "
        "2.0D as `total_rainfall(10min)` union all "
        "select timestamp_ntz'2024-01-01 00:07:00', 'y', 3.0D, 5.0D"
    )
    got = stats.resample(df, "10min").collect()[0]
    assert got["device_id"] == "x" and got["temperature"] == 2.0 and got["total_rainfall(10min)"] == 7.0


@pytest.mark.parametrize("values", [
    [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, 1.0 + 2.0 ** -52],
    [2.0 ** k for k in range(-60, 60, 7)], [0.1 * k for k in range(-50, 50)], [7.0], [3.5] * 20])
def test_radix_selection_of_every_rank(spark, values):
    rows = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0), ("b", None), ("c", None)], "g string, v double")
    lo, hi = min(values), max(values)
    targets = spark.createDataFrame([("a", f"r{k}", k, lo, hi) for k in range(1, len(values) + 1)] + [("b", "r1", 1, 7.0, 7.0)],
                                    "g string, _pick string, _rank long, _lo double, _hi double")
    got = {(r["g"], r["_pick"]): r["v"] for r in order_stats.select_ranks(rows, ["g"], "v", targets).collect()}
    assert got == {**{("a", f"r{k + 1}"): v for k, v in enumerate(sorted(values))}, ("b", "r1"): 7.0}


def test_hot_infinite_values(spark):
    values = [float("-inf")] * 3 + [1.0, 2.0, 5.0] + [float("inf")] * 2
    rows = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    wanted = {"q1", "median", "q3", "p10"}
    hot = order_stats._hot(rows, ["g"], "v", wanted).select("g", *sorted(wanted)).collect()
    plain = order_stats._ordinary(rows, ["g"], "v", wanted).select("g", *sorted(wanted)).collect()
    assert str(hot) == str(plain)


def test_hot_single_row_and_missing_groups(spark):
    rows = spark.createDataFrame([("one", 3.0), ("none", None), ("two", 1.0), ("two", 2.0)], "g string, v double")
    wanted = sorted(order_stats.ORDER_FEATURES | order_stats.MOMENT_FEATURES)
    hot = order_stats._hot(rows, ["g"], "v", set(wanted)).select("g", *wanted).orderBy("g").collect()
    plain = order_stats.group_stats(rows, ["g"], "v", wanted).select("g", *wanted).orderBy("g").collect()
    assert hot == plain
    assert order_stats._hot(rows.limit(0), ["g"], "v", set(wanted)).collect() == []
