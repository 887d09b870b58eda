"""Jobs, requests, metric catalog and the streaming variants."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sensorloom.operators import merge, report, stats
from sensorloom.plans import device_features, fetch, metrics, processors, requests, risk_job
from sensorloom.streaming import windowed


def batch(n, value):
    stamps = [str(t) for t in pd.date_range("2024-01-01", periods=n, freq="h")]
    return json.dumps({"data": {"time": stamps, "temperature": [value(i) for i in range(n)]}})


def test_batch_request(spark):
    answer = json.loads(requests.answer_json(spark, batch(24, lambda i: 20 + 0.5 * i), "temperature", ["均值", "最大值", "标准差"], "D"))
    row = answer["features"][0]
    assert row["均值"] == pytest.approx(25.75) and row["最大值"] == pytest.approx(31.5)
    assert row["标准差"] == pytest.approx(np.std(20 + 0.5 * np.arange(24), ddof=1)) and row["time"].startswith("2024-01-01")


def test_range_comes_with_max_and_min(spark):
    answer = json.loads(requests.answer_json(spark, batch(48, lambda i: 20 + i % 12), "temperature", ["最大值", "最小值"], "D"))
    assert [(r["极差"], r["极差的时间变化率"]) for r in answer["features"]] == [(11.0, 0.0), (11.0, 0.0)]


@pytest.mark.parametrize("data,field,features,freq,kind", [
    ("{bad", "t", ["均值"], "h", "JSONParseError"), ("", "t", ["均值"], "h", "JSONParseError"), (5, "t", ["均值"], "h", "JSONParseError"),
    (batch(3, float), "absent", ["均值"], "h", "ValidationError"), (batch(3, float), "temperature", ["均值"], "INVALID", "ValidationError"),
    (batch(3, float), "temperature", ["nonsense"], "h", "ValidationError"), (batch(3, float), "temperature", [], "h", "ValidationError"),
    (batch(3, float), "temperature", "均值", "h", "ValidationError"), (batch(3, float), "temperature", ["变异系数"], "h", "ValidationError")])
def test_error_answers(spark, data, field, features, freq, kind):
    answer = json.loads(requests.answer_json(spark, data, field, features, freq))
    assert answer["success"] is False and answer["error"]["type"] == kind and answer["error"]["message"]
    assert isinstance(answer["error"]["details"], dict)


def test_single_and_batch_requests_agree(readings):
    batch_result = rows_of(requests.feature_request(readings, "humidity", ["mean", "q3", "share_above_q3"], "D"), "device_id", "time")
    for request, column in ((requests.calculate_mean, "mean"), (requests.calculate_q3, "q3"), (requests.calculate_percent_above_q3, "share_above_q3")):
        one = rows_of(request(readings, "humidity", "D"), "device_id", "time")
        np.testing.assert_allclose(one[column].astype(float), batch_result[column].astype(float))
    ranged = requests.calculate_range(readings, "humidity", "D")
    assert ranged.columns == ["device_id", "time", "range", "range_rate"]
    with pytest.raises(requests.RequestError):
        requests.calculate_mean(readings, "absent", "D")


def test_round_trip_of_special_values(spark):
    docs = spark.createDataFrame([(1, '[{"time": "2024-01-01T00:00:00+08:00", "v": "inf"}, {"time": "2024-01-01T09:00:00+08:00", "v": 2.5}]')], "request_id int, data_json string")
    answers, rejects = requests.answer_documents(docs, "v", ["max"], "h")
    rows = json.loads(answers.first()["features_json"])["features"]
    assert rows[0] == {"time": "2023-12-31T16:00:00+00:00", "max": "Infinity"} and rows[-1]["max"] == 2.5
    assert [r["max"] for r in rows[1:-1]] == [None] * (len(rows) - 2) and rejects.count() == 0


def test_metric_catalog(spark):
    hours = pd.date_range("2024-01-01", "2024-03-01", freq="h")
    i = np.arange(len(hours))
    df = spark.createDataFrame(pd.DataFrame({"time": hours, "空气温度（℃）": 20.0 + i % 5, "空气湿度（%）": 50.0 + i % 10, "site_id": "001"}))
    for metric in metrics.CATALOG:
        assert metrics.run_metric(df, metric, keys=()).count() > 0
    part = metrics.run_metric(df, "humidity_daily", {"start_date": "2024-01-05", "end_date": "2024-01-10", "site_id": "001"}, keys=())
    times = [r["time"] for r in part.select("time").collect()]
    assert min(times) == pd.Timestamp("2024-01-05") and max(times) == pd.Timestamp("2024-01-10")
    assert metrics.run_metric(df, "humidity_daily", {"site_id": "999"}, keys=()).count() == 0
    assert metrics.run_intents(df, [{"metric_id": "humidity_trend"}, {"metric_id": "temperature_daily", "freq": "W"}], keys=()).count() > 0
    assert metrics.catalog_frame(spark).count() == 4
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.run_metric(df, "nope")


def test_device_features(readings, readings_pdf):
    pipes = [{"processor": p, "fields": ["humidity"], "params": {"metrics": ["mean", "std"]} if p in ("statistical", "volatility") else {}}
             for p in processors.PROCESSORS]
    out = device_features.device_features(readings.na.drop(), pipes)
    assert out.columns == list(device_features.LONG_COLUMNS)
    assert {r["device_id"]: r["temple_id"] for r in out.select("device_id", "temple_id").distinct().collect()} == {"A": "0", "B": "1", "C": "2"}
    keys = {r[0] for r in out.select("feature_key").distinct().collect()}
    assert {"mean", "std", "main_period_1_hours", "total_exposure_hours", "rainfall_peak"} <= keys
    only = device_features.device_features(readings, device_ids=["B"])
    assert {r[0] for r in only.select("device_id").distinct().collect()} == {"B"}


def test_gradient_processor(readings):
    inside = readings.filter("device_id = 'A'").select("time", "temperature", "humidity")
    outside = inside.select("time", F.lit(1.0).alias("avg_vapor_pressure"))
    keys = processors.vapor_pressure_gradient(inside, outside, {}).select("feature_key").distinct().collect()
    assert {r[0] for r in keys} == {"VP_in", "VP_out", "delta_VP", "diffusion_direction"}


def test_risk_job(spark, tmp_path):
    n = 6 * 24 * 5
    i = np.arange(n)
    pdf = pd.DataFrame({"time": pd.date_range("2024-01-01", periods=n, freq="10min").astype(str), "temperature": 15 + np.sin(i / 50), "humidity": 55 + 12 * np.sin(i / 70),
                        "avg_vapor_pressure": 1 + 0.2 * np.cos(i / 90), "total_rainfall(10min)": np.where(i % 97 < 5, 0.5, 0.0)})
    path = str(tmp_path / "in.csv")
    pdf.to_csv(path, index=False)
    config = risk_job.default_config(path, path, path, path)
    config["high_humidity_exposure"]["threshold"] = 50.0
    config["rainfall_intensity"].update({"rainfall_column": "total_rainfall(10min)", "window": "1h"})
    stored = risk_job.run_risk_job(spark, config, str(tmp_path / "out"))
    assert set(stored) == {"vapor_pressure_gradient", "high_humidity_exposure", "rainfall_intensity", "correlation_analysis"}
    day = stored["high_humidity_exposure"].orderBy("time").first()
    assert day["total_exposure_hours"] == pytest.approx((pdf.humidity[:144] > 50).sum() / 6) and day["exposure_ratio"] == pytest.approx((pdf.humidity[:144] > 50).mean())
    assert stored["correlation_analysis"].first()["n_samples"] == 5
    lines = spark.read.option("header", True).csv(str(tmp_path / "out" / "summary_report"))
    kpi = {(r["feature"], r["metric"]): r["value"] for r in lines.filter("section = 'kpi'").collect()}
    assert float(kpi[("rainfall_intensity", "total_rainfall")]) == pytest.approx(pdf["total_rainfall(10min)"].sum())
    config["rainfall_intensity"]["rainfall_column"] = "absent"
    left = risk_job.risk_features(config, risk_job.csv_loader(spark))
    assert set(left) == {"vapor_pressure_gradient", "high_humidity_exposure"}
    assert risk_job.risk_features({}, risk_job.csv_loader(spark)) == {}


def test_fetch_config():
    assert fetch.config_problems({}) and fetch.config_problems({"data_sources": "x"})
    assert fetch.config_problems({"data_sources": [{"database": "d", "table": "t"}]}) == ["data_sources[0] misses key: fields"]
    assert fetch.config_problems({"data_sources": [{"database": "d", "table": "t", "fields": ["time"]}]}) == []


def test_describe_equals_pandas(readings, readings_pdf):
    got = report.describe(readings, ["humidity", "temperature"]).toPandas().set_index("column_name")
    want = readings_pdf[["humidity", "temperature"]].describe()
    for c in want.columns:
        np.testing.assert_allclose(got.loc[c, ["count", "mean", "std", "min", "q1", "median", "q3", "max"]].astype(float), want[c].values)


def test_streaming_matches_batch(spark, readings, tmp_path):
    source = str(tmp_path / "in")
    late = readings.select("device_id", F.lit(pd.Timestamp("2030-01-01")).cast("timestamp_ntz").alias("time"), "humidity").limit(1)
    readings.select("device_id", "time", "humidity").union(late).repartition(1).write.parquet(source)
    stream = spark.readStream.schema("device_id string, time timestamp_ntz, humidity double").parquet(source)
    out = windowed.windowed_features(stream, "humidity", "D", "1 hour", threshold=60.0)
    query = out.writeStream.format("memory").queryName("windowed").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = rows_of(spark.table("windowed").filter("time < '2029-01-01'"), "device_id", "time")
    want = rows_of(stats.statistical_features(readings, "humidity", ["mean", "std"], "D", fill=False), "device_id", "time")
    np.testing.assert_allclose(got["mean"].astype(float), want["mean"].astype(float))
    with pytest.raises(ValueError):
        windowed.windowed_features(stream, "humidity", "W")
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    windowed.start_month_ingest(stream, target, state).awaitTermination(120)
    stored = spark.read.parquet(target)
    assert stored.count() == readings.count() + 1 and "yyyymm" in stored.columns and "batch" in stored.columns
    assert not math.isnan(stored.filter("yyyymm = 202401").count())


def _sources(spark):
    """Repeated times, a missing time, columns that clash, a source without own columns and an empty one."""
    a = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13)], "time int, x int")
    b = spark.createDataFrame([(1, 20, 0), (1, 21, 0), (3, 22, 0), (None, 23, 0)], "time int, `y.z` int, x int")
    c = spark.createDataFrame([(1,), (3,), (4,), (4,)], "time int")
    d = spark.createDataFrame([(1, 40), (2, 41), (4, 42)], "time int, w int")
    return [a, b, c, d, d.limit(0).withColumnRenamed("w", "e")]


@pytest.mark.parametrize("how", merge.MERGE_TYPES)
@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_merge_equals_a_fold_of_joins(spark, how, n):
    frames = _sources(spark)[:n]
    want = frames[0]
    for frame in frames[1:]:
        new = [c for c in frame.columns if c == "time" or c not in want.columns]
        want = want.join(frame.select(*[f"`{c}`" for c in new]), ["time"], how)
    got = merge.merge_on_time(frames, "time", how)
    assert sorted(got.columns) == sorted(want.columns)
    order = [f"`{c}`" for c in sorted(want.columns)]
    assert sorted(map(tuple, got.select(*order).collect()), key=repr) == sorted(map(tuple, want.select(*order).collect()), key=repr)


def test_merge_exchanges_once(spark):
    frames = _sources(spark)[:4]
    plan = merge.merge_on_time(frames, "time", "outer")._jdf.queryExecution().sparkPlan().toString()
    text = merge.merge_on_time(frames, "time", "outer")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in plan
