"""Sources and sinks on small files."""

import json

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.operators import cleaning, reshape
from sensorloom.plans import ingest
from sensorloom.schemas import TABLES
from sensorloom.session import configure
from sensorloom.sinks import facts, files as file_sinks, tables as table_sinks
from sensorloom.sources import files, json_records, points, tables


def test_gbk_folder_with_two_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("采集时间,温度\n2024-01-02 00:00:00,1.5\n#####,9\n".encode("gbk"))
    (tmp_path / "b.csv").write_bytes("采集时间,湿度,温度\n2024-01-01 00:00:00,50,2.5\n".encode("gbk"))
    (tmp_path / "skip.txt").write_text("x")
    df = files.read_csv_folder(spark, str(tmp_path), sort=True)
    got = df.toPandas()
    assert sorted(df.columns) == ["温度", "湿度", "采集时间"]
    assert got["温度"].tolist() == ["2.5", "1.5"] and got["湿度"].tolist() == ["50", None]
    (tmp_path / "201A_045窟 (1) 5%20.csv").write_bytes("采集时间,温度\n2024-01-03 00:00:00,3.5\n".encode("gbk"))
    assert files.read_csv_folder(spark, str(tmp_path), sort=True).toPandas()["温度"].tolist() == ["2.5", "1.5", "3.5"]
    same = files.read_csv_folder(spark, str(tmp_path), pattern="a.csv", same_header=True)
    assert same.count() == 1
    with pytest.raises(ValueError, match="no .* files"):
        files.read_csv_folder(spark, str(tmp_path), pattern="*.none")


def test_csv_folder_rejects(spark, tmp_path):
    (tmp_path / "good.csv").write_bytes('time,"y,z",x\n2024-01-01 00:00:00,"1,5",a\n2024-01-02 00:00:00,2\n'.encode("gbk"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "one line.csv").write_bytes(b"time,x")
    (tmp_path / "bad.csv").write_bytes(b"x,time\nb,2024-01-03 00:00:00\nc,when\nd,never\n\xff\xff,2024-01-04 00:00:00\ne,2024-01-05 00:00:00,9\n,\nx,time\n")
    rows, rejects = files.read_csv_folder_checked(spark, str(tmp_path), "time")
    got = {(r["file"].rsplit("/", 1)[1], r["reason"], r["n_lines"]) for r in rejects.collect()}
    assert got == {("empty.csv", "no header", 0), ("bad.csv", "time can't be read", 3), ("bad.csv", "undecodable characters", 1),
                   ("bad.csv", "more fields than the header", 1)}
    out = [(r["time"].day, r["y,z"], r["x"]) for r in rows.orderBy("time").collect()]
    assert out == [(1, "1,5", "a"), (2, "2", None), (3, None, "b")]
    none, rejects = files.read_csv_folder_checked(spark, str(tmp_path), "time", pattern="empty.csv")
    assert none.columns == ["_file"] and none.count() == 0 and rejects.count() == 1
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [line") == 1  # one scan of the lines for all layouts


def test_csv_series(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("﻿time,total_rainfall(10min)\n2024-01-01 00:10:00,1.5\n2024-01-01 00:00:00,\n", encoding="utf-8")
    df = files.read_csv_series(spark, str(path), required=["total_rainfall(10min)"])
    assert rows_of(df, "time")["total_rainfall(10min)"].tolist()[1] == 1.5
    with pytest.raises(ValueError, match="missing columns"):
        files.read_csv_series(spark, str(path), required=["humidity"])


def test_parquet_series_prunes_and_pushes_down(spark, readings, tmp_path):
    path = str(tmp_path / "p")
    readings.write.parquet(path)
    df = files.read_parquet_series(spark, path, "humidity", "2024-01-02", "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan and "temperature" not in plan
    lo, hi = df.agg(F.min("time"), F.max("time")).first()
    assert pd.Timestamp("2024-01-02") <= lo and hi <= pd.Timestamp("2024-01-03")


def sheet_folder(tmp_path):
    head = "采集时间,空气温度（℃）,空气湿度（%）\n"
    name = "20A4_045窟_无线温湿度传感器_x.csv"
    for sheet, lines in {"2023": "2023-05-01 00:00:00,10,50\n2023-05-01 00:10:00,坏,51\n", "2019": "2019-05-01 00:00:00,10,50\n",
                         "说明": "2023-05-01 00:00:00,10,50\n"}.items():
        folder = tmp_path / f"sheet={sheet}"
        folder.mkdir()
        (folder / name).write_text(head + lines, encoding="utf-8")
    (tmp_path / "sheet=2023" / "other.csv").write_text(head + "2023-05-01 00:00:00,1,1\n", encoding="utf-8")
    return str(tmp_path)


def test_sensor_export_ingest(spark, tmp_path):
    sheets = files.read_sheets(spark, sheet_folder(tmp_path))
    out = ingest.sensor_tables(sheets)
    got = out["sensor_temp_humidity"].collect()
    assert len(got) == 1 and got[0]["device_id"] == "20A4" and got[0]["temple_id"] == "045" and got[0]["humidity"] == 50.0
    assert out["sensor_temp_humidity"].columns == TABLES["sensor_temp_humidity"].names
    assert out["sensor_co2"].count() == 0


def test_counter_ingest(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "7.9", None), ("#####", "1", "2")], "`采集时间` string, `未检票（人）` string, `在途中（人）` string")
    got = ingest.checkpoint_counts(raw).collect()
    assert len(got) == 1 and got[0]["uninspected"] == 7 and got[0]["en_route"] == 0


def test_table_store_round_trip(spark, readings):
    spark.sql("drop database if exists io_test cascade")
    df = readings.withColumnRenamed("humidity", "humidity(%)")
    table_sinks.store_table(df, "io_test.readings", order=["device_id", "time"])
    table_sinks.store_table(df, "io_test.readings", order=["device_id", "time"])
    stored = spark.table("io_test.readings")
    assert stored.count() == 2 * readings.count() and "humidity" in stored.columns
    pruned = tables.scan_table("io_test.readings", "2024-01-02", "2024-01-03", spark=spark)
    assert "PartitionFilters: [isnotnull(yyyymm" in pruned._jdf.queryExecution().executedPlan().toString()
    want = readings.filter("time >= '2024-01-02' and time < '2024-01-03'").count()
    assert pruned.count() == 2 * want
    table_sinks.append_by_name(readings.limit(1).select("time", "device_id").withColumn("yyyymm", F.lit("202401")), "io_test.readings")
    with pytest.raises(ValueError, match="no columns"):
        table_sinks.append_by_name(readings.withColumn("extra", F.lit(1)), "io_test.readings")
    exported = {r["table"]: r["ddl"] for r in table_sinks.export_catalog(spark, ["io_test"]).collect()}
    assert "yyyymm" in exported["readings"]
    table_sinks.create_raw_tables(spark, "io_test")
    assert spark.table("io_test.sensor_co2").columns == [*TABLES["sensor_co2"].names, "yyyymm"]
    assert tables.run_sql(spark, "select count(*) n from sensor_co2", "io_test").first()["n"] == 0
    spark.catalog.setCurrentDatabase("default")
    spark.sql("drop database io_test cascade")


def test_fact_load(spark):
    spark.sql("drop database if exists facts_test cascade")
    long = spark.createDataFrame([("1", "a", pd.Timestamp("2024-01-01").to_pydatetime(), "humidity", "mean", 1.5)],
                                 "temple_id string, device_id string, time timestamp, field_name string, feature_key string, value double")
    facts.load_facts(long, "facts_test.sensor_feature_data")
    row = spark.table("facts_test.sensor_feature_data").first()
    assert row["feature_value"] == "1.5" and row["stats_cycle"] == "unknown" and row["created_at"] is not None
    assert facts.to_facts(long, "D", numeric_copy=True).first()["feature_number"] == 1.5
    spark.sql("drop database facts_test cascade")


def test_definitions(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "`a b` int, c double, d string, e boolean")
    assert table_sinks.column_definitions(df) == [("a_b", "Int32"), ("c", "Float64"), ("d", "String"), ("e", "UInt8")]
    assert "PARTITIONED BY (`yyyymm`)" in table_sinks.create_table_sql(df.schema, "x.y", "c")


def test_json_layouts_and_rejects(spark):
    docs = [
        (0, '{"data": [{"time": "2024-01-01T00:00:00+08:00", "v": 1.5}, {"time": "2024-01-01T01:00:00Z", "v": "Infinity"}]}'),
        (1, '[{"index": "2024-01-01T00:00:00", "v": null}]'),
        (2, '{"data": {"time": ["2024-01-01T00:00:00", "2024-01-01T01:00:00"], "v": [1, "-inf"]}}'),
        (3, '{"time": ["2024-01-01T00:00:00"], "v": ["NaN"]}'),
        (4, "{bad"), (5, ""), (6, None), (7, '{"data": [{"time": "2024-01-01T00:00:00", "w": 1}]}'), (8, '{"data": []}'),
    ]
    df = spark.createDataFrame(docs, "id int, data_json string")
    good, bad = json_records.parse_documents(df, ["v"], ids=["id"])
    got = [(r["id"], r["time"].isoformat(), r["v"]) for r in good.orderBy("id", "time").collect()]
    inf = float("inf")
    assert got == [(0, "2023-12-31T16:00:00", 1.5), (0, "2024-01-01T01:00:00", inf), (1, "2024-01-01T00:00:00", None),
                   (2, "2024-01-01T00:00:00", 1.0), (2, "2024-01-01T01:00:00", -inf), (3, "2024-01-01T00:00:00", None)]
    rejected = {r["id"]: (r["type"], r["message"]) for r in bad.collect()}
    assert rejected == {4: ("JSONParseError", "the document is not JSON"), 5: ("JSONParseError", "the document is empty"),
                        6: ("JSONParseError", "the document is empty"), 7: ("ValidationError", "Field not found: v"),
                        8: ("ValidationError", "the document has no rows")}


def test_json_content_errors(spark):
    docs = [
        (0, '{"data": [{"time": "2024-01-01", "v": 1}, {"time": "nonsense", "v": 2}, {"time": "x", "v": "abc"}]}'),
        (1, '{"data": [{"time": "2024-01-01", "v": "abc"}, {"time": null, "v": true}]}'),
        (2, '{"data": {"time": ["2024-01-01", "2024-01-02"], "v": [1]}}'),
        (3, '{"data": {"time": ["2024-01-01", "2024-01-02"], "v": [1, 2], "note": ["a"]}}'),
        (4, '{"data": [{"time": null, "v": "NaN"}, {"time": "2024-01-01", "v": null}, {"time": "2024-01-02", "v": " 7 "}]}'),
        (5, '{"data": [{"time": "2024-01-01", "v": {"a": 1}}]}'), (6, "{bad"), (7, '{"data": [{"time": "2024-01-01"}]}'), (8, "[]"), (9, "3"),
    ]
    good, bad = json_records.parse_documents(spark.createDataFrame(docs, "id int, data_json string"), ["v"], ids=["id"])
    assert [(r["id"], r["v"]) for r in good.orderBy("id", F.asc_nulls_first("time")).collect()] == [(4, None), (4, None), (4, 7.0)]
    got = {r["id"]: (r["type"], r["message"], json.loads(r["details"])) for r in bad.collect()}
    assert got == {
        0: ("ValidationError", "a time can't be read", {"row": 1, "column": "time", "value": "nonsense", "count": 3}),
        1: ("ValidationError", "not a number in field: v", {"row": 0, "column": "v", "value": "abc", "count": 2}),
        2: ("ValidationError", "columns differ in length", {"lengths": {"time": 2, "v": 1}}),
        3: ("ValidationError", "columns differ in length", {"lengths": {"note": 1, "time": 2, "v": 2}}),
        5: ("ValidationError", "not a number in field: v", {"row": 0, "column": "v", "value": '{"a":1}', "count": 1}),
        6: ("JSONParseError", "the document is not JSON", {}),
        7: ("ValidationError", "Field not found: v", {"missing_fields": ["v"]}),
        8: ("ValidationError", "the document has no rows", {}),
        9: ("ValidationError", "the document has no rows", {}),
    }
    none = spark.createDataFrame([], "id int, data_json string")
    assert [df.count() for df in json_records.parse_documents(none, ["v"], ids=["id"])] == [0, 0]


def test_json_files(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"data": [\n {"time": "2024-01-01T00:00:00", "v": 1}]}')
    good, _ = json_records.read_json_series(spark, str(tmp_path / "d.json"), ["v"])
    assert good.first()["v"] == 1.0
    (tmp_path / "l.json").write_text('{"v": 1}\n{oops\n')
    from pyspark.sql.types import LongType, StructField, StructType
    rows, rejects = json_records.read_json_rows(spark, str(tmp_path / "l.json"), StructType([StructField("v", LongType())]))
    assert [r["v"] for r in rows.collect()] == [1] and rejects.first()["details"] == "{oops"


def test_json_export(spark, tmp_path):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as time, double('NaN') as a, double('-Infinity') as b, 1.25D as c, 'q\"' as d, 3 as e, cast(null as string) as f")
    row = json.loads(file_sinks.to_json_rows(df).first()[0])
    assert row == {"time": "2024-01-01T00:00:00+00:00", "a": None, "b": "-Infinity", "c": 1.25, "d": 'q"', "e": 3, "f": None}
    file_sinks.write_json(df, str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first()[0]) == row
    doc = json.loads(file_sinks.to_feature_documents(df.select("time", "c")).first()[0])
    assert doc == {"features": [{"time": "2024-01-01T00:00:00+00:00", "c": 1.25}]}


def test_points(spark):
    raw = spark.createDataFrame([("2024/01/01 08:00", "1.5", "x", "A"), ("bad", "1", "1", "A")], "stamp string, h string, t string, dev string")
    pts = points.to_points(raw, "cave", ["h", "t"], ["dev"], "stamp", "yyyy/MM/dd HH:mm", "Asia/Shanghai")
    got = pts.collect()
    assert len(got) == 1 and got[0]["field"] == "h" and got[0]["tags"] == {"dev": "A"} and got[0]["time"] == pd.Timestamp("2024-01-01")
    assert points.scan_points(pts, "cave", "h", keys=["dev"]).first()["h"] == 1.5


def test_names():
    assert names.sanitize("total_rainfall(10min)") == "total_rainfall_10min"
    assert names.sanitize("空气湿度（%）") == "空气湿度"
    assert names.quote("`a(b)`") == "`a(b)`"
    aliases = {"humidity": ["RH", "湿度"], "temperature": ["RH"]}
    assert [names.resolve_alias(t, aliases) for t in ("humidity", "RH", "温度")] == ["humidity", "humidity", None]


def test_cleaning_and_reshape(spark):
    df = spark.createDataFrame([("1.5", "x"), ("a", "y"), ("2", None)], "v string, k string")
    assert [r["v"] for r in cleaning.coerce_numeric(df, ["v"]).collect()] == [1.5]
    nested = spark.sql("select named_struct('x', 1, 'y', 2) as a, 3 as b")
    assert reshape.flatten_names(nested).columns == ["a_x", "a_y", "b"]
    labelled = cleaning.add_source_label(df, "db", "t").first()["data_source"]
    assert labelled == "db.t"
    assert cleaning.add_metadata(df, device_id="A").first()["device_id"] == "A"


def test_month_tables_keep_appended_rows(spark, readings):
    spark.sql("DROP TABLE IF EXISTS month_append")
    half = readings.select("device_id", "time", "humidity")
    table_sinks.store_table(half.filter("device_id = 'A'"), "month_append", order=["device_id", "time"])
    table_sinks.append_by_name(half.filter("device_id <> 'A'"), "month_append", order=["device_id", "time"])
    lo, hi = half.agg(F.min("time"), F.max("time")).first()
    found = tables.scan_table("month_append", "2000-01-01", "2100-01-01", spark=spark)
    assert found.count() == half.count() and found.filter("yyyymm is null").count() == 0
    pruned = tables.scan_table("month_append", "2030-01-01", "2031-01-01", spark=spark)
    assert "PartitionFilters: [isnotnull(yyyymm" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="partitioned by month"):
        table_sinks.append_by_name(half.drop("time"), "month_append")
    spark.sql("DROP TABLE month_append")


def test_skipped_sheets_are_counted(spark, tmp_path):
    sheets = files.read_sheets(spark, sheet_folder(tmp_path))
    left = {(r["sheet"], r["reason"].split()[0]): r["rows"] for r in ingest.skipped_rows(sheets).collect()}
    assert left == {("2019", "sheet"): 1, ("说明", "sheet"): 1, ("2023", "file"): 1}
    assert ingest.skipped_rows(sheets, (2024, None)).agg(F.sum("rows")).first()[0] == 5


def test_tables_by_device_join_without_exchange(spark, readings, readings_pdf):
    from sensorloom.sinks import bucketed

    left, right = "by_device_left", "by_device_right"
    rows = readings.select("device_id", "time", "humidity")
    assert bucketed.store_by_device(rows.filter("device_id < 'C'"), left, rows_per_bucket=300) == 4
    assert bucketed.store_by_device(rows.filter("device_id >= 'C'").select("time", "humidity", "device_id"), left, buckets=9) == 4
    bucketed.store_by_device(readings.select("device_id", "time", "temperature"), right, buckets=4)
    joined = bucketed.join_stored(spark.table(left), spark.table(right))
    bucketed.join_by_buckets(spark)
    out = bucketed.daily(joined, {"n": F.count(F.lit(1)), "humidity": F.avg("humidity"), "temperature": F.max("temperature")})
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    configure(spark)
    got = out.toPandas().set_index(["device_id", "time"]).sort_index()
    want = readings_pdf.groupby(["device_id", readings_pdf.time.dt.floor("D")]).agg(n=("time", "size"), humidity=("humidity", "mean"), temperature=("temperature", "max"))
    assert (got.index == want.index).all() and (got.n == want.n).all() and np.allclose(got.temperature, want.temperature)
    # an unplanned table, rows without time or device, no rows
    odd = spark.createDataFrame([(None, None, 1.0), ("D", None, 2.0)], "device_id string, time timestamp_ntz, humidity double")
    bucketed.store_by_device(odd, left)
    bucketed.store_by_device(odd.limit(0), left)
    assert spark.table(left).count() == len(readings_pdf) + 2
    assert bucketed.join_stored(spark.table(left), spark.table(right)).count() == len(readings_pdf)
    assert bucketed.store_by_device(odd.limit(0), "by_device_empty") == 1 and spark.table("by_device_empty").count() == 0
    with pytest.raises(ValueError):
        bucketed.store_by_device(odd.withColumn(bucketed.DAY, F.lit(1)), left)


def test_observed_summary_equals_the_computed_one(spark, tmp_path):
    from sensorloom.operators.report import summary
    from sensorloom.plans.risk_job import store_results

    schema = "time timestamp_ntz, VP_in double, n int, diffusion_direction string, `odd.name` double"
    some = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) as time, if(id % 7 = 0, double('nan'), id / 3) as VP_in, "
                     "cast(id as int) as n, if(id % 4 = 0, '向内', if(id % 4 = 1, null, '向外')) as diffusion_direction, cast(null as double) as `odd.name` from range(50)")
    results = {"some": some, "single": some.limit(1), "empty": spark.createDataFrame([], schema)}
    stored, lines = store_results(spark, results, str(tmp_path))
    got = {tuple(x)[:4]: x["value"] for x in lines.collect()}
    assert got == {tuple(x)[:4]: x["value"] for x in summary(stored).collect()}
    assert got["some", "extent", "", "n_rows"] == "50" and got["empty", "extent", "", "n_rows"] == "0" and got["empty", "describe", "n", "mean"] is None
    assert got["some", "distribution", "向内", "n_rows"] == "13" and ("some", "distribution", "平衡", "n_rows") not in got
    assert got["some", "describe", "VP_in", "count"] == "42" and got["some", "describe", "n", "median"] == "24.5"
    assert float(got["some", "kpi", "", "inward_share"]) == 0.26 and got["empty", "kpi", "", "inward_share"] is None
    assert got["single", "describe", "n", "q1"] == "0.0" and got["some", "describe", "odd.name", "mean"] is None
