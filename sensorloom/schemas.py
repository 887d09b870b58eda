"""Schemas and ingest mappings of the known tables.

The names below are fixed values: they must match the exports and tables they
describe.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TABLES: dict[str, T.StructType] = {
    "sensor_temp_humidity": _schema(
        temple_id=T.StringType(),
        device_id=T.StringType(),
        time=T.TimestampType(),
        humidity=T.FloatType(),
        temperature=T.FloatType(),
        created_at=T.TimestampType(),
    ),
    "sensor_co2": _schema(
        temple_id=T.StringType(),
        device_id=T.StringType(),
        time=T.TimestampType(),
        co2_collected=T.FloatType(),
        co2_corrected=T.FloatType(),
        created_at=T.TimestampType(),
    ),
    "zcp_checkpoint_g1": _schema(
        time=T.TimestampType(),
        uninspected=T.IntegerType(),
        inspected=T.IntegerType(),
        digital_exhibition_center=T.IntegerType(),
        nine_storey_building_inspection=T.IntegerType(),
        small_archway_inspection=T.IntegerType(),
        en_route=T.IntegerType(),
        digital_exhibition_inspection=T.IntegerType(),
        total_ticket_sold=T.IntegerType(),
        created_at=T.TimestampType(),
    ),
    "temple_reception_stats": _schema(
        time=T.TimestampType(),
        real_time_headcount=T.IntegerType(),
        same_day_reception=T.IntegerType(),
        past_seven_days_reception=T.IntegerType(),
        dwell_time_range=T.StringType(),
        temple_id=T.StringType(),
        created_at=T.TimestampType(),
    ),
    "sensor_feature_data": _schema(
        temple_id=T.StringType(),
        device_id=T.StringType(),
        stats_start_time=T.TimestampType(),
        monitored_variable=T.StringType(),
        stats_cycle=T.StringType(),
        feature_key=T.StringType(),
        feature_value=T.StringType(),
        created_at=T.TimestampType(),
    ),
}

# Export header -> table column
CHECKPOINT_MAP = {
    "采集时间": "time",
    "未检票（人）": "uninspected",
    "已检票（人）": "inspected",
    "数展中心（人）": "digital_exhibition_center",
    "九层楼检票（人）": "nine_storey_building_inspection",
    "小牌坊检票（人）": "small_archway_inspection",
    "在途中（人）": "en_route",
    "数展检票（人）": "digital_exhibition_inspection",
    "总售票（人）": "total_ticket_sold",
}
RECEPTION_MAP = {
    "采集时间": "time",
    "实时人数": "real_time_headcount",
    "当日接待": "same_day_reception",
    "近七天接待": "past_seven_days_reception",
    "逗留时长": "dwell_time_range",
    "洞窟号": "temple_id",
}

# Sensor keyword in the export's file name -> table and column map
SENSOR_ROUTES = {
    "无线温湿度传感器": {
        "table": "sensor_temp_humidity",
        "columns": {"采集时间": "time", "空气温度（℃）": "temperature", "空气湿度（%）": "humidity"},
    },
    "无线二氧化碳传感器": {
        "table": "sensor_co2",
        "columns": {
            "采集时间": "time",
            "CO₂-校正值（ppm）": "co2_corrected",
            "CO₂-采集值（ppm）": "co2_collected",
        },
    },
}

# device id, temple number and sensor keyword in an export's file name
EXPORT_NAME_PATTERN = r"^([^_]+)_(\d+)窟_.*(无线温湿度传感器|无线二氧化碳传感器).*"
SHEET_YEARS = (2020, None)
RAW_TIME_COLUMN = "采集时间"
