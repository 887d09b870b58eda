"""Watermarked per-bucket features and month-partitioned ingest of a stream.

Only features that combine incrementally are offered here; exact quantiles and
order-dependent features stay with the batch jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions import names
from sensorloom.functions.timebucket import parse_freq
from sensorloom.operators.slices import number
from sensorloom.sinks.tables import write_month_partitions


def windowed_features(
    stream: DataFrame, field: str, freq: str = "h", lateness: str = "2 hours",
    keys: Sequence[str] = ("device_id",), time: str = "time", threshold: float | None = None,
) -> DataFrame:
    """Mean, extremes, deviation and (with a threshold) share of high readings
    per key and bucket; readings later than ``lateness`` are dropped."""
    parsed = parse_freq(freq)
    if not parsed.aligned or parsed.kind != "fixed":
        raise ValueError("streaming buckets must divide a day")
    v = number(names.col(field))
    rows = stream.select(*keys, F.col(time).cast("timestamp").alias(time), v.alias("_v")).withWatermark(time, lateness)
    aggs = [F.avg("_v").alias("mean"), F.max("_v").alias("max"), F.min("_v").alias("min"), F.stddev_samp("_v").alias("std")]
    if threshold is not None:
        aggs.append((F.count_if(F.col("_v") > threshold) / F.count(F.lit(1))).alias("exposure_ratio"))
    bucket = F.window(time, f"{parsed.micros} microseconds")
    out = rows.groupBy(*keys, bucket.alias("_w")).agg(*aggs)
    return out.select(*keys, F.col("_w.start").alias(time), *[c for c in out.columns if c not in (*keys, "_w")])


def start_month_ingest(
    stream: DataFrame, path: str, checkpoint: str, time: str = "time", order: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream of readings to a month-partitioned folder and stop when
    the available input is consumed.  ``checkpoint`` must be a folder that all
    executors share.

    Each batch has a folder of its own, ``batch=<id>``, and replaces it: a
    batch that runs again after a failure leaves its rows once."""

    def append(batch: DataFrame, batch_id: int) -> None:
        write_month_partitions(batch, f"{path}/batch={batch_id}", time, order, "overwrite")

    return (
        stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
