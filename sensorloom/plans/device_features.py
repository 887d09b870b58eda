"""Feature job over all devices: scan, processors, one long table."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.operators.reshape import union_by_name
from sensorloom.plans.processors import PROCESSORS
from sensorloom.sources.tables import as_frame

logger = logging.getLogger(__name__)

# Default job: daily mean of humidity and temperature.
DEFAULT_PIPELINES = (
    {
        "processor": "statistical",
        "fields": ["humidity", "temperature"],
        "params": {"freq": "D", "metrics": ["均值"]},
    },
)

LONG_COLUMNS = ("temple_id", "device_id", "time", "field_name", "stats_cycle", "feature_key", "value")


def device_features(
    table,
    pipelines: Sequence[dict] = DEFAULT_PIPELINES,
    device_ids: Sequence[str] | None = None,
    id_column: str = "device_id",
    time: str = "time",
    temple: str = "temple_id",
    spark=None,
) -> DataFrame:
    """Long features of every device in one plan.

    Device and field are grouping keys, not loops: each processor adds one
    branch with one scan, whatever the number of devices and fields.  Each device carries the
    temple of its first reading.  Unknown processors and absent fields are
    skipped.
    """
    df = as_frame(spark, table)
    df = df.filter(names.col(id_column).isNotNull()).withColumnRenamed(id_column, "device_id")
    df = df.withColumnRenamed(time, "time")
    if device_ids is not None:
        df = df.filter(F.col("device_id").isin(list(device_ids)))
    parts = []
    for pipe in pipelines:
        handler = PROCESSORS.get(pipe["processor"])
        if handler is None:
            logger.warning("unknown processor %r is skipped", pipe["processor"])
            continue
        fields = [f for f in pipe["fields"] if f in df.columns]
        if not fields:
            continue
        params = dict(pipe.get("params", {}))
        ties = [c for c in params.get("tie", ()) if c not in ("device_id", "time")]
        # one scan serves all fields of a processor: the field is a key too
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), names.col(f).cast("double").alias("_value")) for f in fields]))
        rows = df.select("device_id", "time", *ties, each.alias("_f")).select("device_id", "time", *ties, "_f.field_name", "_f._value")
        parts.append(handler(rows, "_value", params, ["device_id", "field_name"]))
    if not parts:
        raise ValueError("no processor applies to the given fields")
    features = union_by_name(parts)
    if temple in df.columns:
        # first reading per device and temple combines map-side
        seen = df.groupBy("device_id", temple).agg(F.min("time").alias("_first"))
        first = seen.groupBy("device_id").agg(F.min_by(temple, "_first").alias("temple_id"))
        features = features.join(first, "device_id", "left")
    else:
        features = features.withColumn("temple_id", F.lit("unknown"))
    return features.select(*LONG_COLUMNS)
