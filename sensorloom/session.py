"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so that they can also be applied to a session that
# somebody else (spark-submit, a notebook, a test driver) created.
RUNTIME_CONF = {
    # stored times are UTC; local days go through from_utc_timestamp
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even if the following aggregate then has to
    # exchange (its map side is already combined, so that exchange is small)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # switched off for joins of bucketed tables only (sinks/bucketed.py)
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # GBK encoded CSV exports
    "spark.sql.legacy.javaCharsets": "true",
}

# Groups with more rows than this leave the one-task-per-group path.
HOT_GROUP_ROWS = "spark.sensorloom.hotGroupRows"
HOT_GROUP_ROWS_DEFAULT = 5_000_000

# Length of the time slices a long series is cut into for ordered work.
SLICE_SECONDS = "spark.sensorloom.sliceSeconds"
SLICE_SECONDS_DEFAULT = 3600


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "sensorloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` entries win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def hot_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_GROUP_ROWS, str(HOT_GROUP_ROWS_DEFAULT)))


def slice_micros(spark: SparkSession) -> int:
    return int(float(spark.conf.get(SLICE_SECONDS, str(SLICE_SECONDS_DEFAULT))) * 1_000_000)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; fall back to a scratch folder
    only where none is configured (single-machine tests)."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="sensorloom-ckpt-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the plan of what follows starts there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
