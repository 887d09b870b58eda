import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "sensorloom-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": "/tmp/sensorloom-test-warehouse-%d" % os.getpid(),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readings_pdf():
    """Three devices, irregular steps, gaps, missing values, repeated values."""
    rng = np.random.default_rng(7)
    frames = []
    for at, device in enumerate(("A", "B", "C")):
        n = 400 + 150 * at
        minutes = np.cumsum(rng.integers(1, 40, n))
        minutes[n // 2:] += 60 * 30  # more than a day without data
        time = pd.Timestamp("2024-01-01 00:03:00") + pd.to_timedelta(minutes, unit="min")
        value = np.round(60 + 8 * np.sin(np.arange(n) / 9) + rng.normal(0, 3, n), 1)
        value[rng.random(n) < 0.05] = np.nan
        frames.append(pd.DataFrame({"device_id": device, "temple_id": str(at), "time": time, "humidity": value,
                                    "temperature": np.round(15 + rng.normal(0, 2, n), 2)}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="session")
def readings(spark, readings_pdf):
    df = spark.createDataFrame(readings_pdf)
    return df.withColumn("time", df.time.cast("timestamp_ntz")).cache()


def rows_of(df, *order):
    return df.orderBy(*order).toPandas().reset_index(drop=True)
