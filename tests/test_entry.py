import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.columns == ["device_id", "time", "feature_key", "value", "stats_cycle"] and out.count() > 0
