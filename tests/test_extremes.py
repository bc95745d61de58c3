"""Queries against their SQL on values that the small tables do not reach."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from skyloom.plans.catalog import ORACLES, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.fixture(scope="module")
def high(spark, sf, tmp_path_factory):
    """The events of the smallest table, some with values up to 70,000."""
    folder = str(tmp_path_factory.mktemp("high"))
    e = spark.read.parquet(f"{sf}/events.parquet")
    key = F.col("event_id")
    value = F.when(key % 37 == 5, F.col("value") + 640).when(key == 100, 70000.0).otherwise(F.col("value"))
    e.withColumn("value", F.round(value, 2)).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["grid_message_scan", "select_by_level", "argmin_record", "forecast_assemble", "silver_air"])
def test_high_values(spark, high, name):
    duckdb = pytest.importorskip("duckdb")
    from check_oracle import compare

    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{high}/events.parquet/*.parquet'")
    verdict = compare(name, QUERIES[name](spark, high), ORACLES[name], db)
    assert verdict.startswith("ok"), verdict
