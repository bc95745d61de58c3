"""A third of all rows in one group: results must not depend on where groups are cut."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyloom.operators.correlation import correlate
from skyloom.operators.quality import MetricRule, flag_log_mad, quality_chain
from skyloom.operators.upserts import keep_last
from skyloom.plans.catalog.base import readings


@pytest.fixture(scope="module")
def hot(spark, sf):
    """The event table with a third of its rows moved to one station, a burst inside it."""
    r = readings(spark, sf)
    key = F.col("event_id")
    burst = F.when(key % 3 == 0, F.timestamp_seconds(F.unix_seconds("ts") % 900 + 1704067200)).otherwise(F.col("ts"))
    return r.withColumns(
        {"station_id": F.when(key % 3 == 0, "hot").otherwise(F.col("station_id")), "ts": burst}
    ).cache()


RULES = [
    MetricRule("gappy", 5.0, 300.0, 100.0, name="level"),
    MetricRule("bearing", 0.0, 350.0, 90.0, circular=True, name="dir"),
    MetricRule("coarse", 0.0, 1000.0, None, flat_window=4, name="step"),
    MetricRule("sparse", name="sparse"),
]


@pytest.mark.parametrize("groups", [["station_id"], []])
def test_chain_is_the_same_whole_and_cut(hot, groups):
    columns = ["event_id", *[c for r in RULES for c in (r.clean, r.flag, r.imputed)]]

    def run(limit):
        return rows(
            quality_chain(hot, RULES, groups=groups, order=["ts", "event_id"], chunk_rows=limit).select(columns), "event_id"
        )

    assert run(25) == run(4_000_000)


def test_robust_outliers_are_the_same_whole_and_cut(hot):
    def run(limit):
        return rows(flag_log_mad(hot, "value", ["station_id"], chunk_rows=limit).select("event_id", "mad_outlier"), "event_id")

    assert run(40) == run(4_000_000)


def test_rank_correlation_is_the_same_whole_and_cut(hot):
    def run(limit):
        out = correlate(hot, "value", "coarse", ["source"], chunk_rows=limit)
        return rows(out.select("source", "n", F.round("pearson", 9), F.round("spearman", 9)), "source")

    assert run(30) == run(4_000_000)


def test_copies_of_one_key_are_combined_before_the_shuffle(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    out = keep_last(df, ["k"], ["id"])
    assert out.count() == 20001 and out.where("k = 0").first()["id"] == 29997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
