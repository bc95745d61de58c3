"""Streams that are stopped and begun again."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyloom.operators import upserts
from skyloom.plans import health
from skyloom.plans.catalog import QUERIES, features
from skyloom.profiles import CONTRACTS, STATION_AIR
from skyloom.schemas import RUN_LOG, SILVER_AIR
from skyloom.streaming import jobs

HOUR = "2026-01-0{}T{:02d}:00:00+00:00"


def log_rows(day):
    return [
        (f"{day}{h:02d}{s}", s, HOUR.format(day, h), HOUR.format(day, h), "success" if (h + len(s)) % 3 else "failure" if h % 2 else "partial", h * 10, None if h % 4 else "late")
        for h in range(0, 24, 2)
        for s in ("cpcb", "gfs")
    ]


@pytest.fixture
def sources(spark):
    return health.monitored(spark).select("source", "threshold_min")


def drive(spark, folder, path, sources, hours):
    log = spark.readStream.schema(RUN_LOG).option("maxFilesPerTrigger", 1).json(folder)
    for name, stream, mode, sink in (
        ("newest", jobs.newest_runs(log, ["run_started_at", "run_id"]), "update", jobs.newest_sink(spark, path, sources)),
        ("recent", log, "append", jobs.recent_sink(spark, path, hours)),
    ):
        run = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{path}/state-{name}")
        run.trigger(availableNow=True).start().awaitTermination()


def add(spark, folder, data):
    spark.createDataFrame(data, RUN_LOG).coalesce(1).write.mode("append").json(folder)


def test_freshness_after_a_restart_is_the_batch_report(spark, tmp_path, sources):
    folder, path = str(tmp_path / "log"), str(tmp_path / "kept")
    order = ["run_started_at", "run_id"]
    everything = []
    for days in ((2,), (3, 1), (4,)):  # day 1 comes late
        for day in days:
            add(spark, folder, log_rows(day))
            everything += log_rows(day)
        drive(spark, folder, path, sources, 24)
        log = spark.createDataFrame(everything, RUN_LOG)
        clock = log.agg(F.max("run_started_at").cast("timestamp")).first()[0]
        for hours, as_of in ((24, F.lit(clock)), (24, F.lit(clock) + F.expr("interval 7 hours")), (5, F.lit(clock))):
            want = health.freshness_report(log, sources, as_of, order=order, window_hours=hours)
            got = jobs.streamed_freshness(spark, path, sources, as_of, window_hours=hours)
            assert rows(got.select(want.columns), "source") == rows(want, "source")
    assert rows(jobs.streamed_freshness(spark, path, sources), "source") == rows(jobs.streamed_freshness(spark, path, sources, F.lit(clock)), "source")
    report = {r["source"]: r["freshness"] for r in spark.read.parquet(f"{path}/report").collect()}
    assert len(report) == 6 and report["firms"] == "NO SUCCESSFUL RUNS" and report["gfs"] == "HEALTHY"
    kept = spark.read.parquet(f"{path}/recent")
    assert kept.groupBy("slot").count().agg(F.max("count")).first()[0] <= 2 * 13  # a day of runs, not the log


def test_a_replayed_batch_changes_nothing(spark, tmp_path, sources):
    path = str(tmp_path / "kept")
    order = ["run_started_at", "run_id"]
    batches = [spark.createDataFrame(log_rows(day), RUN_LOG) for day in (1, 2, 3)]
    newest, recent = jobs.newest_sink(spark, path, sources), jobs.recent_sink(spark, path)
    for k, batch in enumerate([batches[0], batches[1], batches[1], batches[2], batches[2]]):
        batch_id = [0, 1, 1, 2, 2][k]
        sofar = spark.createDataFrame([r for day in range(1, batch_id + 2) for r in log_rows(day)], RUN_LOG)
        newest(jobs.newest_runs(sofar, order), batch_id)
        recent(batch, batch_id)
    want = health.freshness_report(sofar, sources, F.lit("2026-01-03T22:00:00").cast("timestamp"), order=order)
    assert rows(jobs.streamed_freshness(spark, path, sources).select(want.columns), "source") == rows(want, "source")


def test_failure_cases_of_two_streams_stay(spark, tmp_path):
    schema = "station_id string, city string, timestamp string, " + ", ".join(f"{m}_raw double" for m in ("pm25", "pm10", "no2", "so2", "co", "o3"))
    path, failures = str(tmp_path / "silver"), str(tmp_path / "failures")
    sink = jobs.silver_sink(
        spark, path, SILVER_AIR, STATION_AIR, CONTRACTS["cpcb"], station="station_id",
        tags={"source": "cpcb", "is_synthetic": 0}, failures_path=failures,
    )

    def stream(name, value):
        folder = str(tmp_path / f"in-{name}")
        one = [("7", "delhi", f"2026-01-01T{name}:00:00+00:00", value, 1.0, 1.0, 1.0, 1.0, 1.0), ("8", "agra", "soon", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
        spark.createDataFrame(one, schema).coalesce(1).write.mode("append").json(folder)
        run = spark.readStream.schema(schema).json(folder).writeStream.foreachBatch(sink)
        run.option("checkpointLocation", str(tmp_path / f"state-{name}")).trigger(availableNow=True).start().awaitTermination()

    stream("01", -5.0)
    stream("02", -6.0)  # its batch 0 is not the first stream's
    told = spark.read.parquet(failures)
    assert rows(told.groupBy("failed_check", "failed_value").count(), "failed_check", "failed_value") == [
        ("in_range(0, 1000)", "-5.0", 1), ("in_range(0, 1000)", "-6.0", 1), ("readable_time", "soon", 2)]
    stream("02", -7.0)  # goes on with batch 1 of the second one
    assert spark.read.parquet(failures).select("run_id").distinct().count() == 3


def test_a_checked_batch_is_not_deduplicated_again(spark, tmp_path, monkeypatch):
    """The context step leaves one row per key; the merge behind it takes them as they are."""
    again = []
    keep = upserts.keep_last
    monkeypatch.setattr(upserts, "keep_last", lambda *a: again.append(a) or keep(*a))
    schema = "station_id string, city string, timestamp string, " + ", ".join(f"{m}_raw double" for m in ("pm25", "pm10", "no2", "so2", "co", "o3"))
    path = str(tmp_path / "silver")
    sink = jobs.silver_sink(
        spark, path, SILVER_AIR, STATION_AIR, CONTRACTS["cpcb"], station="station_id",
        tags={"source": "cpcb", "is_synthetic": 0},
    )
    at = "2026-01-01T0{}:00:00+00:00"
    data = [("7", "delhi", at.format(h), float(v), 1.0, 1.0, 1.0, 1.0, 1.0) for h, v in ((1, 5), (2, 6), (1, 7), (1, 7))]
    for batch_id in (0, 1):
        sink(spark.createDataFrame(data, schema), batch_id)
        got = spark.read.parquet(path).select("timestamp", "pm25_raw")
        assert rows(got, "timestamp") == [(at.format(1), 7.0), (at.format(2), 6.0)]
    assert not again


def test_silver_grid_merges_its_rows_once(spark, sf, monkeypatch):
    """The chain reads its input twice, so the merge before it is stored."""
    given = []
    build = features.silver.silver_grid
    monkeypatch.setattr(features.silver, "silver_grid", lambda r: given.append(r) or build(r))
    assert QUERIES["silver_grid"](spark, sf).count()
    assert "Aggregate" not in given[0]._jdf.queryExecution().executedPlan().toString()
