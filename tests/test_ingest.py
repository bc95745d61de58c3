"""A whole run from parsed rows to gold, twice."""

from pyspark.sql import functions as F

from conftest import rows
from skyloom.plans.ingest import Feed, build_all_gold, ingest_series
from skyloom.profiles import CONTRACTS, STATION_AIR
from skyloom.schemas import RUN_LOG, SILVER_AIR
from skyloom.sources.lake import scan_table

FEED = Feed("cpcb", "cleaned_cpcb", SILVER_AIR, STATION_AIR, CONTRACTS["cpcb"], "station_id")


def parsed(spark, data):
    df = spark.createDataFrame(data, "station_id string, city string, timestamp string, pm25_raw double")
    return df.withColumns({f"{m}_raw": F.lit(1.0) for m in ("pm10", "no2", "so2", "co", "o3")})


def run(spark, root, data, expected=2):
    return ingest_series(spark, parsed(spark, data), FEED, root, expected=expected,
                         started_at="2026-01-02T00:00:00+00:00", finished_at="2026-01-02T00:01:00+00:00")


def test_runs_across_midnight(spark, tmp_path):
    root = str(tmp_path)
    day1 = [("7", "delhi", f"2026-01-01T{h:02d}:00:00+00:00", 100.0) for h in (21, 22, 23)] + [
        ("8", "agra", "2026-01-01T23:00:00+00:00", 50.0)]
    assert run(spark, root, day1) == ("success", 4, None)
    day2 = [("7", "delhi", "2026-01-02T00:00:00+00:00", 450.0), ("8", "agra", "2026-01-02T00:00:00+00:00", 1500.0)]
    expected = ("partial", 1, "1 rows broke the contract")
    assert run(spark, root, day2) == expected
    assert run(spark, root, day2) == expected
    stored = scan_table(spark, f"{root}/cleaned_cpcb", SILVER_AIR, "date")
    assert stored.count() == 5
    # The jump is seen although its prior reading lies in yesterday's partition.
    assert stored.where("date = '2026-01-02'").first()["pm25_qc_flag"] == "step_fail"
    assert run(spark, root, [("9", "x", "2026-01-03T00:00:00+00:00", -1.0)], 1)[0] == "failure"
    assert run(spark, root, [])[0] == "failure"
    log = rows(spark.read.schema(RUN_LOG).parquet(f"{root}/run_log").groupBy("status").count(), "status")
    assert log == [("failure", 2), ("partial", 2), ("success", 1)]
    failures = spark.read.parquet(f"{root}/contract_failures")
    assert rows(failures.select("failed_column").distinct()) == [("pm25_raw",)]

    for _ in range(2):
        written = build_all_gold(spark, root, "2026-01-03T00:00:00+00:00")
        assert written == {"city_aqi_hourly": 5, "gfs_grid_hourly": 0, "city_daily_summary": 3}
    daily = spark.read.parquet(f"{root}/gold/city_daily_summary")
    got = rows(daily.select(F.date_format("date", "yyyy-MM-dd"), "city", "daily_aqi", "daily_aqi_category",
                            "temp_daily_mean"), "date", "city")
    assert got == [("2026-01-01", "agra", 50.0, "Good", None), ("2026-01-01", "delhi", 100.0, "Satisfactory", None),
                   ("2026-01-02", "delhi", 450.0, "Severe", None)]


def test_rejected_bodies_count_as_dropped(spark, tmp_path):
    root = str(tmp_path)
    bad = spark.createDataFrame([("payload", "empty_body", "")], "failed_column string, failed_check string, failed_value string")
    good = parsed(spark, [("7", "delhi", "2026-01-01T10:00:00+00:00", 5.0), ("8", "agra", "soon", 5.0)])

    def once(batch):
        return ingest_series(spark, batch, FEED, root, expected=1, rejected=bad,
                             started_at="2026-01-02T00:00:00+00:00", finished_at="2026-01-02T00:01:00+00:00")

    assert once(good) == once(good) == ("partial", 1, "2 rows broke the contract")
    told = spark.read.parquet(f"{root}/contract_failures")
    assert rows(told.select("failed_check"), "failed_check") == [("empty_body",), ("readable_time",)]
    assert once(good.limit(0)) == ("failure", 0, "no data retrieved")
