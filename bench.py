"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times over its whole tables; the median is
reported. Results are materialised by Spark's no-op sink, so nothing travels to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from skyloom.session import build_session

HEADLINE = [
    "scan_parquet",
    "table_scan_filter",
    "ts_coerce",
    "aqi_from",
    "json_feed_parse",
    "json_arrays_to_rows",
    "csv_payload_parse",
    "grid_message_scan",
    "qc_step",
    "qc_flatline",
    "qc_log_mad",
    "interpolate_linear",
    "knn_impute",
    "qc_chain",
    "qc_with_context",
    "validate_split",
    "upsert_last_wins",
    "insert_ignore_first_wins",
    "bronze_append_new",
    "city_aqi_hourly",
    "grid_hourly",
    "city_daily_summary",
    "silver_weather",
    "accum_increments",
    "unpivot_long",
    "fire_weather_daily",
    "spearman",
    "corr_by_year",
    "seasonal_anomaly_corr",
    "freshness_report",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from skyloom.plans.catalog import QUERIES

    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    seconds = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
