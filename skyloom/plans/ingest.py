"""Whole runs: one batch from parsed rows to silver, and the rebuild of all gold tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.contracts import VIOLATIONS, Contract, check, split_checked
from skyloom.operators.ordered import CHUNK_ROWS
from skyloom.operators.quality import MetricRule
from skyloom.plans import gold
from skyloom.plans.silver import qc_with_context, run_status
from skyloom.schemas import SILVER_AIR, SILVER_GRID, SILVER_WEATHER
from skyloom.session import cut_lineage, scratch_scoped, store
from skyloom.sources.lake import (
    append_failures,
    context_window,
    log_run,
    observation_date,
    scan_table,
    unreadable_times,
    upsert_table,
)


@dataclass(frozen=True)
class Feed:
    """What one station feed needs to be ingested."""

    source: str
    table: str
    schema: T.StructType
    rules: Sequence[MetricRule]
    contract: Contract
    station: str


@scratch_scoped
def ingest_series(
    spark: SparkSession,
    batch: DataFrame,
    feed: Feed,
    root: str,
    *,
    expected: int,
    started_at: str,
    finished_at: str,
    days_back: int = 1,
    chunk_rows: int = CHUNK_ROWS,
    rejected: DataFrame | None = None,
) -> tuple[str, int, str | None]:
    """Quality control behind the stored days, contract, keyed upsert, failure cases, run log.

    Returns and logs ``(status, rows, error)``. A run whose every row breaks the contract
    fails and stores nothing; running it again changes nothing but the log. ``rejected`` are failure
    cases of bodies the parser set aside; they count as dropped. What is counted is observed in the
    passes that store the batch and the checked rows, not in passes of its own.
    """
    path = f"{root}/{feed.table}"
    run_id = hashlib.sha256(f"{feed.source}|{started_at}".encode()).hexdigest()[:32]
    seen, done, turned = Observation("batch"), Observation("checked"), Observation("rejected")
    readable = F.col("date").isNotNull()
    # One entry per station of the run.
    stations = F.size(F.collect_set(F.when(readable, F.col(feed.station))))
    dated = store(
        batch.withColumn("date", observation_date()).observe(
            seen, F.count_if(~readable).alias("unreadable"), F.min("date").alias("first"), F.max("date").alias("last"),
            stations.alias("stations"),
        )
    )
    n_unreadable, first, last, got = (seen.get[c] for c in ("unreadable", "first", "last", "stations"))
    lost = [unreadable_times(dated)]
    n_lost = n_unreadable
    if rejected is not None:
        lost.append(store(rejected.observe(turned, F.count(F.lit(1)).alias("n"))))
        n_lost += turned.get["n"]
    if not got:
        if n_lost:
            append_failures(f"{root}/contract_failures", feed.source, run_id, *lost)
        result = ("failure", 0, "no data retrieved")
        log_run(spark, f"{root}/run_log", feed.source, started_at, finished_at, result)
        return result
    stored = scan_table(spark, path, feed.schema, "date").where(F.col("date") >= first)
    before = context_window(scan_table(spark, path, feed.schema, "date"), first, days_back)
    context = before.where(F.col("date") < first).unionByName(stored.where(F.col("date") <= last))
    flagged = qc_with_context(
        dated.where(readable), context, feed.rules, station=feed.station, time="timestamp", chunk_rows=chunk_rows
    ).withColumns({"source": F.lit(feed.source), "is_synthetic": F.lit(0)})
    checked = store(
        check(flagged, feed.contract).observe(
            done, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(VIOLATIONS) > 0).alias("dropped")
        )
    )
    rows, dropped = done.get["rows"], done.get["dropped"]
    valid, failures = split_checked(checked)
    if dropped or n_lost:
        append_failures(f"{root}/contract_failures", feed.source, run_id, failures, *lost)
    if dropped == rows:
        result = ("failure", 0, f"none of {rows + n_lost} rows met the contract")
    else:
        upsert_table(
            spark, valid, path, feed.schema, partition="date", keys=[feed.station, "timestamp"],
            order=["timestamp"],
        )
        dropped, rows = dropped + n_lost, rows + n_lost
        status = spark.range(1).select(run_status(F.lit(got), F.lit(expected), F.lit(dropped))).first()[0]
        problems = []
        if got < expected:
            problems.append(f"fetched {got} of {expected}")
        if dropped:
            problems.append(f"{dropped} rows broke the contract")
        result = (status, rows - dropped, " | ".join(problems) or None)
    log_run(spark, f"{root}/run_log", feed.source, started_at, finished_at, result)
    return result


def build_all_gold(spark: SparkSession, root: str, computed_at: str) -> dict[str, int]:
    """Rebuild the gold tables from silver; a missing silver table skips what needs it.

    Returns the rows written per table.
    """
    at = F.lit(computed_at)
    air = scan_table(spark, f"{root}/cleaned_cpcb", SILVER_AIR)
    weather = scan_table(spark, f"{root}/cleaned_weather", SILVER_WEATHER)
    grid = scan_table(spark, f"{root}/cleaned_gfs", SILVER_GRID)
    plans = {
        "city_aqi_hourly": (air, gold.city_aqi_hourly(air, at), "date"),
        "gfs_grid_hourly": (grid, gold.grid_hourly(grid, at), "cycle"),
        "city_daily_summary": (air, gold.city_daily_summary(air, weather, at), "date"),
    }
    written = {}
    for name, (source, plan, partition) in plans.items():
        if source.isEmpty():
            written[name] = 0
            continue
        # Stored once, counted and written from there.
        table = cut_lineage(plan)
        gold.write_gold(table, f"{root}/gold/{name}", partition)
        written[name] = table.count()
    return written
