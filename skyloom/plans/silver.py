"""Silver builders: parse, quality chain, tags and contract, per feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalars import iso_utc_text, parse_instant, valid_time
from skyloom.operators.accumulation import increments_or_raise, null_without_window
from skyloom.operators.contracts import validate
from skyloom.operators.ordered import CHUNK_ROWS
from skyloom.operators.quality import MetricRule, quality_chain, range_only
from skyloom.operators.upserts import keep_last
from skyloom.profiles import (
    CONTRACTS,
    FIRE,
    FORECAST,
    GRID,
    MODEL_AIR,
    SATELLITE,
    STATION_AIR,
    WEATHER,
)
from skyloom.session import store

SORT_TIME = "_sort_time"
POOL_DAY = "_pool_day"


def build_series(
    rows: DataFrame,
    rules: Sequence[MetricRule],
    *,
    station: str,
    source: str,
    contract: str | None,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Station series to ``(silver, failure cases)``. Keys must already be unique: a reading
    polled twice would lengthen a run of equal values."""
    timed = rows.withColumn(SORT_TIME, parse_instant("timestamp"))
    out = quality_chain(
        timed, rules, groups=[station], order=[SORT_TIME, "timestamp"], chunk_rows=chunk_rows
    ).drop(SORT_TIME)
    tagged = out.withColumns({"source": F.lit(source), "is_synthetic": F.lit(0)})
    return validate(tagged, CONTRACTS.get(contract))


def silver_air(rows: DataFrame, contract: str | None = "cpcb", **kw) -> tuple[DataFrame, DataFrame]:
    return build_series(rows, STATION_AIR, station="station_id", source="cpcb", contract=contract, **kw)


def silver_weather(rows: DataFrame, source: str = "open-meteo-archive", **kw) -> tuple[DataFrame, DataFrame]:
    return build_series(rows, WEATHER, station="station", source=source, contract="weather", **kw)


def silver_model_air(rows: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    return build_series(
        rows, MODEL_AIR, station="city", source="cams-openmeteo-archive", contract="cams_aq", **kw
    )


def silver_fire(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Detections rarely repeat at a point, so the whole table is one series in time order.
    The order is total, and the series is cut into chunks like any other large group. What time
    leaves missing is filled from detections of the same day."""
    timed = rows.withColumn(SORT_TIME, parse_instant("timestamp")).withColumn(
        POOL_DAY, F.to_date(SORT_TIME)
    )
    out = quality_chain(
        timed,
        FIRE,
        order=[SORT_TIME, "lat", "lon", "satellite"],
        lat="lat",
        lon="lon",
        pool=[POOL_DAY],
        chunk_rows=chunk_rows,
    ).drop(SORT_TIME, POOL_DAY)
    tagged = out.withColumns(
        {
            "confidence_clean": F.col("confidence_raw"),
            "confidence_imputed": F.lit(0),
            "source": F.lit("firms"),
            "is_synthetic": F.lit(0),
        }
    )
    return validate(tagged, CONTRACTS["firms"])


def silver_grid(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Forecast grid: each point is its own series over valid time; points fill from points of
    their own cycle."""
    timed = rows.withColumn(SORT_TIME, parse_instant("valid_time"))
    out = quality_chain(
        timed,
        GRID,
        groups=["lat", "lon"],
        order=[SORT_TIME, "cycle", "fhr"],
        lat="lat",
        lon="lon",
        pool=["cycle"],
        chunk_rows=chunk_rows,
    ).drop(SORT_TIME)
    out = null_without_window(
        out,
        window="precipitation_window_h",
        values=["precipitation_raw", "precipitation_clean"],
        flag="precipitation_qc_flag",
        imputed="precipitation_imputed",
    )
    synthetic = (
        F.coalesce(F.col("is_synthetic").cast("int"), F.lit(0))
        if "is_synthetic" in rows.columns
        else F.lit(0)
    )
    tagged = out.withColumn("is_synthetic", synthetic).withColumn(
        "source",
        F.when(F.col("is_synthetic") == 1, F.lit("fallback_constant")).otherwise(F.lit("noaa")),
    )
    return validate(tagged, CONTRACTS["gfs"])


def silver_satellite(rows: DataFrame) -> DataFrame:
    """Satellite grid: range flags only, nothing filled, no contract."""
    return range_only(rows, SATELLITE).withColumns(
        {"source": F.lit("cams_open-meteo"), "is_synthetic": F.lit(0)}
    )


def silver_forecast(
    rows: DataFrame, run_totals: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """A forecast run to its ordered series with uniform 3-hour precipitation.

    ``rows``: ``cycle, fhr, lat, lon``, the instantaneous fields, ``bucket, span_h,
    constant_zero`` and ``fetched_at``.
    """
    made = increments_or_raise(rows, run_totals, out="precipitation_mm_3h").drop(
        "bucket", "span_h", "constant_zero"
    )
    timed = made.withColumn("valid_time", valid_time("cycle", F.col("fhr").cast("string")))
    out = quality_chain(
        timed,
        FORECAST,
        groups=["cycle", "lat", "lon"],
        order=["valid_time", "cycle"],
        lat="lat",
        lon="lon",
        pool=["cycle"],
        chunk_rows=chunk_rows,
    )
    at_analysis = F.col("fhr") == 0
    rain = "precipitation_mm_3h"
    final = {}
    for rule in FORECAST:
        value, flag, filled = F.col(rule.clean), F.col(rule.flag), F.col(rule.imputed) == 1
        if rule.column == rain:
            # The analysis hour has no interval: its rain is undefined, not missing.
            value = F.when(~at_analysis, value)
            flag = F.when(at_analysis, F.lit("no_accumulation_window")).otherwise(flag)
            filled = ~at_analysis & filled
        final[rule.column] = (value, flag, filled)
    columns: list[Column] = [
        iso_utc_text("valid_time").alias("valid_time"),
        F.col("cycle"),
        F.col("fhr").cast("smallint").alias("fhr"),
        F.col("lat"),
        F.col("lon"),
    ]
    for name, (value, flag, filled) in final.items():
        columns += [value.alias(name), flag.alias(f"{name}_qc_flag"), filled.alias(f"{name}_imputed")]
    columns += [F.lit("noaa").alias("source"), F.lit(False).alias("is_synthetic"), F.col("fetched_at")]
    return out.select(*columns)


def qc_with_context(
    batch: DataFrame,
    context: DataFrame,
    rules: Sequence[MetricRule],
    *,
    station: str,
    time: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Quality chain of a batch that can see the stored rows before it; only new rows return.

    A row fetched again replaces its stored copy first, so it is compared once. Time is text in
    any spelling; rows are ordered by the instant it names, unreadable times first.
    """
    raw = [r.column for r in rules]
    stored = context.select(*[c for c in batch.columns if c in context.columns])
    both = batch.withColumn("_is_new", F.lit(1)).unionByName(
        stored.withColumn("_is_new", F.lit(0)), allowMissingColumns=True
    )
    # Read by the count of the groups and by the windows.
    once = store(keep_last(both, [station, time], ["_is_new", *raw]).withColumn(SORT_TIME, parse_instant(time)), "once")
    out = quality_chain(once, rules, groups=[station], order=[SORT_TIME, time], chunk_rows=chunk_rows)
    return out.where(F.col("_is_new") == 1).drop("_is_new", SORT_TIME)


def run_status(
    got: Column, expected: Column, failures: Column
) -> Column:
    """Outcome of a fetch: nothing is a failure, a shortfall or a dropped row is partial."""
    return (
        F.when(got == 0, "failure")
        .when((got < expected) | (failures > 0), "partial")
        .otherwise("success")
    )
