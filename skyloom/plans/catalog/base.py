"""Registry and the shared bindings of the given tables to sensor-like frames."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import apply_runtime_conf, load_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the same result as plain SQL."""

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as sensor readings: users are stations, event types are cities."""
    e = load_table(spark, sf, "events")
    key, value = F.col("event_id"), F.col("value")
    return e.select(
        "event_id",
        "user_id",
        F.col("user_id").cast("string").alias("station_id"),
        F.col("event_type").alias("city"),
        "ts",
        "value",
        F.when(~(key % 7).isin(0, 1), value).alias("gappy"),
        F.when(key % 100 >= 60, value).alias("sparse"),
        F.floor(value / 40).cast("double").alias("coarse"),
        (value * 7 % 360).alias("bearing"),
        (6 + (F.col("user_id") % 125) * 0.25).alias("lat"),
        (68 + (F.col("user_id") * 31 % 117) * 0.25).alias("lon"),
        (key % 11 == 0).cast("int").alias("is_synthetic"),
        source_of(key).alias("source"),
        "props",
    )


def source_of(key: Column) -> Column:
    return F.when(key % 3 == 0, "cpcb").when(key % 3 == 1, "waqi").otherwise("cams")


# The same binding in SQL.
READINGS = """readings AS (
  SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS station_id, event_type AS city, ts, value,
    CASE WHEN event_id % 7 NOT IN (0, 1) THEN value END AS gappy,
    CASE WHEN event_id % 100 >= 60 THEN value END AS sparse,
    CAST(floor(value / 40) AS DOUBLE) AS coarse,
    value * 7 % 360 AS bearing,
    6 + (user_id % 125) * 0.25e0 AS lat,
    68 + (user_id * 31 % 117) * 0.25e0 AS lon,
    CAST(event_id % 11 = 0 AS INTEGER) AS is_synthetic,
    CASE event_id % 3 WHEN 0 THEN 'cpcb' WHEN 1 THEN 'waqi' ELSE 'cams' END AS source,
    props
  FROM events
)"""


def iso_text(ts: Column | str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')"
SECOND_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')"
HOUR_SQL = "strftime(ts, '%Y-%m-%dT%H:00:00+00:00')"
DATE_SQL = "strftime(ts, '%Y-%m-%d')"


# Breakpoints as (low, high, index low, index high).
SQL_BREAKPOINTS = {
    "pm25": [(0, 30, 0, 50), (30, 60, 51, 100), (60, 90, 101, 200), (90, 120, 201, 300), (120, 250, 301, 400), (250, 500, 401, 500)],
    "pm10": [(0, 50, 0, 50), (50, 100, 51, 100), (100, 250, 101, 200), (250, 350, 201, 300), (350, 430, 301, 400), (430, 600, 401, 500)],
}


def sub_index_sql(c: str, kind: str) -> str:
    """The piecewise index written out as SQL."""
    cases = " ".join(
        f"WHEN {c} >= {low} AND {c} <= {high} THEN (({to} - {base}) / ({high}e0 - {low})) * ({c} - {low}) + {base}"
        for low, high, base, to in SQL_BREAKPOINTS[kind]
    )
    return f"CASE WHEN {c} IS NULL OR {c} < 0 THEN NULL {cases} ELSE 500e0 END"


def index_sql(pm25: str, pm10: str, source: str) -> str:
    return (
        f"CASE WHEN lower(trim(coalesce({source}, 'cpcb'))) IN ('cpcb', 'waqi') "
        f"THEN greatest({pm25}, {pm10}) "
        f"ELSE greatest({sub_index_sql(pm25, 'pm25')}, {sub_index_sql(pm10, 'pm10')}) END"
    )


def category_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'unknown' WHEN {c} <= 50 THEN 'Good' "
        f"WHEN {c} <= 100 THEN 'Satisfactory' WHEN {c} <= 200 THEN 'Moderate' "
        f"WHEN {c} <= 300 THEN 'Poor' WHEN {c} <= 400 THEN 'Very Poor' ELSE 'Severe' END"
    )


def circular_sql(c: str) -> str:
    angle = f"degrees(atan2(avg(sin(radians({c}))), avg(cos(radians({c})))))"
    return f"CASE WHEN {angle} < 0 THEN {angle} + 360 ELSE {angle} END"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round aggregates, whose last bits depend on the order rows were added in."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
