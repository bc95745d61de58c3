"""Gold features: hourly and daily air quality, grid summaries, daily weather join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.aggregates import circular_mean, first_by, sum_or_zero
from skyloom.functions.scalars import (
    air_quality_index,
    hour_bucket,
    index_category,
    parse_instant,
    utc_date,
    wind_speed,
)
from skyloom.schemas import GOLD_DAILY_WEATHER
from skyloom.sources.lake import overwrite_partitions

WEATHER_FEATURES = [f for f in GOLD_DAILY_WEATHER.fieldNames() if f not in ("city_key", "date")]
POLLUTANTS = ("pm25", "pm10", "no2", "so2", "co", "o3")


def measured(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Rows that are neither synthetic nor without a readable time, with ``ts`` and ``date``."""
    ts = F.col(timestamp) if dict(df.dtypes)[timestamp] == "timestamp" else parse_instant(timestamp)
    return (
        df.where(F.col("is_synthetic") == 0)
        .withColumn("ts", ts)
        .where(F.col("ts").isNotNull())
        .withColumn("date", utc_date("ts"))
    )


def city_key(name: str) -> Column:
    """Spelling-free join key of a place."""
    return F.lower(F.trim(name))


def city_aqi_hourly(air: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Hourly index per city; the category describes the maximum it stands beside."""
    rows = measured(air).where(F.col("city").isNotNull()).withColumns(
        {
            "hour_bucket": hour_bucket("ts"),
            "aqi": air_quality_index("pm25_clean", "pm10_clean", "source"),
        }
    )
    gold = rows.groupBy("city", "hour_bucket", "date").agg(
        F.avg("pm25_clean").alias("pm25_mean"),
        F.avg("pm10_clean").alias("pm10_mean"),
        F.avg("no2_clean").alias("no2_mean"),
        F.max("aqi").alias("aqi_max"),
        F.count_distinct("station_id").alias("n_stations"),
    )
    gold = gold.withColumn("aqi_category", index_category("aqi_max"))
    return gold if computed_at is None else gold.withColumn("computed_at", computed_at)


def grid_hourly(grid: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Summary per cycle and valid time; precipitation nobody measured stays NULL, not 0."""
    rows = grid.where(
        (F.col("is_synthetic") == 0)
        & F.col("cycle").isNotNull()
        & F.col("valid_time").isNotNull()
    )
    speed = wind_speed("u_wind_clean", "v_wind_clean") if "v_wind_clean" in grid.columns else F.col(
        "u_wind_clean"
    )
    gold = rows.groupBy("cycle", "valid_time").agg(
        F.avg("temperature_clean").alias("temp_mean"),
        F.max("temperature_clean").alias("temp_max"),
        F.min("temperature_clean").alias("temp_min"),
        F.sum("precipitation_clean").alias("precip_total"),
        F.avg(speed).alias("wind_speed_mean"),
        F.count("lat").alias("n_grid_points"),
    )
    return gold if computed_at is None else gold.withColumn("computed_at", computed_at)


def city_daily_pollution(air: DataFrame, first_order: Sequence[str] = ("ts", "station_id")) -> DataFrame:
    """Daily means per city; ``source`` is the day's first under an explicit order."""
    rows = measured(air).where(F.col("city").isNotNull())
    return rows.groupBy("city", "date").agg(
        *[F.avg(f"{p}_clean").alias(f"{p}_daily_mean") for p in POLLUTANTS],
        F.count("timestamp").alias("n_obs"),
        first_by("source", *first_order).alias("source"),
    )


def city_daily_weather(weather: DataFrame) -> DataFrame:
    """Daily weather per place; rain over a day without rain readings counts as 0."""
    rows = measured(weather).withColumn("city_key", city_key("station")).where(
        F.col("city_key").isNotNull()
    )
    return rows.groupBy("city_key", "date").agg(
        F.avg("temperature_clean").alias("temp_daily_mean"),
        F.max("temperature_clean").alias("temp_daily_max"),
        F.min("temperature_clean").alias("temp_daily_min"),
        F.avg("humidity_clean").alias("humidity_daily_mean"),
        sum_or_zero("rainfall_clean").alias("rainfall_daily_total"),
        F.avg("wind_speed_clean").alias("wind_speed_daily_mean"),
        circular_mean("wind_dir_clean", 6).alias("wind_dir_daily_mean"),
        F.count("timestamp").alias("n_weather_obs"),
    )


def join_daily(pollution: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Left join on place and day. Both sides are aggregated, so keys are unique and nothing is
    hinted: the planner sees the real sizes. Weather columns exist even with no weather."""
    if weather is None:
        weather = pollution.sparkSession.createDataFrame([], GOLD_DAILY_WEATHER)
    return (
        pollution.withColumn("city_key", city_key("city"))
        .join(weather.select("city_key", "date", *WEATHER_FEATURES), ["city_key", "date"], "left")
        .drop("city_key")
    )


def city_daily_summary(
    air: DataFrame,
    weather: DataFrame | None,
    computed_at: Column | None = None,
    first_order: Sequence[str] = ("ts", "station_id"),
) -> DataFrame:
    """Daily feature row per city; the index comes from the daily means."""
    daily = join_daily(
        city_daily_pollution(air, first_order),
        None if weather is None else city_daily_weather(weather),
    )
    daily = daily.withColumn(
        "daily_aqi", air_quality_index("pm25_daily_mean", "pm10_daily_mean", "source")
    ).withColumn("daily_aqi_category", index_category("daily_aqi"))
    return daily if computed_at is None else daily.withColumn("computed_at", computed_at)


def write_gold(df: DataFrame, path: str, partition: str) -> None:
    """Rebuild the partitions present; older ones stay."""
    overwrite_partitions(df, path, [partition])
