"""Explicit schemas and unique keys of the tables of the lake."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def _schema(*pairs: str) -> T.StructType:
    fields = [pair.split() for pair in pairs]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def _four(metrics: list[str], raw: str = "raw") -> list[str]:
    out = []
    for m in metrics:
        out += [f"{m}_{raw} double", f"{m}_clean double", f"{m}_imputed int", f"{m}_qc_flag string"]
    return out


_TAGS = ["source string", "is_synthetic int"]
_AIR = ["pm25", "pm10", "no2", "so2", "co", "o3"]

BRONZE_PAYLOAD = _schema(
    "payload_ts string", "payload string", "payload_hash string", *_TAGS, "date string"
)
SILVER_AIR = _schema("station_id string", "city string", "timestamp string", *_four(_AIR), *_TAGS)
SILVER_WEATHER = _schema(
    "station string", "timestamp string",
    *_four(["temperature", "humidity", "rainfall", "wind_speed", "wind_dir"]), *_TAGS,
)
SILVER_GRID = _schema(
    "lat double", "lon double", "cycle string", "fhr string", "valid_time string",
    "fetched_at string", *_four(["temperature", "precipitation", "u_wind", "v_wind"]),
    "precipitation_window_h int", *_TAGS,
)
SILVER_FIRE = _schema(
    "lat double", "lon double", "timestamp string", *_four(["brightness"]),
    "confidence_raw string", "confidence_clean string", "confidence_imputed int",
    "satellite string", *_TAGS,
)
SILVER_SATELLITE = _schema(
    "lat double", "lon double", "timestamp string",
    *[f"{m}_{p}" for m in ("no2", "so2", "co", "o3")
      for p in ("ppb double", "clean double", "qc_flag string")],
    "fetched_at string", *_TAGS,
)
SILVER_MODEL_AIR = _schema(
    "city string", "lat double", "lon double", "timestamp string", *_four(_AIR, "ugm3"), *_TAGS
)
RUN_LOG = _schema(
    "run_id string", "source string", "run_started_at string", "run_finished_at string",
    "status string", "rows_inserted bigint", "error_message string",
)
GOLD_DAILY_WEATHER = _schema(
    "city_key string", "date string", "temp_daily_mean double", "temp_daily_max double",
    "temp_daily_min double", "humidity_daily_mean double", "rainfall_daily_total double",
    "wind_speed_daily_mean double", "wind_dir_daily_mean double", "n_weather_obs bigint",
)

# Unique keys per table.
KEYS = {
    "bronze_payload": ["payload_ts", "payload_hash"],
    "silver_air": ["station_id", "timestamp"],
    "silver_weather": ["station", "timestamp"],
    "silver_grid": ["lat", "lon", "cycle", "fhr"],
    "silver_fire": ["lat", "lon", "timestamp", "satellite"],
    "silver_satellite": ["lat", "lon", "timestamp"],
    "silver_model_air": ["city", "timestamp"],
}
