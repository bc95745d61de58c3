"""Fixed values per feed: quality-control thresholds, contracts, stations and cities."""

from __future__ import annotations

from skyloom.operators.contracts import ColumnRule, Contract
from skyloom.operators.quality import MetricRule

# Box of the study area.
LAT_RANGE = (6.0, 37.0)
LON_RANGE = (68.0, 97.0)

# Quality-control thresholds per feed.
STATION_AIR = [
    MetricRule("pm25_raw", 0.0, 1000.0, 300.0, name="pm25"),
    MetricRule("pm10_raw", 0.0, 1500.0, 450.0, name="pm10"),
    MetricRule("no2_raw", 0.0, 1000.0, 200.0, name="no2"),
    MetricRule("so2_raw", 0.0, 1000.0, 200.0, name="so2"),
    MetricRule("co_raw", 0.0, 100.0, 20.0, name="co"),
    MetricRule("o3_raw", 0.0, 1000.0, 200.0, name="o3"),
]
MODEL_AIR = [
    MetricRule("pm25_ugm3", 0.0, 2000.0, 500.0, name="pm25"),
    MetricRule("pm10_ugm3", 0.0, 3000.0, 800.0, name="pm10"),
    MetricRule("no2_ugm3", 0.0, 1000.0, 300.0, name="no2"),
    MetricRule("so2_ugm3", 0.0, 1000.0, 300.0, name="so2"),
    MetricRule("co_ugm3", 0.0, 50000.0, 8000.0, name="co"),
    MetricRule("o3_ugm3", 0.0, 1000.0, 300.0, name="o3"),
]
WEATHER = [
    MetricRule("temperature_raw", -50.0, 60.0, 15.0, name="temperature"),
    MetricRule("humidity_raw", 0.0, 100.0, 50.0, name="humidity"),
    MetricRule("rainfall_raw", 0.0, 500.0, 100.0, ignore_zero_runs=True, name="rainfall"),
    MetricRule("wind_speed_raw", 0.0, 100.0, 30.0, name="wind_speed"),
    MetricRule("wind_dir_raw", 0.0, 360.0, 180.0, circular=True, name="wind_dir"),
]
GRID = [
    MetricRule("temperature_raw", -60.0, 60.0, 25.0, name="temperature"),
    MetricRule("precipitation_raw", 0.0, 500.0, 100.0, ignore_zero_runs=True, name="precipitation"),
    MetricRule("u_wind_raw", -150.0, 150.0, 50.0, name="u_wind"),
    MetricRule("v_wind_raw", -150.0, 150.0, 50.0, name="v_wind"),
]
FORECAST = [
    MetricRule("temperature_c", -60.0, 60.0, 25.0),
    MetricRule("u_wind_ms", -150.0, 150.0, 50.0),
    MetricRule("v_wind_ms", -150.0, 150.0, 50.0),
    MetricRule("precipitation_mm_3h", 0.0, 500.0, 200.0, ignore_zero_runs=True),
]
FIRE = [MetricRule("brightness_raw", 200.0, 600.0, 150.0, name="brightness")]
SATELLITE = [
    MetricRule("no2_ppb", 0.0, 500.0, name="no2"),
    MetricRule("so2_ppb", 0.0, 500.0, name="so2"),
    MetricRule("co_ppb", 0.0, 15000.0, name="co"),
    MetricRule("o3_ppb", 0.0, 500.0, name="o3"),
]
QC_PROFILES = {
    "station_air": STATION_AIR,
    "model_air": MODEL_AIR,
    "weather": WEATHER,
    "grid": GRID,
    "forecast": FORECAST,
    "fire": FIRE,
    "satellite": SATELLITE,
}


def _text(column: str, nullable: bool = False) -> ColumnRule:
    return ColumnRule(column, "string", nullable)


def _tags() -> list[ColumnRule]:
    return [_text("source"), ColumnRule("is_synthetic", "int", False, allowed=(0, 1))]


def _measure(column: str, low: float, high: float, nullable: bool = True) -> ColumnRule:
    return ColumnRule(column, "double", nullable, low, high)


# Data contracts per silver table.
CONTRACTS = {
    "cpcb": Contract("silver_air", [
        _text("station_id"), _text("city"), _text("timestamp"),
        _measure("pm25_raw", 0, 1000), _measure("pm10_raw", 0, 1500),
        _measure("no2_raw", 0, 1000), _measure("so2_raw", 0, 1000),
        _measure("co_raw", 0, 100), _measure("o3_raw", 0, 1000), *_tags(),
    ]),
    "weather": Contract("silver_weather", [
        _text("station"), _text("timestamp"),
        _measure("temperature_raw", -60, 60), _measure("humidity_raw", 0, 100),
        _measure("rainfall_raw", 0, 500), _measure("wind_speed_raw", 0, 100),
        _measure("wind_dir_raw", 0, 360), *_tags(),
    ]),
    "gfs": Contract("silver_grid", [
        _measure("lat", *LAT_RANGE, nullable=False), _measure("lon", *LON_RANGE, nullable=False),
        _text("cycle"), _text("fhr"),
        _measure("temperature_raw", -60, 60), _measure("precipitation_raw", 0, 500),
        ColumnRule("precipitation_window_h", "double", allowed=(3.0, 6.0), required=False),
        _measure("u_wind_raw", -150, 150), _measure("v_wind_raw", -150, 150), *_tags(),
    ]),
    "firms": Contract("silver_fire", [
        _measure("lat", *LAT_RANGE, nullable=False), _measure("lon", *LON_RANGE, nullable=False),
        _text("timestamp"), _measure("brightness_raw", 200, 600), _text("satellite", True), *_tags(),
    ]),
    "cams_aq": Contract("silver_model_air", [
        _text("city"), _text("timestamp"),
        _measure("pm25_ugm3", 0, 2000), _measure("pm10_ugm3", 0, 3000),
        _measure("no2_ugm3", 0, 1000), _measure("so2_ugm3", 0, 1000),
        _measure("co_ugm3", 0, 50000), _measure("o3_ugm3", 0, 1000), *_tags(),
    ]),
}

# Stations as (id, name, latitude, longitude).
STATIONS = [
    ("42369", "Lucknow", 26.77, 80.88),
    ("42339", "Jodhpur", 26.30, 73.02),
    ("42867", "Nagpur", 21.10, 79.05),
    ("43128", "Hyderabad", 17.45, 78.47),
    ("43279", "Chennai", 13.00, 80.18),
    ("42667", "Bhopal", 23.28, 77.35),
    ("42182", "Delhi", 28.58, 77.20),
    ("42647", "Ahmedabad", 23.07, 72.63),
    ("43295", "Bengaluru", 12.97, 77.58),
    ("42807", "Kolkata", 22.65, 88.45),
    ("43003", "Mumbai", 19.12, 72.85),
    ("42071", "Amritsar", 31.63, 74.87),
    ("42101", "Patiala", 30.34, 76.38),
]
# Cities with model air quality as (name, latitude, longitude).
CITIES = [
    ("delhi", 28.61, 77.21),
    ("mumbai", 19.08, 72.88),
    ("bengaluru", 12.97, 77.59),
    ("chennai", 13.08, 80.27),
    ("kolkata", 22.57, 88.36),
    ("lucknow", 26.85, 80.95),
    ("amritsar", 31.63, 74.87),
    ("patiala", 30.34, 76.38),
]
# Fixed values: (key, name, interval minutes, stale after minutes) of the monitored jobs.
JOBS = [
    ("cpcb", "CPCB Air Quality", 15, 30),
    ("firms", "FIRMS Active Fires", 20, 40),
    ("weather", "Open-Meteo Weather", 60, 120),
    ("gfs", "GFS Grid Forecast", 360, 720),
    ("sentinel5p", "Sentinel-5P TROPOMI", 1440, 2880),
    ("gold", "Medallion Gold Layer", 60, 120),
]
# Exported variable -> (unit, column suffix).
EXPORT_VARIABLES = {
    "temperature": ("degC", "c"),
    "u_wind": ("m s-1", "ms"),
    "v_wind": ("m s-1", "ms"),
    "precipitation": ("mm", "mm"),
}
HELD_BACK = ("precipitation",)
BURN_MONTHS = ("10", "11")
BELT = (29.0, 32.0, 74.0, 77.5)
MODEL_AIR_START = "2022-08-03"
