"""Payload tables to rows: nested JSON, hourly arrays, CSV bodies, mixed sensors.

Each ``split_*`` gives the rows and, apart from them, failure cases of the bodies that are empty, cannot
be read or are of another kind, such as an error message; ``parse_*`` gives the rows alone. Both frames
are plans over the same bodies: store these first where parsing twice costs more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalars import acquisition_time, iso_normalise, missing_to_null

AIR_METRICS = ("pm25", "pm10", "no2", "so2", "co", "o3")
# Archive variable -> column.
WEATHER_VARIABLES = {
    "temperature_2m": "temperature_raw",
    "relative_humidity_2m": "humidity_raw",
    "precipitation": "rainfall_raw",
    "wind_speed_10m": "wind_speed_raw",
    "wind_direction_10m": "wind_dir_raw",
}
MODEL_AIR_VARIABLES = {
    "pm2_5": "pm25_ugm3",
    "pm10": "pm10_ugm3",
    "nitrogen_dioxide": "no2_ugm3",
    "sulphur_dioxide": "so2_ugm3",
    "carbon_monoxide": "co_ugm3",
    "ozone": "o3_ugm3",
}
SATELLITE_VARIABLES = {
    "nitrogen_dioxide": "no2_ppb",
    "sulphur_dioxide": "so2_ppb",
    "carbon_monoxide": "co_ppb",
    "ozone": "o3_ppb",
}
FIRE_CSV = (
    "latitude string, longitude string, brightness string, acq_date string, acq_time string, "
    "satellite string, confidence string"
)


_CORRUPT = "_corrupt"
#: So much of a rejected body goes into its failure case; the whole body stays in bronze.
PREVIEW = 200


def read_json(df: DataFrame, payload: str, schema: str, needed: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``_body`` and ``_rejected``, the name of the check a body fails, NULL for a good one.

    ``needed`` tells from the body whether it is of the expected kind. A body that merely holds
    values of the wrong type is good; these values are NULL.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    body = df.withColumn("_body", F.from_json(payload, f"{schema}, {_CORRUPT} string", options))
    expected = F.coalesce(needed(F.col("_body")), F.lit(False))
    blank = F.coalesce(F.rlike(F.col(payload), F.lit(r"^\s*$")), F.lit(True))
    return body.withColumn(
        "_rejected",
        F.when(expected, F.lit(None).cast("string"))
        .when(blank, "empty_body")
        .when(F.col(f"_body.{_CORRUPT}").isNotNull(), "readable_json")
        .otherwise("expected_fields"),
    )


def rejected_bodies(judged: DataFrame, payload: str, keep: Sequence[str]) -> DataFrame:
    """Failure cases of the bodies that were set aside, with their beginning."""
    return judged.where(F.col("_rejected").isNotNull()).select(
        *keep,
        F.lit(payload).alias("failed_column"),
        F.col("_rejected").alias("failed_check"),
        F.substring(payload, 1, PREVIEW).alias("failed_value"),
    )


def _split(judged: DataFrame, payload: str, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return judged.where(F.col("_rejected").isNull()), rejected_bodies(judged, payload, keep)


def split_station_feed(
    df: DataFrame, payload: str = "payload", *, fetched_at: Column, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(readings, rejected)``: one reading per feed body that names its station; the time falls back
    to ``s`` and then to the fetch time."""
    schema = (
        "idx string, query_city string, time struct<iso:string,s:string>, "
        "iaqi map<string,struct<v:double>>"
    )
    body, rejected = _split(read_json(df, payload, schema, lambda b: F.trim(b["idx"]) != ""), payload, keep)
    stamp = F.coalesce(
        F.nullif(F.col("_body.time.iso"), F.lit("")),
        F.nullif(F.col("_body.time.s"), F.lit("")),
        fetched_at,
    )
    readings = body.select(
        *keep,
        F.col("_body.idx").alias("station_id"),
        F.coalesce(F.col("_body.query_city"), F.lit("")).alias("city"),
        stamp.alias("timestamp"),
        *[
            missing_to_null(F.col("_body.iaqi").getItem(m)["v"]).alias(f"{m}_raw")
            for m in AIR_METRICS
        ],
    )
    return readings, rejected


def parse_station_feed(df: DataFrame, payload: str = "payload", **options) -> DataFrame:
    """The readings of ``split_station_feed``."""
    return split_station_feed(df, payload, **options)[0]


def split_current(
    df: DataFrame, payload: str = "payload", *, fetched_at: Column, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)``: one row per body with a flat ``current`` object; no time means the fetch
    time."""
    fields = ", ".join(f"{v}: double" for v in WEATHER_VARIABLES)
    schema = f"current struct<time: string, {fields}>"
    body, rejected = _split(read_json(df, payload, schema, lambda b: b["current"].isNotNull()), payload, keep)
    rows = body.select(
        *keep,
        F.coalesce(F.col("_body.current.time"), fetched_at).alias("timestamp"),
        *[
            missing_to_null(F.col(f"_body.current.{v}")).alias(c)
            for v, c in WEATHER_VARIABLES.items()
        ],
    )
    return rows, rejected


def parse_current(df: DataFrame, payload: str = "payload", **options) -> DataFrame:
    """The rows of ``split_current``."""
    return split_current(df, payload, **options)[0]


def split_hourly(
    df: DataFrame,
    variables: dict[str, str],
    payload: str = "payload",
    *,
    keep: Sequence[str] = (),
    drop_empty: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)``: column-oriented hourly arrays to one row per hour.

    A missing, empty or short array leaves NULLs. ``drop_empty`` removes hours with no value
    at all. A body without a ``time`` array is rejected, one with an empty array has no hours.
    """
    fields = ", ".join(f"{v}: array<double>" for v in variables)
    schema = f"hourly struct<time: array<string>, {fields}>"
    judged = read_json(df, payload, schema, lambda b: b["hourly"]["time"].isNotNull())
    body, rejected = _split(judged, payload, keep)
    body = body.withColumn("_h", F.col("_body.hourly")).where(F.size("_h.time") > 0)
    hours = F.transform(
        F.col("_h.time"),
        lambda t, i: F.struct(
            t.alias("timestamp"),
            *[
                F.get(F.col(f"_h.{v}"), i).alias(c)
                for v, c in variables.items()
            ],
        ),
    )
    out = body.select(*keep, F.inline(hours))
    out = out.withColumns(
        {
            "timestamp": iso_normalise("timestamp"),
            **{c: missing_to_null(c) for c in variables.values()},
        }
    )
    return out.dropna("all", subset=list(variables.values())) if drop_empty else out, rejected


def parse_hourly(df: DataFrame, variables: dict[str, str], payload: str = "payload", **options) -> DataFrame:
    """The rows of ``split_hourly``."""
    return split_hourly(df, variables, payload, **options)[0]


def _csv_head(payload: str) -> Column:
    """Whether the first line names an expected column."""
    head = F.lower(F.regexp_extract(payload, r"^\s*([^\r\n]*)", 1))
    return F.coalesce(head.contains("latitude") | head.contains("country_id"), F.lit(False))


def csv_bodies(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """``(csv, rejected)``: a body whose first line names no expected column is an error page."""
    is_csv = _csv_head(payload)
    return df.where(is_csv), df.where(~is_csv)


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line; a quoted cell may hold commas and doubled quotes."""
    raw = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'(\s*"(?:[^"]|"")*"\s*|[^,]*),'), 1)

    def bare(cell: Column) -> Column:
        inner = F.regexp_extract(cell, r'^\s*"(.*)"\s*$', 1)
        quoted = F.rlike(cell, F.lit(r'^\s*".*"\s*$'))
        return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)

    return F.transform(raw, bare)


def split_fire_csv(
    df: DataFrame, payload: str = "payload", *, fallback: Column, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(detections, rejected)``; see ``parse_fire_csv``."""
    blank = F.coalesce(F.rlike(F.col(payload), F.lit(r"^\s*$")), F.lit(True))
    failed = F.when(blank, "empty_body").when(~_csv_head(payload), "known_header")
    rejected = rejected_bodies(df.withColumn("_rejected", failed), payload, keep)
    return parse_fire_csv(df, payload, fallback=fallback, keep=keep), rejected


def parse_fire_csv(
    df: DataFrame, payload: str = "payload", *, fallback: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """CSV bodies to detections, whatever the sensor's column order.

    Cells are looked up by the body's own header; only one of the two sensors names its
    brightness ``brightness``, the other ``bright_ti4``.
    """
    bodies, _ = csv_bodies(df, payload)
    lines = F.split(F.regexp_replace(F.trim(F.col(payload)), r"[\r\n]+", "\n"), "\n")
    header = F.transform(csv_cells(F.get(F.col("_lines"), F.lit(0))), lambda c: F.trim(F.lower(c)))
    names = [c.split()[0] for c in FIRE_CSV.split(", ")] + ["bright_ti4"]
    parts = (
        bodies.select(*keep, fallback.alias("_fallback"), lines.alias("_lines"))
        .withColumn("_head", header)
        # Where each column stands is looked up once per body, not once per line.
        .withColumns({f"_at_{n}": F.array_position("_head", F.lit(n)).cast("int") - 1 for n in names})
        .select("*", F.posexplode("_lines").alias("line_no", "_line"))
        .where((F.col("line_no") > 0) & (F.trim("_line") != ""))
        .withColumn("line_no", F.col("line_no") - 1)
        .withColumn("_cells", csv_cells(F.col("_line")))
    )

    def cell(name: str) -> Column:
        return F.nullif(F.trim(F.get(F.col("_cells"), F.col(f"_at_{name}"))), F.lit(""))

    return parts.select(
        *keep,
        "line_no",
        cell("latitude").try_cast("double").alias("lat"),
        cell("longitude").try_cast("double").alias("lon"),
        F.coalesce(
            cell("brightness").try_cast("double"), cell("bright_ti4").try_cast("double")
        ).alias("brightness_raw"),
        acquisition_time(cell("acq_date"), cell("acq_time"), F.col("_fallback")).alias("timestamp"),
        cell("satellite").alias("satellite"),
        cell("confidence").alias("confidence_raw"),
    )


def union_sensors(*frames: DataFrame) -> DataFrame:
    """Stack frames whose columns differ; what a sensor lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coalesce_brightness(df: DataFrame) -> DataFrame:
    """One brightness column from whichever of the two sensor columns a row carries."""
    present = [c for c in ("brightness", "bright_ti4") if c in df.columns]
    return df.withColumn("brightness", F.coalesce(*[F.col(c) for c in present]))
