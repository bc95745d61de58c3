"""Scalar functions over the event, order and document tables."""

from pyspark.sql import functions as F

from skyloom.functions import scalars as S
from skyloom.plans.catalog.base import (
    DATE_SQL,
    HOUR_SQL,
    READINGS,
    SECOND_SQL,
    category_sql,
    index_sql,
    iso_text,
    query,
    readings,
    sub_index_sql,
)
from skyloom.session import load_table


@query("payload_hash", "SELECT doc_id, sha256(text) AS payload_hash FROM documents")
def payload_hash(spark, sf):
    return load_table(spark, sf, "documents").select("doc_id", S.payload_hash("text").alias("payload_hash"))


@query(
    "canonical_hash",
    """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey ||
       ',"o_orderstatus":"' || o_orderstatus || '"}') AS payload_hash FROM orders""",
)
def canonical_hash(spark, sf):
    return load_table(spark, sf, "orders").select(
        "o_orderkey",
        S.payload_hash(S.canonical_json(["o_orderstatus", "o_orderkey", "o_custkey"])).alias("payload_hash"),
    )


@query(
    "valid_time",
    """SELECT event_id, CASE WHEN event_id % 10 < 8 THEN
         strftime(date_trunc('hour', ts) + to_hours(CAST(event_id % 25 * 3 AS INTEGER)), '%Y-%m-%dT%H:%M:%S+00:00')
       END AS valid_time FROM events""",
)
def valid_time(spark, sf):
    key = F.col("event_id") % 10
    cycle = F.when(key == 8, F.date_format("ts", "HH")).otherwise(F.date_format("ts", "yyyyMMdd_HH'z'"))
    step = F.when(key == 9, "f3").otherwise(F.lpad((F.col("event_id") % 25 * 3).cast("string"), 3, "0"))
    return load_table(spark, sf, "events").select(
        "event_id", S.iso_utc_text(S.valid_time(cycle, step)).alias("valid_time")
    )


@query(
    "acq_timestamp",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'unknown'
         ELSE strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S+00:00') END AS acquired_at FROM events""",
)
def acq_timestamp(spark, sf):
    hhmm = (F.hour("ts") * 100 + F.minute("ts")).cast("string")
    bad = F.when(F.col("event_id") % 2 == 0, F.lit("2572")).otherwise(F.lit("x1"))
    return load_table(spark, sf, "events").select(
        "event_id",
        S.acquisition_time(
            F.date_format("ts", "yyyy-MM-dd"),
            F.when(F.col("event_id") % 9 == 0, bad).otherwise(hhmm),
            F.lit("unknown"),
        ).alias("acquired_at"),
    )


@query(
    "iso_normalise",
    """SELECT event_id, CASE event_id % 4
         WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:00+00:00')
         WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:00+00:00')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS iso FROM events""",
)
def iso_normalise(spark, sf):
    key = F.col("event_id") % 4
    text = (
        F.when(key == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .when(key == 1, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(key == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )
    return load_table(spark, sf, "events").select("event_id", S.iso_normalise(text).alias("iso"))


@query("iso_utc_text", f"SELECT event_id, {SECOND_SQL} AS iso FROM events")
def iso_utc_text(spark, sf):
    return load_table(spark, sf, "events").select("event_id", S.iso_utc_text("ts").alias("iso"))


def mixed_times(df):
    """Five spellings of one instant, one of them another zone, and one that is no time."""
    key = F.col("event_id") % 6
    local = F.expr("ts + interval 330 minutes")
    return (
        F.when(key == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .when(key == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(key == 2, iso_text("ts"))
        .when(key == 3, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(key == 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.lit("n/a "), F.col("event_id").cast("string")))
    )


@query(
    "ts_coerce",
    f"""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:00+00:00')
        ELSE {SECOND_SQL} END AS iso FROM events WHERE event_id % 6 <> 5""",
)
def ts_coerce(spark, sf):
    df = load_table(spark, sf, "events")
    parsed = df.select("event_id", S.parse_instant(mixed_times(df)).alias("at"))
    return parsed.where(F.col("at").isNotNull()).select("event_id", S.iso_utc_text("at").alias("iso"))


@query("hour_bucket", f"SELECT event_id, {HOUR_SQL} AS hour_bucket, {DATE_SQL} AS date FROM events")
def hour_bucket(spark, sf):
    return load_table(spark, sf, "events").select(
        "event_id", S.hour_bucket("ts").alias("hour_bucket"), S.utc_date("ts").alias("date")
    )


@query(
    "numeric_coerce",
    """SELECT event_id, CASE WHEN event_id % 5 IN (3, 4) THEN NULL ELSE value END AS value FROM events""",
)
def numeric_coerce(spark, sf):
    key = F.col("event_id") % 5
    text = (
        F.when(key == 3, "n/a").when(key == 4, "NaN").otherwise(F.col("value").cast("string"))
    )
    return load_table(spark, sf, "events").select("event_id", S.numeric(text).alias("value"))


@query(
    "unit_convert",
    "SELECT event_id, round((value * 1.4142135e0 + 200) - 273.15e0, 2) AS celsius FROM events",
)
def unit_convert(spark, sf):
    return load_table(spark, sf, "events").select(
        "event_id", S.kelvin_to_celsius(F.col("value") * 1.4142135 + 200, 2).alias("celsius")
    )


@query(
    "sign_magnitude",
    """SELECT event_id, CAST(CASE WHEN h >= 32768 THEN 32768 - h ELSE h END AS BIGINT) AS signed
       FROM (SELECT event_id, (event_id * 7919) % 65536 AS h FROM events)""",
)
def sign_magnitude(spark, sf):
    raw = F.unhex(F.lpad(F.hex(F.col("event_id") * 7919 % 65536), 4, "0"))
    return load_table(spark, sf, "events").select("event_id", S.sign_magnitude(raw, 2).alias("signed"))


@query(
    "packing_decode",
    """SELECT event_id, (0.5e0 + (event_id % 4096) * pow(2e0, CAST(-(event_id % 6) AS DOUBLE)))
         * pow(10e0, -1e0) AS decoded FROM events""",
)
def packing_decode(spark, sf):
    key = F.col("event_id")
    return load_table(spark, sf, "events").select(
        "event_id",
        S.unpack_simple(key % 4096, F.lit(0.5), (-(key % 6)).cast("double"), F.lit(1.0)).alias("decoded"),
    )


@query(
    "aqi_subindex",
    f"""SELECT event_id, {sub_index_sql('v', 'pm25')} AS pm25_index, {sub_index_sql('w', 'pm10')} AS pm10_index
        FROM (SELECT event_id, value * 2 - 5 AS v, CASE WHEN event_id % 7 > 1 THEN value * 2 END AS w FROM events)""",
)
def aqi_subindex(spark, sf):
    return readings(spark, sf).select(
        "event_id",
        S.sub_index(F.col("value") * 2 - 5, S.PM25_BREAKPOINTS).alias("pm25_index"),
        S.sub_index(F.col("gappy") * 2, S.PM10_BREAKPOINTS).alias("pm10_index"),
    )


MIXED_SOURCE_SQL = "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' WAQI ' WHEN 2 THEN 'cpcb' ELSE 'cams' END"


def _mixed_source():
    key = F.col("event_id") % 4
    return F.when(key == 1, " WAQI ").when(key == 2, "cpcb").when(key == 3, "cams")


@query(
    "aqi_from",
    f"""SELECT event_id, {index_sql('p25', 'p10', 'src')} AS aqi FROM (
        SELECT event_id, CASE WHEN event_id % 7 > 1 THEN value END AS p25,
          CASE WHEN event_id % 100 >= 60 THEN value END AS p10, {MIXED_SOURCE_SQL} AS src FROM events)""",
)
def aqi_from(spark, sf):
    return readings(spark, sf).select(
        "event_id", S.air_quality_index("gappy", "sparse", _mixed_source()).alias("aqi")
    )


@query(
    "aqi_category",
    f"""SELECT event_id, {category_sql('v')} AS category
        FROM (SELECT event_id, CASE WHEN event_id % 7 > 1 THEN value END AS v FROM events)""",
)
def aqi_category(spark, sf):
    return readings(spark, sf).select("event_id", S.index_category("gappy").alias("category"))


@query(
    "wind_speed",
    """SELECT event_id, sqrt((value - 200) * (value - 200) + (value * 0.5e0) * (value * 0.5e0)) AS speed FROM events""",
)
def wind_speed(spark, sf):
    return readings(spark, sf).select(
        "event_id", S.wind_speed(F.col("value") - 200, F.col("value") * 0.5).alias("speed")
    )


SECTOR_CASE = """CASE WHEN {c} IS NULL THEN '?' WHEN {c} >= 337.5 OR {c} < 22.5 THEN 'N' WHEN {c} < 67.5 THEN 'NE'
  WHEN {c} < 112.5 THEN 'E' WHEN {c} < 157.5 THEN 'SE' WHEN {c} < 202.5 THEN 'S' WHEN {c} < 247.5 THEN 'SW'
  WHEN {c} < 292.5 THEN 'W' ELSE 'NW' END"""


@query(
    "wind_sector",
    f"""WITH {READINGS} SELECT event_id, {SECTOR_CASE.format(c='b')} AS sector
        FROM (SELECT event_id, CASE WHEN event_id % 7 > 1 THEN bearing END AS b FROM readings)""",
)
def wind_sector(spark, sf):
    b = F.when(F.col("gappy").isNotNull(), F.col("bearing"))
    return readings(spark, sf).select("event_id", S.wind_sector(b).alias("sector"))
