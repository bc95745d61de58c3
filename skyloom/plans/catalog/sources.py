"""Scans and payload parsers. Payloads are built from the event table, sixteen rows per body."""

from pyspark.sql import functions as F

from skyloom.plans.catalog.base import ISO_SQL, READINGS, iso_text, query, readings, rounded
from skyloom.profiles import STATIONS
from skyloom.session import load_table, scratch_path
from skyloom.sources import lake
from skyloom.sources import payloads as P


@query("scan_parquet", "SELECT event_id, user_id, event_type, value FROM events")
def scan_parquet(spark, sf):
    return load_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


@query("context_window_scan", """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_rows, round(sum(value), 4) AS total
  FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-16' GROUP BY ALL""")
def context_window_scan(spark, sf):
    """The table is stored by date; the day comes from a table of runs, so it is known at run time only."""
    dated = readings(spark, sf).select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("date"))
    path = scratch_path(spark, "by-date")
    lake.overwrite_partitions(dated, path, ["date"])
    runs = dated.groupBy("date").agg(F.min("event_id").alias("first_event"))
    stored = lake.scan_table(spark, path, dated.drop("date").schema, "date")
    out = lake.context_of(stored, runs.where(F.col("date") == "2024-01-15"), days_back=2)
    return rounded(
        out.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")), "total", digits=4
    )


@query("table_scan_filter", """SELECT o_orderkey, o_totalprice FROM orders
  WHERE o_orderstatus = 'O' AND o_totalprice >= 100000 AND o_orderdate >= TIMESTAMP '1997-01-01'""")
def table_scan_filter(spark, sf):
    # The date is compared in the file's own type, so the filter reaches the scan.
    return (
        spark.read.parquet(f"{sf}/orders.parquet")
        .where((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") >= 100000))
        .where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        .select("o_orderkey", "o_totalprice")
    )


@query("json_feed_parse", f"""SELECT event_id, CAST(user_id AS VARCHAR) AS station_id, event_type AS city,
    CASE event_id % 3 WHEN 0 THEN {ISO_SQL} WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE 'fetched' END AS timestamp,
    value AS pm25_raw, CASE WHEN event_id % 7 > 1 THEN value * 2 END AS pm10_raw, CAST(NULL AS DOUBLE) AS no2_raw
  FROM events""")
def json_feed_parse(spark, sf):
    key = F.col("event_id")
    number = lambda c: F.struct(c.alias("v"))
    body = F.to_json(
        F.struct(
            F.col("user_id").alias("idx"),
            F.col("city").alias("query_city"),
            F.struct(
                F.when(key % 3 == 0, iso_text("ts")).alias("iso"),
                F.when(key % 3 < 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("s"),
            ).alias("time"),
            F.struct(
                number(F.col("value")).alias("pm25"),
                number(F.when(F.col("gappy").isNotNull(), F.col("value") * 2)).alias("pm10"),
            ).alias("iaqi"),
        )
    )
    feed = readings(spark, sf).select("event_id", body.alias("payload"))
    parsed = P.parse_station_feed(feed, fetched_at=F.lit("fetched"), keep=["event_id"])
    return parsed.select("event_id", "station_id", "city", "timestamp", "pm25_raw", "pm10_raw", "no2_raw")


@query("json_props_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_parse(spark, sf):
    return readings(spark, sf).select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("json_current_parse", """SELECT event_id, CASE WHEN event_id % 5 > 0 THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE 'fetched' END AS timestamp,
    value AS temperature_raw, CASE WHEN event_id % 7 > 1 THEN value END AS humidity_raw FROM events""")
def json_current_parse(spark, sf):
    body = F.to_json(F.struct(F.struct(
        F.when(F.col("event_id") % 5 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.col("value").alias("temperature_2m"), F.col("gappy").alias("relative_humidity_2m"),
    ).alias("current")))
    feed = readings(spark, sf).select("event_id", body.alias("payload"))
    return P.parse_current(feed, fetched_at=F.lit("fetched"), keep=["event_id"]).select(
        "event_id", "timestamp", "temperature_raw", "humidity_raw"
    )


def hourly_bodies(spark, sf, names: dict[str, str]):
    """Bodies of sixteen rows with one array per variable; ``names`` maps variable to column."""
    r = readings(spark, sf).withColumn("_time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    columns = sorted(set(names.values()))
    blocks = r.groupBy(F.expr("event_id div 16").alias("block")).agg(
        # Sixteen rows per block.
        F.array_sort(F.collect_list(F.struct("event_id", "_time", *columns))).alias("rows")
    )
    hourly = F.struct(
        F.col("rows._time").alias("time"), *[F.col(f"rows.{c}").alias(v) for v, c in names.items()]
    )
    return blocks.select("block", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))


STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:00+00:00')"


@query("json_arrays_to_rows", f"""WITH {READINGS} SELECT event_id // 16 AS block, {STAMP} AS timestamp, gappy AS temperature_raw,
    value AS humidity_raw, CAST(NULL AS DOUBLE) AS rainfall_raw, bearing AS wind_dir_raw FROM readings""")
def json_arrays_to_rows(spark, sf):
    names = {"temperature_2m": "gappy", "relative_humidity_2m": "value", "wind_direction_10m": "bearing"}
    out = P.parse_hourly(hourly_bodies(spark, sf, names), P.WEATHER_VARIABLES, keep=["block"])
    return out.select("block", "timestamp", "temperature_raw", "humidity_raw", "rainfall_raw", "wind_dir_raw")


@query("drop_all_null", f"""WITH {READINGS} SELECT event_id // 16 AS block, {STAMP} AS timestamp, gappy AS pm25_ugm3, sparse AS pm10_ugm3
  FROM readings WHERE gappy IS NOT NULL OR sparse IS NOT NULL""")
def drop_all_null(spark, sf):
    bodies = hourly_bodies(spark, sf, {"pm2_5": "gappy", "pm10": "sparse"})
    out = P.parse_hourly(bodies, P.MODEL_AIR_VARIABLES, keep=["block"], drop_empty=True)
    return out.select("block", "timestamp", "pm25_ugm3", "pm10_ugm3")


@query("json_grid_to_rows", f"""WITH {READINGS} SELECT event_id // 16 AS block, (event_id // 16 % 16) * 2e0 AS lat, {STAMP} AS timestamp,
    value AS no2_ppb, sparse AS o3_ppb, CAST(NULL AS DOUBLE) AS so2_ppb FROM readings""")
def json_grid_to_rows(spark, sf):
    bodies = hourly_bodies(spark, sf, {"nitrogen_dioxide": "value", "ozone": "sparse"})
    bodies = bodies.withColumn("lat", F.col("block") % 16 * 2.0)
    out = P.parse_hourly(bodies, P.SATELLITE_VARIABLES, keep=["block", "lat"])
    return out.select("block", "lat", "timestamp", "no2_ppb", "o3_ppb", "so2_ppb")


@query("csv_payload_parse", f"""WITH {READINGS} SELECT event_id // 16 AS block, CAST(event_id % 16 AS INTEGER) AS line_no, lat, lon,
    gappy AS brightness_raw, strftime(ts, '%Y-%m-%dT%H:%M:00+00:00') AS timestamp,
    CASE WHEN event_id // 16 % 2 = 0 THEN 'Terra' ELSE 'N' END AS satellite FROM readings WHERE event_id // 16 % 10 <> 3""")
def csv_payload_parse(spark, sf):
    """Two sensors' CSV bodies, whose headers name the brightness differently, and error pages."""
    r = readings(spark, sf)
    modis = F.col("block") % 2 == 0
    line = F.concat_ws(
        ",", F.col("lat").cast("string"), F.col("lon").cast("string"),
        F.coalesce(F.col("gappy").cast("string"), F.lit("")), F.date_format("ts", "yyyy-MM-dd"),
        (F.hour("ts") * 100 + F.minute("ts")).cast("string"), F.when(modis, "Terra").otherwise("N"), F.lit("80"),
    )
    blocks = r.withColumn("block", F.expr("event_id div 16")).groupBy("block").agg(
        # Sixteen rows per block.
        F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("rows")
    )
    head = F.concat(
        F.lit("latitude,longitude,"), F.when(modis, "brightness").otherwise("bright_ti4"),
        F.lit(",acq_date,acq_time,satellite,confidence\n"),
    )
    bodies = blocks.select(
        "block",
        F.when(F.col("block") % 10 == 3, "<html>invalid key</html>")
        .otherwise(F.concat(head, F.array_join(F.col("rows.line"), "\n"), F.lit("\n")))
        .alias("payload"),
    )
    out = P.parse_fire_csv(bodies, fallback=F.lit("none"), keep=["block"])
    return out.select("block", "line_no", "lat", "lon", "brightness_raw", "timestamp", "satellite")


@query("payload_rejects", """WITH k AS (SELECT event_id, event_id % 5 AS m FROM events), j AS (SELECT event_id, CASE m WHEN 1 THEN 'empty_body' WHEN 2 THEN 'readable_json'
      WHEN 3 THEN 'expected_fields' WHEN 4 THEN 'empty_body' END AS failed_check FROM k)
  SELECT kind, failed_check, count(*) AS n, sum(event_id) AS total FROM j, (VALUES ('current'), ('feed'), ('hourly')) t(kind) GROUP BY ALL
  UNION ALL SELECT 'csv', CASE WHEN m = 0 THEN NULL WHEN m IN (1, 4) THEN 'empty_body' ELSE 'known_header' END, count(*), sum(event_id) FROM k GROUP BY ALL""")
def payload_rejects(spark, sf):
    """Of every five bodies one is good, two are empty, one is cut off and one is an error message:
    what each parser reads, and the failure cases of the others."""
    kind = F.col("event_id") % 5
    good = {
        "feed": F.to_json(F.struct(F.col("user_id").alias("idx"))),
        "current": F.to_json(F.struct(F.struct(F.col("value").alias("temperature_2m")).alias("current"))),
        "hourly": F.to_json(F.struct(F.struct(F.array(iso_text("ts")).alias("time")).alias("hourly"))),
        "csv": F.concat(F.lit("latitude,longitude\n"), F.col("lat"), F.lit(","), F.col("lon")),
    }
    parsers = {
        "feed": lambda df: P.split_station_feed(df, fetched_at=F.lit(""), keep=["event_id"]),
        "current": lambda df: P.split_current(df, fetched_at=F.lit(""), keep=["event_id"]),
        "hourly": lambda df: P.split_hourly(df, P.WEATHER_VARIABLES, keep=["event_id"]),
        "csv": lambda df: P.split_fire_csv(df, fallback=F.lit(""), keep=["event_id"]),
    }
    told = []
    for name, body in good.items():
        bad = F.when(kind == 1, "").when(kind == 2, F.lit('{"status": ')).when(kind == 3, F.lit('{"status": "error", "data": "no such station"}'))
        bodies = readings(spark, sf).select("event_id", F.when(kind == 0, body).otherwise(bad).alias("payload"))
        rows, rejected = parsers[name](bodies)
        told.append(rows.select("event_id", F.lit(None).cast("string").alias("failed_check")).withColumn("kind", F.lit(name)))
        told.append(rejected.select("event_id", "failed_check").withColumn("kind", F.lit(name)))
    counts = [t.groupBy("kind", "failed_check").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total")) for t in told]
    return P.union_sensors(*counts)


def two_sensors(spark, sf):
    r = readings(spark, sf)
    odd = F.col("event_id") % 2 == 1
    modis = r.where(~odd).select("event_id", F.col("gappy").alias("brightness"), F.lit("T").alias("track"))
    viirs = r.where(odd).select("event_id", F.col("value").alias("bright_ti4"))
    return P.union_sensors(modis, viirs)


@query("union_by_name", f"""WITH {READINGS} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN gappy END AS brightness,
    CASE WHEN event_id % 2 = 0 THEN 'T' END AS track, CASE WHEN event_id % 2 = 1 THEN value END AS bright_ti4 FROM readings""")
def union_by_name(spark, sf):
    return two_sensors(spark, sf)


@query("coalesce_sensor", f"WITH {READINGS} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN gappy ELSE value END AS brightness FROM readings")
def coalesce_sensor(spark, sf):
    return P.coalesce_brightness(two_sensors(spark, sf)).select("event_id", "brightness")


STATION_VALUES = ", ".join(f"({i}, '{s[0]}', '{s[1]}', {s[2]}e0, {s[3]}e0)" for i, s in enumerate(STATIONS))


@query("station_dim", f"""WITH {READINGS}, s(slot, wmo, name, slat, slon) AS (VALUES {STATION_VALUES})
  SELECT wmo, name, slat AS station_lat, slon AS station_lon, count(*) AS n_rows, round(avg(value), 6) AS mean_value
  FROM readings JOIN s ON user_id % 13 = slot GROUP BY ALL""")
def station_dim(spark, sf):
    """Readings per named station; the dimension is a fixed list of thirteen."""
    dim = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(STATIONS)],
        "slot bigint, wmo string, name string, station_lat double, station_lon double",
    )
    out = readings(spark, sf).withColumn("slot", F.col("user_id") % 13).groupBy("slot").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean_value")
    )
    return rounded(out.join(F.broadcast(dim), "slot").drop("slot"), "mean_value")
