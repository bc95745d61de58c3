"""Streaming jobs over the event table, driven to the end of the data and read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.plans.catalog.base import ISO_SQL, ORACLES, READINGS, query
from skyloom.plans.catalog.tables import REPORT_AT, as_run_log, run_log, watched
from skyloom.profiles import CONTRACTS, STATION_AIR
from skyloom.operators.quality import MetricRule
from skyloom.schemas import SILVER_AIR
from skyloom.session import load_table, scratch_path
from skyloom.streaming import jobs


def event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A pattern serves both a single file and a folder of files.
    raw = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def order_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf}/orders.parque[t]")
    return raw.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def drain(stream, spark, name: str, mode: str = "append"):
    """Run a stream over everything available into a table and read that table."""
    path = scratch_path(spark, name)
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/table")
    run = writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{path}/table")


def drain_each(stream, spark, name: str, sink, mode: str = "append") -> None:
    path = scratch_path(spark, name)
    run = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", path)
    run.trigger(availableNow=True).start().awaitTermination()


@query("stream_dedup", "SELECT event_id // 2 AS body, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY ALL")
def stream_dedup(spark, sf):
    """Every payload arrives twice with the same time; one copy of each is kept."""
    pair = F.expr("event_id div 2")
    e = event_stream(spark, sf)
    payloads = e.select(
        F.concat(F.lit("2024-01-01T"), F.lpad((pair % 24).cast("string"), 2, "0"), F.lit(":00:00+00:00")).alias("timestamp"),
        F.to_json(F.struct(pair.alias("body"))).alias("payload"),
    )
    once = drain(
        jobs.dedup_payloads(payloads, timestamp="timestamp", payload="payload", delay="2 days"), spark, "dedup"
    )
    body = F.from_json("payload", "body bigint")["body"]
    return once.groupBy(body.alias("body")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_hourly_aqi", f"""WITH {READINGS} SELECT city, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS hour_start,
    count(*) AS n_readings, count(DISTINCT station_id) AS n_stations, round(avg(gappy), 6) AS pm25_mean, max(value) AS aqi_max
  FROM readings WHERE is_synthetic = 0 GROUP BY city, date_trunc('hour', ts)
  HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM readings WHERE is_synthetic = 0) - INTERVAL 2 HOUR""")
def stream_hourly_aqi(spark, sf):
    """Hours the watermark has closed by the end of the table."""
    key = F.col("event_id")
    stream = event_stream(spark, sf).select(
        "ts", F.col("event_type").alias("city"), F.col("user_id").cast("string").alias("station_id"),
        F.when(~(key % 7).isin(0, 1), F.col("value")).alias("pm25_clean"), F.col("value").alias("pm10_clean"),
        F.lit("waqi").alias("source"), (key % 11 == 0).cast("int").alias("is_synthetic"),
    )
    hours = drain(jobs.hourly_index(stream, delay="2 hours"), spark, "hourly")
    return hours.select(
        "city", F.date_format("hour_start", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("hour_start"), "n_readings", "n_stations",
        F.round("pm25_mean", 6).alias("pm25_mean"), "aqi_max",
    )


@query("stream_qc", f"""WITH {READINGS} SELECT event_id, CASE WHEN abs(value - lag(value) OVER (PARTITION BY station_id ORDER BY ts)) > 100
    THEN 'step_fail' ELSE 'ok' END AS value_qc_flag FROM readings""")
def stream_qc(spark, sf):
    rules = [MetricRule("value", 0.0, 1000.0, 100.0)]
    path = scratch_path(spark, "stream-qc")
    schema = T.StructType([
        T.StructField("station_id", T.LongType()), T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ])
    sink = jobs.quality_sink(spark, path, schema, rules, station="station_id", time="ts")
    drain_each(event_stream(spark, sf).withColumnRenamed("user_id", "station_id"), spark, "qc-state", sink)
    flags = spark.read.parquet(f"{path}/flags").select("station_id", "ts", "value_qc_flag")
    events = load_table(spark, sf, "events").select("event_id", F.col("user_id").alias("station_id"), "ts")
    return events.join(flags, ["station_id", "ts"]).select("event_id", "value_qc_flag")


@query("stream_silver", f"""SELECT {ISO_SQL} AS timestamp, CAST(user_id AS VARCHAR) AS station_id, value AS pm25_clean FROM events
  WHERE value / 5 <= 100""")
def stream_silver(spark, sf):
    """Stream to a silver table twice over: the second run finds every row in place."""
    v = F.col("value")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    rows = event_stream(spark, sf).select(
        F.col("user_id").cast("string").alias("station_id"), F.col("event_type").alias("city"), iso.alias("timestamp"),
        v.alias("pm25_raw"), (v * 2).alias("pm10_raw"), v.alias("no2_raw"), v.alias("so2_raw"),
        (v / 5).alias("co_raw"), v.alias("o3_raw"),
    )
    path = scratch_path(spark, "silver-stream")
    sink = jobs.silver_sink(
        spark, path, SILVER_AIR, STATION_AIR, CONTRACTS["cpcb"], station="station_id",
        tags={"source": "cpcb", "is_synthetic": 0},
    )
    drain_each(rows, spark, "silver-state-1", sink)
    drain_each(rows, spark, "silver-state-2", sink)
    return spark.read.parquet(path).select("timestamp", "station_id", "pm25_clean")


@query("stream_freshness", ORACLES["freshness_report"])
def stream_freshness(spark, sf):
    """The freshness report from what two streams over the run log keep."""
    path = scratch_path(spark, "freshness")
    log = as_run_log(order_stream(spark, sf))
    sources = watched(spark, run_log(spark, sf))
    drain_each(jobs.newest_runs(log, ["run_id"]), spark, "newest", jobs.newest_sink(spark, path, sources), "update")
    drain_each(log, spark, "recent", jobs.recent_sink(spark, path, 9600))
    return jobs.streamed_freshness(spark, path, sources, F.lit(REPORT_AT).cast("timestamp"), window_hours=9600)
