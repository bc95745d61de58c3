"""Filters, merges, planning, reports and maintenance over the given tables."""

from pyspark.sql import functions as F

from skyloom.functions.scalars import payload_hash
from skyloom.operators import periods, upserts
from skyloom.plans import export, gold, health, maintenance
from skyloom.plans.catalog.base import DATE_SQL, READINGS, iso_text, query, readings, rounded
from skyloom.plans.catalog.features import GRID, air, grid
from skyloom.plans.season import in_box
from skyloom.profiles import HELD_BACK
from skyloom.session import load_table, scratch_path
from skyloom.sources import lake


@query("filter_synthetic", "SELECT event_id FROM events WHERE event_id % 11 <> 0")
def filter_synthetic(spark, sf):
    return export.select_rows(readings(spark, sf)).select("event_id")


@query("bbox_filter", f"WITH {READINGS} SELECT event_id, lat, lon FROM readings WHERE lat BETWEEN 10 AND 20 AND lon BETWEEN 70 AND 85")
def bbox_filter(spark, sf):
    return readings(spark, sf).where(in_box("lat", "lon", (10, 20, 70, 85))).select("event_id", "lat", "lon")


@query("time_range_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'")
def time_range_filter(spark, sf):
    at = F.col("o_orderdate")
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1996, 1999))
    return spark.read.parquet(f"{sf}/orders.parquet").where((at >= low) & (at < high)).select("o_orderkey")


@query("month_filter", "SELECT o_orderkey FROM orders WHERE month(o_orderdate) IN (10, 11)")
def month_filter(spark, sf):
    month = F.date_format("o_orderdate", "MM")
    return load_table(spark, sf, "orders").where(month.isin("10", "11")).select("o_orderkey")


@query("semi_anti_lookup", """SELECT s_suppkey, CAST(s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) AS INTEGER) AS known
  FROM supplier""")
def semi_anti_lookup(spark, sf):
    """Suppliers of wanted nations, and the names the lookup does not know."""
    supplier = load_table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    wanted = load_table(spark, sf, "nation").where(F.col("n_regionkey") < 3)
    known = supplier.join(wanted, "n_nationkey", "left_semi")
    unknown = supplier.join(
        upserts.absent_names(supplier, wanted, ["n_nationkey"]), "n_nationkey", "left_semi"
    )
    return known.select("s_suppkey", F.lit(1).alias("known")).union(
        unknown.select("s_suppkey", F.lit(0))
    )


@query("unknown_names", "SELECT DISTINCT s_nationkey AS n_nationkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def unknown_names(spark, sf):
    supplier = load_table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    wanted = load_table(spark, sf, "nation").where(F.col("n_regionkey") < 3)
    return upserts.absent_names(supplier, wanted, ["n_nationkey"])


@query("duplicate_check", """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
  ORDER BY copies DESC, l_orderkey, l_linenumber LIMIT 5""")
def duplicate_check(spark, sf):
    found = upserts.duplicate_keys(load_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.orderBy(F.desc("copies"), "l_orderkey", "l_linenumber").limit(5)


@query("unique_key_check", """SELECT 'o_orderkey' AS key_column, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_distinct,
    CAST(count(*) = count(DISTINCT o_orderkey) AS INTEGER) AS is_unique FROM orders
  UNION ALL SELECT 'o_custkey', count(*), count(DISTINCT o_custkey), CAST(count(*) = count(DISTINCT o_custkey) AS INTEGER) FROM orders""")
def unique_key_check(spark, sf):
    return upserts.key_uniqueness(load_table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])


# Merges and sinks.


@query("bronze_append_new", """WITH known AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE doc_id % 3 = 0)
  SELECT sha256(text) AS payload_hash, min(doc_id) AS first_doc FROM documents
  WHERE sha256(text) NOT IN (SELECT h FROM known) GROUP BY ALL""")
def bronze_append_new(spark, sf):
    rows = load_table(spark, sf, "documents").select("doc_id", payload_hash("text").alias("payload_hash"))
    known = rows.where(F.col("doc_id") % 3 == 0)
    fresh = upserts.insert_ignore(known, rows, ["payload_hash"], ["doc_id"])
    return fresh.select("payload_hash", F.col("doc_id").alias("first_doc"))


@query("bronze_append_files", """SELECT lang AS source, count(DISTINCT sha256(text)) AS n_payloads FROM documents GROUP BY lang""")
def bronze_append_files(spark, sf):
    """Two appends of overlapping batches to a stored bronze table; every content is held once."""
    docs = load_table(spark, sf, "documents").select(
        "doc_id", "text", F.col("lang").alias("source"), F.lit(0).alias("is_synthetic"),
        F.lit("2024-01-01T00:00:00+00:00").alias("seen"),
    )
    path = scratch_path(spark, "bronze")
    for batch in (docs.where(F.col("doc_id") % 3 < 2), docs):
        rows = lake.bronze_rows(batch, payload="text", timestamp="seen", fetched_at=F.lit("now"))
        lake.append_bronze(spark, rows, path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n_payloads"))


def _copies(spark, sf):
    e = load_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    again = e.where(F.col("event_id") % 5 == 0)
    return e, again.withColumn("value", F.col("value") + 1000), again.withColumn("value", F.col("value") + 2000)


@query("upsert_last_wins", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN value + 2000 ELSE value END AS value FROM events")
def upsert_last_wins(spark, sf):
    stored, first, second = _copies(spark, sf)
    batch = first.withColumn("seq", F.lit(1)).union(second.withColumn("seq", F.lit(2)))
    out = upserts.upsert(stored.withColumn("seq", F.lit(0)), batch, ["user_id", "ts"], ["seq"])
    return out.select("event_id", "value")


@query("upsert_partitions", f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN value + 2000 ELSE value END AS value,
    CASE WHEN event_id % 10 > 1 THEN {DATE_SQL} END AS date FROM events""")
def upsert_partitions(spark, sf):
    """Stored in two batches and a repeat, with rows in the NULL partition, where blank dates go too."""
    from pyspark.sql import types as T

    key = F.col("event_id")
    e = _dated(spark, sf).withColumn("date", F.when(key % 10 > 1, F.col("date")).when(key % 10 == 1, ""))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    path = scratch_path(spark, "upserts")
    again = e.where(key % 5 == 0).withColumn("value", F.col("value") + 2000)
    for batch in (e.where(key % 2 == 0), e.where(key % 2 == 1), again, again):
        lake.upsert_table(spark, batch, path, schema, partition="date", keys=["event_id"], order=["timestamp"])
    return spark.read.parquet(path).select("event_id", "value", F.date_format(F.to_date("date"), "yyyy-MM-dd").alias("date"))


@query("insert_ignore_first_wins", """SELECT event_id, value + 1000 AS value FROM events WHERE event_id % 5 = 0 AND event_id % 2 = 1""")
def insert_ignore_first_wins(spark, sf):
    stored, first, second = _copies(spark, sf)
    batch = first.withColumn("seq", F.lit(1)).union(second.withColumn("seq", F.lit(2)))
    known = stored.where(F.col("event_id") % 2 == 0)
    return upserts.insert_ignore(known, batch, ["user_id", "ts"], ["seq"]).select("event_id", "value")


def _dated(spark, sf):
    return load_table(spark, sf, "events").select(
        "event_id", "user_id", "value", iso_text("ts").alias("timestamp")
    ).withColumn("date", lake.observation_date())


@query("partition_by_obs_date", f"SELECT {DATE_SQL} AS date, count(*) AS n_rows, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def partition_by_obs_date(spark, sf):
    path = scratch_path(spark, "by-date")
    dated = _dated(spark, sf)
    lake.overwrite_partitions(dated, path, ["date"])
    stored = spark.read.parquet(path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return rounded(
        stored.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")), "total", digits=4
    )


@query("partition_overwrite", f"""SELECT {DATE_SQL} AS date, count(*) AS n_rows FROM events
  WHERE ts < TIMESTAMP '2024-01-20' OR event_id % 2 = 0 GROUP BY ALL""")
def partition_overwrite(spark, sf):
    """Some dates written again with half their rows: those are replaced, the others stay."""
    path = scratch_path(spark, "overwrite")
    dated = _dated(spark, sf)
    lake.overwrite_partitions(dated, path, ["date"])
    again = dated.where((F.col("date") >= "2024-01-20") & (F.col("event_id") % 2 == 0))
    lake.overwrite_partitions(again, path, ["date"])
    stored = spark.read.parquet(path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("partition_by_cycle", f"WITH {READINGS}, {GRID} SELECT cycle, count(*) AS n_rows FROM grid GROUP BY cycle")
def partition_by_cycle(spark, sf):
    path = scratch_path(spark, "by-cycle")
    lake.overwrite_partitions(grid(spark, sf), path, ["cycle"])
    return spark.read.parquet(path).groupBy("cycle").agg(F.count(F.lit(1)).alias("n_rows"))


@query("gold_write", f"""WITH {READINGS} SELECT {DATE_SQL} AS date, count(DISTINCT (city, hour(ts))) AS n_rows FROM readings
  WHERE is_synthetic = 0 GROUP BY ALL""")
def gold_write(spark, sf):
    path = scratch_path(spark, "gold")
    gold.write_gold(gold.city_aqi_hourly(air(spark, sf)), path, "date")
    stored = spark.read.parquet(path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("export_with_units", f"WITH {READINGS}, {GRID} SELECT cycle, count(*) AS n_rows, 'degC' AS unit FROM grid WHERE is_synthetic = 0 GROUP BY cycle")
def export_with_units(spark, sf):
    from skyloom.plans.catalog.grids import export_grid

    variables = export.exported_variables()
    wide = export.to_wide(export.select_rows(export_grid(spark, sf)), variables, order=())
    path = scratch_path(spark, "export")
    marked = wide.withColumn("_cycle", F.col("cycle"))
    extra = marked.withColumn("_cycle", F.lit("stale"))
    # A first export has a partition that the second one lacks.
    for rows in (extra.unionByName(marked), marked):
        lake.write_export(
            rows, path, units=export.unit_map(variables, wide=True),
            notes={"excluded": list(HELD_BACK), "format": "wide"}, partitions=["_cycle"],
        )
    stored = spark.read.parquet(path)
    unit = stored.schema["temperature_c"].metadata["unit"]
    return stored.groupBy("cycle").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("unit", F.lit(unit))


@query("run_log_append", "SELECT 'success' AS status, count(*) AS rows_inserted FROM events UNION ALL SELECT 'failure', 0")
def run_log_append(spark, sf):
    """Log a run that counted the event table, and one that returned nothing."""
    path = scratch_path(spark, "run-log")
    n = load_table(spark, sf, "events").count()
    for result in (("success", n, None), None):
        lake.log_run(spark, path, "cpcb", "2024-01-01T00:00:00+00:00", "2024-01-01T00:01:00+00:00", result)
    return spark.read.parquet(path).select("status", "rows_inserted")


@query("migrate_to_lake", """SELECT 'events' AS table_name, count(*) AS n_left, count(*) AS n_right, 0 AS difference, 'OK' AS verdict FROM events
  UNION ALL SELECT 'orders', count(*), count(*), 0, 'OK' FROM orders""")
def migrate_to_lake(spark, sf):
    tables = {
        "events": _dated(spark, sf),
        "orders": load_table(spark, sf, "orders"),
    }
    out = maintenance.migrate_to_lake(
        tables, scratch_path(spark, "lake"), {"events": "date", "orders": "o_orderstatus"}
    )
    return out.withColumn("difference", F.col("difference").cast("int"))


@query("context_union", "SELECT event_id, CAST(ts >= TIMESTAMP '2024-01-20' AS INTEGER) AS is_new FROM events")
def context_union(spark, sf):
    r = readings(spark, sf).select("event_id", "ts")
    new = F.col("ts") >= F.lit("2024-01-20").cast("timestamp")
    both = r.where(new).withColumn("is_new", F.lit(1)).unionByName(r.where(~new).withColumn("is_new", F.lit(0)))
    return both.select("event_id", "is_new")


# Calendar planning.


@query("contiguous_spans", """WITH m AS (SELECT DISTINCT o_custkey AS customer, CAST(year(o_orderdate) AS INTEGER) AS year, month(o_orderdate) AS m FROM orders),
  r AS (SELECT *, m - row_number() OVER (PARTITION BY customer, year ORDER BY m) AS run FROM m),
  s AS (SELECT customer, year, make_date(year, min(m), 1) AS a, last_day(make_date(year, max(m), 1)) AS b FROM r GROUP BY customer, year, run)
  SELECT customer, year, strftime(greatest(a, DATE '1996-03-15'), '%Y-%m-%d') AS start_date, strftime(b, '%Y-%m-%d') AS end_date
  FROM s WHERE b >= DATE '1996-03-15'""")
def contiguous_spans(spark, sf):
    """Months in which a customer ordered: few have none missing."""
    months = load_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    spans = periods.contiguous_spans(months, by=["customer"], coverage_start="1996-03-15")
    return spans.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("start_date", "end_date")})


@query("date_chunks", """WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS f FROM orders)
  SELECT strftime(f + to_days(CAST(d AS INTEGER)), '%Y-%m-%d') AS start_date, CAST(least(5, day(last_day(f)) - d) AS INTEGER) AS n_days
  FROM m, (SELECT range AS d FROM range(0, 31, 5)) x WHERE d < day(last_day(f))""")
def date_chunks(spark, sf):
    months = load_table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).distinct()
    return periods.date_chunks(months).select(F.date_format("start_date", "yyyy-MM-dd").alias("start_date"), "n_days")


@query("catalogue_scan", """WITH c AS (SELECT o_orderpriority AS source, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY o_orderpriority),
  w AS (SELECT DISTINCT o_orderpriority AS source, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders WHERE o_totalprice > 300000)
  SELECT source, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM w JOIN c USING (source)
  WHERE source NOT LIKE '1%' AND make_date(year, month, 1) BETWEEN date_trunc('month', a) AND b""")
def catalogue_scan(spark, sf):
    """The months that a catalogue in CSV files can serve; one of its sources is listed under a quoted
    name that nobody asks for, and one row cannot be read."""
    orders = load_table(spark, sf, "orders")
    listed = orders.groupBy(F.col("o_orderpriority").alias("data_id")).agg(
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("min_date"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("max_date"),
    )
    named = F.when(F.col("data_id").startswith("1"), F.concat("data_id", F.lit(", all"))).otherwise(F.col("data_id"))
    bad = listed.limit(1).select(F.lit("unlisted").alias("data_id"), F.lit("soon").alias("min_date"), "max_date")
    path = scratch_path(spark, "catalogue")
    listed.withColumn("data_id", named).unionByName(bad).write.option("header", True).csv(path)
    catalogue, _ = lake.scan_catalogue(spark, path)
    wanted = orders.where("o_totalprice > 300000").select(
        F.col("o_orderpriority").alias("source"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    return periods.available_months(catalogue, wanted)


@query("availability_overlap", """WITH c AS (SELECT o_orderpriority AS source, date_trunc('month', min(CASE WHEN o_totalprice > 490000 THEN o_orderdate END)) AS a,
      max(CASE WHEN o_totalprice > 490000 THEN o_orderdate END) AS b FROM orders GROUP BY ALL),
  w AS (SELECT DISTINCT o_orderpriority AS source, date_trunc('month', o_orderdate) AS f FROM orders)
  SELECT source, CAST(year(f) AS INTEGER) AS year, CAST(month(f) AS INTEGER) AS month FROM w JOIN c USING (source) WHERE f >= a AND f <= b""")
def availability_overlap(spark, sf):
    orders = load_table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "source")
    # The catalogue of a source spans its dearest orders.
    dear = F.when(F.col("o_totalprice") > 490000, F.col("o_orderdate"))
    catalogue = orders.groupBy("source").agg(F.to_date(F.min(dear)).alias("min_date"), F.to_date(F.max(dear)).alias("max_date"))
    wanted = orders.select("source", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return periods.available_months(catalogue, wanted)


# Reports.


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("events", "orders", "lineitem", "customer", "part")))
def table_counts(spark, sf):
    return health.table_counts({t: load_table(spark, sf, t) for t in ("events", "orders", "lineitem", "customer", "part")})


@query("reconcile_counts", """WITH a AS (SELECT l_shipdate AS d, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT o_orderdate AS d, count(*) AS n FROM orders GROUP BY 1)
  SELECT strftime(coalesce(a.d, b.d), '%Y-%m-%d') AS day, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right,
    coalesce(b.n, 0) - coalesce(a.n, 0) AS difference, CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'OK' ELSE 'MISMATCH' END AS verdict
  FROM a FULL JOIN b ON a.d = b.d""")
def reconcile_counts(spark, sf):
    per_day = lambda t, c: load_table(spark, sf, t).groupBy(
        F.date_format(c, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    return health.reconcile_counts(per_day("lineitem", "l_shipdate"), per_day("orders", "o_orderdate"), "day")


@query("run_breakdown", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_rows FROM events GROUP BY ALL ORDER BY day DESC")
def run_breakdown(spark, sf):
    day = load_table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return health.breakdown(day, ["day", "event_type"]).orderBy(F.desc("day"), "event_type")


@query("flag_histogram", f"""WITH {READINGS}, f AS (SELECT CASE WHEN value > 300 THEN 'range_fail' ELSE 'ok' END AS flag FROM readings)
  SELECT 'level_qc_flag' AS flag_column, flag, count(*) AS n_rows FROM f GROUP BY ALL
  UNION ALL SELECT 'kind', source, count(*) FROM readings GROUP BY ALL""")
def flag_histogram(spark, sf):
    r = readings(spark, sf).select(
        F.when(F.col("value") > 300, "range_fail").otherwise("ok").alias("level_qc_flag"), F.col("source").alias("kind")
    )
    return health.flag_histogram(r, ["level_qc_flag", "kind"])


@query("null_profile", f"""WITH {READINGS} SELECT city, count(*) AS n_rows, count(*) FILTER (gappy IS NULL) AS null_gappy,
    count(*) FILTER (sparse IS NULL) AS null_sparse FROM readings GROUP BY city""")
def null_profile(spark, sf):
    return health.null_profile(readings(spark, sf), ["gappy", "sparse"], ["city"])


@query("recent_payloads", "SELECT doc_id, length(text) AS n_bytes, substring(text, 1, 120) AS preview FROM documents ORDER BY doc_id DESC LIMIT 6")
def recent_payloads(spark, sf):
    out = health.recent_payloads(load_table(spark, sf, "documents"), "doc_id", "text")
    return out.withColumn("n_bytes", F.col("n_bytes").cast("bigint"))


def run_log(spark, sf):
    return as_run_log(load_table(spark, sf, "orders"))


def as_run_log(orders):
    """Orders as a run log: priorities are sources, states are outcomes."""
    at = iso_text("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "P", "partial").otherwise("failure")
    return orders.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("source"), at.alias("run_started_at"),
        at.alias("run_finished_at"), status.alias("status"), F.col("o_custkey").alias("rows_inserted"),
        F.when(status == "failure", F.concat(F.lit("order "), F.col("o_orderkey"))).alias("error_message"),
    )


RUN_LOG = """log AS (SELECT o_orderkey AS run_id, o_orderpriority AS source, o_orderdate AS ran, o_custkey AS n,
    CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'P' THEN 'partial' ELSE 'failure' END AS status FROM orders)"""


@query("run_status_counts", f"""WITH {RUN_LOG} SELECT source, count(*) FILTER (status = 'success') AS successes,
    count(*) FILTER (status = 'partial') AS partials, count(*) FILTER (status = 'failure') AS failures,
    round(avg(n) FILTER (status = 'success'), 1) AS avg_rows FROM log GROUP BY source""")
def run_status_counts(spark, sf):
    return health.status_counts(run_log(spark, sf))


@query("latest_per_source", f"""WITH {RUN_LOG} SELECT source, run_id, status FROM log
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_id DESC) = 1""")
def latest_per_source(spark, sf):
    return health.latest_per_source(run_log(spark, sf), ["run_id"], ["run_id", "status"])


@query("freshness_report", f"""WITH {RUN_LOG}, dim AS (SELECT DISTINCT o_orderpriority AS source,
      CASE WHEN o_orderpriority LIKE '1%' THEN 1000 ELSE 100000 END AS threshold_min FROM orders
    UNION ALL VALUES ('cpcb', 30), ('firms', 40), ('weather', 120), ('gfs', 720), ('sentinel5p', 2880), ('gold', 120)),
  t AS (SELECT TIMESTAMP '2001-08-03' AS now),
  s AS (SELECT source,
    count(*) FILTER (status = 'success' AND ran >= now - INTERVAL 9600 HOUR) AS successes,
    count(*) FILTER (status = 'partial' AND ran >= now - INTERVAL 9600 HOUR) AS partials,
    count(*) FILTER (status = 'failure' AND ran >= now - INTERVAL 9600 HOUR) AS failures,
    round(avg(n) FILTER (status = 'success' AND ran >= now - INTERVAL 9600 HOUR), 1) AS avg_rows,
    arg_max(ran, run_id) FILTER (status = 'success') AS ok_at,
    arg_max(status, run_id) FILTER (status <> 'success') AS last_error_status,
    arg_max(CASE WHEN status = 'failure' THEN 'order ' || run_id ELSE 'Unknown error' END, run_id) FILTER (status <> 'success') AS last_error
    FROM log, t GROUP BY source),
  j AS (SELECT dim.*, s.* EXCLUDE (source), date_diff('minute', ok_at, TIMESTAMP '2001-08-03') AS minutes_ago FROM dim LEFT JOIN s ON dim.source = s.source)
  SELECT source, threshold_min, coalesce(successes, 0) AS successes, coalesce(partials, 0) AS partials, coalesce(failures, 0) AS failures,
    coalesce(avg_rows, 0) AS avg_rows, last_error_status, last_error, minutes_ago,
    CASE WHEN minutes_ago IS NULL THEN 'NO SUCCESSFUL RUNS' WHEN minutes_ago > threshold_min THEN 'STALE' ELSE 'HEALTHY' END AS freshness FROM j""")
def freshness_report(spark, sf):
    log = run_log(spark, sf)
    return health.freshness_report(log, watched(spark, log), F.lit(REPORT_AT).cast("timestamp"), order=["run_id"], window_hours=9600)


REPORT_AT = "2001-08-03"


def watched(spark, log):
    """Thresholds of the log's sources, and of jobs that never ran in it and are reported all the same."""
    threshold = F.when(F.col("source").startswith("1"), 1000).otherwise(100000)
    sources = log.select("source").distinct().withColumn("threshold_min", threshold)
    return sources.unionByName(health.monitored(spark).select("source", "threshold_min"))


@query("adhoc_sql", "SELECT event_type, count(*) AS n FROM events WHERE value > 100 GROUP BY event_type")
def adhoc_sql(spark, sf):
    return health.ad_hoc(
        {"skyloom_events": load_table(spark, sf, "events")},
        "SELECT event_type, count(*) AS n FROM skyloom_events WHERE value > 100 GROUP BY event_type",
    )


# Maintenance.


@query("evolve_copy", """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 <> 3 THEN text END AS text FROM documents)
  SELECT min(doc_id) AS timestamp, sha256(text) AS raw_data_hash, min(doc_id) AS fetched_at, CAST(NULL AS VARCHAR) AS note
  FROM d WHERE text IS NOT NULL GROUP BY sha256(text)
  UNION ALL SELECT doc_id, NULL, doc_id, NULL FROM d WHERE text IS NULL""")
def evolve_copy(spark, sf):
    from pyspark.sql import types as T

    """Some payloads are missing: a NULL hash is in nobody's way, so all of these are copied."""
    raw = F.when(F.col("doc_id") % 50 != 3, F.col("text")).alias("raw_data")
    old = load_table(spark, sf, "documents").select(F.col("doc_id").alias("timestamp"), raw, "lang")
    schema = T.StructType([
        T.StructField("timestamp", T.LongType()), T.StructField("raw_data_hash", T.StringType()),
        T.StructField("fetched_at", T.LongType()), T.StructField("note", T.StringType()),
    ])
    return maintenance.evolve_copy(old, schema, ["raw_data_hash"], ["timestamp"])


@query("backfill_valid_time", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'kept'
    WHEN 1 THEN strftime(date_trunc('day', ts) + to_hours(CAST(6 + event_id % 24 * 3 AS INTEGER)), '%Y-%m-%dT%H:%M:%S+00:00')
    WHEN 2 THEN strftime(date_trunc('day', ts) + to_hours(CAST(12 + event_id % 24 * 3 AS INTEGER)), '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS valid_time FROM events""")
def backfill_valid_time(spark, sf):
    key = F.col("event_id")
    rows = load_table(spark, sf, "events").select(
        "event_id", iso_text("ts").alias("fetched_at"),
        F.when(key % 4 == 0, "kept").alias("valid_time"),
        F.when(key % 4 == 1, "6").when(key % 4 == 2, F.date_format("ts", "yyyyMMdd_12'z'")).otherwise("bad").alias("cycle"),
        F.lpad((key % 24 * 3).cast("string"), 3, "0").alias("fhr"),
    )
    return maintenance.backfill_valid_time(rows).select("event_id", "valid_time")


@query("retag_synthetic", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'fallback_constant' WHEN event_id % 3 = 2 THEN 'noaa' ELSE 'given' END AS source,
    CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS is_synthetic FROM events""")
def retag_synthetic(spark, sf):
    key = F.col("event_id")
    constant = key % 10 == 0
    rows = load_table(spark, sf, "events").select(
        "event_id", F.when(key % 3 < 2, "given").alias("source"), F.when(key % 3 < 2, 0).alias("is_synthetic"),
        F.when(constant, 25.0).otherwise(F.col("value")).alias("temperature_raw"),
        F.when(key % 2 == 0, 0.0).alias("precipitation_raw"),
        F.lit(1.0).alias("u_wind_raw"), F.when(constant, 1.0).otherwise(-F.col("value")).alias("v_wind_raw"),
    )
    return maintenance.retag_synthetic(rows, "noaa").select("event_id", "source", "is_synthetic")


@query("clear_unmeasured", """SELECT event_id, CASE WHEN event_id % 4 > 0 THEN value END AS precipitation_raw,
    CASE WHEN event_id % 4 > 0 THEN 'ok' ELSE 'no_accumulation_window' END AS precipitation_qc_flag,
    CASE WHEN event_id % 4 > 0 THEN 1 ELSE 0 END AS precipitation_imputed, CASE WHEN event_id % 4 > 0 THEN 3 END AS precipitation_window_h FROM events""")
def clear_unmeasured(spark, sf):
    rows = load_table(spark, sf, "events").select(
        "event_id", F.lpad((F.col("event_id") % 4 * 3).cast("string"), 3, "0").alias("fhr"),
        F.col("value").alias("precipitation_raw"), F.lit("ok").alias("precipitation_qc_flag"),
        F.lit(1).alias("precipitation_imputed"), F.lit(3).alias("precipitation_window_h"),
    )
    once = maintenance.clear_unmeasured(rows)
    return maintenance.clear_unmeasured(once).drop("fhr")


@query("clear_preview", "SELECT count(*) AS n_rows, count(*) FILTER (event_id % 4 = 0) AS n_to_clear FROM events")
def clear_preview(spark, sf):
    rows = load_table(spark, sf, "events").select(
        F.lpad((F.col("event_id") % 4 * 3).cast("string"), 3, "0").alias("fhr"), F.col("value").alias("precipitation_raw")
    )
    return maintenance.clear_preview(rows)


@query("relabel_partition", """SELECT count(*) AS rows_before, count(*) FILTER (o_orderpriority = '2-HIGH') AS relabelled, count(*) AS rows_after,
    CAST(0 AS BIGINT) AS remaining, 1 AS verified FROM orders""")
def relabel_partition(spark, sf):
    """On storage: the old label's partition is gone afterwards and no row with it."""
    orders = load_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "relabel")
    lake.overwrite_partitions(orders, path, ["o_orderpriority"])
    maintenance.relabel_partition(spark, path, "o_orderpriority", "2-HIGH", "1-URGENT")
    return maintenance.verify_relabel(orders, spark.read.parquet(path), "o_orderpriority", "2-HIGH")
