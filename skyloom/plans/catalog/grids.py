"""Forecast grids over the event table: message files, accumulation buckets, extracts."""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from skyloom.operators import accumulation as A
from skyloom.plans import export, silver
from skyloom.plans.catalog.base import READINGS, query, readings, rounded
from skyloom.plans.catalog.chain_sql import chain_ctes
from skyloom.plans.catalog.features import GRID, grid
from skyloom.profiles import FORECAST
from skyloom.session import load_table
from skyloom.sources import grids as G

BLOCK = 16
#: Bytes of a packed value: the widest the reader takes.
PACKED_BYTES = G.MAX_BITS // 8


def _hex(value, width: int) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.lpad(F.hex(value.cast("bigint")), 2 * width, "0")


def _packed(value: Column) -> Column:
    """Hex text of a packed value; one that needs more bytes is refused, as padding would cut it."""
    fits = value.between(0, (1 << 8 * PACKED_BYTES) - 1) | value.isNull()
    return F.when(fits, _hex(value, PACKED_BYTES)).otherwise(F.raise_error(F.lit("a packed value is too wide")))


def _message(data: Column, field, *, surface, level, rows, nbits=8 * PACKED_BYTES, reference="00000000",
             binary=0, decimal=0, hour=0, span=None) -> Column:
    """Hex text of one message over a grid of four columns."""
    zeros = lambda n: F.lit("00" * n)
    grid_part = [
        _hex(72, 4), _hex(3, 1), zeros(1), _hex(rows * 4, 4), zeros(20), _hex(4, 4), _hex(rows, 4), zeros(8),
        _hex(10_000_000, 4), _hex(70_000_000, 4), zeros(1),
        _hex(10_000_000 + (rows - 1) * 250_000, 4), _hex(70_750_000, 4),
        _hex(250_000, 4), _hex(250_000, 4), _hex(G.SCAN_SOUTH_TO_NORTH, 1),
    ]
    product = [
        _hex(58, 4), _hex(4, 1), zeros(2), _hex(0 if span is None else 8, 2), _hex(field[0], 1),
        _hex(field[1], 1), zeros(7), _hex(hour, 4), _hex(surface, 1), zeros(1), _hex(level, 4),
        zeros(21), _hex(0 if span is None else span, 4), zeros(5),
    ]
    packing = [
        _hex(21, 4), _hex(5, 1), _hex(rows * 4, 4), _hex(0, 2), F.lit(reference), _hex(binary, 2),
        _hex(decimal, 2), _hex(nbits, 1), zeros(1),
    ]
    size = F.length(data) / 2
    body = F.concat(*grid_part, *product, *packing, _hex(size + 5, 4), _hex(7, 1), data, F.lit("37373737"))
    return F.concat(F.lit("47524942"), zeros(2), _hex(0, 1), _hex(2, 1), _hex(F.length(body) / 2 + 16, 8), body)


def message_files(spark, sf):
    """One file per sixteen events: six messages, junk ahead, a damaged and a cut-off message
    behind; every tenth file is an error page."""
    e = load_table(spark, sf, "events")
    value = F.col("value")
    packed = {
        "skin": value.cast("bigint") + 3000,
        "air": (value * 10).cast("bigint") + 20000,
        "wind": (value * 100).cast("bigint"),
        "rain": (value * 16).cast("bigint"),
    }
    blocks = e.groupBy(F.expr("event_id div 16").alias("block")).agg(
        # Sixteen rows per block.
        F.array_sort(
            F.collect_list(F.struct("event_id", *[_packed(c).alias(n) for n, c in packed.items()]))
        ).alias("rows")
    )
    data = {n: F.array_join(F.col(f"rows.{n}"), "") for n in packed}
    n_rows = F.ceil(F.size("rows") / 4)
    hour = (F.col("block") % 24 + 1) * 3
    span = F.when(F.col("block") % 2 == 0, 3).otherwise(6)
    messages = [
        _message(data["skin"], (0, 0), surface=1, level=0, rows=n_rows, decimal=1, hour=hour),
        _message(data["air"], (0, 0), surface=103, level=2, rows=n_rows, decimal=2, hour=hour),
        _message(data["wind"], (2, 2), surface=103, level=10, rows=n_rows, binary=0x8002, decimal=1, hour=hour),
        _message(F.lit(""), (2, 3), surface=103, level=10, rows=n_rows, nbits=0, reference="3FC00000", hour=hour),
        _message(data["rain"], (1, 8), surface=1, level=0, rows=n_rows, binary=0x8004, hour=0, span=hour),
        _message(data["rain"], (1, 8), surface=1, level=0, rows=n_rows, binary=0x8004, hour=hour - span, span=span),
    ]
    damaged = F.lit("47524942" + "00000002" + "0000000000000019" + "0000000504" + "37373737")
    cut_off = F.lit("47524942000000020000000000FFFFFF")
    body = F.unhex(F.concat(messages[0], F.lit("0A0B"), *messages[1:], damaged, cut_off))
    page = F.encode(F.concat(F.lit("<html>no such cycle "), F.col("block"), F.lit("</html>")), "utf-8")
    return blocks.select(
        F.concat(F.lit("run/"), F.col("block")).alias("file"),
        F.when(F.col("block") % 10 == 9, page).otherwise(body).alias("content"),
    )


FILES_SQL = """f AS (SELECT event_id // 16 AS block, 'run/' || (event_id // 16) AS file, CAST(event_id % 16 AS INTEGER) AS point,
    (event_id // 16 % 24 + 1) * 3 AS hour, CASE WHEN event_id // 16 % 2 = 0 THEN 3 ELSE 6 END AS span,
    10 + (event_id % 16 // 4) * 0.25e0 AS lat, 70 + (event_id % 4) * 0.25e0 AS lon, value
  FROM events WHERE event_id // 16 % 10 <> 9)"""


@query("payload_guard", """SELECT 'run/' || block AS file, CAST(block % 10 <> 9 AS INTEGER) AS accepted
  FROM (SELECT DISTINCT event_id // 16 AS block FROM events)""")
def payload_guard(spark, sf):
    good, bad = G.guard_payload(message_files(spark, sf))
    return good.select("file", F.lit(1).alias("accepted")).union(bad.select("file", F.lit(0)))


def decoded(spark, sf):
    good, _ = G.guard_payload(message_files(spark, sf))
    return G.decode_messages(good)


@query("grid_message_scan", f"""WITH {FILES_SQL}
  SELECT file, 0 AS msg, 0 AS category, 0 AS number, 1 AS surface, 0e0 AS level, CAST(NULL AS INTEGER) AS span_h,
    point, lat, lon, (trunc(value) + 3000) * pow(10e0, -1e0) AS value FROM f
  UNION ALL SELECT file, 1, 0, 0, 103, 2e0, NULL, point, lat, lon, (trunc(value * 10) + 20000) * pow(10e0, -2e0) FROM f
  UNION ALL SELECT file, 2, 2, 2, 103, 10e0, NULL, point, lat, lon, (trunc(value * 100) * 0.25e0) * pow(10e0, -1e0) FROM f
  UNION ALL SELECT file, 3, 2, 3, 103, 10e0, NULL, point, lat, lon, 1.5e0 FROM f
  UNION ALL SELECT file, 4, 1, 8, 1, 0e0, CAST(hour AS INTEGER), point, lat, lon, trunc(value * 16) * 0.0625e0 FROM f
  UNION ALL SELECT file, 5, 1, 8, 1, 0e0, span, point, lat, lon, trunc(value * 16) * 0.0625e0 FROM f""")
def grid_message_scan(spark, sf):
    return decoded(spark, sf).where("error IS NULL").select(
        "file", "msg", "category", "number", "surface", "level", "span_h", "point", "lat", "lon", "value"
    )


@query("select_by_level", f"""WITH {FILES_SQL}
  SELECT file, 'temperature_c' AS field, point, round((trunc(value * 10) + 20000) * pow(10e0, -2e0) - 273.15e0, 3) AS value FROM f
  UNION ALL SELECT file, 'u_wind_ms', point, round((trunc(value * 100) * 0.25e0) * pow(10e0, -1e0), 3) FROM f
  UNION ALL SELECT file, 'v_wind_ms', point, 1.5e0 FROM f""")
def select_by_level(spark, sf):
    return G.select_fields(decoded(spark, sf)).select("file", "field", "point", "value")


@query("argmin_record", f"""WITH {FILES_SQL}
  SELECT file, point, CAST(least(span, hour) AS INTEGER) AS span_h, trunc(value * 16) * 0.0625e0 AS value FROM f""")
def argmin_record(spark, sf):
    return G.accumulation_buckets(decoded(spark, sf)).select("file", "point", "span_h", "value")


@query("forecast_assemble", f"""WITH {FILES_SQL} SELECT file, 'c' || block AS cycle, CAST(hour AS INTEGER) AS fhr, point, lat, lon,
    round((trunc(value * 10) + 20000) * pow(10e0, -2e0) - 273.15e0, 3) AS temperature_c,
    round((trunc(value * 100) * 0.25e0) * pow(10e0, -1e0), 3) AS u_wind_ms, 1.5e0 AS v_wind_ms,
    trunc(value * 16) * 0.0625e0 AS bucket, CAST(least(span, hour) AS INTEGER) AS span_h FROM f""")
def forecast_assemble(spark, sf):
    files, _ = G.guard_payload(message_files(spark, sf))
    block = F.substring_index("file", "/", -1)
    steps = files.select("file", F.concat(F.lit("c"), block).alias("cycle"), ((block.cast("bigint") % 24 + 1) * 3).alias("fhr"))
    return G.assemble_run(decoded(spark, sf), steps).drop("constant_zero")


@query("grid_generate", f"""WITH {READINGS}, box AS (SELECT city, min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS d
    FROM readings GROUP BY city)
  SELECT city, round(a + i * 1e0, 2) AS lat, round(c + j * 1e0, 2) AS lon FROM box,
    (SELECT range AS i FROM range(0, 200)) x, (SELECT range AS j FROM range(0, 200)) y
  WHERE i <= floor(b - a + 1e-9) AND j <= floor(d - c + 1e-9)""")
def grid_generate(spark, sf):
    box = readings(spark, sf).groupBy("city").agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
    )
    return G.regular_grid(box, 1.0, keep=("city",))


@query("synthetic_fallback", f"""WITH {READINGS}, box AS (SELECT strftime(ts, '%Y%m%d_00z') AS cycle, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS valid_time,
    min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS d FROM readings GROUP BY ALL)
  SELECT cycle, valid_time, '000' AS fhr, round(a + i * 2e0, 2) AS lat, round(c + j * 2e0, 2) AS lon, 25e0 AS temperature_raw,
    CAST(NULL AS DOUBLE) AS precipitation_raw, 1e0 AS u_wind_raw, 'fallback_constant' AS source, 1 AS is_synthetic
  FROM box, (SELECT range AS i FROM range(0, 100)) x, (SELECT range AS j FROM range(0, 100)) y
  WHERE i <= floor((b - a) / 2 + 1e-9) AND j <= floor((d - c) / 2 + 1e-9)""")
def synthetic_fallback(spark, sf):
    """A placeholder grid for every day of the table, over the box of that day's readings."""
    box = readings(spark, sf).groupBy(F.date_format("ts", "yyyyMMdd_00'z'").alias("day")).agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
    )
    points = G.regular_grid(box, 2.0, keep=("day",))
    made = G.synthetic_fallback(points, F.col("day"), F.lit("2024-02-01T00:00:00+00:00"))
    from skyloom.functions.scalars import iso_utc_text

    return made.select(
        "cycle", iso_utc_text("valid_time").alias("valid_time"), "fhr", "lat", "lon", "temperature_raw",
        "precipitation_raw", "u_wind_raw", "source", "is_synthetic",
    )


# Accumulation buckets: eight events are one point's run of steps 0, 3, … 21.


def runs(spark, sf):
    e = load_table(spark, sf, "events").select("event_id", "value", F.expr("event_id div 8").alias("block"))
    k = F.col("event_id") % 8
    # Eight rows per block.
    before = F.lag("value").over(Window.partitionBy("block").orderBy("event_id"))
    return e.withColumn("_before", before).select(
        "event_id",
        F.concat(F.lit("202401"), F.lpad((F.col("block") % 28 + 1).cast("string"), 2, "0"), F.lit("_00z")).alias("cycle"),
        F.expr("block div 28").cast("double").alias("lat"),
        F.lit(68.0).alias("lon"),
        (k * 3).cast("int").alias("fhr"),
        F.when(k == 0, None).when(k % 2 == 1, F.col("value")).otherwise(F.col("value") + F.col("_before")).alias("bucket"),
        F.when(k == 0, None).when(k % 2 == 1, 3).otherwise(6).alias("span_h"),
        F.lit(False).alias("constant_zero"),
        F.col("value"),
    )


RUNS = """runs AS (SELECT event_id, event_id // 8 AS block, value, event_id % 8 AS k, lag(value) OVER (PARTITION BY event_id // 8 ORDER BY event_id) AS pv,
    '202401' || lpad(CAST(event_id // 8 % 28 + 1 AS VARCHAR), 2, '0') || '_00z' AS cycle FROM events)"""


@query("bucket_difference", f"""WITH {RUNS} SELECT event_id, CASE WHEN k = 0 THEN NULL WHEN k % 2 = 1 THEN round(value, 2)
    ELSE round((value + pv) - pv, 2) END AS increment, CAST(0 AS INTEGER) AS no_difference FROM runs""")
def bucket_difference(spark, sf):
    made = A.bucket_increments(runs(spark, sf), point=["cycle", "lat", "lon"])
    return made.select("event_id", F.round("increment", 2).alias("increment"), F.col("no_difference").cast("int").alias("no_difference"))


@query("accum_increments", f"WITH {RUNS} SELECT event_id, CASE WHEN k > 0 THEN round(value, 2) END AS increment FROM runs")
def accum_increments(spark, sf):
    """Increments of every run, refused as a whole when any of the checks fails."""
    r = runs(spark, sf)
    made = A.increments_or_raise(r, _totals(r))
    return made.select("event_id", F.round("increment", 2).alias("increment"))


def _totals(r):
    return r.where(F.col("fhr") > 0).groupBy("cycle", "lat", "lon").agg(F.sum("value").alias("run_total"))


@query("accumulation_reconcile", f"""WITH {RUNS}, p AS (SELECT cycle, block, CASE WHEN max(block % 28) > 3 THEN sum(value) FILTER (k > 0) END AS total FROM runs GROUP BY ALL)
  SELECT cycle, CASE WHEN count(total) > 0 THEN 0 END AS gap_mm, round(greatest(0.25, 0.02 * max(total)), 4) AS tolerance,
    count(*) - count(total) AS without_total, CAST(count(total) = count(*) AS INTEGER) AS reconciled FROM p GROUP BY cycle""")
def accumulation_reconcile(spark, sf):
    r = runs(spark, sf)
    made = A.bucket_increments(r, point=["cycle", "lat", "lon"])
    # The first days' runs come without totals.
    totals = _totals(r).where(F.substring("cycle", 7, 2).cast("int") > 4)
    out = A.reconcile(made, totals, run=["cycle"], point=["cycle", "lat", "lon"])
    return out.select(
        "cycle", F.round("worst_gap", 2).cast("int").alias("gap_mm"), F.round("tolerance", 4).alias("tolerance"), "without_total",
        F.col("reconciled").cast("int").alias("reconciled"),
    )


@query("all_zero_guard", f"""WITH {RUNS} SELECT cycle, count(*) FILTER (k > 0 AND value > 10000) AS negative,
    CAST(sum(CASE WHEN k > 0 AND block % 28 > 13 THEN value ELSE 0 END) = 0 AS INTEGER) AS all_zero,
    CAST(sum(CASE WHEN k > 0 AND block % 28 > 13 THEN value ELSE 0 END) = 0 AND block % 28 > 6 AS INTEGER) AS zero_but_packed
  FROM runs GROUP BY cycle, block % 28""")
def all_zero_guard(spark, sf):
    """Half of the runs zeroed: some because their fields were packed as constant zeros, some as
    a broken decode would zero them."""
    r = runs(spark, sf)
    day = F.substring("cycle", 7, 2).cast("int") - 1
    zeroed = r.withColumn("bucket", F.when(F.col("bucket").isNotNull(), F.when(day > 13, F.col("bucket")).otherwise(0.0)))
    zeroed = zeroed.withColumn("constant_zero", day <= 6)
    made = A.bucket_increments(zeroed, point=["cycle", "lat", "lon"])
    out = A.run_checks(made, None)
    return out.select("cycle", "negative", F.col("all_zero").cast("int").alias("all_zero"),
                      F.col("zero_but_packed").cast("int").alias("zero_but_packed"))


@query("newest_complete_group", f"""WITH {READINGS}, {GRID}, n AS (SELECT source, cycle, count(DISTINCT fhr) AS c FROM grid GROUP BY ALL)
  SELECT source, max(cycle) AS cycle FROM n WHERE c >= 8 GROUP BY source""")
def newest_complete_group(spark, sf):
    return A.newest_complete(grid(spark, sf), "cycle", "fhr", 8, by=["source"])


@query("null_without_window", f"""WITH {READINGS} SELECT event_id, CASE WHEN event_id % 3 > 0 THEN gappy END AS precipitation_clean,
    CASE WHEN event_id % 3 = 0 THEN 'no_accumulation_window' ELSE 'ok' END AS precipitation_qc_flag,
    CAST(event_id % 3 > 0 AS INTEGER) AS precipitation_imputed FROM readings""")
def null_without_window(spark, sf):
    r = readings(spark, sf).select(
        "event_id", F.col("gappy").alias("precipitation_clean"), F.lit("ok").alias("precipitation_qc_flag"),
        F.lit(1).alias("precipitation_imputed"), F.when(F.col("event_id") % 3 > 0, 3).alias("window_h"),
    )
    return A.null_without_window(
        r, window="window_h", values=["precipitation_clean"], flag="precipitation_qc_flag",
        imputed="precipitation_imputed",
    ).drop("window_h")


RAIN = "precipitation_mm_3h"
STEADY = [r for r in FORECAST if r.column != RAIN]


@query("silver_forecast", f"""WITH {RUNS}, src AS (SELECT event_id, cycle, CAST(block // 28 AS DOUBLE) AS lat, 68e0 AS lon, CAST(k * 3 AS SMALLINT) AS fhr,
    strftime(strptime(cycle, '%Y%m%d_00z') + to_hours(CAST(k * 3 AS INTEGER)), '%Y-%m-%dT%H:%M:%S+00:00') AS valid_time,
    CASE WHEN event_id % 7 > 1 THEN value / 10 END AS temperature_c, value - 50 AS u_wind_ms, 1.5e0 AS v_wind_ms,
    CASE WHEN k > 0 THEN round(value, 2) END AS {RAIN} FROM runs),
  {chain_ctes('src', FORECAST, part='(cycle, lat, lon)', order='valid_time', tie='valid_time, cycle', pool='s.cycle')}
  SELECT valid_time, cycle, fhr, lat, lon, {', '.join(f"round({r.column}_clean, 4) AS {r.column}, {r.column}_qc_flag, {r.column}_imputed = 1 AS {r.column}_imputed" for r in STEADY)},
    CASE WHEN fhr > 0 THEN {RAIN} END AS {RAIN}, CASE WHEN fhr > 0 THEN {RAIN}_qc_flag ELSE 'no_accumulation_window' END AS {RAIN}_qc_flag,
    FALSE AS {RAIN}_imputed, 'noaa' AS source, FALSE AS is_synthetic, '2024-02-01T00:00:00+00:00' AS fetched_at FROM chained""")
def silver_forecast(spark, sf):
    r = runs(spark, sf)
    key = F.col("event_id")
    fields = r.withColumns(
        {
            "temperature_c": F.when(key % 7 > 1, F.col("value") / 10),
            "u_wind_ms": F.col("value") - 50,
            "v_wind_ms": F.lit(1.5),
            "fetched_at": F.lit("2024-02-01T00:00:00+00:00"),
        }
    ).drop("value", "event_id")
    out = silver.silver_forecast(fields, _totals(r))
    out = rounded(out, *[r.column for r in STEADY], digits=4)
    return rounded(out, RAIN, digits=2)


def export_grid(spark, sf):
    g = grid(spark, sf)
    flags = {}
    for v in ("temperature", "u_wind", "v_wind"):
        flags[f"{v}_qc_flag"] = F.when(F.col("event_id") % 5 > 0, "step_fail")
        flags[f"{v}_imputed"] = F.when(F.col("event_id") % 4 > 0, 1)
    return g.withColumns(flags)


@query("unpivot_long", f"""WITH {READINGS}, {GRID}, g AS (SELECT * FROM grid WHERE is_synthetic = 0),
  l AS (SELECT g.*, 'temperature' AS variable, temperature_clean AS value, temperature_raw AS value_raw, 'degC' AS unit FROM g
    UNION ALL SELECT g.*, 'u_wind', u_wind_clean, u_wind_clean, 'm s-1' FROM g
    UNION ALL SELECT g.*, 'v_wind', v_wind_clean, v_wind_clean, 'm s-1' FROM g)
  SELECT valid_time, cycle, CAST(step AS SMALLINT) AS fhr, lat, lon, variable, value, value_raw, unit,
    CASE WHEN event_id % 5 > 0 THEN 'step_fail' ELSE 'ok' END AS qc_flag, event_id % 4 > 0 AS imputed, source,
    is_synthetic = 1 AS is_synthetic FROM l""")
def unpivot_long(spark, sf):
    from skyloom.functions.scalars import iso_utc_text

    rows = export.select_rows(export_grid(spark, sf))
    long = export.to_long(rows, export.exported_variables(), order=())
    return long.withColumn("valid_time", iso_utc_text("valid_time")).drop("fetched_at")


WIDE = """SELECT valid_time, cycle, CAST(step AS SMALLINT) AS fhr, lat, lon, temperature_clean AS temperature_c,
    temperature_raw AS temperature_c_raw, CASE WHEN event_id % 5 > 0 THEN 'step_fail' ELSE 'ok' END AS temperature_qc_flag,
    event_id % 4 > 0 AS temperature_imputed, u_wind_clean AS u_wind_ms, u_wind_clean AS u_wind_ms_raw,
    CASE WHEN event_id % 5 > 0 THEN 'step_fail' ELSE 'ok' END AS u_wind_qc_flag, event_id % 4 > 0 AS u_wind_imputed,
    v_wind_clean AS v_wind_ms, v_wind_clean AS v_wind_ms_raw,
    CASE WHEN event_id % 5 > 0 THEN 'step_fail' ELSE 'ok' END AS v_wind_qc_flag, event_id % 4 > 0 AS v_wind_imputed,
    source, is_synthetic = 1 AS is_synthetic, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS fetched_at FROM grid"""


@query("wide_with_units", f"WITH {READINGS}, {GRID} {WIDE} WHERE is_synthetic = 0")
def wide_with_units(spark, sf):
    rows = export.select_rows(export_grid(spark, sf))
    return export.to_wide(rows, export.exported_variables(), order=())


@query("sorted_export", f"WITH {READINGS}, {GRID} {WIDE} WHERE lat BETWEEN 10 AND 20 AND lon BETWEEN 70 AND 85 ORDER BY valid_time, lat, lon")
def sorted_export(spark, sf):
    rows = export.select_rows(export_grid(spark, sf), include_synthetic=True, box=(10, 20, 70, 85))
    return export.to_wide(rows, export.exported_variables())


@query("extract_profile", f"""WITH {READINGS}, {GRID} SELECT count(*) AS n_rows, count(DISTINCT (lat, lon)) AS n_points,
    count(DISTINCT fhr) AS n_steps, count(DISTINCT cycle) AS n_groups, min(fhr) AS first_step, max(fhr) AS last_step,
    min(precipitation_clean) AS min_value, max(precipitation_clean) AS max_value,
    count(*) FILTER (precipitation_clean > 20) AS wet_cells, count(precipitation_clean) AS n_values,
    round(sum(precipitation_clean), 4) AS total_value FROM grid""".replace("> 20", "> 0"))
def extract_profile(spark, sf):
    from skyloom.plans.health import extract_profile as profile

    out = profile(grid(spark, sf), "precipitation_clean", "fhr", "cycle")
    return out.withColumn("total_value", F.round("total_value", 4))


@query("cycle_breakdown", f"""WITH {READINGS}, {GRID} SELECT cycle, fhr, valid_time, count(*) AS n_rows FROM grid
  GROUP BY ALL ORDER BY cycle, fhr, valid_time LIMIT 5""")
def cycle_breakdown(spark, sf):
    from skyloom.plans.health import breakdown

    return breakdown(grid(spark, sf), ["cycle", "fhr", "valid_time"], 5)


@query("bbox_coverage", f"""WITH {READINGS} SELECT city, min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon,
    max(lon) AS max_lon, CAST(min(lat) <= 6 AND max(lat) >= 37 AND min(lon) <= 68 AND max(lon) >= 97 AS INTEGER) AS covers_box
  FROM readings GROUP BY city""")
def bbox_coverage(spark, sf):
    from skyloom.plans.health import coverage

    return coverage(readings(spark, sf), (6.0, 37.0, 68.0, 97.0), ["city"])
