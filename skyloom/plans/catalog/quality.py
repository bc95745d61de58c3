"""Quality control, gap filling and contracts over the event and embedding tables."""

from pyspark.sql import functions as F

from skyloom.operators.contracts import VIOLATIONS, check, validate
from skyloom.operators.nearest import fill_from_nearest
from skyloom.operators.quality import (
    MetricRule,
    flag_log_mad,
    flatlined,
    interpolated,
    out_of_range,
    quality_chain,
    range_only,
    step_exceeded,
)
from skyloom.operators.series import neighbourhood
from skyloom.plans.catalog.base import READINGS, iso_text, query, readings
from skyloom.plans.silver import qc_with_context
from skyloom.profiles import CONTRACTS, QC_PROFILES, SATELLITE
from skyloom.session import load_table

SERIES = ["ts", "event_id"]
OVER = "(PARTITION BY station_id ORDER BY ts, event_id)"


@query("qc_range", f"""WITH {READINGS} SELECT event_id,
  CAST(coalesce(gappy < 5 OR gappy > 300, FALSE) AS INTEGER) AS range_fail FROM readings""")
def qc_range(spark, sf):
    return readings(spark, sf).select(
        "event_id", out_of_range("gappy", 5.0, 300.0).cast("int").alias("range_fail")
    )


@query("qc_step", f"""WITH {READINGS} SELECT event_id,
  CAST(coalesce(abs(gappy - lag(gappy) OVER {OVER}) > 100, FALSE) AS INTEGER) AS step_fail FROM readings""")
def qc_step(spark, sf):
    rule = MetricRule("gappy", max_step=100)
    near = neighbourhood(readings(spark, sf), ["gappy"], groups=["station_id"], order=SERIES)
    return near.select("event_id", step_exceeded(rule).cast("int").alias("step_fail"))


@query("qc_step_circular", f"""WITH {READINGS}, d AS (
    SELECT event_id, abs(bearing - lag(bearing) OVER {OVER}) AS gap FROM readings)
  SELECT event_id, CAST(coalesce(least(gap, 360 - gap) > 45, FALSE) AS INTEGER) AS step_fail FROM d""")
def qc_step_circular(spark, sf):
    rule = MetricRule("bearing", max_step=45, circular=True)
    near = neighbourhood(readings(spark, sf), ["bearing"], groups=["station_id"], order=SERIES)
    return near.select("event_id", step_exceeded(rule).cast("int").alias("step_fail"))


def runs_sql(c: str) -> str:
    """CTEs that give every row the length of its run of equal values of ``c``."""
    return f"""{c}_prior AS (SELECT *, lag({c}) OVER {OVER} AS {c}_before FROM readings),
  {c}_mark AS (SELECT *, sum(CASE WHEN {c} IS NULL OR {c}_before IS NULL OR {c} <> {c}_before THEN 1 ELSE 0 END)
     OVER (PARTITION BY station_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS {c}_run FROM {c}_prior),
  {c}_runs AS (SELECT *, count(*) OVER (PARTITION BY station_id, {c}_run) AS {c}_len FROM {c}_mark)"""


@query("qc_flatline", f"""WITH {READINGS}, {runs_sql('coarse')}
  SELECT event_id, CAST(coarse_len >= 4 AS INTEGER) AS flatline,
    CAST(coarse_len >= 4 AND coarse <> 0 AS INTEGER) AS flatline_nonzero FROM coarse_runs""")
def qc_flatline(spark, sf):
    near = neighbourhood(readings(spark, sf), ["coarse"], groups=["station_id"], order=SERIES)
    return near.select(
        "event_id",
        flatlined(MetricRule("coarse", flat_window=4)).cast("int").alias("flatline"),
        flatlined(MetricRule("coarse", flat_window=4, ignore_zero_runs=True))
        .cast("int")
        .alias("flatline_nonzero"),
    )


def mad_sql(c: str, group: str) -> str:
    """CTEs ``y`` to ``lim`` of the log-space deviation test of ``c`` per ``group``."""
    return f"""y AS (SELECT {group} AS g, event_id, ln(1 + {c}) AS y FROM readings WHERE {c} >= 0),
  med AS (SELECT g, median(y) AS m, quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS iqr FROM y GROUP BY g),
  dev AS (SELECT y.g, event_id, abs(y - m) AS d, iqr FROM y JOIN med ON y.g = med.g),
  mad AS (SELECT g, median(d) AS mad FROM dev GROUP BY g)"""


MAD_TEST = """CASE WHEN mad <> 0 THEN 0.6745e0 * d / mad > 3.5
  WHEN iqr <> 0 THEN d > 1.5 * iqr ELSE FALSE END"""


@query("qc_log_mad", f"""WITH {READINGS}, {mad_sql('gappy', 'city')}
  SELECT r.event_id, CAST(coalesce({MAD_TEST}, FALSE) AS INTEGER) AS mad_outlier
  FROM readings r LEFT JOIN dev ON r.event_id = dev.event_id LEFT JOIN mad ON dev.g = mad.g""")
def qc_log_mad(spark, sf):
    flagged = flag_log_mad(readings(spark, sf), "gappy", ["city"])
    return flagged.select("event_id", F.col("mad_outlier").cast("int").alias("mad_outlier"))


@query("qc_log_mad_quartiles", f"""WITH flat AS (SELECT event_id, CASE WHEN event_id % 20 < 13 THEN 5e0
     WHEN event_id % 20 < 19 THEN 7e0 ELSE value END AS v FROM events),
  {mad_sql('v', '1').replace('FROM readings', 'FROM flat')}
  SELECT r.event_id, CAST(coalesce({MAD_TEST}, FALSE) AS INTEGER) AS mad_outlier
  FROM flat r LEFT JOIN dev ON r.event_id = dev.event_id LEFT JOIN mad ON dev.g = mad.g""")
def qc_log_mad_quartiles(spark, sf):
    key = F.col("event_id") % 20
    flat = F.when(key < 13, F.lit(5.0)).when(key < 19, F.lit(7.0)).otherwise(F.col("value"))
    flagged = flag_log_mad(readings(spark, sf).select("event_id", flat.alias("v")), "v")
    return flagged.select("event_id", F.col("mad_outlier").cast("int").alias("mad_outlier"))


def fill_sql(c: str) -> str:
    """CTE ``<c>_fill`` with the interpolated ``<c>_clean`` of every row."""
    return f"""{c}_pos AS (SELECT *, row_number() OVER {OVER} AS p FROM readings),
  {c}_near AS (SELECT *,
    last_value(CASE WHEN {c} IS NOT NULL THEN p END IGNORE NULLS) OVER w AS pb,
    last_value({c} IGNORE NULLS) OVER w AS vb,
    first_value(CASE WHEN {c} IS NOT NULL THEN p END IGNORE NULLS) OVER x AS pa,
    first_value({c} IGNORE NULLS) OVER x AS va
    FROM {c}_pos
    WINDOW w AS (PARTITION BY station_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           x AS (PARTITION BY station_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  {c}_fill AS (SELECT *, CASE WHEN {c} IS NOT NULL THEN {c} WHEN pb IS NULL OR p - pb > 3 THEN NULL
    WHEN pa IS NULL THEN vb ELSE vb + (va - vb) * (p - pb) / (pa - pb) END AS {c}_clean FROM {c}_near)"""


@query("interpolate_linear", f"""WITH {READINGS}, {fill_sql('gappy')}, {fill_sql('sparse')}
  SELECT g.event_id, gappy_clean, sparse_clean FROM gappy_fill g JOIN sparse_fill s ON g.event_id = s.event_id""")
def interpolate_linear(spark, sf):
    near = neighbourhood(
        readings(spark, sf), ["gappy", "sparse"], groups=["station_id"], order=SERIES
    )
    return near.select(
        "event_id",
        interpolated("gappy").alias("gappy_clean"),
        interpolated("sparse").alias("sparse_clean"),
    )


POINTS = """pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon,
  CASE WHEN vec_id % 5 > 0 THEN CAST(embedding[3] AS DOUBLE) END AS v FROM embeddings)"""


@query("knn_impute", f"""WITH {POINTS},
  pair AS (SELECT u.vec_id, k.v, sqrt((k.lat - u.lat) * (k.lat - u.lat) + (k.lon - u.lon) * (k.lon - u.lon)) AS d,
      k.lat, k.lon, k.vec_id AS t
    FROM pts u, pts k WHERE u.v IS NULL AND k.v IS NOT NULL),
  near AS (SELECT * FROM pair QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, lat, lon, t) <= 5),
  est AS (SELECT vec_id, CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(v) FILTER (d = 0)
      ELSE sum(v / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END AS e FROM near GROUP BY vec_id)
  SELECT pts.vec_id, round(coalesce(v, e), 6) AS v, CAST(v IS NULL AND e IS NOT NULL AS INTEGER) AS imputed
  FROM pts LEFT JOIN est ON pts.vec_id = est.vec_id""")
def knn_impute(spark, sf):
    points = load_table(spark, sf, "embeddings").select(
        "vec_id",
        F.get("embedding", F.lit(0)).cast("double").alias("lat"),
        F.get("embedding", F.lit(1)).cast("double").alias("lon"),
        F.when(F.col("vec_id") % 5 > 0, F.get("embedding", F.lit(2)).cast("double")).alias("raw"),
    )
    filled = fill_from_nearest(
        points.withColumn("v", F.col("raw")), ["v"], lat="lat", lon="lon", tie=["vec_id"]
    )
    return filled.select(
        "vec_id",
        F.round("v", 6).alias("v"),
        (F.col("raw").isNull() & F.col("v").isNotNull()).cast("int").alias("imputed"),
    )


CHAIN_RULES = [
    MetricRule("gappy", 5.0, 300.0, 100.0, name="level"),
    MetricRule("bearing", 0.0, 350.0, 90.0, circular=True, name="dir"),
    MetricRule("coarse", 0.0, 1000.0, None, flat_window=4, ignore_zero_runs=True, name="step"),
]


def flags_sql(parts: dict[str, str]) -> str:
    joined = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in parts.items())
    return f"CASE WHEN concat_ws(',', {joined}) = '' THEN 'ok' ELSE concat_ws(',', {joined}) END"


CHAIN_SQL = f"""{READINGS}, {runs_sql('coarse')}, {fill_sql('gappy')},
  chain AS (SELECT f.event_id, f.ts, f.station_id,
    {flags_sql({'range_fail': 'f.gappy < 5 OR f.gappy > 300',
                'step_fail': 'abs(f.gappy - lag(f.gappy) OVER w) > 100'})} AS level_qc_flag,
    f.gappy_clean AS level_clean,
    CAST(f.gappy IS NULL AND f.gappy_clean IS NOT NULL AS INTEGER) AS level_imputed,
    {flags_sql({'range_fail': 'f.bearing < 0 OR f.bearing > 350',
                'step_fail': 'least(abs(f.bearing - lag(f.bearing) OVER w), '
                             '360 - abs(f.bearing - lag(f.bearing) OVER w)) > 90'})} AS dir_qc_flag,
    {flags_sql({'flatline': 'r.coarse_len >= 4 AND r.coarse <> 0'})} AS step_qc_flag
    FROM gappy_fill f JOIN coarse_runs r ON f.event_id = r.event_id
    WINDOW w AS (PARTITION BY f.station_id ORDER BY f.ts, f.event_id))"""
CHAIN_COLUMNS = ["event_id", "level_qc_flag", "level_clean", "level_imputed", "dir_qc_flag", "step_qc_flag"]


@query("qc_chain", f"WITH {CHAIN_SQL} SELECT {', '.join(CHAIN_COLUMNS)} FROM chain")
def qc_chain(spark, sf):
    out = quality_chain(readings(spark, sf), CHAIN_RULES, groups=["station_id"], order=SERIES)
    return out.select(*CHAIN_COLUMNS)


@query("qc_chain_spatial", f"""WITH {READINGS}, {fill_sql('sparse')},
  known AS (SELECT lat, lon, sparse_clean AS v, ts, event_id FROM sparse_fill WHERE sparse_clean IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY ts, event_id) <= 5),
  wanted AS (SELECT DISTINCT lat, lon FROM sparse_fill WHERE sparse_clean IS NULL),
  pair AS (SELECT u.lat AS ulat, u.lon AS ulon, k.*,
      sqrt((k.lat - u.lat) * (k.lat - u.lat) + (k.lon - u.lon) * (k.lon - u.lon)) AS d FROM wanted u, known k),
  near AS (SELECT * FROM pair QUALIFY row_number() OVER (PARTITION BY ulat, ulon ORDER BY d, lat, lon, ts, event_id) <= 5),
  est AS (SELECT ulat, ulon, CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(v) FILTER (d = 0)
      ELSE sum(v / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END AS e FROM near GROUP BY ulat, ulon)
  SELECT event_id, round(coalesce(sparse_clean, e), 6) AS level_clean,
    CAST(sparse IS NULL AND coalesce(sparse_clean, e) IS NOT NULL AS INTEGER) AS level_imputed,
    CASE WHEN abs(sparse - lag(sparse) OVER (PARTITION BY station_id ORDER BY ts, event_id)) > 300
      THEN 'step_fail' ELSE 'ok' END AS level_qc_flag
  FROM sparse_fill LEFT JOIN est ON lat = ulat AND lon = ulon""")
def qc_chain_spatial(spark, sf):
    """The chain with the spatial step: what a series cannot fill, its neighbours do."""
    out = quality_chain(
        readings(spark, sf),
        [MetricRule("sparse", 0.0, 1000.0, 300.0, name="level")],
        groups=["station_id"],
        order=SERIES,
        lat="lat",
        lon="lon",
    )
    return out.select("event_id", "level_qc_flag", F.round("level_clean", 6).alias("level_clean"), "level_imputed")


@query("qc_with_context", f"""WITH {CHAIN_SQL} SELECT {', '.join(CHAIN_COLUMNS)} FROM chain
  WHERE ts >= TIMESTAMP '2024-01-16'""")
def qc_with_context_query(spark, sf):
    """The second half of the month as a batch behind the stored first half. Unlike a filter on
    the result, the batch sees no later rows; the context is what has been stored."""
    rows = readings(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    out = qc_with_context(
        rows.where(F.col("ts") >= cut),
        rows.where(F.col("ts") < cut),
        CHAIN_RULES,
        station="station_id",
        time="ts",
    )
    return out.select(*CHAIN_COLUMNS)


@query("qc_range_only", """SELECT event_id, value AS no2_clean,
  CASE WHEN value < 0 OR value > 500 THEN 'range_fail' ELSE 'ok' END AS no2_qc_flag,
  CASE WHEN value * 50 < 0 OR value * 50 > 15000 THEN 'range_fail' ELSE 'ok' END AS co_qc_flag FROM events""")
def qc_range_only(spark, sf):
    rows = readings(spark, sf).select(
        "event_id",
        F.col("value").alias("no2_ppb"),
        (F.col("value") * 2).alias("so2_ppb"),
        (F.col("value") * 50).alias("co_ppb"),
        F.col("gappy").alias("o3_ppb"),
    )
    return range_only(rows, SATELLITE).select("event_id", "no2_clean", "no2_qc_flag", "co_qc_flag")


PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{profile}' AS profile, '{r.column}' AS metric, "
    f"CAST(count(*) FILTER (value - 100 < {r.minimum} OR value - 100 > {r.maximum}) AS BIGINT) AS n_range_fail FROM events"
    for profile, rules in QC_PROFILES.items()
    for r in rules
)


@query("qc_profiles", PROFILE_SQL)
def qc_profiles(spark, sf):
    """How many readings each feed's bounds would flag, from one scan."""
    rules = [(p, r) for p, rules in QC_PROFILES.items() for r in rules]
    shifted = F.col("value") - 100
    counts = readings(spark, sf).agg(
        *[F.count_if(out_of_range(shifted, r.minimum, r.maximum)).alias(f"n{i}") for i, (_, r) in enumerate(rules)]
    )
    rows = [
        F.struct(F.lit(p).alias("profile"), F.lit(r.column).alias("metric"), F.col(f"n{i}").alias("n_range_fail"))
        for i, (p, r) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


# Contract inputs: one frame per feed with every rule broken somewhere.


def contract_input(spark, sf, feed):
    r = readings(spark, sf)
    key = F.col("event_id")
    tags = {
        "source": F.when(key % 97 > 0, F.col("source")),
        "is_synthetic": F.when(key % 89 == 0, 2).otherwise(F.col("is_synthetic")),
        "timestamp": iso_text("ts"),
    }
    value = F.col("value")
    columns = {
        "cpcb": {
            "station_id": F.col("station_id"), "city": F.when(key % 83 > 0, F.col("city")),
            "pm25_raw": value * 4, "pm10_raw": value * 5,
            "no2_raw": F.when(key % 79 == 0, "bad").otherwise(value.cast("string")),
            "so2_raw": value - 2, "co_raw": value / 3, "o3_raw": F.col("gappy"),
        },
        "weather": {
            "station": F.col("station_id"), "temperature_raw": value - 62, "humidity_raw": value,
            "rainfall_raw": value * 2, "wind_speed_raw": value / 2, "wind_dir_raw": F.col("bearing"),
        },
        "gfs": {
            "lat": F.col("lat") - 2, "lon": F.when(key % 83 > 0, F.col("lon")), "cycle": F.date_format("ts", "yyyyMMdd_00'z'"),
            "fhr": F.lit("003"), "temperature_raw": value - 62, "precipitation_raw": F.col("gappy"),
            "precipitation_window_h": F.when(key % 4 == 0, 3).when(key % 4 == 1, 6).when(key % 41 == 3, 12),
            "u_wind_raw": value - 50, "v_wind_raw": 50 - value,
        },
        "firms": {
            "lat": F.col("lat") - 2, "lon": F.col("lon"), "brightness_raw": value + 198,
            "satellite": F.when(key % 3 > 0, F.lit("N")),
        },
        "cams_aq": {
            "city": F.col("city"), "pm25_ugm3": value * 7, "pm10_ugm3": value * 8, "no2_ugm3": value * 3,
            "so2_ugm3": value - 2, "co_ugm3": value * 150, "o3_ugm3": F.col("gappy"),
        },
    }[feed]
    return r.select("event_id", *[c.alias(n) for n, c in {**columns, **tags}.items()])


def _tests(*outside: str, extra: str = "0") -> str:
    ranges = " + ".join(f"CAST(coalesce({o}, FALSE) AS INTEGER)" for o in outside)
    return f"{ranges} + {extra} + CAST(event_id % 97 = 0 AS INTEGER) + CAST(event_id % 89 = 0 AS INTEGER)"


CONTRACT_TESTS = {
    "cpcb": _tests(
        "value * 4 > 1000", "value * 5 > 1500", "event_id % 79 <> 0 AND value > 1000",
        "value - 2 < 0 OR value - 2 > 1000", "value / 3 > 100", "gappy > 1000",
        extra="CAST(event_id % 83 = 0 AS INTEGER) + CAST(event_id % 79 = 0 AS INTEGER)"),
    "weather": _tests("value - 62 < -60 OR value - 62 > 60", "value > 100", "value * 2 > 500", "value / 2 > 100",
                      "bearing > 360"),
    "gfs": _tests(
        "lat - 2 < 6 OR lat - 2 > 37", "event_id % 83 > 0 AND (lon < 68 OR lon > 97)",
        "value - 62 < -60 OR value - 62 > 60", "gappy > 500",
        "event_id % 4 > 1 AND event_id % 41 = 3", "value - 50 > 150", "50 - value < -150",
        extra="CAST(event_id % 83 = 0 AS INTEGER)"),
    "firms": _tests("lat - 2 < 6 OR lat - 2 > 37", "lon < 68 OR lon > 97",
                    "value + 198 < 200 OR value + 198 > 600"),
    "cams_aq": _tests("value * 7 > 2000", "value * 8 > 3000", "value * 3 > 1000",
                      "value - 2 < 0 OR value - 2 > 1000", "value * 150 > 50000", "gappy > 1000"),
}
CONTRACT_KEYS = {
    "cpcb": "contract_aq", "weather": "contract_weather", "gfs": "contract_grid",
    "firms": "contract_fire", "cams_aq": "contract_cams",
}


def _register_contract(feed: str) -> None:
    sql = f"WITH {READINGS} SELECT event_id, {CONTRACT_TESTS[feed]} AS n_failures FROM readings"

    @query(CONTRACT_KEYS[feed], sql)
    def contract(spark, sf):
        checked = check(contract_input(spark, sf, feed), CONTRACTS[feed])
        return checked.select("event_id", F.size(VIOLATIONS).alias("n_failures"))


for _feed in CONTRACT_KEYS:
    _register_contract(_feed)


@query("validate_split", f"""WITH {READINGS} SELECT event_id, value * 4 AS pm25_raw,
  CASE WHEN event_id % 79 <> 0 THEN value END AS no2_raw FROM readings WHERE {CONTRACT_TESTS['cpcb']} = 0""")
def validate_split(spark, sf):
    valid, _ = validate(contract_input(spark, sf, "cpcb"), CONTRACTS["cpcb"])
    return valid.select("event_id", "pm25_raw", "no2_raw")


@query("failure_cases", f"""WITH {READINGS}, f AS (
    SELECT 'temperature_raw' AS failed_column, 'in_range(-60, 60)' AS failed_check FROM readings
      WHERE value - 62 < -60 OR value - 62 > 60
    UNION ALL SELECT 'humidity_raw', 'in_range(0, 100)' FROM readings WHERE value > 100
    UNION ALL SELECT 'rainfall_raw', 'in_range(0, 500)' FROM readings WHERE value * 2 > 500
    UNION ALL SELECT 'wind_speed_raw', 'in_range(0, 100)' FROM readings WHERE value / 2 > 100
    UNION ALL SELECT 'source', 'not_null' FROM readings WHERE event_id % 97 = 0
    UNION ALL SELECT 'is_synthetic', 'isin' FROM readings WHERE event_id % 89 = 0)
  SELECT failed_column, failed_check, count(*) AS n_rows FROM f GROUP BY ALL""")
def failure_cases(spark, sf):
    _, failures = validate(contract_input(spark, sf, "weather"), CONTRACTS["weather"])
    return failures.groupBy("failed_column", "failed_check").agg(F.count(F.lit(1)).alias("n_rows"))
