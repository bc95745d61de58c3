"""Season studies: line items are a station's weather, orders are the events of a day."""

from pyspark.sql import functions as F

from skyloom.operators.correlation import correlate, pearson as pearson_of
from skyloom.plans import season
from skyloom.plans.catalog.base import READINGS, circular_sql, iso_text, query, readings, rounded
from skyloom.plans.catalog.scalars import SECTOR_CASE
from skyloom.profiles import BELT, CITIES
from skyloom.session import load_table

RAIN_ABOVE = 48


def weather(spark, sf):
    rain = F.greatest(F.col("l_quantity") - RAIN_ABOVE, F.lit(0.0))
    return load_table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"),
        F.col("l_quantity").alias("t"),
        (F.col("l_discount") * 100).alias("rh"),
        F.when(F.col("l_orderkey") % 9 < 8, rain).alias("rain"),
        (F.col("l_tax") * 100).alias("ws"),
        (F.col("l_extendedprice") % 360).alias("wd"),
        F.col("l_suppkey").alias("place"),
    )


def fires(spark, sf):
    return load_table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).agg(
        F.count(F.lit(1)).alias("fires")
    )


def daily(spark, sf):
    return season.daily_frame(fires(spark, sf), season.weather_per_day(weather(spark, sf)))


DAILY = f"""wx AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS d, l_quantity AS t, l_discount * 100 AS rh,
    CASE WHEN l_orderkey % 9 < 8 THEN greatest(l_quantity - {RAIN_ABOVE}, 0) END AS rain, l_tax * 100 AS ws,
    l_extendedprice % 360 AS wd, l_suppkey AS place FROM lineitem),
  fr AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS fires FROM orders GROUP BY 1),
  wd AS (SELECT d, avg(t) AS t_mean, max(t) AS t_max, avg(rh) AS rh_mean, coalesce(sum(rain), 0) AS rain_sum,
    avg(ws) AS ws_mean, {circular_sql('wd')} AS wd_circ FROM wx GROUP BY d),
  daily AS (SELECT wd.*, coalesce(fires, 0) AS fires, wd.d[1:4] AS year, wd.d[6:7] AS month FROM wd LEFT JOIN fr ON wd.d = fr.d)"""


@query("events_per_day_bbox", f"""WITH {READINGS} SELECT strftime(ts, '%Y-%m-%d') AS d, count(*) AS fires FROM readings
  WHERE lat BETWEEN 29 AND 32 AND lon BETWEEN 74 AND 77.5 GROUP BY 1""")
def events_per_day_bbox(spark, sf):
    r = readings(spark, sf).select("lat", "lon", iso_text("ts").alias("timestamp"))
    return season.events_per_day(r, BELT, 2020, 2025)


@query("spine_left_join", f"WITH {DAILY} SELECT d, CAST(fires AS BIGINT) AS fires, year, month FROM daily")
def spine_left_join(spark, sf):
    return daily(spark, sf).select("d", "fires", "year", "month")


@query("fire_weather_daily", f"""WITH {DAILY} SELECT d, round(t_mean, 6) AS t_mean, t_max, round(rh_mean, 6) AS rh_mean,
    round(rain_sum, 6) AS rain_sum, round(ws_mean, 6) AS ws_mean, round(wd_circ, 5) AS wd_circ, CAST(fires AS BIGINT) AS fires, year, month FROM daily""")
def fire_weather_daily(spark, sf):
    out = rounded(daily(spark, sf), "t_mean", "rh_mean", "rain_sum", "ws_mean")
    return rounded(out, "wd_circ", digits=5)


@query("pearson", f"""WITH {READINGS} SELECT city, count(*) AS n, round(corr(gappy, bearing), 6) AS pearson FROM readings
  WHERE gappy IS NOT NULL GROUP BY city""")
def pearson(spark, sf):
    return rounded(pearson_of(readings(spark, sf), "gappy", "bearing", ["city"]), "pearson")


def ranks_sql(source: str, groups: str, x: str, y: str) -> str:
    """Query of n, Pearson and Spearman per group over rows where both sides are present."""
    part = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    by = f"GROUP BY {groups}" if groups else ""
    keys = f"{groups}, " if groups else ""
    return f"""SELECT {lead}count(*) AS n, {_guard('corr(x, y)')} AS pearson, {_guard('corr(rx, ry)')} AS spearman FROM (
      SELECT *, rank() OVER ({part} ORDER BY x) + (count(*) OVER (PARTITION BY {keys}x) - 1) / 2e0 AS rx,
        rank() OVER ({part} ORDER BY y) + (count(*) OVER (PARTITION BY {keys}y) - 1) / 2e0 AS ry
      FROM (SELECT {lead}CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)) {by}"""


def _guard(c: str) -> str:
    return f"CASE WHEN count(*) >= 5 AND stddev_samp(x) > 0 AND stddev_samp(y) > 0 THEN {c} END"


@query("spearman", f"""WITH {READINGS}, r AS ({ranks_sql('readings', 'city', 'gappy', 'coarse')})
  SELECT city, n, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman FROM r""")
def spearman(spark, sf):
    return rounded(correlate(readings(spark, sf), "gappy", "coarse", ["city"]), "pearson", "spearman")


@query("spearman_pooled", f"""WITH {READINGS}, r AS ({ranks_sql('readings', '', 'gappy', 'coarse')})
  SELECT n, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman FROM r""")
def spearman_pooled(spark, sf):
    """The whole table as one group."""
    return rounded(correlate(readings(spark, sf), "gappy", "coarse"), "pearson", "spearman")


def long_sql(source: str, keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{v}' AS variable, fires AS f, {v} AS v FROM {source}" for v in season.VARIABLES
    )


NINE = ", ".join(f"round({v}, 9) AS {v}" for v in ("t_mean", "rh_mean", "rain_sum", "ws_mean"))


@query("corr_by_year", f"""WITH {DAILY}, nine AS (SELECT d, year, month, fires, t_max, {NINE} FROM daily),
  win AS (SELECT * FROM nine WHERE month IN ('10', '11')), lp AS ({long_sql('nine')}), lw AS ({long_sql('win')}), ly AS ({long_sql('win', 'year')}),
  a AS (SELECT 'pooled' AS scope, CAST(NULL AS VARCHAR) AS year, * FROM ({ranks_sql('lp', 'variable', 'f', 'v')})
    UNION ALL SELECT 'window', NULL, * FROM ({ranks_sql('lw', 'variable', 'f', 'v')})
    UNION ALL SELECT 'per_year', * FROM ({ranks_sql('ly', 'year, variable', 'f', 'v')}))
  SELECT scope, year, variable, n, round(pearson, 5) AS pearson, round(spearman, 5) AS spearman FROM a""")
def corr_by_year(spark, sf):
    rows = _exact(daily(spark, sf))
    return rounded(season.correlation_report(rows), "pearson", "spearman", digits=5)


def _exact(df):
    """Daily means rounded, so that equal means rank as equal whatever order they summed in."""
    return rounded(df, "t_mean", "rh_mean", "rain_sum", "ws_mean", digits=9)


@query("lagged_event_study", f"""WITH {DAILY}, win AS (SELECT * FROM daily WHERE month IN ('10', '11')),
  p AS (SELECT a.fires, b.rain_sum AS rain FROM win a JOIN win b ON CAST(a.d AS DATE) = CAST(b.d AS DATE) + 1)
  SELECT count(*) FILTER (rain > 1) AS n_wet, CAST(median(fires) FILTER (rain > 1) AS DOUBLE) AS median_wet, round(avg(fires) FILTER (rain > 1), 6) AS mean_wet,
    count(*) FILTER (rain = 0) AS n_dry, CAST(median(fires) FILTER (rain = 0) AS DOUBLE) AS median_dry, round(avg(fires) FILTER (rain = 0), 6) AS mean_dry,
    round(CASE WHEN count(*) FILTER (rain > 1) > 3 AND count(*) FILTER (rain = 0) > 3 AND median(fires) FILTER (rain = 0) > 0
      THEN median(fires) FILTER (rain > 1) / median(fires) FILTER (rain = 0) END, 6) AS ratio FROM p""")
def lagged_event_study(spark, sf):
    study = season.lagged_event_study(season.burning_window(daily(spark, sf)))
    return rounded(study, "mean_wet", "mean_dry", "ratio")


@query("topk_days", f"WITH {DAILY} SELECT d, CAST(fires AS BIGINT) AS fires FROM daily ORDER BY fires DESC, d LIMIT 30")
def topk_days(spark, sf):
    return season.top_days(daily(spark, sf)).select("d", "fires")


@query("sector_profile", f"""WITH {DAILY}, win AS (SELECT *, {SECTOR_CASE.format(c='wd_circ')} AS sector FROM daily WHERE month IN ('10', '11')),
  top AS (SELECT sector, count(*) AS n FROM (SELECT * FROM win ORDER BY fires DESC, d LIMIT 30) GROUP BY sector)
  SELECT win.sector, coalesce(any_value(top.n), 0) AS top_days, round(coalesce(any_value(top.n), 0) / 30e0, 6) AS top_share,
    round(count(*) / (SELECT count(*) FROM win), 6) AS base_share FROM win LEFT JOIN top ON win.sector = top.sector GROUP BY win.sector""")
def sector_profile(spark, sf):
    return rounded(season.sector_profile(season.burning_window(daily(spark, sf))), "top_share", "base_share")


ANOMALY = ", ".join(f"round({v} - avg({v}) OVER (PARTITION BY d[6:10]), 9) AS {v}" for v in ("fires", *season.VARIABLES))


@query("seasonal_anomaly_corr", f"""WITH {DAILY}, nine AS (SELECT d, fires, t_max, {NINE} FROM daily), an AS (SELECT d, {ANOMALY} FROM nine),
  l0 AS ({long_sql('nine')}), l1 AS ({long_sql('an')}),
  r0 AS ({ranks_sql('l0', 'variable', 'f', 'v')}), r1 AS ({ranks_sql('l1', 'variable', 'f', 'v')})
  SELECT variable, r0.n, round(r0.spearman, 4) AS rho_raw, round(r1.spearman, 4) AS rho_deseasonalised FROM r0 JOIN r1 USING (variable)""")
def seasonal_anomaly_corr(spark, sf):
    out = season.deseasonalised(_exact(daily(spark, sf)))
    return rounded(out.drop("retained"), "rho_raw", "rho_deseasonalised", digits=4)


@query("monthly_climatology", f"""WITH {DAILY}, m AS (SELECT year, month, CAST(sum(fires) AS BIGINT) AS detections FROM daily GROUP BY ALL)
  SELECT year, month, detections, first_value(month) OVER (PARTITION BY year ORDER BY detections DESC, month) AS peak_month FROM m""")
def monthly_climatology(spark, sf):
    return season.monthly_climatology(daily(spark, sf))


@query("sign_consistency", f"""WITH {DAILY}, nine AS (SELECT d, year, month, fires, t_max, {NINE} FROM daily),
  ly AS ({long_sql('nine', 'year')}), lm AS ({long_sql('nine', 'month')}),
  ry AS ({ranks_sql('ly', 'year, variable', 'f', 'v')}), rm AS ({ranks_sql('lm', 'month, variable', 'f', 'v')}),
  y AS (SELECT variable, count(spearman) AS n_years, CAST(min(sign(spearman)) = max(sign(spearman)) AS INTEGER) AS same_sign FROM ry GROUP BY 1),
  m AS (SELECT variable, median(spearman) AS med FROM rm GROUP BY 1)
  SELECT variable, n_years, coalesce(same_sign, 0) AS same_sign, round(med, 5) AS median_month_rho FROM y JOIN m USING (variable)""")
def sign_consistency(spark, sf):
    return rounded(season.sign_consistency(_exact(daily(spark, sf))), "median_month_rho", digits=5)


PLACE_VALUES = ", ".join(f"({i}, '{c[0]}', {c[1]}e0, {c[2]}e0)" for i, c in enumerate(CITIES))


@query("distance_decay_table", f"""WITH {DAILY}, c(slot, city, clat, clon) AS (VALUES {PLACE_VALUES}),
  pd AS (SELECT city, d, round(avg(t), 9) AS v FROM wx JOIN c ON place % 8 = slot GROUP BY ALL),
  j AS (SELECT city, pd.d, v, coalesce(fires, 0) AS f FROM pd LEFT JOIN fr ON pd.d = fr.d),
  an AS (SELECT city, round(v - avg(v) OVER w, 9) AS v, round(f - avg(f) OVER w, 9) AS f FROM j WINDOW w AS (PARTITION BY city, d[6:10])),
  r0 AS ({ranks_sql('j', 'city', 'f', 'v')}), r1 AS ({ranks_sql('an', 'city', 'f', 'v')})
  SELECT city, r0.n, round(r0.pearson, 5) AS r_raw, round(r0.spearman, 5) AS rho_raw, round(r1.spearman, 4) AS rho_deseasonalised,
    round(12742 * asin(sqrt(pow(sin(radians(30.5 - clat) / 2), 2) + cos(radians(clat)) * cos(radians(30.5)) * pow(sin(radians(75.75 - clon) / 2), 2))), 3) AS distance_km
  FROM r0 JOIN r1 USING (city) JOIN c USING (city)""")
def distance_decay_table(spark, sf):
    places = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(CITIES)], "slot bigint, city string, lat double, lon double"
    )
    w = weather(spark, sf).withColumn("slot", F.col("place") % 8)
    per_day = w.groupBy("slot", "d").agg(F.round(F.avg("t"), 9).alias("v"))
    rows = per_day.join(F.broadcast(places.select("slot", "city")), "slot").drop("slot")
    rows = rows.join(fires(spark, sf), "d", "left").withColumn("fires", F.coalesce("fires", F.lit(0)))
    centre = ((BELT[0] + BELT[1]) / 2, (BELT[2] + BELT[3]) / 2)
    out = season.distance_decay(rows, places.drop("slot"), centre, place="city", value="v")
    out = rounded(out, "r_raw", "rho_raw", digits=5)
    return rounded(rounded(out, "rho_deseasonalised", digits=4), "distance_km", digits=3)
