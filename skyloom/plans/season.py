"""Season studies: daily event counts against weather, with and without the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.aggregates import circular_mean, sum_or_zero
from skyloom.functions.scalars import wind_sector
from skyloom.operators.correlation import correlate, seasonal_anomaly, unpivot_pairs
from skyloom.profiles import BURN_MONTHS
from skyloom.session import cut_lineage

VARIABLES = ("t_mean", "t_max", "rh_mean", "rain_sum", "ws_mean")
TOP_DAYS = 30
EARTH_RADIUS_KM = 6371.0


def in_box(lat: str, lon: str, box: Sequence[float]) -> Column:
    return F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3])


def events_per_day(
    events: DataFrame, box: Sequence[float], first_year: int, last_year: int,
    *, lat: str = "lat", lon: str = "lon", timestamp: str = "timestamp",
) -> DataFrame:
    """Detections per text date inside a box and a half-open range of years."""
    return (
        events.where(in_box(lat, lon, box))
        .where((F.col(timestamp) >= str(first_year)) & (F.col(timestamp) < str(last_year + 1)))
        .groupBy(F.substring(timestamp, 1, 10).alias("d"))
        .agg(F.count(F.lit(1)).alias("fires"))
    )


def weather_per_day(weather: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Daily weather; ``weather`` has ``d, t, rh, rain, ws, wd``."""
    return weather.groupBy(*keys, "d").agg(
        F.avg("t").alias("t_mean"),
        F.max("t").alias("t_max"),
        F.avg("rh").alias("rh_mean"),
        sum_or_zero("rain").alias("rain_sum"),
        F.avg("ws").alias("ws_mean"),
        circular_mean("wd").alias("wd_circ"),
    )


def daily_frame(fires: DataFrame, weather_days: DataFrame) -> DataFrame:
    """Weather days with their detections. A day without any is a zero, not a gap: leaving it
    out would hide exactly the wet days."""
    return (
        weather_days.join(fires, "d", "left")
        .withColumn("fires", F.coalesce("fires", F.lit(0)).cast("bigint"))
        .withColumns({"year": F.substring("d", 1, 4), "month": F.substring("d", 6, 2)})
    )


def burning_window(daily: DataFrame, months: Sequence[str] = BURN_MONTHS) -> DataFrame:
    return daily.where(F.col("month").isin(*months))


def correlation_table(
    daily: DataFrame, by: Sequence[str] = (), variables: Sequence[str] = VARIABLES,
    target: str = "fires",
) -> DataFrame:
    """Both coefficients of the target against every variable, optionally per ``by``.

    The pairs are stored once: days times variables is little, their aggregation is not.
    """
    pairs = unpivot_pairs(daily, target, variables, by)
    return correlate(pairs, "x", "y", [*by, "variable"], materialise=True)


def correlation_report(daily: DataFrame, months: Sequence[str] = BURN_MONTHS) -> DataFrame:
    """The pooled, burning-window and per-year tables, from one pass: a day enters each table
    it belongs to."""
    inside = F.col("month").isin(*months)
    whole = F.lit(None).cast("string")

    def scope(name: str, year: Column) -> Column:
        return F.struct(F.lit(name).alias("scope"), year.alias("year"))

    scopes = F.array_compact(
        F.array(
            scope("pooled", whole),
            F.when(inside, scope("window", whole)),
            F.when(inside, scope("per_year", F.col("year"))),
        )
    )
    placed = daily.select("fires", *VARIABLES, F.inline(scopes))
    return correlation_table(placed, ["scope", "year"])


def lagged_event_study(daily: DataFrame, keys: Sequence[str] = (), wet_above: float = 1.0) -> DataFrame:
    """Detections the day after rain against the day after none.

    The previous day is found by an equi-join on the date, which also leaves out days whose
    predecessor is absent. Drizzle up to ``wet_above`` belongs to neither side. Daily rows per
    key are bounded by the calendar, so their exact median is a small aggregate.
    """
    before = daily.select(
        *keys, F.date_add(F.to_date("d"), 1).alias("_day"), F.col("rain_sum").alias("_rain_before")
    )
    paired = daily.withColumn("_day", F.to_date("d")).join(before, [*keys, "_day"])
    wet = F.when(F.col("_rain_before") > wet_above, F.col("fires"))
    dry = F.when(F.col("_rain_before") == 0.0, F.col("fires"))
    study = paired.groupBy(*keys).agg(
        F.count(wet).alias("n_wet"),
        F.median(wet).alias("median_wet"),
        F.avg(wet).alias("mean_wet"),
        F.count(dry).alias("n_dry"),
        F.median(dry).alias("median_dry"),
        F.avg(dry).alias("mean_dry"),
    )
    enough = (F.col("n_wet") > 3) & (F.col("n_dry") > 3) & (F.col("median_dry") > 0)
    return study.withColumn("ratio", F.when(enough, F.col("median_wet") / F.col("median_dry")))


def top_days(daily: DataFrame, n: int = TOP_DAYS) -> DataFrame:
    """The heaviest days; the earlier of two equal days comes first."""
    return daily.orderBy(F.desc("fires"), "d").limit(n)


def sector_profile(daily: DataFrame, n: int = TOP_DAYS) -> DataFrame:
    """Wind sectors of the heaviest days beside their share of all days."""
    top = top_days(daily, n).groupBy(wind_sector("wd_circ").alias("sector")).agg(
        F.count(F.lit(1)).alias("top_days")
    )
    base = daily.groupBy(wind_sector("wd_circ").alias("sector")).agg(F.count(F.lit(1)).alias("_days"))
    # At most nine sectors are summed again here.
    everything = base.agg(F.sum("_days").alias("_all")).withColumn("_k", F.lit(0))
    return (
        base.join(top, "sector", "left")
        .withColumn("_k", F.lit(0))
        .join(everything, "_k")
        .select(
            "sector",
            F.coalesce("top_days", F.lit(0)).alias("top_days"),
            (F.coalesce("top_days", F.lit(0)) / F.lit(n)).alias("top_share"),
            (F.col("_days") / F.col("_all")).alias("base_share"),
        )
    )


def _with_anomalies(daily: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Every day twice: as it was (``kind`` raw) and as distance from the mean of its day of the
    year (``kind`` flat)."""
    doubled = daily.select(
        *keys,
        *[F.col(c).cast("double").alias(c) for c in columns],
        F.date_format(F.to_date("d"), "MM-dd").alias("_doy"),
    )
    # Read twice, for the means and for the distances: store the days, do not derive them again.
    doubled = cut_lineage(doubled)
    kept = {f"_raw_{c}": F.col(c) for c in columns}
    both = seasonal_anomaly(doubled.withColumns(kept), columns, [*keys, "_doy"])

    def kind(name: str, prefix: str) -> Column:
        values = [F.col(f"{prefix}{c}").alias(f"_v_{c}") for c in columns]
        return F.struct(F.lit(name).alias("kind"), *values)

    out = both.select(*keys, F.inline(F.array(kind("raw", "_raw_"), kind("flat", ""))))
    return out.withColumnsRenamed({f"_v_{c}": c for c in columns})


def _of(kind: str, c: str) -> Column:
    return F.max(F.when(F.col("kind") == kind, F.col(c)))


def deseasonalised(
    daily: DataFrame, variables: Sequence[str] = VARIABLES, target: str = "fires"
) -> DataFrame:
    """Coefficients before and after subtracting each day-of-year's own mean."""
    both = correlation_table(_with_anomalies(daily, [target, *variables]), ["kind"], variables, target)
    return (
        both.groupBy("variable")
        .agg(
            _of("raw", "n").alias("n"),
            _of("raw", "spearman").alias("rho_raw"),
            _of("flat", "spearman").alias("rho_deseasonalised"),
        )
        .withColumn("retained", F.col("rho_deseasonalised") / F.nullif(F.col("rho_raw"), F.lit(0.0)))
    )


def monthly_climatology(daily: DataFrame, target: str = "fires") -> DataFrame:
    """Detections per month of each year, with the year's peak month."""
    months = daily.groupBy("year", "month").agg(F.sum(target).alias("detections"))
    # Twelve rows per year at most.
    peaks = months.groupBy("year").agg(
        F.max_by("month", F.struct(F.col("detections"), -F.col("month").cast("int"))).alias("peak_month")
    )
    return months.join(peaks, "year")


def sign_consistency(daily: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """Whether a variable keeps the sign of its rank correlation across years, and the median
    of its per-month coefficients."""
    spans = F.array(
        F.struct(F.lit("year").alias("span"), F.col("year").alias("part")),
        F.struct(F.lit("month").alias("span"), F.col("month").alias("part")),
    )
    placed = daily.select("fires", *variables, F.inline(spans))
    yearly = F.when(F.col("span") == "year", F.col("spearman"))
    monthly = F.when(F.col("span") == "month", F.col("spearman"))
    return (
        correlation_table(placed, ["span", "part"], variables)
        .groupBy("variable")
        .agg(
            F.count(yearly).alias("n_years"),
            F.coalesce((F.min(F.signum(yearly)) == F.max(F.signum(yearly))).cast("int"), F.lit(0))
            .alias("same_sign"),
            # Twelve coefficients at most.
            F.median(monthly).alias("median_month_rho"),
        )
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def distance_decay(
    daily: DataFrame, places: DataFrame, centre: tuple[float, float], *, place: str, value: str,
    target: str = "fires",
) -> DataFrame:
    """Per place, its distance from a centre beside raw and deseasonalised coefficients."""
    both = correlate(
        _with_anomalies(daily, [target, value], [place]), target, value, [place, "kind"], materialise=True
    )
    table = both.groupBy(place).agg(
        _of("raw", "n").alias("n"),
        _of("raw", "pearson").alias("r_raw"),
        _of("raw", "spearman").alias("rho_raw"),
        _of("flat", "spearman").alias("rho_deseasonalised"),
    )
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(centre[0]), F.lit(centre[1]))
    return table.join(places.select(place, km.alias("distance_km")), place)
