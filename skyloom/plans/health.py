"""Run-log reports: outcomes, freshness, latest runs, and profiles of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.scalars import parse_instant
from skyloom.profiles import JOBS


def status_counts(log: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """Outcomes per source and the mean rows of its successful runs."""
    return log.groupBy(*keys).agg(
        F.count_if(F.col("status") == "success").alias("successes"),
        F.count_if(F.col("status") == "partial").alias("partials"),
        F.count_if(F.col("status") == "failure").alias("failures"),
        F.coalesce(
            F.round(F.avg(F.when(F.col("status") == "success", F.col("rows_inserted"))), 1), F.lit(0.0)
        ).alias("avg_rows"),
    )


def latest_per_source(
    log: DataFrame, order: Sequence[str], columns: Sequence[str], keys: Sequence[str] = ("source",)
) -> DataFrame:
    """Newest row per source as an aggregate; no source's log is sorted."""
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def monitored(spark: SparkSession) -> DataFrame:
    """The monitored jobs: ``source, name, interval_min, threshold_min``."""
    return spark.createDataFrame(JOBS, "source string, name string, interval_min int, threshold_min int")


def freshness_report(
    log: DataFrame,
    sources: DataFrame,
    as_of: Column,
    *,
    order: Sequence[str],
    window_hours: int = 24,
) -> DataFrame:
    """One row per monitored source, even one that never ran.

    ``sources``: ``source, threshold_min``; ``log`` times are text or instants. The report is a
    function of ``as_of``, so it can be repeated.
    """
    rows = with_instants(log)
    recent = F.unix_seconds("_run_started_at") >= F.unix_seconds(as_of) - window_hours * 3600
    stats = rows.groupBy("source").agg(*recent_outcomes(recent), *newest_outcomes(order))
    return freshness_of(stats, sources, as_of)


def with_instants(log: DataFrame) -> DataFrame:
    """The log with ``_run_started_at`` and ``_run_finished_at`` as instants; its times may be text."""
    kinds = dict(log.dtypes)
    times = ("run_started_at", "run_finished_at")
    return log.withColumns({f"_{c}": parse_instant(c) if kinds[c] == "string" else F.col(c) for c in times})


def recent_outcomes(recent: Column) -> list[Column]:
    """Aggregates over the runs for which ``recent`` holds."""
    good = (F.col("status") == "success") & recent
    return [
        F.count_if(good).alias("successes"),
        F.count_if((F.col("status") == "partial") & recent).alias("partials"),
        F.count_if((F.col("status") == "failure") & recent).alias("failures"),
        F.coalesce(F.round(F.avg(F.when(good, F.col("rows_inserted"))), 1), F.lit(0.0)).alias("avg_rows"),
    ]


def newest_outcomes(order: Sequence[str]) -> list[Column]:
    """Aggregates over all runs: when the newest success ended, and what the newest problem was."""
    by = F.struct(*order)
    bad = F.col("status").isin("failure", "partial")
    return [
        F.max_by("_run_finished_at", F.when(F.col("status") == "success", by)).alias("_last_success"),
        F.max_by("status", F.when(bad, by)).alias("last_error_status"),
        F.max_by(F.coalesce("error_message", F.lit("Unknown error")), F.when(bad, by)).alias("last_error"),
    ]


def freshness_of(stats: DataFrame, sources: DataFrame, as_of: Column) -> DataFrame:
    """Every monitored source with its outcomes, zero where it has none, and its freshness."""
    joined = sources.join(stats, "source", "left")
    minutes = F.floor((F.unix_seconds(as_of) - F.unix_seconds("_last_success")) / 60)
    counted = [c for c in ("successes", "partials", "failures", "avg_rows") if c in stats.columns]
    return (
        joined.withColumns({c: F.coalesce(c, F.lit(0.0 if c == "avg_rows" else 0)) for c in counted})
        .withColumn("minutes_ago", minutes)
        .withColumn(
            "freshness",
            F.when(F.col("minutes_ago").isNull(), "NO SUCCESSFUL RUNS")
            .when(F.col("minutes_ago") > F.col("threshold_min"), "STALE")
            .otherwise("HEALTHY"),
        )
        .drop("_last_success")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(left: DataFrame, right: DataFrame, key: str, n: str = "n_rows") -> DataFrame:
    """Counts of two stores side by side; what one lacks counts as 0."""
    a = left.select(key, F.col(n).alias("n_left"))
    b = right.select(key, F.col(n).alias("n_right"))
    both = a.join(b, key, "full").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("n_left", "n_right")}
    )
    return both.withColumns(
        {
            "difference": F.col("n_right") - F.col("n_left"),
            "verdict": F.when(F.col("n_left") == F.col("n_right"), "OK").otherwise("MISMATCH"),
        }
    )


def null_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows and nulls per column."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def coverage(df: DataFrame, box: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Extent of the coordinates and whether it spans the box."""
    extent = df.groupBy(*keys).agg(
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
    )
    spans = (
        (F.col("min_lat") <= box[0]) & (F.col("max_lat") >= box[1])
        & (F.col("min_lon") <= box[2]) & (F.col("max_lon") >= box[3])
    )
    return extent.withColumn("covers_box", F.coalesce(spans, F.lit(False)).cast("int"))


def extract_profile(df: DataFrame, value: str, step: str, group: str) -> DataFrame:
    """Report of an extract: points, steps, groups, span and wet cells."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("lat", "lon").alias("n_points"),
        F.count_distinct(step).alias("n_steps"),
        F.count_distinct(group).alias("n_groups"),
        F.min(step).alias("first_step"),
        F.max(step).alias("last_step"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count_if(F.col(value) > 0).alias("wet_cells"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("total_value"),
    )


def flag_histogram(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How often each flag value occurs per flag column."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("flag_column"), F.col(f).alias("flag")) for f in flags]
    )
    return df.select(F.inline(pairs)).groupBy("flag_column", "flag").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def breakdown(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows per key combination, in key order; ``limit`` is the report's own length."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(*keys).limit(limit) if limit else counted


def recent_payloads(df: DataFrame, order: str, payload: str, n: int = 6, preview: int = 120) -> DataFrame:
    """The newest payloads with their size and beginning."""
    return df.orderBy(F.desc(order)).limit(n).select(
        order, F.length(payload).alias("n_bytes"), F.substring(payload, 1, preview).alias("preview")
    )


def ad_hoc(tables: dict[str, DataFrame], query: str) -> DataFrame:
    """Run a user's SQL over the given tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return next(iter(tables.values())).sparkSession.sql(query)
