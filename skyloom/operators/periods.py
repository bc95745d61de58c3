"""Calendar planning: contiguous spans, bounded chunks, availability overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contiguous_spans(
    months: DataFrame,
    *,
    by: Sequence[str] = (),
    year: str = "year",
    month: str = "month",
    coverage_start: str | None = None,
) -> DataFrame:
    """Runs of adjacent months of a year as ``(start_date, end_date)``.

    Spans wholly before ``coverage_start`` go, a span across it starts there. A year has
    twelve months at most, so its window is small whatever the input.
    """
    keys = [*by, year]
    wanted = months.select(*keys, month).distinct()
    order = Window.partitionBy(*keys).orderBy(month)
    runs = wanted.withColumn("_run", F.col(month) - F.row_number().over(order))
    spans = runs.groupBy(*keys, "_run").agg(
        F.make_date(F.col(year), F.min(month), F.lit(1)).alias("start_date"),
        F.last_day(F.make_date(F.col(year), F.max(month), F.lit(1))).alias("end_date"),
    ).drop("_run")
    if coverage_start:
        floor = F.lit(coverage_start).cast("date")
        spans = spans.where(F.col("end_date") >= floor).withColumn(
            "start_date", F.greatest("start_date", floor)
        )
    return spans


def date_chunks(
    months: DataFrame, *, year: str = "year", month: str = "month", max_days: int = 5
) -> DataFrame:
    """Chunks of at most ``max_days`` that cover each month: ``(start_date, n_days)``."""
    first = F.make_date(F.col(year), F.col(month), F.lit(1))
    last = F.dayofmonth(F.last_day(first))
    starts = months.withColumn("_day", F.explode(F.sequence(F.lit(1), last, F.lit(max_days))))
    return starts.select(
        *months.columns,
        F.make_date(F.col(year), F.col(month), F.col("_day")).alias("start_date"),
        F.least(F.lit(max_days), last - F.col("_day") + 1).alias("n_days"),
    )


def available_months(
    catalogue: DataFrame,
    wanted: DataFrame,
    *,
    source: str = "source",
    first: str = "min_date",
    last: str = "max_date",
) -> DataFrame:
    """Source-months a catalogue can serve among the wanted ``(source, year, month)``.

    Each source's dates unfold to its own months, which turns the overlap test into an
    equi-join. A source the catalogue does not list yields nothing.
    """
    months = F.sequence(
        F.trunc(F.col(first), "month"), F.trunc(F.col(last), "month"), F.expr("interval 1 month")
    )
    served = catalogue.where(F.col(first) <= F.col(last)).select(
        source, F.explode(months).alias("_month")
    ).select(source, F.year("_month").alias("year"), F.month("_month").alias("month"))
    return wanted.select(source, "year", "month").distinct().join(
        served.distinct(), [source, "year", "month"]
    )
