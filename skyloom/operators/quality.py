"""Quality control of series: range, step, flatline and robust-outlier flags, gap filling.

Flags mark a reading and never remove or change it; only readings that were missing to begin
with are filled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalars import circular_difference, join_flags
from skyloom.operators.nearest import fill_from_nearest, place_estimates
from skyloom.operators.ordered import CHUNK_ROWS, exact_quantiles, match_null_safe, split_groups
from skyloom.operators.series import (
    KNOWN_AFTER,
    KNOWN_BEFORE,
    POSITION,
    PRIOR,
    RUN,
    neighbourhood,
)
from skyloom.session import store

FILL_LIMIT = 3
MAD_SCALE = 0.6745
MAD_THRESHOLD = 3.5
IQR_FACTOR = 1.5


@dataclass(frozen=True)
class MetricRule:
    """Checks of one metric. ``name`` is the prefix of the columns it yields."""

    column: str
    minimum: float | None = None
    maximum: float | None = None
    max_step: float | None = None
    circular: bool = False
    flat_window: int | None = 12
    ignore_zero_runs: bool = False
    log_mad: bool = False
    name: str | None = None

    @property
    def prefix(self) -> str:
        return self.name or self.column

    @property
    def clean(self) -> str:
        return f"{self.prefix}_clean"

    @property
    def flag(self) -> str:
        return f"{self.prefix}_qc_flag"

    @property
    def imputed(self) -> str:
        return f"{self.prefix}_imputed"


def out_of_range(
    c: Column | str, minimum: float | None = 0.0, maximum: float | None = 1000.0
) -> Column:
    """A present reading outside its bounds; an absent bound never fails."""
    value = F.col(c) if isinstance(c, str) else c
    failed = F.lit(False)
    if minimum is not None:
        failed = failed | (value < float(minimum))
    if maximum is not None:
        failed = failed | (value > float(maximum))
    return F.coalesce(failed, F.lit(False))


def step_exceeded(rule: MetricRule) -> Column:
    """Jump against the prior reading of the series, on a neighbourhood frame."""
    if rule.max_step is None or rule.max_step <= 0:
        return F.lit(False)
    value, prior = F.col(rule.column), F.col(PRIOR.format(rule.column))
    jump = circular_difference(value, prior) if rule.circular else F.abs(value - prior)
    return F.coalesce(jump > float(rule.max_step), F.lit(False))


def flatlined(rule: MetricRule) -> Column:
    """Reading inside a run of equal readings at least ``flat_window`` long."""
    if rule.flat_window is None or rule.flat_window <= 1:
        return F.lit(False)
    value = F.col(rule.column)
    flat = value.isNotNull() & (F.col(RUN.format(rule.column)) >= rule.flat_window)
    return flat & (value != 0) if rule.ignore_zero_runs else flat


def interpolated(column: str, limit: int = FILL_LIMIT) -> Column:
    """Value of the row, or the straight line between its known neighbours.

    Positions count as evenly spaced; only the first ``limit`` rows of a gap are filled, the
    slope spans the whole gap, a gap at the end repeats the last value and one at the start
    stays empty.
    """
    value = F.col(column).cast("double")
    before, after = F.col(KNOWN_BEFORE.format(column)), F.col(KNOWN_AFTER.format(column))
    at = F.col(POSITION)
    line = before["value"] + (after["value"] - before["value"]) * (at - before["at"]) / (
        after["at"] - before["at"]
    )
    return (
        F.when(value.isNotNull(), value)
        .when(before.isNull() | (at - before["at"] > limit), F.lit(None).cast("double"))
        .when(after.isNull(), before["value"])
        .otherwise(line)
    )


def mad_limits(
    df: DataFrame,
    column: str,
    groups: Sequence[str] = (),
    threshold: float = MAD_THRESHOLD,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per group, the median in log space and the deviation beyond which a value is outlying.

    The limit is NULL when neither the median absolute deviation nor the quartiles spread. How a
    large group is ranked: see ``exact_quantiles``.
    """
    groups = list(groups)
    keys = groups or ["_g"]
    rows = df.where(F.col(column) >= 0).withColumn("_log", F.log1p(F.col(column).cast("double")))
    if not groups:
        rows = rows.withColumn("_g", F.lit(0))
    # Both quantile passes and the choice between them read these two columns.
    rows = store(rows.select(*keys, "_log"), "logs")
    centre = store(
        exact_quantiles(
            rows, keys, "_log", {"_median": 0.5, "_lower": 0.25, "_upper": 0.75}, chunk_rows=chunk_rows
        ).drop("_n"),
        "centres",
    )
    apart = match_null_safe(rows, centre.select(*keys, "_median"), keys, "inner", centre.count())
    apart = apart.withColumn("_deviation", F.abs(F.col("_log") - F.col("_median")))
    spread = exact_quantiles(apart, keys, "_deviation", {"_mad": 0.5}, chunk_rows=chunk_rows).drop("_n")
    both = match_null_safe(centre, spread, keys, "inner")
    iqr = F.col("_upper") - F.col("_lower")
    limits = both.select(
        *keys,
        "_median",
        F.when(F.col("_mad") != 0, F.col("_mad")).alias("_mad"),
        F.when((F.col("_mad") == 0) & (iqr != 0), iqr * IQR_FACTOR).alias("_iqr_limit"),
        F.lit(float(threshold)).alias("_threshold"),
    )
    return limits if groups else limits.drop("_g")


def flag_log_mad(
    df: DataFrame,
    column: str,
    groups: Sequence[str] = (),
    *,
    out: str = "mad_outlier",
    threshold: float = MAD_THRESHOLD,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add a boolean for readings far from their group's median in log space."""
    groups = list(groups)
    keys = groups or ["_g"]
    limits = mad_limits(df, column, groups, threshold, chunk_rows)
    rows = df
    if not groups:
        rows, limits = df.withColumn("_g", F.lit(0)), limits.withColumn("_g", F.lit(0))
    limits = store(limits, "limits")
    # One row per group: below the bound of a broadcast no reading moves.
    joined = match_null_safe(rows, limits, keys, "left", limits.count())
    if not groups:
        joined = joined.drop("_g")
    value = F.when(F.col(column) >= 0, F.col(column).cast("double"))
    deviation = F.abs(F.log1p(value) - F.col("_median"))
    raised = F.when(
        F.col("_mad").isNotNull(), deviation * MAD_SCALE / F.col("_mad") > F.col("_threshold")
    ).otherwise(deviation > F.col("_iqr_limit"))
    return joined.withColumn(out, F.coalesce(raised, F.lit(False))).drop(
        "_median", "_mad", "_iqr_limit", "_threshold"
    )


def quality_chain(
    df: DataFrame,
    rules: Sequence[MetricRule],
    *,
    groups: Sequence[str] = (),
    order: Sequence[str],
    fill_in_time: bool = True,
    lat: str | None = None,
    lon: str | None = None,
    pool: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Flag every metric and fill what was missing.

    Adds ``<name>_clean``, ``<name>_imputed`` and ``<name>_qc_flag`` per rule. The clean column
    keeps flagged readings; gaps are filled along the series and then, where coordinates are
    named, from the nearest known points of the same ``pool`` (a run, a day). ``order`` must be a
    total order of a series.
    """
    columns = [r.column for r in rules]
    layout = split_groups(df, groups, order, chunk_rows)
    out = neighbourhood(df, columns, groups=groups, order=order, layout=layout)
    for rule in rules:
        if rule.log_mad:
            out = flag_log_mad(
                out, rule.column, groups, out=f"_mad_{rule.column}", chunk_rows=chunk_rows
            )
    added = {}
    for rule in rules:
        added[rule.flag] = join_flags(
            [
                ("range_fail", out_of_range(rule.column, rule.minimum, rule.maximum)),
                ("step_fail", step_exceeded(rule)),
                ("flatline", flatlined(rule)),
                ("mad_outlier", F.col(f"_mad_{rule.column}") if rule.log_mad else F.lit(False)),
            ]
        )
        added[rule.clean] = (
            interpolated(rule.column) if fill_in_time else F.col(rule.column).cast("double")
        )
    helpers = [POSITION, *[f"_mad_{c}" for c in columns]]
    for pattern in (PRIOR, RUN, KNOWN_BEFORE, KNOWN_AFTER):
        helpers += [pattern.format(c) for c in columns]
    out = out.withColumns(added).drop(*helpers)
    if lat and lon:
        near = dict(lat=lat, lon=lon, tie=order, pool=pool)
        cleaned, settled = [r.clean for r in rules], None
        if groups and set(groups) <= {*pool, lat, lon} and not layout.split:
            # A place of a pool lies inside one series, which its task holds in any case.
            out, settled = place_estimates(out, cleaned, **near)
        # The windows above are read several times below.
        out = store(out, "series")
        out = fill_from_nearest(out, cleaned, **near, settled=settled)
    return out.withColumns(
        {
            rule.imputed: (F.col(rule.column).isNull() & F.col(rule.clean).isNotNull()).cast("int")
            for rule in rules
        }
    )


def range_only(df: DataFrame, rules: Sequence[MetricRule]) -> DataFrame:
    """Range flags alone, for feeds with no series to compare against: nothing is filled."""
    added = {}
    for rule in rules:
        failed = out_of_range(rule.column, rule.minimum, rule.maximum)
        added[rule.clean] = F.col(rule.column)
        added[rule.flag] = join_flags([("range_fail", failed)])
    return df.withColumns(added)
