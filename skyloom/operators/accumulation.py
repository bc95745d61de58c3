"""Accumulation buckets of a forecast run to uniform increments, with the checks that guard it.

A bucket at step ``h`` covers the ``span`` hours before ``h``. Where the span exceeds the step
width, the bucket one step earlier covers its beginning, and their difference is the increment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import store

STEP_HOURS = 3
NEGATIVE_TOLERANCE = 1e-6
RECONCILE_FLOOR = 0.25
RECONCILE_SHARE = 0.02


class AccumulationError(Exception):
    """The buckets of a run contradict each other; ``findings`` holds every refused run."""

    def __init__(self, message: str, findings: DataFrame) -> None:
        super().__init__(message)
        self.findings = findings


def bucket_increments(
    df: DataFrame,
    *,
    point: Sequence[str],
    step: str = "fhr",
    bucket: str = "bucket",
    span: str = "span_h",
    out: str = "increment",
    step_hours: int = STEP_HOURS,
) -> DataFrame:
    """Add the increment, unclipped, and ``no_difference`` where a bucket has no usable partner.

    The partner is found by an equi-join on point and step, so a run's points spread over
    all tasks. Steps without a bucket stay NULL: an analysis hour has no interval.
    """
    earlier = df.where(F.col(bucket).isNotNull()).select(
        *[F.col(p).alias(f"_p_{p}") for p in point],
        (F.col(step) + step_hours).alias("_p_step"),
        F.col(bucket).alias("_p_bucket"),
        F.col(span).alias("_p_span"),
    )
    condition = F.col(step) == F.col("_p_step")
    for p in point:
        condition = condition & (F.col(p) == F.col(f"_p_{p}"))
    # Only buckets wider than a step look for a partner.
    condition = condition & (F.col(span) > step_hours)
    joined = df.join(earlier, condition, "left")
    usable = F.coalesce(F.col("_p_span") == F.col(span) - step_hours, F.lit(False))
    increment = F.when(F.col(bucket).isNull(), F.lit(None).cast("double")).when(
        F.col(span) == step_hours, F.col(bucket)
    ).when(usable, F.col(bucket) - F.col("_p_bucket"))
    broken = F.col(bucket).isNotNull() & ~F.coalesce(
        (F.col(span) == step_hours) | ((F.col(span) > step_hours) & usable), F.lit(False)
    )
    return (
        joined.withColumn(out, F.round(increment, 4))
        .withColumn("no_difference", broken)
        .drop("_p_step", "_p_bucket", "_p_span", *[f"_p_{p}" for p in point])
    )


def run_checks(
    increments: DataFrame,
    run_totals: DataFrame | None,
    *,
    run: Sequence[str] = ("cycle",),
    point: Sequence[str] = ("cycle", "lat", "lon"),
    increment: str = "increment",
    total: str = "run_total",
    bucket: str = "bucket",
    constant_zero: str = "constant_zero",
) -> DataFrame:
    """One row of findings per run: what could not be differenced, fell below zero, does not
    add up to the run total, or is all zero although its fields carried packed bits."""
    value = F.col(increment)
    packed = F.col(bucket).isNotNull() & ~F.coalesce(F.col(constant_zero), F.lit(False))
    findings = increments.groupBy(*run).agg(
        F.count_if(F.col("no_difference")).alias("undifferenced"),
        F.count_if(value < -NEGATIVE_TOLERANCE).alias("negative"),
        F.coalesce(F.sum(F.abs(F.greatest(value, F.lit(0.0)))), F.lit(0.0)).alias("_abs_sum"),
        F.coalesce(F.bool_or(packed), F.lit(False)).alias("_packed"),
    )
    findings = findings.withColumn("all_zero", F.col("_abs_sum") == 0).withColumn(
        "zero_but_packed", F.col("all_zero") & F.col("_packed")
    )
    if run_totals is None:
        closed = {
            "worst_gap": F.lit(None).cast("double"),
            "tolerance": F.lit(None).cast("double"),
            "reconciled": F.lit(None).cast("boolean"),
        }
        findings = findings.withColumns(closed)
    else:
        findings = findings.join(
            reconcile(increments, run_totals, run=run, point=point, increment=increment, total=total),
            list(run),
            "left",
        )
    return findings.drop("_abs_sum", "_packed")


def reconcile(
    increments: DataFrame,
    run_totals: DataFrame,
    *,
    run: Sequence[str],
    point: Sequence[str],
    increment: str = "increment",
    total: str = "run_total",
) -> DataFrame:
    """Per run, the worst gap between a point's summed increments and its own run total, and how
    many points have no total: such a run is not reconciled."""
    summed = increments.groupBy(*point).agg(
        F.coalesce(F.sum(F.greatest(F.col(increment), F.lit(0.0))), F.lit(0.0)).alias("_summed")
    )
    gaps = summed.join(run_totals.select(*point, total), list(point), "left")
    return (
        gaps.groupBy(*run)
        .agg(
            F.max(F.abs(F.col("_summed") - F.col(total))).alias("worst_gap"),
            F.greatest(F.lit(RECONCILE_FLOOR), F.max(total) * RECONCILE_SHARE).alias("tolerance"),
            F.count_if(F.col(total).isNull()).alias("without_total"),
        )
        .withColumn(
            "reconciled",
            F.coalesce(F.col("worst_gap") <= F.col("tolerance"), F.lit(False))
            & (F.col("without_total") == 0),
        )
    )


def increments_or_raise(
    df: DataFrame, run_totals: DataFrame | None = None, *, run: Sequence[str] = ("cycle",),
    point: Sequence[str] = ("cycle", "lat", "lon"), **columns: str,
) -> DataFrame:
    """Increments clipped at zero, refusing runs whose findings say the decode is wrong."""
    out = columns.get("out", "increment")
    # Read by the checks and again by the caller.
    made = store(bucket_increments(df, point=point, **columns), "increments")
    findings = run_checks(
        made, run_totals, run=run, point=point, increment=out,
        bucket=columns.get("bucket", "bucket"),
    )
    # Without totals to compare with, there is no verdict on them.
    unreconciled = F.lit(False) if run_totals is None else ~F.coalesce(F.col("reconciled"), F.lit(False))
    bad = store(
        findings.where(
            (F.col("undifferenced") > 0)
            | (F.col("negative") > 0)
            | F.col("zero_but_packed")
            | unreconciled
        ),
        "findings",
    )
    if count := bad.count():
        raise AccumulationError(f"{count} runs refused, first {bad.first().asDict()}", bad)
    # An undefined increment stays undefined: greatest() would read NULL as 0.
    return made.withColumn(out, F.when(F.col(out) < 0, F.lit(0.0)).otherwise(F.col(out))).drop(
        "no_difference"
    )


def shortest_span(
    records: DataFrame, keys: Sequence[str], span: str = "span_h", order: Sequence[str] = ("msg",)
) -> DataFrame:
    """Of several accumulation records per key, the one over the shortest span."""
    usable = records.where(F.coalesce(F.col(span), F.lit(0)) != 0)
    rest = [c for c in records.columns if c not in keys]
    picked = usable.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(span, *order)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def newest_complete(
    df: DataFrame, group: str, step: str, expected_steps: int, by: Sequence[str] = ()
) -> DataFrame:
    """Newest group that has all its steps, optionally per ``by``."""
    complete = (
        df.groupBy(*by, group)
        .agg(F.count_distinct(F.col(step)).alias("n_steps"))
        .where(F.col("n_steps") >= expected_steps)
    )
    return complete.groupBy(*by).agg(F.max(group).alias(group))


def null_without_window(
    df: DataFrame, *, window: str, values: Sequence[str], flag: str, imputed: str
) -> DataFrame:
    """Undo filling where there was no interval to accumulate over, and say so in the flag."""
    absent = F.col(window).isNull()
    return df.withColumns(
        {
            **{v: F.when(~absent, F.col(v)) for v in values},
            flag: F.when(absent, F.lit("no_accumulation_window")).otherwise(F.col(flag)),
            imputed: F.when(absent, F.lit(0)).otherwise(F.col(imputed)),
        }
    )
