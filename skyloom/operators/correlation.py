"""Pearson and Spearman correlation per group, from mergeable sums only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.ordered import CHUNK_ROWS, average_ranks
from skyloom.session import cut_lineage

MIN_PAIRS = 5
ANOMALY_DIGITS = 9


def _coefficient(x: str, y: str) -> Column:
    """Pearson coefficient that is NULL, not an error, where a side does not vary."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _pearson(x: str, y: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        _coefficient(x, y).alias("_r"),
        F.stddev_pop(F.col(x).cast("double")).alias("_sx"),
        F.stddev_pop(F.col(y).cast("double")).alias("_sy"),
    ]


def _guarded(r: str) -> Column:
    """No coefficient for fewer than five pairs or a constant side."""
    enough = (F.col("n") >= MIN_PAIRS) & (F.col("_sx") > 0) & (F.col("_sy") > 0)
    return F.when(enough, F.col(r))


def pearson(df: DataFrame, x: str, y: str, groups: Sequence[str] = ()) -> DataFrame:
    """``(groups, n, pearson)`` over rows where both sides are present."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return (
        pairs.groupBy(*groups).agg(*_pearson(x, y)).select(*groups, "n", _guarded("_r").alias("pearson"))
    )


def correlate(
    df: DataFrame,
    x: str,
    y: str,
    groups: Sequence[str] = (),
    *,
    materialise: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(groups, n, pearson, spearman)``; ranks average over ties.

    Groups too large for one task are ranked from counts of distinct values. ``materialise``
    stores the pairs first, which pays when they are few but costly to derive.
    """
    groups = list(groups)
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *groups, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    if materialise:
        pairs = cut_lineage(pairs)
    ranked = average_ranks(pairs, groups, {"_rx": "_x", "_ry": "_y"}, chunk_rows)
    return (
        ranked.groupBy(*groups)
        .agg(*_pearson("_x", "_y"), _coefficient("_rx", "_ry").alias("_rho"))
        .select(*groups, "n", _guarded("_r").alias("pearson"), _guarded("_rho").alias("spearman"))
    )


def unpivot_pairs(
    df: DataFrame, target: str, variables: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per variable: ``(keep, variable, x, y)`` with ``x`` the target."""
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("y"))
            for v in variables
        ]
    )
    return df.select(*keep, F.col(target).cast("double").alias("x"), F.inline(pairs))


def seasonal_anomaly(
    df: DataFrame, columns: Sequence[str], season: Sequence[str]
) -> DataFrame:
    """Replace each column by its distance from the mean of its season.

    The climatology is aggregated first and joined back, so a season is never one task.
    """
    means = df.groupBy(*season).agg(*[F.avg(c).alias(f"_normal_{c}") for c in columns])
    joined = df.join(means, list(season), "left")
    # Rounding keeps anomalies equal that differ only in the order their mean was summed in,
    # so that they tie in rank.
    return joined.withColumns(
        {c: F.round(F.col(c) - F.col(f"_normal_{c}"), ANOMALY_DIGITS) for c in columns}
    ).drop(*[f"_normal_{c}" for c in columns])
