"""Extracts of the forecast grid: long with a unit column, or wide with units in the names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalars import iso_utc_text, parse_instant
from skyloom.plans.season import in_box
from skyloom.profiles import EXPORT_VARIABLES, HELD_BACK

LONG_ORDER = ("valid_time", "variable", "lat", "lon")
WIDE_ORDER = ("valid_time", "lat", "lon")


def exported_variables(include_held_back: bool = False) -> list[str]:
    return [v for v in EXPORT_VARIABLES if include_held_back or v not in HELD_BACK]


def select_rows(
    grid: DataFrame, *, include_synthetic: bool = False, box: Sequence[float] | None = None
) -> DataFrame:
    """Rows of an extract; placeholders are left out unless asked for."""
    out = grid if include_synthetic else grid.where(F.col("is_synthetic") == 0)
    return out if box is None else out.where(in_box("lat", "lon", box))


def _instant(df: DataFrame, c: str) -> Column:
    return parse_instant(c) if dict(df.dtypes)[c] == "string" else F.col(c)


def _flag(v: str) -> Column:
    return F.coalesce(F.col(f"{v}_qc_flag"), F.lit("ok"))


def _imputed(v: str) -> Column:
    return F.coalesce(F.col(f"{v}_imputed"), F.lit(0)).cast("boolean")


def to_long(df: DataFrame, variables: Sequence[str], order: Sequence[str] = LONG_ORDER) -> DataFrame:
    """One row per point and variable with its unit, from a single scan of the table."""
    cells = F.array(
        *[
            F.struct(
                F.lit(v).alias("variable"),
                F.col(f"{v}_clean").cast("double").alias("value"),
                F.col(f"{v}_raw").cast("double").alias("value_raw"),
                F.lit(EXPORT_VARIABLES[v][0]).alias("unit"),
                _flag(v).alias("qc_flag"),
                _imputed(v).alias("imputed"),
            )
            for v in variables
        ]
    )
    out = df.select(
        _instant(df, "valid_time").alias("valid_time"),
        "cycle",
        F.col("fhr").cast("smallint").alias("fhr"),
        "lat",
        "lon",
        F.col("source"),
        F.col("is_synthetic").cast("boolean").alias("is_synthetic"),
        _instant(df, "fetched_at").alias("fetched_at"),
        F.inline(cells),
    )
    return out.orderBy(*order) if order else out


def to_wide(df: DataFrame, variables: Sequence[str], order: Sequence[str] = WIDE_ORDER) -> DataFrame:
    """One row per point, units as column suffixes, times as zoned text."""
    columns = [
        iso_utc_text(_instant(df, "valid_time")).alias("valid_time"),
        F.col("cycle"),
        F.col("fhr").cast("smallint").alias("fhr"),
        F.col("lat"),
        F.col("lon"),
    ]
    for v in variables:
        suffix = EXPORT_VARIABLES[v][1]
        columns += [
            F.col(f"{v}_clean").cast("double").alias(f"{v}_{suffix}"),
            F.col(f"{v}_raw").cast("double").alias(f"{v}_{suffix}_raw"),
            _flag(v).alias(f"{v}_qc_flag"),
            _imputed(v).alias(f"{v}_imputed"),
        ]
    out = df.select(
        *columns,
        F.col("source"),
        F.col("is_synthetic").cast("boolean").alias("is_synthetic"),
        iso_utc_text(_instant(df, "fetched_at")).alias("fetched_at"),
    )
    return out.orderBy(*order) if order else out


def unit_map(variables: Sequence[str], wide: bool) -> dict[str, str]:
    if wide:
        return {f"{v}_{EXPORT_VARIABLES[v][1]}": EXPORT_VARIABLES[v][0] for v in variables}
    return {v: EXPORT_VARIABLES[v][0] for v in variables}
