"""Aggregate expressions built from mergeable built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.functions.scalars import _col


def circular_mean(degrees: Column | str, digits: int | None = None) -> Column:
    """Vector mean of bearings in [0, 360); NULL when there is none.

    ``digits`` rounds first and wraps again, so float residue below 360 reads 0.
    """
    r = F.radians(_col(degrees))
    mean = F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))
    return mean if digits is None else F.pmod(F.round(mean, digits), F.lit(360.0))


def sum_or_zero(c: Column | str) -> Column:
    """A sum that is 0.0 over nothing, for totals where absence means none."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def first_by(c: Column | str, *order: Column | str) -> Column:
    """Value of the earliest row under an explicit order."""
    return F.min_by(_col(c), F.struct(*[_col(o) for o in order]))
