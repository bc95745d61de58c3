"""Exact order statistics of large groups by radix selection.

A double has an integer code that orders like it. The wanted ranks of a group start with all of its
rows; a pass counts rows by the next ``DIGIT_BITS`` bits of their code, and each rank goes on with the
rows of the one digit it falls into. After ``64 / DIGIT_BITS`` passes a rank has its value. A pass moves
no row: what is shuffled and kept are at most ``2 ** DIGIT_BITS`` counts per open prefix and task, however
many different values a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import cut_lineage, store

DIGIT_BITS = 16
_FRACTION = 52
_BIAS = 1023


def order_code(value: Column | str) -> Column:
    """BIGINT that orders like a DOUBLE (not NaN) and differs where it differs.

    Exponent and fraction of the size, exactly as the format has them, with the value's sign. A
    logarithm only guesses the exponent; exact powers of two on both sides of it settle it.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(power > size, -1).when(F.pow(F.lit(2.0), guess + 1) <= size, 1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**_FRACTION).cast("bigint")
    normal = (exponent.cast("bigint") + _BIAS) * (1 << _FRACTION) + fraction
    half = 2.0**537  # the smallest steps are 2 ** -1074, whose inverse is no double
    code = F.when(size == 0, F.lit(0).cast("bigint")).when(size < 2.0**-1022, (size * half * half).cast("bigint"))
    code = code.when(size == float("inf"), F.lit((2 * _BIAS + 1) << _FRACTION)).otherwise(normal)
    return F.when(x < 0, -code).otherwise(code)


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def select_ranks(df: DataFrame, groups: Sequence[str], value: str, ranks: DataFrame, weight: str | None = None) -> DataFrame:
    """The values at ``ranks``: groups, ``_name``, ``_value`` for each row of ``ranks`` (groups, ``_name``,
    ``_rank`` from 0). Their groups must be few, for they are sent to every task; equal values count
    each, or ``weight`` times. Rows without a value have no rank."""
    groups = list(groups)
    own = [f"_own_{g}" for g in groups]
    named = dict(zip(groups, own, strict=True))
    wanted = F.broadcast(ranks.select(*[F.col(g).alias(named[g]) for g in groups]).distinct())
    rows = df.where(F.col(value).isNotNull()).join(wanted, _null_safe(groups, own), "left_semi")
    n = F.lit(1) if weight is None else F.col(weight)
    coded = store(
        rows.select(*groups, F.col(value).cast("double").alias("_value"), n.cast("bigint").alias("_n")).withColumn("_code", order_code("_value")),
        "codes",
    )
    open_ = ranks.select(*groups, "_name", F.col("_rank").cast("bigint").alias("_rank"), F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_below"))
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        whole = shift + DIGIT_BITS
        prefix = F.lit(0).cast("bigint") if whole == 64 else F.shiftright("_code", whole)
        asked = open_.select(*[F.col(g).alias(named[g]) for g in groups], F.col("_prefix").alias("_own_prefix")).distinct()
        held = coded.withColumn("_prefix", prefix).join(
            F.broadcast(asked), _null_safe([*groups, "_prefix"], [*own, "_own_prefix"]), "left_semi"
        )
        cells = held.groupBy(*groups, "_prefix", F.shiftright("_code", shift).alias("_digit")).agg(
            F.sum("_n").alias("_in"), F.min("_value").alias("_least")
        )
        along = Window.partitionBy(*groups, "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cells = cells.withColumn("_upto", F.sum("_in").over(along)).withColumnsRenamed({**named, "_prefix": "_own_prefix"})
        met = open_.drop("_least").join(cells, _null_safe([*groups, "_prefix"], [*own, "_own_prefix"]))
        at = F.col("_rank") - F.col("_below")
        here = met.where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_in")))
        # One row per wanted rank.
        open_ = cut_lineage(
            here.select(
                *groups, "_name", "_rank", F.col("_digit").alias("_prefix"),
                (F.col("_below") + F.col("_upto") - F.col("_in")).alias("_below"), "_least",
            )
        )
    return open_.select(*groups, "_name", F.col("_least").alias("_value"))
