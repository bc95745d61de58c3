"""Keyed merges: last or first row wins, as aggregates that combine before the shuffle.

A window would bring all copies of a key into one task; ``max_by`` and ``min_by`` keep one
row per key and task, so a key with countless copies costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators.ordered import match_null_safe


def _one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool
) -> DataFrame:
    columns = df.columns
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in columns if c not in keys])
    best = df.groupBy(*keys).agg(pick(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key; NULL keys are equal. ``order`` must leave no tie."""
    return _one_per_key(df, keys, order, last=True)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row per key; NULL keys are equal. ``order`` must leave no tie."""
    return _one_per_key(df, keys, order, last=False)


def upsert(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], *, unique: bool = False
) -> DataFrame:
    """Merge a batch into a table: the batch beats the table, later batch rows beat earlier.

    Stored rows hold a key once, so only the batch is aggregated, and not even that where it is known
    to be ``unique``; of the table the rows stay whose key the batch lacks. NULL keys are equal.
    """
    latest = batch if unique else keep_last(batch, keys, order)
    untouched = match_null_safe(existing, latest.select(*keys), keys, "left_anti")
    return untouched.unionByName(latest, allowMissingColumns=True)


def insert_ignore(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows a unique-key insert would add: first of its key in the batch, absent before.

    As with SQL uniqueness, a key with a NULL in it never conflicts.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    fresh = keep_first(batch.where(complete), keys, order).join(
        existing.select(*keys), list(keys), "left_anti"
    )
    return fresh.unionByName(batch.where(~complete))


def absent_names(wanted: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct wanted keys that the dimension does not know."""
    return match_null_safe(wanted.select(*keys).distinct(), known.select(*keys), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key column: rows, distinct values and whether the column is unique."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_distinct(F.col(k)).alias(f"d_{i}") for i, k in enumerate(keys)],
    )
    per_key = F.array(
        *[
            F.struct(F.lit(k).alias("key_column"), F.col("n").alias("n_rows"),
                     F.col(f"d_{i}").alias("n_distinct"))
            for i, k in enumerate(keys)
        ]
    )
    return counts.select(F.inline(per_key)).withColumn(
        "is_unique", (F.col("n_rows") == F.col("n_distinct")).cast("int")
    )
