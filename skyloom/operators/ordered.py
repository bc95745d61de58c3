"""Ordered work over groups of any size.

A window keyed by station or city puts a whole group into one task, which fails once one
group holds a large share of the rows. Here a group larger than ``chunk_rows`` is cut, along
its own order, into chunks of about that many rows; windows run inside a chunk and a small
table of one row per chunk carries what crosses a cut. The cuts come from a histogram of the
group itself, so a burst inside a group is split as well. Groups below the limit, normally
all of them, take the plain window path: one cheap count decides.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.selection import select_ranks
from skyloom.session import cut_lineage, store

CHUNK_ROWS = 2_000_000
CELLS_PER_CHUNK = 16
BROADCAST_ROWS = 500_000
ONE_GROUP = "_one_group"
NULLS_LAST_CELL = 1 << 60


def match_null_safe(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    right_rows: int | None = None,
) -> DataFrame:
    """Join where equal keys include two NULLs; the right side's keys are dropped.

    ``right_rows`` is a proven upper bound of the right side; only below
    ``BROADCAST_ROWS`` is it broadcast, otherwise the planner decides at run time.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_right_{k}"])
    if right_rows is not None and right_rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(
        *[f"_right_{k}" for k in keys]
    )


def order_position(df: DataFrame, column: str) -> Column | None:
    """A DOUBLE that orders like ``column``, or None when it has no numeric reading."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    return None


@dataclass(frozen=True)
class Layout:
    """A frame with the columns its windows partition by."""

    df: DataFrame
    groups: list[str]
    chunks: list[str]
    temporary: list[str]

    @property
    def keys(self) -> list[str]:
        return self.groups + self.chunks

    @property
    def split(self) -> bool:
        return bool(self.chunks)


def split_groups(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> Layout:
    """Cut every group above ``chunk_rows`` along ``order`` into chunks of about that size.

    A cut follows the first order column that varies inside the group. Chunks a burst leaves
    too large are cut again, on the same column at a finer scale, or on the next one once all
    their rows tie. Rows that tie on every numeric order column stay together.
    """
    groups, temporary = list(groups), []
    if not groups:
        df, groups, temporary = df.withColumn(ONE_GROUP, F.lit(0)), [ONE_GROUP], [ONE_GROUP]
    positions = []
    for column in order:
        position = order_position(df, column)
        if position is None:
            break
        positions.append(position)
    chunks: list[str] = []
    # Every round leaves chunks that are small or span less, so the rounds come to an end.
    for depth in itertools.count() if positions else ():
        parents = groups + chunks
        large = _groups_to_cut(df, parents, positions, chunk_rows if depth == 0 else 2 * chunk_rows)
        found, rows = large.agg(F.count(F.lit(1)), F.sum("_rows")).first()
        if not found:
            break
        cells = CELLS_PER_CHUNK * (found + rows // chunk_rows)
        large = cut_lineage(
            large.withColumn(
                "_width", F.col("_span") / (CELLS_PER_CHUNK * F.ceil(F.col("_rows") / chunk_rows))
            ).drop("_span", "_rows")
        )
        position = F.lit(None).cast("double")
        for i, p in enumerate(positions):
            position = F.when(F.col("_pick") == i, p).otherwise(position)
        cell = (
            F.when(position.isNull(), F.lit(NULLS_LAST_CELL))
            .when(F.col("_width") > 0, F.floor((position - F.col("_low")) / F.col("_width")))
            .otherwise(F.lit(0))
            .cast("bigint")
        )
        inside = match_null_safe(df, large, parents, "inner", found).withColumn("_cell", cell)
        along = Window.partitionBy(*parents).orderBy("_cell").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        chunk = f"_chunk{depth}"
        cuts = cut_lineage(
            inside.groupBy(*parents, "_cell")
            .agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_seen", F.sum("_rows").over(along))
            .select(
                *parents,
                "_cell",
                F.floor((F.col("_seen") - F.col("_rows")) / chunk_rows)
                .cast("bigint")
                .alias(chunk),
            )
            .where(F.col(chunk) > 0)
        )
        df = match_null_safe(df, large, parents, "left", found).withColumn("_cell", cell)
        df = match_null_safe(df, cuts, [*parents, "_cell"], "left", cells)
        df = df.withColumn(chunk, F.coalesce(F.col(chunk), F.lit(0).cast("bigint"))).drop(
            "_pick", "_low", "_width", "_cell"
        )
        chunks.append(chunk)
    return Layout(df, groups, chunks, temporary)


def _groups_to_cut(
    df: DataFrame, parents: Sequence[str], positions: Sequence[Column], limit: int
) -> DataFrame:
    """Groups above ``limit`` with the first order column that varies in them and its extent."""
    stats = [F.count(F.lit(1)).alias("_rows")]
    for i, p in enumerate(positions):
        stats += [F.min(p).alias(f"_low{i}"), F.max(p).alias(f"_high{i}"), F.count(p).alias(f"_set{i}")]
    pick, low, span = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in reversed(range(len(positions))):
        varies = (F.col(f"_low{i}") < F.col(f"_high{i}")) | (
            (F.col(f"_set{i}") > 0) & (F.col(f"_set{i}") < F.col("_rows"))
        )
        pick = F.when(varies, F.lit(i)).otherwise(pick)
        low = F.when(varies, F.col(f"_low{i}")).otherwise(low)
        span = F.when(varies, F.col(f"_high{i}") - F.col(f"_low{i}")).otherwise(span)
    return (
        df.groupBy(*parents)
        .agg(*stats)
        .where(F.col("_rows") > limit)
        .select(*parents, "_rows", pick.alias("_pick"), low.alias("_low"), span.alias("_span"))
        .where(F.col("_pick").isNotNull())
    )


def drop_layout(df: DataFrame, layout: Layout) -> DataFrame:
    return df.drop(*layout.chunks, *layout.temporary)


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    weights: dict[str, str],
    *,
    group_totals: dict[str, str] | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add, per output name, the total of its weight column over all earlier rows, and, per
    name in ``group_totals``, the total over the whole group."""
    group_totals = group_totals or {}
    layout = split_groups(df, groups, order, chunk_rows)
    ordered = Window.partitionBy(*layout.keys).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = layout.df.withColumns(
        {name: F.coalesce(F.sum(w).over(before), F.lit(0)) for name, w in weights.items()}
    )
    if not layout.split:
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = out.withColumns({name: F.sum(w).over(whole) for name, w in group_totals.items()})
        return drop_layout(out, layout)
    along = Window.partitionBy(*layout.groups).orderBy(*layout.chunks)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = layout.df.groupBy(*layout.keys).agg(
        *[F.sum(w).alias(f"_total_{name}") for name, w in {**weights, **group_totals}.items()]
    )
    bases = totals.select(
        *layout.keys,
        *[F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_base_{n}") for n in weights],
        *[F.sum(f"_total_{n}").over(every).alias(n) for n in group_totals],
    )
    out = match_null_safe(out, bases, layout.keys)
    out = out.withColumns({n: F.col(n) + F.col(f"_base_{n}") for n in weights})
    return drop_layout(out.drop(*[f"_base_{n}" for n in weights]), layout)


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    *,
    weight: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, one output column per name, and ``_n``.

    Groups of up to ``chunk_rows`` rows are counted by value and ranked in a window. The ranks of a
    larger group are found by radix selection, so nothing that is kept grows with its rows or with
    its different values. ``weight`` names a count column of rows that stand for several.
    """
    kept = list(groups)
    rows = df.where(F.col(value).isNotNull())
    if not kept:
        rows = rows.withColumn(ONE_GROUP, F.lit(0))
    groups = kept or [ONE_GROUP]
    n = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = store(rows.groupBy(*groups).agg(n.alias("_n")), "sizes")
    large = sizes.where(F.col("_n") > chunk_rows)
    n_large = large.count()
    spots = {name: F.lit(float(q)) * (F.col("_n") - 1) for name, q in quantiles.items()}
    parts = []
    if n_large < sizes.count():
        small = match_null_safe(rows, large, groups, "left_anti", n_large) if n_large else rows
        parts.append(_small_quantiles(small, groups, value, weight, spots))
    if n_large:
        ends = F.array(*[F.struct(F.lit(f"{end}_{name}").alias("_name"), whole(spot).alias("_rank")) for name, spot in spots.items() for end, whole in (("low", F.floor), ("high", F.ceil))])
        found = select_ranks(rows, groups, value, large.select(*groups, F.inline(ends)), weight)
        picked = [F.max(F.when(F.col("_name") == f"{end}_{q}", F.col("_value"))).alias(f"_{end}_{q}") for q in quantiles for end in ("low", "high")]
        parts.append(match_null_safe(large, found.groupBy(*groups).agg(*picked), groups, "inner", n_large))
    if not parts:
        parts.append(_small_quantiles(rows, groups, value, weight, spots))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    out = []
    for name, spot in spots.items():
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        out.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return found.select(*kept, "_n", *out)


def _small_quantiles(rows: DataFrame, groups: Sequence[str], value: str, weight: str | None, spots: dict[str, Column]) -> DataFrame:
    """Per group ``_n`` and the values at both ends of each spot, from a window over its counts."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = rows.groupBy(*groups, F.col(value).cast("double").alias("_value")).agg(n.alias("_count"))
    along = Window.partitionBy(*groups).orderBy("_value")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = counts.withColumns(
        {
            "_before": F.sum("_count").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_count"),
            "_n": F.sum("_count").over(whole),
        }
    )

    def at(index: Column) -> Column:
        here = (F.col("_before") <= index) & (index < F.col("_before") + F.col("_count"))
        return F.max(F.when(here, F.col("_value")))

    picks = [at(whole(spot)).alias(f"_{end}_{name}") for name, spot in spots.items() for end, whole in (("low", F.floor), ("high", F.ceil))]
    return placed.groupBy(*groups).agg(F.max("_n").alias("_n"), *picks)


def average_ranks(
    df: DataFrame,
    groups: Sequence[str],
    values: dict[str, str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add, per output name, the rank of its value column in the group; ties share their mean.

    Groups of up to ``chunk_rows`` rows are ranked by a window, larger ones in ranges of their own
    order, see ``_ranked_in_ranges``.
    """
    groups, temporary = list(groups), []
    if not groups:
        df, groups, temporary = df.withColumn(ONE_GROUP, F.lit(0)), [ONE_GROUP], [ONE_GROUP]
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"))
    large = cut_lineage(sizes.where(F.col("_rows") > chunk_rows))
    n_large, n_rows = large.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if not n_large:
        return _ranked_in_windows(df, groups, values).drop(*temporary)
    large = large.select(*groups)
    out = match_null_safe(df, large, groups, "left_semi", n_large)
    for name, value in values.items():
        out = _ranked_in_ranges(out, groups, name, value, -(-n_rows // chunk_rows) + n_large)
    small = match_null_safe(df, large, groups, "left_anti", n_large)
    return out.unionByName(_ranked_in_windows(small, groups, values)).drop(*temporary)


def _ranked_in_windows(df: DataFrame, groups: Sequence[str], values: dict[str, str]) -> DataFrame:
    ranks = {}
    for name, value in values.items():
        below = F.rank().over(Window.partitionBy(*groups).orderBy(F.asc_nulls_last(value)))
        same = F.count(F.lit(1)).over(Window.partitionBy(*groups, value))
        ranks[name] = F.when(F.col(value).isNotNull(), below + (same - 1) / 2.0)
    return df.withColumns(ranks)


def _ranked_in_ranges(df: DataFrame, groups: Sequence[str], name: str, value: str, n_ranges: int) -> DataFrame:
    """Ranks of groups of any size.

    Spark samples splitters and deals the rows to ranges of (group, value, hash), so even equal values
    that make up a third of the table are spread. A range ranks its rows on its own; a table of one row
    per range and group then tells how many rows lie in earlier ranges, and how often the value at either
    end of a range occurs in its neighbours, for only such a value can straddle a splitter. Rows are
    joined with that table alone, never on their values.
    """
    own = list(df.columns)
    salted = df.withColumn("_salt", F.xxhash64(*own))
    dealt = salted.repartitionByRange(int(n_ranges), *groups, F.asc_nulls_last(value), "_salt")
    ranges = store(dealt.withColumn("_range", F.spark_partition_id()).drop("_salt"), "ranges")
    inside = Window.partitionBy("_range", *groups)
    rows = ranges.where(F.col(value).isNotNull()).withColumns(
        {
            "_below": F.rank().over(inside.orderBy(value)) - 1,
            "_same": F.count(F.lit(1)).over(Window.partitionBy("_range", *groups, value)),
        }
    )
    ends = cut_lineage(
        rows.groupBy("_range", *groups).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min(F.struct(F.col(value).alias("v"), F.col("_same").alias("same"))).alias("_first"),
            F.max(F.struct(F.col(value).alias("v"), F.col("_same").alias("same"))).alias("_last"),
        )
    )
    n_ends = ends.count()
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ends.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    # What each range knows of the values at its ends; a value that fills the range counts once.
    low = F.struct(F.col("_first.v").alias("v"), F.col("_first.same").alias("same"), F.col("_offset").alias("below"))
    high = F.struct(F.col("_last.v").alias("v"), F.col("_last.same").alias("same"), (F.col("_offset") + F.col("_rows") - F.col("_last.same")).alias("below"))
    known = placed.select(*groups, F.explode(F.array_distinct(F.array(low, high))).alias("_end"))
    totals = cut_lineage(known.groupBy(*groups, F.col("_end.v").alias("_v")).agg(F.sum("_end.same").alias("_all"), F.min("_end.below").alias("_start")))
    facts = placed
    for side in ("_first", "_last"):
        of = totals.select(*groups, F.col("_v").alias(f"{side}_v"), F.struct("_all", "_start").alias(f"{side}_total"))
        facts = match_null_safe(facts.withColumn(f"{side}_v", F.col(f"{side}.v")), of, [*groups, f"{side}_v"], "left", 2 * n_ends)
    facts = facts.select("_range", *groups, "_offset", "_first_v", "_last_v", "_first_total", "_last_total")
    joined = match_null_safe(rows, cut_lineage(facts), ["_range", *groups], "left", n_ends)
    at_end = F.when(F.col(value) == F.col("_first_v"), F.col("_first_total")).when(F.col(value) == F.col("_last_v"), F.col("_last_total"))
    below = F.coalesce(at_end["_start"], F.col("_offset") + F.col("_below"))
    same = F.coalesce(at_end["_all"], F.col("_same"))
    ranked = joined.withColumn(name, below + (same + 1) / 2.0).select(*own, name)
    unranked = ranges.where(F.col(value).isNull()).select(*own).withColumn(name, F.lit(None).cast("double"))
    return ranked.unionByName(unranked)
