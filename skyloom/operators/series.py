"""Neighbourhood of each reading in its own series.

For every metric one pass finds the prior reading, the length of the run of equal readings
around the row, and the nearest known readings on both sides. All metrics share one window
order, hence one shuffle and one sort. See ``ordered`` for series too large for one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.operators.ordered import (
    CHUNK_ROWS,
    Layout,
    drop_layout,
    match_null_safe,
    split_groups,
)

PRIOR = "_prior_{}"
RUN = "_run_{}"
KNOWN_BEFORE = "_known_before_{}"
KNOWN_AFTER = "_known_after_{}"
POSITION = "_position"


def _next_non_null(expression: str, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Following non-null value. An offset window with IGNORE NULLS is linear, a frame that
    reaches to the end of the partition is not."""
    part = ", ".join(f"`{k}`" for k in keys)
    by = ", ".join(f"`{o}` ASC NULLS LAST" for o in order)
    return F.expr(f"lead({expression}, 1) IGNORE NULLS OVER (PARTITION BY {part} ORDER BY {by})")


def _differs(metric: str, prior: Column) -> Column:
    """A missing reading is a run of its own and ends the run before it."""
    value = F.col(metric)
    return value.isNull() | prior.isNull() | (value != prior)


def neighbourhood(
    df: DataFrame,
    metrics: Sequence[str],
    *,
    groups: Sequence[str],
    order: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
    layout: Layout | None = None,
) -> DataFrame:
    """Add, per metric, the columns ``PRIOR``, ``RUN``, ``KNOWN_BEFORE`` and ``KNOWN_AFTER``.

    The known columns are structs of position and value; ``POSITION`` is the row's own
    position in its series. Without ``order`` the frame comes back with no helper columns
    that need one. ``layout`` is the frame's split by ``groups`` where the caller has it already.
    """
    order = list(order)
    layout = layout or split_groups(df, groups, order, chunk_rows)
    keys = layout.keys
    ordered = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    out = layout.df.withColumns(
        {
            POSITION: F.row_number().over(ordered).cast("bigint"),
            "_size": F.count(F.lit(1)).over(whole),
            **{PRIOR.format(m): F.lag(m).over(ordered) for m in metrics},
        }
    )
    first = F.col(POSITION) == 1
    marks = {}
    for m in metrics:
        starts = _differs(m, F.col(PRIOR.format(m)))
        if layout.split:
            starts = starts & ~first
        marks[f"_turn_{m}"] = F.when(starts, F.col(POSITION))
        marks[f"_known_{m}"] = F.when(
            F.col(m).isNotNull(),
            F.struct(F.col(POSITION).alias("at"), F.col(m).cast("double").alias("value")),
        )
    out = out.withColumns(marks)
    reach = {}
    for m in metrics:
        reach[f"_start_{m}"] = F.last(f"_turn_{m}", ignorenulls=True).over(so_far)
        reach[f"_stop_{m}"] = _next_non_null(f"`_turn_{m}`", keys, order)
        reach[KNOWN_BEFORE.format(m)] = F.last(f"_known_{m}", ignorenulls=True).over(so_far)
        reach[KNOWN_AFTER.format(m)] = _next_non_null(f"`_known_{m}`", keys, order)
    out = out.withColumns(reach)
    if layout.split:
        out = _carry(out, layout, metrics)
    else:
        out = out.withColumns(
            {
                RUN.format(m): F.coalesce(F.col(f"_stop_{m}"), F.col("_size") + 1)
                - F.col(f"_start_{m}")
                for m in metrics
            }
        )
    return drop_layout(out, layout).drop(
        "_size", *[f"_{p}_{m}" for m in metrics for p in ("turn", "known", "start", "stop")]
    )


def _carry(out: DataFrame, layout: Layout, metrics: Sequence[str]) -> DataFrame:
    """Complete the helper columns of a chunked frame with what lies beyond each cut."""
    edges = out.groupBy(*layout.keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            piece
            for m in metrics
            for piece in (
                F.min_by(m, POSITION).alias(f"_first_{m}"),
                F.max_by(m, POSITION).alias(f"_last_{m}"),
                F.min(f"_turn_{m}").alias(f"_first_turn_{m}"),
                F.max(f"_turn_{m}").alias(f"_last_turn_{m}"),
                F.min(f"_known_{m}").alias(f"_first_known_{m}"),
                F.max(f"_known_{m}").alias(f"_last_known_{m}"),
            )
        ],
    )
    along = Window.partitionBy(*layout.groups).orderBy(*layout.chunks)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*layout.groups)
    edges = edges.withColumns(
        {
            "_base": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_total": F.sum("_rows").over(whole),
            **{f"_carry_prior_{m}": F.lag(f"_last_{m}").over(along) for m in metrics},
        }
    )

    def shifted(known: str) -> Column:
        k = F.col(known)
        return F.when(
            k.isNotNull(),
            F.struct((k["at"] + F.col("_base")).alias("at"), k["value"].alias("value")),
        )

    step = {}
    for m in metrics:
        opens = (
            F.col(f"_first_{m}").isNull()
            | F.col(f"_carry_prior_{m}").isNull()
            | (F.col(f"_first_{m}") != F.col(f"_carry_prior_{m}"))
        )
        own = F.when(opens, F.col("_base") + 1)
        step[f"_own_turn_{m}"] = own
        step[f"_head_turn_{m}"] = F.coalesce(own, F.col("_base") + F.col(f"_first_turn_{m}"))
        step[f"_tail_turn_{m}"] = F.coalesce(F.col("_base") + F.col(f"_last_turn_{m}"), own)
        step[f"_head_known_{m}"] = shifted(f"_first_known_{m}")
        step[f"_tail_known_{m}"] = shifted(f"_last_known_{m}")
    edges = edges.withColumns(step)
    carried = [F.col("_base"), F.col("_total")]
    for m in metrics:
        carried += [
            F.col(f"_carry_prior_{m}"),
            F.coalesce(
                F.col(f"_own_turn_{m}"),
                F.last(f"_tail_turn_{m}", ignorenulls=True).over(earlier),
            ).alias(f"_carry_start_{m}"),
            _next_non_null(f"`_head_turn_{m}`", layout.groups, layout.chunks).alias(
                f"_carry_stop_{m}"
            ),
            F.last(f"_tail_known_{m}", ignorenulls=True).over(earlier).alias(f"_carry_before_{m}"),
            _next_non_null(f"`_head_known_{m}`", layout.groups, layout.chunks).alias(
                f"_carry_after_{m}"
            ),
        ]
    edges = edges.select(*layout.keys, *carried)
    out = match_null_safe(out, edges, layout.keys)
    base = F.col("_base")

    def moved(known: str) -> Column:
        k = F.col(known)
        return F.when(
            k.isNotNull(), F.struct((k["at"] + base).alias("at"), k["value"].alias("value"))
        )

    fixed = {POSITION: F.col(POSITION) + base}
    for m in metrics:
        start = F.coalesce(base + F.col(f"_start_{m}"), F.col(f"_carry_start_{m}"))
        stop = F.coalesce(
            base + F.col(f"_stop_{m}"), F.col(f"_carry_stop_{m}"), F.col("_total") + 1
        )
        fixed[RUN.format(m)] = stop - start
        fixed[PRIOR.format(m)] = F.when(
            F.col(POSITION) == 1, F.col(f"_carry_prior_{m}")
        ).otherwise(F.col(PRIOR.format(m)))
        fixed[KNOWN_BEFORE.format(m)] = F.coalesce(
            moved(KNOWN_BEFORE.format(m)), F.col(f"_carry_before_{m}")
        )
        fixed[KNOWN_AFTER.format(m)] = F.coalesce(
            moved(KNOWN_AFTER.format(m)), F.col(f"_carry_after_{m}")
        )
    return out.withColumns(fixed).drop(
        "_base",
        "_total",
        *[f"_carry_{p}_{m}" for m in metrics for p in ("prior", "start", "stop", "before", "after")],
    )
