"""Exact nearest-neighbour estimates without comparing every pair.

Known points are grouped into a grid that halves twice per level. An unknown point walks
down it: at each level it keeps only cells that can still hold one of its k nearest points,
judged by cell bounds and cell counts. The kept cells per point stay few whatever the
clustering, so the work grows with the points, not with their product. A point whose own place
has a known row needs no walk: rows at the same place take all the weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.operators.ordered import BROADCAST_ROWS
from skyloom.session import store

NEIGHBOURS = 5
PER_LEAF = 32
DEEPEST = 12
FAN_BITS = 2


def place_estimates(
    df: DataFrame,
    columns: Sequence[str],
    *,
    lat: str,
    lon: str,
    tie: Sequence[str],
    pool: Sequence[str] = (),
    k: int = NEIGHBOURS,
) -> tuple[DataFrame, dict[str, str]]:
    """The frame with a column per name of ``columns`` for what the known rows of the very same place
    give, and the names of these columns, for ``fill_from_nearest``. One window per place: for frames
    whose places are known to be small, best where their rows share a task already."""
    ordered = Window.partitionBy(*pool, lat, lon).orderBy(*tie)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {f"_first_{c}": F.when(F.count(c).over(so_far) <= k, F.col(c).cast("double")) for c in columns}
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    settled = {c: f"_here_{c}" for c in columns}
    here = {settled[c]: F.when(placed, F.avg(f"_first_{c}").over(whole)) for c in columns}
    return df.withColumns(first).withColumns(here).drop(*first), settled


def fill_from_nearest(
    df: DataFrame,
    columns: Sequence[str],
    *,
    lat: str,
    lon: str,
    tie: Sequence[str],
    pool: Sequence[str] = (),
    k: int = NEIGHBOURS,
    settled: dict[str, str] | None = None,
) -> DataFrame:
    """Fill missing values of each column by the inverse-distance mean of its k nearest known
    rows with the same ``pool`` columns.

    Rows at the very same coordinates take all the weight. Equally near rows are taken in
    the order latitude, longitude, ``tie``. Rows without coordinates stay as they are. The
    estimates are one row per place and joined once for all columns. ``settled`` names, per column, the
    one that holds what ``place_estimates`` found; these columns are dropped.
    """
    settled = settled or {}
    if settled:
        found = {c: F.coalesce(F.col(c), F.col(here)) for c, here in settled.items()}
        open_rows = {c: F.col(c).isNull() & F.col(here).isNull() for c, here in settled.items()}
    else:
        found, open_rows = {c: F.col(c) for c in columns}, {c: F.col(c).isNull() for c in columns}
    place = [F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")]
    names = [f"_t{i}" for i in range(len(tie))]
    pools = [f"p{i}" for i in range(len(pool))]
    own = [F.col(c).alias(p) for c, p in zip(pool, pools)]
    located = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    lacking = located.agg(F.lit(0), *[F.count_if(open_rows[c]) for c in columns]).first()[1:]
    searched = [c for c, n in zip(columns, lacking) if n]
    if not searched:
        return df.withColumns(found).drop(*settled.values())
    # A series is one column inside one pool; nothing below looks across series.
    cells = F.array(
        *[
            F.struct(F.struct(F.lit(c).alias("name"), *own).alias("series"), F.col(c).cast("double").alias("value"), open_rows[c].alias("open"))
            for c in searched
        ]
    )
    long = located.select(
        *place, *[F.col(t).alias(n) for t, n in zip(tie, names)], F.inline(cells)
    )
    wanted = store(
        long.where(F.col("open"))
        .select("series", F.col("lat").alias("u_lat"), F.col("lon").alias("u_lon"))
        .distinct(),
        "wanted",
    )
    same_place = Window.partitionBy("series", "lat", "lon").orderBy(*names)
    known = store(
        long.where(F.col("value").isNotNull())
        # Rows at one place are equally far from everywhere: only its first k can be picked, and
        # each task drops the others before the shuffle.
        .withColumn("slot", F.row_number().over(same_place))
        .where(F.col("slot") <= k)
        .select("series", "lat", "lon", "value", "slot"),
        "known",
    )
    if settled:
        estimates = nearest_estimates(wanted, known, k)
        if estimates is None:
            return df.withColumns(found).drop(*settled.values())
    else:
        # Rows at the same place take all the weight; only the other places look around.
        at = ["series", "u_lat", "u_lon"]
        here = known.select("series", F.col("lat").alias("u_lat"), F.col("lon").alias("u_lon"), "value").join(wanted, at, "left_semi")
        estimates = store(here.groupBy(*at).agg(F.avg("value").alias("_estimate")), "own_place")
        others = store(wanted.join(estimates, at, "left_anti"), "others")
        looked = None if others.isEmpty() else nearest_estimates(others, known, k)
        estimates = estimates if looked is None else estimates.unionByName(looked)
    per_place = estimates.groupBy(*[F.col(f"series.{p}").alias(f"_{p}") for p in pools], "u_lat", "u_lon").agg(
        *[F.max(F.when(F.col("series.name") == c, F.col("_estimate"))).alias(f"_estimate_{c}") for c in searched]
    )
    here = (F.col(lat) == F.col("u_lat")) & (F.col(lon) == F.col("u_lon"))
    for c, p in zip(pool, pools):
        here = here & F.col(c).eqNullSafe(F.col(f"_{p}"))
    return df.join(per_place, here, "left").withColumns(
        found | {c: F.coalesce(found[c], F.col(f"_estimate_{c}")) for c in searched}
    ).drop("u_lat", "u_lon", *[f"_{p}" for p in pools], *[f"_estimate_{c}" for c in searched], *settled.values())


def nearest_estimates(wanted: DataFrame, known: DataFrame, k: int) -> DataFrame | None:
    """Per wanted ``(series, u_lat, u_lon)`` the weighted mean ``_estimate`` of its k nearest
    rows of the same series; None when nothing is known."""
    picked = nearest_points(wanted, known, k)
    if picked is None:
        return None
    exact = F.col("distance") == 0
    hits = F.count_if(exact)
    weight = 1.0 / F.when(~exact, F.col("distance"))
    return picked.groupBy("series", "u_lat", "u_lon").agg(
        F.when(hits > 0, F.sum(F.when(exact, F.col("value"))) / hits)
        .otherwise(F.sum(weight * F.col("value")) / F.sum(weight))
        .alias("_estimate")
    )


def nearest_points(wanted: DataFrame, known: DataFrame, k: int) -> DataFrame | None:
    """The k nearest rows of ``known(series, lat, lon, value, slot)`` of every wanted point."""
    box = known.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("lat").alias("lat"),
        F.min("lon").alias("lon"),
        F.greatest(F.max("lat") - F.min("lat"), F.max("lon") - F.min("lon")).alias("side"),
    ).first()
    if not box["rows"]:
        return None
    side = box["side"] or 1.0
    last = (1 << (FAN_BITS * DEEPEST)) - 1

    def index(c: str, origin: float):
        scaled = (F.col(c) - F.lit(origin)) / F.lit(side) * float(last + 1)
        return F.least(F.floor(scaled).cast("bigint"), F.lit(last))

    points = known.withColumn("ix", index("lat", box["lat"])).withColumn(
        "iy", index("lon", box["lon"])
    )
    depth, occupied = _leaf_depth(points)
    root = F.lit(0).cast("bigint")
    frontier = wanted.select("series", "u_lat", "u_lon", root.alias("cx"), root.alias("cy"))
    one = Window.partitionBy("series", "u_lat", "u_lon")
    by_far = one.orderBy("far", "cx", "cy").rowsBetween(Window.unboundedPreceding, 0)
    for level in range(1, depth + 1):
        cells = _cells(points, level)
        if occupied[level] <= BROADCAST_ROWS:
            cells = F.broadcast(cells)
        off_lat = F.greatest(F.col("lat_0") - F.col("u_lat"), F.col("u_lat") - F.col("lat_1"), F.lit(0.0))
        off_lon = F.greatest(F.col("lon_0") - F.col("u_lon"), F.col("u_lon") - F.col("lon_1"), F.lit(0.0))
        far_lat = F.greatest(F.abs(F.col("lat_0") - F.col("u_lat")), F.abs(F.col("u_lat") - F.col("lat_1")))
        far_lon = F.greatest(F.abs(F.col("lon_0") - F.col("u_lon")), F.abs(F.col("u_lon") - F.col("lon_1")))
        frontier = (
            frontier.withColumnsRenamed({"cx": "parent_x", "cy": "parent_y"})
            .join(cells, ["series", "parent_x", "parent_y"])
            .withColumn("near", F.sqrt(off_lat * off_lat + off_lon * off_lon))
            .withColumn("far", F.sqrt(far_lat * far_lat + far_lon * far_lon))
            .withColumn("_held", F.sum("held").over(by_far))
            .withColumn("_reach", F.min(F.when(F.col("_held") >= k, F.col("far"))).over(one))
            .where(F.col("_reach").isNull() | (F.col("near") <= F.col("_reach")))
            .select("series", "u_lat", "u_lon", "cx", "cy")
        )
    shift = FAN_BITS * (DEEPEST - depth)
    leaves = points.select(
        "series", "lat", "lon", "value", "slot",
        F.shiftright("ix", shift).alias("cx"), F.shiftright("iy", shift).alias("cy"),
    )
    d_lat, d_lon = F.col("lat") - F.col("u_lat"), F.col("lon") - F.col("u_lon")
    rank = F.row_number().over(one.orderBy("distance", "lat", "lon", "slot"))
    return (
        frontier.join(leaves, ["series", "cx", "cy"])
        .withColumn("distance", F.sqrt(d_lat * d_lat + d_lon * d_lon))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("series", "u_lat", "u_lon", "rank", "distance", "value")
    )


def _leaf_depth(points: DataFrame) -> tuple[int, dict[int, int]]:
    """Shallowest level whose fullest cell holds at most ``PER_LEAF`` points, and the number of
    occupied cells of every level: one pass counts the deepest cells, which add up to the others."""
    deepest = points.groupBy("series", "ix", "iy").agg(F.count(F.lit(1)).alias("held"))
    levels = F.explode(F.sequence(F.lit(1), F.lit(DEEPEST))).alias("level")
    shift = ((DEEPEST - F.col("level")) * FAN_BITS).cast("int")
    cells = (
        deepest.select("*", levels)
        .groupBy(
            "level", "series",
            F.call_function("shiftright", F.col("ix"), shift).alias("cx"),
            F.call_function("shiftright", F.col("iy"), shift).alias("cy"),
        )
        .agg(F.sum("held").alias("held"))
    )
    counted = cells.groupBy("level").agg(F.max("held").alias("most"), F.count(F.lit(1)).alias("n")).collect()
    occupied = {r["level"]: r["n"] for r in counted}
    depth = min((r["level"] for r in counted if r["most"] <= PER_LEAF), default=DEEPEST)
    return depth, occupied


def _cells(points: DataFrame, level: int) -> DataFrame:
    """Cells of one level with their parent, count and the true bounds of their points."""
    shift = FAN_BITS * (DEEPEST - level)
    return (
        points.groupBy(
            "series", F.shiftright("ix", shift).alias("cx"), F.shiftright("iy", shift).alias("cy")
        )
        .agg(
            F.count(F.lit(1)).alias("held"),
            F.min("lat").alias("lat_0"),
            F.max("lat").alias("lat_1"),
            F.min("lon").alias("lon_0"),
            F.max("lon").alias("lon_1"),
        )
        .withColumn("parent_x", F.shiftright("cx", FAN_BITS))
        .withColumn("parent_y", F.shiftright("cy", FAN_BITS))
    )
