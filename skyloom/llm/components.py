"""Connected components of a link table by alternating star contraction.

Every round replaces links by links to smaller neighbours until each component is one star around
its smallest node. Links and nodes stay distributed; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import scratch_scope, store


def _both(links: DataFrame) -> DataFrame:
    flipped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(flipped)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour."""
    both = _both(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of a link table (columns a, b); the component is its
    smallest node. Nodes are of an ordered type."""

    def clean(df: DataFrame) -> DataFrame:
        return store(df.filter("a != b").distinct(), "links")

    def shape(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    with scratch_scope(links.sparkSession):
        now = clean(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        before, seen = None, shape(now)
        while seen[0] and seen != before:
            now = clean(_small_star(_large_star(now)))
            before, seen = seen, shape(now)
        stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        return store(stars.unionByName(centres), "components", outlive=True)
