"""How filters interact: what each removes in every order they could run in, from decision diagrams.

Every document gets a mask of the filters it fails. Documents are counted by part and mask, so a part
of any size comes down to at most ``2 ** filters`` cells. From its cells each part gets a decision
diagram: one level per filter, a pass and a fail edge per node, equal subdiagrams shared, and in each
node the counts of the documents below it. Two neighbouring filters change places by a swap of their
levels; a walk through all orders takes one swap per order. Along the all-pass path of an order, the
weight behind a fail edge is what that step removes, the weight of the next node what it keeps.

Defined cases: null and empty texts are equal empty texts; a null source is the part ''; a null doc_id
is no copy of anything, shields nothing and has no label; repeated rows count each and are no copies of
each other; a document with several labels counts as good (toxic) if any says so; an empty table gives
no rows; very long texts are judged whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import doc_words, let
from skyloom.session import store

FILTERS = "ABCDE"
#: Steps of n filters are n * n! rows a part.
MOST_FILTERS = 7
_PARTS_AT_ONCE = 64
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def own_failures(text: Column) -> Column:
    """Bits of the filters that look at one text alone: few words, few different words, many
    capitals, symbols."""
    words = let(
        doc_words(text),
        lambda w: (F.size(w) < 50).cast("int") + (100 * F.size(F.array_distinct(w)).cast("long") < 65 * F.size(w).cast("long")).cast("int") * 2,
    )
    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long")
    symbols = F.rlike(text, F.lit(r"[#$%&*|]"))
    return words + capitals.cast("int") * 4 + symbols.cast("int") * 8


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by part and failure mask.

    A text is first where no smaller doc_id has it. Rows meet their first one on (text, doc_id), so a
    text that countless documents share is no hot key; before that, equal rows become one.
    """
    text = F.coalesce("text", F.lit(""))
    judged = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        own_failures(text).alias("own"),
    )
    # Some 60 bytes a document, so that texts are judged once.
    rows = store(judged.groupBy("id", "part", "digest", "own").agg(F.count("*").alias("n")), "judged")
    first = rows.filter(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id"))
    marks = (
        labels.groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .filter("good = 1 OR toxic = 1")
        .withColumnRenamed("doc_id", "id")
    )
    placed = rows.join(marks, "id", "left").join(first.withColumn("first", F.lit(True)), ["id", "digest"], "left")
    copied = F.col("id").isNotNull() & F.col("first").isNull()
    return placed.groupBy("part", (F.col("own") + copied.cast("int") * 16).alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one, one after the other, to see every order of ``n`` once."""
    if n < 2:
        return
    up, inner = False, adjacent_swaps(n - 1)
    while True:
        yield from range(n - 1) if up else range(n - 2, -1, -1)
        step = next(inner, None)
        if step is None:
            return
        up = not up
        yield step + up  # the last filter now stands before or behind the others


class Diagram:
    """Shared diagram of one part. ``cells`` maps masks to counts, bit k of a mask for filter k."""

    def __init__(self, cells: dict[int, tuple[int, ...]], filters: int, width: int = 3):
        self.order = list(range(filters))
        self.edges: list[tuple[int, int] | None] = []  # pass and fail edge of each node, none for a leaf
        self.weight: list[tuple[int, ...]] = []
        self._known: dict[tuple, int] = {}
        none = (0,) * width

        def build(level: int, mask: int) -> int:
            if level == filters:
                return self._leaf(cells.get(mask, none))
            return self._node(build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _keep(self, key: tuple, edges: tuple[int, int] | None, weight: tuple[int, ...]) -> int:
        if key not in self._known:
            self._known[key] = len(self.edges)
            self.edges.append(edges)
            self.weight.append(weight)
        return self._known[key]

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._keep(("leaf", *weight), None, weight)

    def _node(self, passed: int, failed: int) -> int:
        total = tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed], strict=True))
        return self._keep((passed, failed), (passed, failed), total)

    def swap(self, level: int) -> None:
        """Let the filters of ``level`` and the next one change places."""
        done: dict[int, int] = {}

        def turned(node: int, above: int) -> int:
            if node not in done:
                passed, failed = self.edges[node]
                if above:
                    done[node] = self._node(turned(passed, above - 1), turned(failed, above - 1))
                else:
                    (pp, pf), (fp, ff) = self.edges[passed], self.edges[failed]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = turned(self.root, level)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Filter, weight removed and weight kept of each step along the all-pass path."""
        node = self.root
        for which in self.order:
            node, failed = self.edges[node]
            yield which, self.weight[failed], self.weight[node]

    def alone(self, which: int) -> int:
        """Documents that fail this filter only."""
        node = self.root
        for k in self.order:
            node = self.edges[node][k == which]
        return self.weight[node][0]


def audit_part(cells: dict[int, tuple[int, ...]], names: str) -> list[tuple]:
    """Rows of the audit of one part, without its name."""
    n = len(names)
    diagram = Diagram(cells, n)
    alone = [diagram.alone(k) for k in range(n)]
    fails, shapley, found = [0] * n, [0] * n, []
    swaps = adjacent_swaps(n)
    while True:
        label = "".join(names[k] for k in diagram.order)
        for step, (which, lost, kept) in enumerate(diagram.steps(), 1):
            found.append((label, step, which, kept[0], *lost))
            shapley[which] += lost[0]
            if step == 1:
                fails[which] = lost[0]  # nothing went before
        level = next(swaps, None)
        if level is None:
            break
        diagram.swap(level)
    return [(label, step, kept, lost, fails[k] - lost, alone[k], good, toxic, shapley[k]) for label, step, k, kept, lost, good, toxic in found]


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_counts``; bit k of a mask belongs
    to the k-th of ``names`` (one character each, at most ``MOST_FILTERS``)."""
    if not 0 < len(set(names)) == len(names) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} different one-character names, not {names!r}")
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in _COUNTS)])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (row for batch in batches for row in batch.to_pylist())
        while some := list(islice(parts, _PARTS_AT_ONCE)):
            rows = [
                (row["part"], *r)
                for row in some
                for r in audit_part({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["cells"]}, names)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return cells.mapInArrow(steps, AUDIT_SCHEMA)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, by source."""
    return audit(mask_counts(docs, labels))
