"""Mix sources to target weights by cube-method balanced sampling.

Every document of a source is due ``target / source size`` copies: the whole part is given to all
of them, the fraction is sampled. The sample is balanced on two totals, documents and words: the
flight phase moves the inclusion probabilities of three documents at a time along the one
direction that changes neither total, until one of them becomes 0 or 1. A block ends with at most
two open documents; the open ones of all blocks fly again. In a source's last block a ladder of documents,
from the smallest up, is left out of the flight: these and the last open ones land by falling size, the
words of each made up for by the smaller ones, so a source misses its target by part of a small document,
unless one document outweighs all others.

Blocks are small and dealt by a hash, so a source that holds a third of all rows is worked on by
many tasks, and the open rows shrink several hundred times per round.

Defined cases: null text has size 0; a null source is a source of its own, last in the order; a
source without words has target 0; an empty table gives an empty result; repeated rows are sampled
each for itself; other columns are ignored. Everything is drawn from hashes, so reruns agree.
"""

from __future__ import annotations

import bisect
import math
import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import store

BLOCK_ROWS = 1000
#: The landing keeps this many of the smallest documents, and holds each larger one's words so many times.
RUNGS, ROOM = 4, 16
#: With fewer documents left, the landing gives up their count.
BOTH_TOTALS = 16
#: A mix has one row per source on the driver; more than this is refused.
MAX_SOURCES = 100_000
_STATE = "doc_id {id}, source string, size long, u double, p double"


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), limit: float = 3.0) -> dict[str | None, float]:
    """Words each source is to give. Sources in code point order (null last) take the weights in
    turn and share the total; none gives over ``limit`` times its size, and what that leaves is
    shared anew among the others by weight."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    rest, free, out = float(sum(sizes.values())), list(ordered), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > limit * sizes[s]]
        if not over:
            out |= {s: rest * weight[s] / total for s in free}
            break
        out |= {s: limit * sizes[s] for s in over}
        rest -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def _step(window: list[int], p: list[float], direction: list[float], u: float) -> None:
    """Move along the direction to one of its two ends, so that expectations stay."""
    up = down = math.inf
    for k, d in zip(window, direction, strict=True):
        if d:
            up = min(up, ((1 - p[k]) if d > 0 else p[k]) / abs(d))
            down = min(down, (p[k] if d > 0 else (1 - p[k])) / abs(d))
    by = up if u * (up + down) < down else -down
    for k, d in zip(window, direction, strict=True):
        moved = p[k] + by * d
        p[k] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved


def _ladder(open_: list[int], size: list[int]) -> set[int]:
    """Of the open documents, by index, as few as make up for each other: the smallest ones, and up from
    there always the largest whose words the chosen ones hold ``ROOM`` times; where there is none, the
    next one that the gap leaves."""
    left = sorted((k for k in open_ if size[k]), key=lambda k: (size[k], k))
    chosen, total = left[:RUNGS], float(sum(size[k] for k in left[:RUNGS]))
    left = left[RUNGS:]
    while left and total < ROOM * size[left[-1]]:
        fits = bisect.bisect_right(left, total / ROOM, key=lambda k: size[k])
        chosen.append(left.pop(max(fits - 1, 0)))
        total += size[chosen[-1]]
    return set(chosen)


def _made_up(size: list[int], largest: int, smaller: list[int], room: list[float]) -> list[float]:
    """How the smaller documents move when the largest goes up by one: by their room, so that neither
    total changes, or only the words' when they are few or all of one size."""
    s0, s1, s2 = (sum(r * size[k] ** n for r, k in zip(room, smaller, strict=True)) for n in range(3))
    spread = s0 * s2 - s1 * s1
    if len(smaller) < BOTH_TOTALS or spread <= 1e-9 * s0 * s2:
        return [-size[largest] * r / s1 for r in room]
    level, slope = (s2 - s1 * size[largest]) / spread, (s0 * size[largest] - s1) / spread
    return [-r * (level + slope * size[k]) for r, k in zip(room, smaller, strict=True)]


def _land(p: list[float], size: list[int], u: list[float], open_: list[int]) -> None:
    """Bring open documents to 0 or 1 by falling size. What one of them moves, all smaller ones that are
    still open make up for; only the last has nobody left and is rounded to its nearer end."""
    order = sorted(open_, key=lambda k: (-size[k], u[k], k))
    draw = random.Random(repr([u[k] for k in order])).random
    for n, largest in enumerate(order):
        while 0 < p[largest] < 1:
            smaller = [k for k in order[n + 1 :] if size[k] and 0 < p[k] < 1]
            if not smaller:
                p[largest] = float(p[largest] + (draw() - 0.5) * 1e-9 > 0.5)
                break
            room = [p[k] * (1 - p[k]) for k in smaller]
            _step([largest, *smaller], p, [1.0, *_made_up(size, largest, smaller, room)], draw())


def fly(p: list[float], size: list[int], u: list[float], land: bool) -> list[float]:
    """Inclusion probabilities after the flight; with ``land`` all of them are 0 or 1. The flight leaves
    the landing a ladder of documents, which gives up the count of documents only near its end."""
    p, window = list(p), []
    ladder = _ladder([k for k in range(len(p)) if 0 < p[k] < 1], size) if land else set()
    for new in range(len(p)):
        if not 0 < p[new] < 1 or new in ladder:
            continue
        window.append(new)
        if len(window) == 3:
            a, b, c = (float(size[k]) for k in window)
            direction = [c - b, a - c, b - a] if not a == b == c else [1.0, -1.0, 0.0]
            _step(window, p, direction, u[new])
            window = [k for k in window if 0 < p[k] < 1]
    if land:
        _land(p, size, u, [*window, *ladder])
    return p


def _flight(land: bool):
    def fly_block(table: pa.Table) -> pa.Table:
        size, u, p = (table.column(c).to_numpy() for c in ("size", "u", "p"))
        order = np.lexsort((size, u))
        moved = np.empty(len(p))
        moved[order] = fly(p[order].tolist(), size[order].tolist(), u[order].tolist(), land)
        at = table.schema.get_field_index("p")
        return table.set_column(at, "p", pa.array(moved)).select(["doc_id", "source", "size", "u", "p"])

    return fly_block


def _blocks(counts: dict[str | None, int]) -> dict[str | None, int]:
    return {s: -(-n // BLOCK_ROWS) for s, n in counts.items()}


def _per_source(df: DataFrame, values: dict, schema: str) -> DataFrame:
    """Join values known per source; they are as many as the sources, whose number is bounded."""
    table = df.sparkSession.createDataFrame([(s, *v) for s, v in values.items()], f"_source string, {schema}")
    return df.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), limit: float = 3.0, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sized = store(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("_drawn"),
        )
    )
    found = sized.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; weights per source are kept on the driver")
    total = {r["source"]: r["s"] for r in found}
    due = targets(total, weights, limit)
    share = {s: due[s] / total[s] if total[s] else 0.0 for s in total}
    blocks = _blocks({r["source"]: r["n"] for r in found})
    rows = {s: (total[s], due[s], int(share[s] + 1e-9), max(0.0, share[s] - int(share[s] + 1e-9)), blocks[s]) for s in total}
    planned = _per_source(sized, rows, "source_size long, target double, whole int, part double, _blocks long")
    state = _STATE.format(id=dict(docs.dtypes)["doc_id"])
    open_rows = planned.select(
        "doc_id", "source", "size",
        (F.shiftrightunsigned("_drawn", 11) / F.lit(2.0**53)).alias("u"),
        F.when(F.col("part") < 1e-9, 0.0).otherwise(F.col("part")).alias("p"),
        F.pmod("_drawn", "_blocks").alias("_block"),
    )
    settled: list[DataFrame] = []
    while True:
        land = all(b <= 1 for b in blocks.values())
        flown = store(open_rows.groupBy("source", "_block").applyInArrow(_flight(land), state))
        if land:
            settled.append(flown)
            break
        still = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(flown.filter(~still))
        blocks = _blocks({s: 2 * b for s, b in blocks.items()})
        open_rows = _per_source(flown.filter(still), {s: (b,) for s, b in blocks.items()}, "_blocks long").select(
            "doc_id", "source", "size", "u", "p", F.pmod(F.xxhash64("u"), "_blocks").alias("_block")
        )
    chosen = settled[0]
    for more in settled[1:]:
        chosen = chosen.unionByName(more)
    facts = {s: (total[s], due[s], r[2]) for s, r in rows.items()}
    copies = (F.col("whole") + F.col("p")).cast("int")
    return _per_source(chosen, facts, "source_size long, target double, whole int").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def repeated(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it, with its columns.
    A doc_id must be unique here."""
    taken = mix.filter("copies > 0").select(F.col("doc_id").alias("_id"), F.col("copies").alias("_copies"))
    packed = docs.select(F.struct("*").alias("_row")).join(taken, F.col("_row.doc_id") == F.col("_id"))
    return packed.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")

