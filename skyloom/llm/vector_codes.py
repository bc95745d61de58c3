"""Vector code compression: product codes whose nearest entries are found through GNATs.

Vectors become integers, ``floor(SCALE * x)``, and are cut into ``PARTS`` equal parts. Each part has a
codebook, started from the vectors of the smallest ids and moved to the mean of its members in
``ROUNDS`` rounds. Sums are made per task, so one row per task, part and entry is shuffled; codebooks
are all that reaches the driver.

A codebook is searched through a GNAT. A node takes up to ``SPLITS`` of its entries as split points and
gives every other entry to the nearest of them. For each pair of a split point and a child, the least
and greatest distance between that point and the child's entries are kept, rounded outwards. A query's
distance to a split point, itself an interval, rules a child out where even the nearest entry its range
allows lies strictly beyond the best one found. Entries at equal distance thus always stay, and are told
apart by integer squared distances and their index. Queries walk down together as arrays.

Defined cases: vectors that are null or hold a null or non-finite component are dropped; the width is
that of the first kept vector (by id, then components) whose length is a positive multiple of ``PARTS``,
and vectors of any other length get a null code and error and teach nothing; rows with a null id are
coded and teach, but start no entry; repeated rows count each; with fewer than ``ENTRIES`` ids codebooks
are smaller, with none all codes are null; an empty table gives an empty result; a component of ``REACH``
or more in size after scaling raises ``ValueError``, as its squares would leave 64 bits; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import join_totals
from skyloom.session import store

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Split points of a node; nodes of this many entries or fewer have no children.
SPLITS = 8
REACH = 1 << 26
_ROWS = 1 << 14


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to one entry."""
    apart = points - entry
    return np.einsum("ij,ij->i", apart, apart)


def _root_down(square: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.sqrt(square.astype(np.float64)), -np.inf) * (1 - 1e-15), 0)


def _root_up(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square.astype(np.float64)), np.inf) * (1 + 1e-15)


@dataclass
class Node:
    splits: np.ndarray  # entries that are split points
    least: np.ndarray | None = None  # [split point, child]: least distance, rounded down
    greatest: np.ndarray | None = None  # and greatest, rounded up
    children: list[Node | None] = field(default_factory=list)


def build_gnat(entries: np.ndarray, at: np.ndarray | None = None) -> Node:
    """GNAT over ``entries`` (integers, one row each), of those numbered ``at``. Split points are
    taken far apart, each the farthest from those before it."""
    at = np.arange(len(entries)) if at is None else at
    if len(at) <= SPLITS:
        return Node(at)
    chosen, near = [0], squared(entries[at], entries[at[0]])
    while len(chosen) < SPLITS:
        far = int(np.argmax(near))
        if not near[far]:
            break  # all that is left equals a split point
        chosen.append(far)
        near = np.minimum(near, squared(entries[at], entries[at[far]]))
    to = np.stack([squared(entries[at], entries[at[c]]) for c in chosen])
    if len(chosen) < 2:
        return Node(at)  # equal entries: nothing tells them apart but their index
    owner = np.argmin(to, axis=0)
    rest = np.ones(len(at), dtype=bool)
    rest[chosen] = False
    groups = [np.flatnonzero((owner == c) & rest) for c in range(len(chosen))]
    least, greatest = np.full((2, len(chosen), len(chosen)), 0.0)
    for c, group in enumerate(groups):
        if len(group):
            least[:, c] = _root_down(to[:, group].min(axis=1))
            greatest[:, c] = _root_up(to[:, group].max(axis=1))
    children = [build_gnat(entries, at[g]) if len(g) else None for g in groups]
    return Node(at[chosen], least, greatest, children)


def nearest(gnat: Node, entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each point, the lowest index among equals, its squared distance, and how many
    distances were worked out."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.full(len(points), len(entries))
    spent = 0

    def visit(node: Node, rows: np.ndarray) -> None:
        nonlocal spent
        alive = np.ones((len(rows), len(node.children)), dtype=bool)
        nearer = np.empty((len(rows), len(node.children)))
        for s, entry in enumerate(node.splits):
            spent += len(rows)
            to = squared(points[rows], entries[entry])
            better = (to < best[rows]) | ((to == best[rows]) & (entry < index[rows]))
            best[rows[better]], index[rows[better]] = to[better], entry
            if node.children:
                nearer[:, s] = to
        if not node.children:
            return
        low, high = _root_down(nearer), _root_up(nearer)
        order = np.argsort([-(c is not None and len(c.splits)) for c in node.children], kind="stable")
        bound = np.zeros_like(alive, dtype=np.float64)
        for c, child in enumerate(node.children):
            if child is not None:
                bound[:, c] = np.maximum(low - node.greatest[:, c], node.least[:, c] - high).max(axis=1)
        for c in order:
            if node.children[c] is not None:
                stay = bound[:, c] <= _root_up(best[rows])  # strictly beyond the best one goes
                if stay.any():
                    visit(node.children[c], rows[stay])

    if len(points) and len(entries):
        visit(gnat, np.arange(len(points)))
    return index, best, spent


def vectors_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector is kept, the bounds of these vectors, and all their scaled components."""
    column = batch.column("embedding")
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(owner[~np.isfinite(values)], minlength=len(sizes)) > 0
    bad |= column.is_null().to_numpy(zero_copy_only=False)
    scaled = np.floor(values[~bad[owner]] * SCALE)
    if len(scaled) and np.abs(scaled).max() >= REACH:
        raise ValueError(f"a component of {REACH // SCALE} or more in size cannot be coded")
    rows = np.flatnonzero(~bad)
    return rows, np.concatenate([[0], np.cumsum(sizes[rows])]), scaled.astype(np.int64)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        rows, bounds, values = vectors_of(batch)
        vector = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), vector], ["vec_id", "vector"])


def _of_width(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept rows, which of them have the width, and the vectors of these."""
    rows, bounds, values = vectors_of(batch)
    fits = np.diff(bounds) == width
    inside = np.repeat(fits, np.diff(bounds))
    return rows, fits, values[inside].reshape(fits.sum(), max(width, 0))


@dataclass
class Codebooks:
    entries: np.ndarray  # [part, entry, component]

    def __post_init__(self):
        self.trees = [build_gnat(e) for e in self.entries]

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part of each vector."""
        step = self.entries.shape[2]
        found = [nearest(t, e, vectors[:, p * step : (p + 1) * step])[:2] for p, (t, e) in enumerate(zip(self.trees, self.entries, strict=True))]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _start(vectors: DataFrame) -> Codebooks | None:
    kept = vectors.mapInArrow(_kept, "vec_id long, vector array<long>").filter(F.col("vec_id").isNotNull())
    usable = kept.filter((F.size("vector") > 0) & (F.size("vector") % PARTS == 0)).orderBy("vec_id", "vector")
    width = usable.select(F.size("vector")).first()
    if width is None:
        return None
    first = [r[0] for r in usable.filter(F.size("vector") == width[0]).limit(ENTRIES).select("vector").collect()]
    cut = np.array(first, dtype=np.int64).reshape(len(first), PARTS, -1)
    return Codebooks(np.ascontiguousarray(cut.transpose(1, 0, 2)))


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the mean of its members, rounded down; entries without any stay."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        parts, entries, step = own.entries.shape
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, step), dtype=np.int64)
        for batch in _small(batches):
            vectors = _of_width(batch, own.width)[2]
            if len(vectors):
                code = own.assign(vectors)[0]
                for p in range(parts):
                    np.add.at(count[p], code[:, p], 1)
                    np.add.at(total[p], code[:, p], vectors[:, p * step : (p + 1) * step])
        p, e = np.nonzero(count)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * step), pa.array(total[p, e].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), flat], ["part", "entry", "n", "total"])

    step = books.entries.shape[2]
    made = vectors.mapInArrow(sums, "part int, entry int, n long, total array<long>")
    wide = [F.sum(F.get("total", F.lit(k)).cast("decimal(38,0)")).alias(f"t{k}") for k in range(step)]
    entries = books.entries.copy()
    for row in made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():  # at most PARTS * ENTRIES rows
        entries[row["part"], row["entry"]] = [int(row[f"t{k}"]) // row["n"] for k in range(step)]
    return Codebooks(entries)


def fit_codebooks(vectors: DataFrame) -> Codebooks | None:
    """Codebooks over all of ``vectors`` (vec_id, embedding); none where no vector can be cut."""
    vectors = vectors.select("vec_id", "embedding")
    books = _start(vectors)
    for _ in range(ROUNDS if books else 0):
        books = _moved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, label, code and error of every vector that is not dropped."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in _small(batches):
            rows, fits, found = _of_width(batch, own.width if own else -1)  # no vector has that width
            code, error = np.full(len(rows), None, dtype=object), np.zeros(len(rows), dtype=np.int64)
            if len(found):
                entry, apart = own.assign(found)
                error[fits] = apart.sum(axis=1)
                joined = entry.astype(np.uint8).tobytes().hex()
                code[fits] = [joined[k : k + 2 * PARTS] for k in range(0, len(joined), 2 * PARTS)]
            held = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [held.column("vec_id"), held.column("label"), pa.array(code, pa.string()), pa.array(error, mask=~fits)],
                ["vec_id", "label", "code", "error"],
            )

    columns = vectors.select("vec_id", "label", "embedding")
    kinds = [f"{c} {columns.schema[c].dataType.simpleString()}" for c in ("vec_id", "label")]
    return columns.mapInArrow(coded, ", ".join([*kinds, "code string", "error long"]))


def compress_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept vector of ``vectors``
    (vec_id, embedding, label). Labels of any size: see ``join_totals``."""
    books = fit_codebooks(vectors)
    coded = store(encode(vectors, books), "codes")
    summed = join_totals(coded, "label", {"label_error": F.sum("error")})
    return summed.withColumn("codebooks_sha256", F.lit(books.digest if books else None).cast("string"))
