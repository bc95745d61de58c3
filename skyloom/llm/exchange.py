"""Shuffling of (hash, document) pairs as packed arrays.

A task sends one row per slab and part, holding all pairs of that part as binary arrays, so a pair
costs its bytes and no row. Parts are dealt by ``repartitionById``, so each task gets one even part;
they are as many as the session's shuffle partitions, or more where the texts ask for it, so that a part
stays of one size whatever the corpus. Arrays of more than ``MOST`` values are split, since a binary
column counts its bytes in 32 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import fan_out

#: kind 0: pairs to be judged; 1: pairs already decided, passed on; 2: hashes known to be shared.
PACKED = "part int, kind int, hashes binary, checks binary, docs binary"
PAIRS, DECIDED, SHARED = 0, 1, 2
ANSWERS = "doc_id long, hashes binary"


#: Values of 8 bytes in one binary column, at most.
MOST = (1 << 28) - 1
#: Bytes of text whose pairs one part holds, some 5 million.
PART_BYTES = 64 << 20


def parts_for(texts: DataFrame) -> int:
    """Number of parts for the pairs of ``texts`` (text)."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(fan_out(texts.sparkSession), -(-size // PART_BYTES))


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of an array of 8-byte values as a binary column."""
    if len(bounds) > 1 and bounds[-1] - bounds[0] > MOST:
        raise OverflowError(f"over {MOST} values for one binary column")
    data = np.ascontiguousarray(values[bounds[0] : bounds[-1]])
    offsets = ((np.asarray(bounds) - bounds[0]) * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _within(edges: np.ndarray) -> Iterator[slice]:
    """Runs of rows, given by the edges of their values, of at most ``MOST`` values each."""
    a = 0
    while a < len(edges) - 1:
        z = max(int(np.searchsorted(edges, edges[a] + MOST, side="right")) - 1, a + 1)
        yield slice(a, z)
        a = z


def packed(kind: int, parts: int, part: np.ndarray, hashes: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per part that has pairs, or several where a part has more than a row can hold; pairs keep
    their order within it."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(bounds))
    starts = [np.arange(bounds[p], bounds[p + 1], MOST) for p in full]
    owner = np.repeat(full, [len(x) for x in starts])
    edges = np.concatenate([*starts, [len(part)]]).astype(np.int64)
    for rows in _within(edges):
        own = edges[rows.start : rows.stop + 1]
        count = rows.stop - rows.start
        columns = [
            pa.array(owner[rows].astype(np.int32)),
            pa.array(np.full(count, kind, dtype=np.int32)),
            binaries(hashes[order], own),
            binaries(np.zeros(0, np.uint64), np.zeros(count + 1, dtype=np.int64)) if checks is None else binaries(checks[order], own),
            binaries(docs[order], own),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["part", "kind", "hashes", "checks", "docs"])


def joined(column: pa.Array, kind: type) -> np.ndarray:
    """All values of a binary column as one array."""
    column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]].view(kind) if data is not None and len(column) else np.zeros(0, kind)


def answers(docs: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs as one row per document."""
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.diff(docs, prepend=docs[:1] - 1)) if len(docs) else np.zeros(0, dtype=np.int64)
    edges = np.append(first, len(docs))
    for rows in _within(edges):
        own = edges[rows.start : rows.stop + 1]
        yield pa.RecordBatch.from_arrays([pa.array(docs[first[rows]]), binaries(hashes[order], own)], ["doc_id", "hashes"])


def judged(sent: DataFrame, parts: int, judge: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Bring the pairs of a part together and keep those that ``judge`` (hashes, checks, docs and
    hashes known to be shared, to a mask) picks, with the decided ones: ``ANSWERS``, one row per
    document. The picked pairs travel packed by their document's part, as the decided ones do."""

    def one_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        shared = [np.zeros(0, np.uint64)]
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            for k in np.unique(kind):
                rows = batch.filter(pa.array(kind == k))
                if k == DECIDED:
                    yield rows
                    continue
                h, c, d = (joined(rows.column(n), t) for n, t in (("hashes", np.uint64), ("checks", np.uint64), ("docs", np.int64)))
                if k == SHARED:
                    shared.append(h.copy())
                else:
                    held.append((h.copy(), c.copy(), d.copy()))
        if held:
            h, c, d = (np.concatenate(x) for x in zip(*held, strict=True))
            mask = judge(h, c, d, np.unique(np.concatenate(shared)))
            yield from packed(DECIDED, parts, d[mask] % parts, h[mask], d[mask])

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            docs.append(joined(batch.column("docs"), np.int64).copy())
            hashes.append(joined(batch.column("hashes"), np.uint64).copy())
        yield from answers(np.concatenate(docs), np.concatenate(hashes))

    picked = sent.repartitionById(parts, "part").mapInArrow(one_part, PACKED)
    return picked.repartitionById(parts, "part").mapInArrow(by_document, ANSWERS)
