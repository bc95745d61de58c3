"""Substring dedup with difference-cover anchors.

A word goes if it lies in a window of ``WINDOW`` words whose sequence also starts in a document with
a smaller doc_id. Hashing every window of a corpus would move several times its size, so only
anchors are hashed first: runs of seven words that begin at positions whose remainder by 7 is in the
difference cover {0, 1, 3}. Every remainder is a difference of two members, so two equal windows of
13 words, wherever they stand, have a common offset below 7 at which both texts hold an anchor, and
it is the same anchor. Documents with an anchor that another document has too then extend it: they
hash the windows around their shared anchors, and the least doc_id of each window is found.

Hashes and documents travel as packed arrays, each slab sending a hash once however many documents
hold it. A text moves only if its document shares an anchor, and again if it loses a word. Windows of
different documents are told apart by 128 bits of hash; which windows of its own a document loses, it is
told by 64.

Defined cases: doc_id is an integer; a null text has no words; a row with a null doc_id keeps all
words and takes none from others; rows with one doc_id are one document; texts of fewer than
``WINDOW`` words lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.exchange import DECIDED, PACKED, PAIRS, SHARED, judged, packed, parts_for
from skyloom.llm.frames import sieve_of, sieved
from skyloom.llm.text import LARGE_SLAB_BYTES, Words, slabs, windows, word_hashes, words_of
from skyloom.session import store

WINDOW, PERIOD = 13, 7
COVER = (0, 1, 3)
#: The longest anchor that fits into a window at any offset below the period.
ANCHOR = WINDOW - PERIOD + 1


def anchors(hashes: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each anchor: runs at cover positions of their document."""
    at, h = windows(hashes, words.first, ANCHOR, salt=1)
    place = (at - words.first[words.doc[at]]) % PERIOD
    chosen = np.isin(place, COVER)
    return at[chosen], h[chosen]


def _distinct(hashes: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct (hash, check, document) triples, sorted in this order; without checks, pairs."""
    columns = (hashes, docs) if checks is None else (hashes, checks, docs)
    order = np.lexsort(columns[::-1])
    out = tuple(c[order] for c in columns)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in out])
    return tuple(c[new] for c in out)


def _by(values: np.ndarray, parts: int) -> np.ndarray:
    return (values % np.uint64(parts)).astype(np.int64)


def _send_anchors(parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, LARGE_SLAB_BYTES):
            words = words_of(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            at, h = anchors(word_hashes(words), words)
            h, d = _distinct(h, ids[words.doc[at]])
            if not len(h):
                continue
            edge = h[1:] == h[:-1]
            several = np.append(edge, False) | np.insert(edge, 0, False)
            alone = ~several
            order = np.argsort(d[alone], kind="stable")  # runs of one document compress well
            yield from packed(PAIRS, parts, _by(h[alone][order], parts), h[alone][order], d[alone][order])
            if several.any():
                yield from packed(DECIDED, parts, d[several] % parts, h[several], d[several])
                known = np.unique(h[several])
                yield from packed(SHARED, parts, _by(known, parts), known, np.zeros(len(known), np.int64))

    return send


def _in_several(h: np.ndarray, _: np.ndarray, d: np.ndarray, shared: np.ndarray) -> np.ndarray:
    order = np.argsort(h, kind="stable")
    hs, ds = h[order], d[order]
    start = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
    low, high = np.minimum.reduceat(ds, start), np.maximum.reduceat(ds, start)
    several = (low != high) | np.isin(hs[start], shared)
    out = np.empty(len(h), dtype=bool)
    out[order] = np.repeat(several, np.diff(np.append(start, len(h))))
    return out


def _answered(batch: pa.RecordBatch, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which hashes are in the answers (column hashes, a packed array) of their document."""
    lists = batch.column("hashes")
    mine = np.zeros(len(hashes), dtype=bool)
    bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    for row in range(batch.num_rows):
        a, b = bounds[row], bounds[row + 1]
        if a < b and lists[row].is_valid:
            mine[a:b] = np.isin(hashes[a:b], np.frombuffer(lists[row].as_buffer(), dtype=np.uint64))
    return mine


def _send_windows(parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, LARGE_SLAB_BYTES):
            words = words_of(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            hashes = word_hashes(words)
            at, h = anchors(hashes, words)
            at = at[_answered(batch, h, words.doc[at])]
            marks = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.add.at(marks, np.maximum(at - PERIOD + 1, 0), 1)
            np.add.at(marks, at + 1, -1)
            near = np.cumsum(marks)[:-1] > 0  # starts of windows that hold a shared anchor
            start, one = windows(hashes, words.first, WINDOW, salt=0)
            two = windows(hashes, words.first, WINDOW, salt=2)[1]
            chosen = near[start]
            one, two, d = _distinct(one[chosen], ids[words.doc[start[chosen]]], two[chosen])
            if not len(one):
                continue
            first = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
            order = np.argsort(d[first], kind="stable")
            h, k, c = one[first][order], d[first][order], two[first][order]
            yield from packed(PAIRS, parts, _by(h, parts), h, k, c)
            if not first.all():
                yield from packed(DECIDED, parts, d[~first] % parts, one[~first], d[~first])

    return send


def _not_least(h: np.ndarray, c: np.ndarray, d: np.ndarray, _: np.ndarray) -> np.ndarray:
    order = np.lexsort((c, h))
    hs, cs, ds = h[order], c[order], d[order]
    start = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])]))
    least = np.repeat(np.minimum.reduceat(ds, start), np.diff(np.append(start, len(h))))
    out = np.empty(len(h), dtype=bool)
    out[order] = ds > least
    return out


def _with_answers(docs: DataFrame, found: DataFrame, every: bool) -> DataFrame:
    """doc_id, text, hashes of the documents that have answers, or of every one. Only texts that
    the sieve of the answered ids lets through are shuffled."""
    marked = sieved(docs, sieve_of(found, F.xxhash64("doc_id")), F.xxhash64("doc_id"))
    moved = marked.filter("_maybe").drop("_maybe").join(found, "doc_id", "left" if every else "inner")
    if not every:
        return moved
    still = marked.filter(~F.col("_maybe")).drop("_maybe").withColumn("hashes", F.lit(None).cast("binary"))
    return still.unionByName(moved)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slabs(batches, LARGE_SLAB_BYTES):
        answers = batch.column("hashes")
        texts, n_words, n_removed = [], [], []
        for row, text in enumerate(batch.column("text")):
            kept = (text.as_py() or "").encode().split()
            n_words.append(len(kept))
            if len(kept) >= WINDOW and answers[row].is_valid:
                one = batch.slice(row, 1)
                words = words_of(one.column("text"))
                start, h = windows(word_hashes(words), words.first, WINDOW, salt=0)
                start = start[_answered(one, h, words.doc[start])]
                marks = np.zeros(len(kept) + 1, dtype=np.int64)
                np.add.at(marks, start, 1)
                np.add.at(marks, start + WINDOW, -1)
                kept = [w for w, gone in zip(kept, np.cumsum(marks)[:-1].tolist(), strict=True) if not gone]
            n_removed.append(n_words[-1] - len(kept))
            texts.append(b" ".join(kept).decode())
        columns = [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_words", "n_removed"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per document its doc_id, kept words joined by single spaces, n_words and n_removed."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = texts.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    parts = parts_for(known)
    shared = store(judged(known.mapInArrow(_send_anchors(parts), PACKED), parts, _in_several))
    extended = _with_answers(known, shared, every=False)
    removed = store(judged(extended.mapInArrow(_send_windows(parts), PACKED), parts, _not_least))
    return _with_answers(texts, removed, every=True).mapInArrow(_keep, "doc_id long, kept string, n_words long, n_removed long")
