"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the bytes of the whole text, read once by numpy in Arrow batches. Trees are
grown on binned statistics of a bounded sample of labelled rows (``SAMPLE_ROWS``) and flattened into
arrays: a batch walks all trees level by level without a loop over rows. No row is shuffled: the
sample's ids and the model have a fixed bound and go to the tasks.

Defined cases: null and empty texts have statistics of 0 and are scored; a document with
contradicting labels, a null id or a null label teaches nothing; without both labels every score is
the share of good labels (one half if there are none); an empty table gives an empty result;
repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.labels import sample_labels
from skyloom.llm.text import Words, mix, slabs, word_hashes, words_of

#: Labelled rows a model is fitted on, at most; the least by hash are taken.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.2
MIN_ROWS, L2 = 10, 1.0

_CLASSES = {
    "lower": [*range(0x61, 0x7B)],
    "upper": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)],
    "high": [*range(0x80, 0x100)],
    "stop": [0x21, 0x2C, 0x2E, 0x3A, 0x3B, 0x3F],
    "symbol": [b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in "!,.:;?'\"()-"],
    "newline": [0x0A],
}
STATISTICS = [
    "words", "bytes", *(f"share_{c}" for c in _CLASSES), "mean_word", "long_words", "short_words",
    "distinct", "repeats_next", "repeats_second", "distinct_lines", "line_words", "distinct_pairs", "top_word",
]


def _distinct_per_doc(hashes: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document, and the count of its most frequent one."""
    if not len(hashes):
        return np.zeros(docs), np.zeros(docs)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]))
    runs = np.diff(np.append(new, len(h)))
    most = np.zeros(docs)
    np.maximum.at(most, d[new], runs)
    return np.bincount(d[new], minlength=docs).astype(float), most


def statistics(words: Words) -> np.ndarray:
    """One row per document, one column per name in STATISTICS."""
    docs = len(words.first) - 1
    length = np.diff(words.bounds).astype(float)
    n = np.diff(words.first).astype(float)
    doc, size = words.doc, (words.ends - words.starts).astype(float)

    def per_doc(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return np.diff(sums[words.bounds]).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=docs)

    shares = []
    for members in _CLASSES.values():
        table = np.zeros(256, dtype=bool)
        table[members] = True
        shares.append(per_doc(table[words.data]))
    lines = shares[-1] + 1
    h = word_hashes(words)
    same = np.zeros(len(h)), np.zeros(len(h))
    for k in (1, 2):
        same[k - 1][k:] = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
    distinct, top = _distinct_per_doc(h, doc, docs)
    follows = np.flatnonzero(doc[1:] == doc[:-1])
    pairs, _ = _distinct_per_doc(mix(h[follows] + mix(h[follows + 1])), doc[follows], docs)
    newline = np.concatenate([[0], np.cumsum(words.data == 0x0A)])
    line = newline[words.starts] + doc  # a new document begins a new line too
    opens = np.flatnonzero(np.diff(line, prepend=-1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
    line_hash = mix(sums[np.append(opens[1:], len(h))] - sums[opens])
    distinct_lines, _ = _distinct_per_doc(line_hash, doc[opens], docs)
    written = np.bincount(doc[opens], minlength=docs)
    w, b = np.maximum(n, 1), np.maximum(length, 1)
    columns = [
        n, length, *(s / b for s in shares), per_word(size) / w, per_word(size > 12) / w, per_word(size < 3) / w,
        distinct / w, per_word(same[0]) / w, per_word(same[1]) / w, distinct_lines / np.maximum(written, 1),
        n / lines, pairs / np.maximum(n - 1, 1), top / w,
    ]
    return np.column_stack(columns)


@dataclass
class Forest:
    """Complete trees of one depth: test t of a tree has children 2t+1 and 2t+2, then the leaves."""

    feature: np.ndarray  # trees x tests
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[row, feature[at]] > threshold[at])
            total += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on logistic loss. Statistics are binned once at their quantiles; a level of a
    tree is one count of gradients per node, statistic and bin."""
    share = float(y.mean()) if len(y) else 0.5
    tests, leaves = 2**DEPTH - 1, 2**DEPTH
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0 * (2 * share - 1)
    if not len(y) or not 0 < share < 1:
        return Forest(np.zeros((0, tests), int), np.zeros((0, tests)), np.zeros((0, leaves)), start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)])
    width = x.shape[1]
    place = np.arange(width) * BINS
    total = np.full(len(y), start)
    forest = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(tests, dtype=np.int64), np.full(tests, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            key = ((node - first)[:, None] * (width * BINS) + place + binned).ravel()
            shape = (count, width, BINS)
            sums = [np.bincount(key, np.repeat(v, width), count * width * BINS).reshape(shape) for v in (g, h, np.ones(len(y)))]
            left = [np.cumsum(s, axis=2)[:, :, :-1] for s in sums]
            whole = [s.sum(axis=2, keepdims=True) for s in sums]
            right = [a - b for a, b in zip(whole, left, strict=True)]
            gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - whole[0] ** 2 / (whole[1] + L2)
            gain[(left[2] < MIN_ROWS) | (right[2] < MIN_ROWS)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best):
                f, at = divmod(int(b), BINS - 1)
                if gain[k, f, at] > 1e-9 and at < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][at]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - tests
        leaf = RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + L2)
        total += leaf[at]
        forest.append((feature, threshold, leaf))
    return Forest(*(np.array([t[k] for t in forest]) for k in range(3)), start)


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slabs(batches):
        x = statistics(words_of(batch.column("text")))
        rows = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on at most ``rows`` of the documents that ``labels`` (doc_id, quality) marks."""
    drawn = sample_labels(labels, "quality", rows)
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi")
    known = texts.mapInArrow(_statistics_of, f"doc_id {kind}, x array<double>").join(F.broadcast(drawn), "doc_id")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("x", "quality").collect()
    x = np.array([r["x"] for r in sample]).reshape(-1, len(STATISTICS))
    return fit(x, np.array([float(r["quality"]) for r in sample]))


def with_quality(docs: DataFrame, forest: Forest, keep: bool = True) -> DataFrame:
    """``docs`` with a double ``_score`` in front, in place of any it had; with ``keep`` off only doc_id
    goes with it."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    columns = [c for c in docs.columns if c != "_score"] if keep else ["doc_id"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            scores = shared.value.scores(statistics(words_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([pa.array(scores), *(batch.column(c) for c in columns)], ["_score", *columns])

    needed = docs.select(*dict.fromkeys([*columns, "text"]))
    schema = T.StructType([T.StructField("_score", T.DoubleType()), *(docs.schema[c] for c in columns)])
    return needed.mapInArrow(score, schema)
