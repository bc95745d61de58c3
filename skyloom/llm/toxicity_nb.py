"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the n-grams of ``SIZES`` bytes of its words, lower-cased and closed at both
ends by a blank, present or not, hashed to ``BUCKETS``. From a bounded sample of labelled rows each
feature gets the log ratio of its smoothed frequencies in the two classes; the ``FEATURES`` that
tell most are kept, and a logistic regression is fitted to them, each scaled by its ratio. Word by
word the n-grams are looked up once per distinct word of a slab.

Defined cases: null and empty texts have no features and get the model's prior; documents with
contradicting labels, a null id or a null label teach nothing; without both labels every score is
the share of label 1 (0 if there are none); an empty table gives an empty result; repeated rows are
scored each; other columns are ignored.
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
from skyloom.llm.text import LARGE_SLAB_BYTES, Words, mix, powers, slabs, word_hashes, words_of

#: Labelled rows of each class a model is fitted on, at most; the least by hash are taken.
SAMPLE_ROWS = 6_000
SIZES = (3, 4, 5)
BUCKETS = 1 << 20
FEATURES = 1 << 12
#: Standard errors by which a feature's frequencies must differ; there are a million candidates.
SURE = 5.0
_STEPS, _L2 = 200, 1e-3
_BASE = 0x9E3779B97F4A7C15


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct word of the slab, and the distinct word of each place."""
    _, first, which = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    return first, which


def ngrams(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the chosen words, and the number of the word it is from."""
    size = (words.ends - words.starts)[chosen] + 2
    bounds = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(chosen)), size)
    inside = np.arange(bounds[-1]) - bounds[owner] - 1
    letters = np.full(bounds[-1], 0x20, dtype=np.uint8)
    real = (inside >= 0) & (inside < (size - 2)[owner])
    letters[real] = words.data[(words.starts[chosen][owner] + inside)[real]]
    power, _ = powers(max(SIZES), _BASE)
    buckets, owners = [], []
    for n in SIZES:
        at = np.arange(max(0, len(letters) - n + 1))
        at = at[owner[at] == owner[at + n - 1]]
        code = sum((letters[at + k].astype(np.uint64) + np.uint64(1)) * power[k] for k in range(n)) + np.uint64(n)
        buckets.append((mix(code) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def features(words: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of a slab, sorted. ``keep`` maps buckets to features, -1
    for none; without it features are buckets."""
    if not len(words.starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first, which = distinct_words(words)
    bucket, owner = ngrams(words, first)
    if keep is not None:
        bucket = keep[bucket]
        bucket, owner = bucket[bucket >= 0], owner[bucket >= 0]
    order = np.argsort(owner, kind="stable")
    bucket, per_word = bucket[order], np.bincount(owner, minlength=len(first))
    starts = np.concatenate([[0], np.cumsum(per_word)])
    doc = words.doc
    # a word counts once in a document
    pair = np.unique(doc * len(first) + which)
    doc, which = pair // len(first), pair % len(first)
    n = per_word[which]
    shift = np.repeat(starts[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    found = bucket[np.arange(n.sum()) + shift]
    pairs = np.unique(np.repeat(doc, n) * BUCKETS + found)
    return pairs // BUCKETS, pairs % BUCKETS


@dataclass
class Linear:
    keep: np.ndarray  # feature of each bucket, -1 for none
    weight: np.ndarray  # of each feature
    bias: float

    def scores(self, words: Words) -> np.ndarray:
        docs = len(words.first) - 1
        doc, feature = features(words, self.keep)
        total = self.bias + np.bincount(doc, self.weight[feature], docs)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(doc: np.ndarray, bucket: np.ndarray, y: np.ndarray, share: float) -> Linear:
    """Fit to (document, bucket) pairs and labels; ``share`` of label 1 sets the prior."""
    none = np.full(BUCKETS, -1, dtype=np.int32)
    if not 0 < y.sum() < len(y):
        return Linear(none, np.zeros(1), float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0 * (2 * share - 1))
    counts = [np.bincount(bucket[y[doc] == c], minlength=BUCKETS).astype(float) + 1 for c in (0, 1)]
    rows = [float((y == c).sum()) + 2 for c in (0, 1)]
    shares = [c / r for c, r in zip(counts, rows, strict=True)]
    ratio = np.log(shares[1] / shares[0])
    # how far the two frequencies are apart in standard errors
    pooled = (counts[0] + counts[1]) / sum(rows)
    apart = np.abs(shares[1] - shares[0]) / np.sqrt(pooled * (1 - np.minimum(pooled, 0.999)) * (1 / rows[0] + 1 / rows[1]))
    chosen = np.argsort(-apart, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[apart[chosen] > SURE])
    none[chosen] = np.arange(len(chosen))
    at = none[bucket]
    row, col, scale = doc[at >= 0], at[at >= 0], ratio[chosen]
    w, bias = np.zeros(len(chosen)), 0.0
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    moment, square, moved, turned = np.zeros(len(chosen)), np.zeros(len(chosen)), 0.0, 0.0
    for step in range(1, _STEPS + 1):  # Adam on the class-balanced logistic loss; the prior goes to the bias
        margin = bias + np.bincount(row, (w * scale)[col], len(y))
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * each
        g = np.bincount(col, error[row], len(chosen)) * scale + _L2 * w / len(chosen)
        moment, square = 0.9 * moment + 0.1 * g, 0.99 * square + 0.01 * g * g
        moved, turned = 0.9 * moved + 0.1 * error.sum(), 0.99 * turned + 0.01 * error.sum() ** 2
        fade = 0.05 / (1 + step / 100)
        w -= fade * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        bias -= fade * (moved / (1 - 0.9**step)) / (np.sqrt(turned / (1 - 0.99**step)) + 1e-9)
    return Linear(none, w * scale, bias + float(np.log(share / (1 - share))))


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slabs(batches, LARGE_SLAB_BYTES):
        doc, bucket = features(words_of(batch.column("text"), lower=True))
        bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
        held = pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), held], ["toxic", "buckets"])


def _fit_sample(share: float):
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, sizes, buckets = [np.zeros(0)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
        for batch in batches:
            labels.append(batch.column(0).to_numpy().astype(float))
            sizes.append(np.diff(batch.column(1).offsets.to_numpy()).astype(np.int64))
            buckets.append(batch.column(1).flatten().to_numpy())
        size = np.concatenate(sizes)
        model = fit(np.repeat(np.arange(len(size)), size), np.concatenate(buckets), np.concatenate(labels), share)
        at = np.flatnonzero(model.keep >= 0)
        weight = model.weight[model.keep[at]]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(weight, model.bias))], ["bucket", "weight"])

    return one


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Linear:
    """Fit on at most ``rows`` documents of each class that ``labels`` (doc_id, toxic) marks. The
    sample is brought together in one task, whose size its bound sets."""
    drawn = [sample_labels(labels.filter(F.col("toxic") == c), "toxic", rows) for c in (0, 1)]
    n = [d.count() for d in drawn]
    marked = labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    both = F.broadcast(drawn[0].unionByName(drawn[1]).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")))
    texts = docs.select("doc_id", "text").join(both, F.col("doc_id") == F.col("_id")).select("text", "toxic")
    pairs = texts.mapInArrow(_pairs_of, "toxic int, buckets array<int>")
    share = float(marked or 0.0) if min(n) else float(n[1] > 0)
    keep, weight, bias = np.full(BUCKETS, -1, dtype=np.int32), [0.0], 0.0
    for row in pairs.repartition(1).mapInArrow(_fit_sample(share), "bucket long, weight double").collect():
        if row["bucket"] < 0:
            bias = row["weight"]
        else:
            keep[row["bucket"]] = len(weight)
            weight.append(row["weight"])
    return Linear(keep, np.array(weight), bias)


def with_toxicity(docs: DataFrame, model: Linear, keep: bool = True) -> DataFrame:
    """``docs`` with a double ``_score`` in front, in place of any it had; with ``keep`` off only doc_id
    goes with it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != "_score"] if keep else ["doc_id"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, LARGE_SLAB_BYTES):
            scores = shared.value.scores(words_of(batch.column("text"), lower=True))
            yield pa.RecordBatch.from_arrays([pa.array(scores), *(batch.column(c) for c in columns)], ["_score", *columns])

    needed = docs.select(*dict.fromkeys([*columns, "text"]))
    schema = T.StructType([T.StructField("_score", T.DoubleType()), *(docs.schema[c] for c in columns)])
    return needed.mapInArrow(score, schema)
