"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the n-grams of ``SIZES`` characters of a text's words, A-Z lower-cased and closed at both
ends by a blank, hashed to ``BUCKETS``. Document frequencies are counted over all texts to learn from;
the ``FEATURES`` most frequent buckets stay. A feature's value is its share of the text's n-grams times
its inverse document frequency. Weights come from follow-the-regularised-leader with an L1 and an L2
penalty, one example at a time, on a bounded sample with as many rows of each language; a part of the
sample kept aside then sets the temperature that divides the logits.

As a score is a sum over words, each distinct word of a slab is looked up once, and texts of any length
are read whole, in blocks.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and teach nothing; rows
with a null language teach nothing; rows that share doc_id and language teach once, by their least text,
as far as the sample goes; with one learned language every text with a letter gets it, with none all are
``und`` with score 0; a text without a known n-gram gets the language the model holds likeliest
beforehand; ties go to the language that sorts first; an empty table gives an empty result; repeated rows
are judged each; columns named lang_pred or score are replaced, other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skyloom.llm.text import LARGE_SLAB_BYTES, Words, mix, powers, slabs, word_hashes, words_of
from skyloom.session import cut_lineage, store

#: Rows a model is fitted on, at most, shared evenly by the languages; the least by hash are taken.
SAMPLE_ROWS = 8_000
#: Languages a model can tell apart; beyond that the most frequent are learned.
LANGUAGES = 256
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 18
FEATURES = 1 << 15
LEAST_DOCUMENTS = 3
UNDETERMINED = "und"
#: Learning rate, its delay, the two penalties, rounds over the sample, and a feature's usual size.
ALPHA, BETA, L1, L2, EPOCHS, UNIT = 0.3, 1.0, 0.02, 0.02, 3, 20.0
#: Every so many rows of the sample are kept aside to calibrate.
_ASIDE = 5
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def character_ngrams(words: Words, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket of every n-gram of the chosen words, and the number of the word it is from, in blocks of
    bounded size whatever the words are."""
    size = (words.ends - words.starts)[chosen] + 2
    bounds = np.concatenate([[0], np.cumsum(size)])
    power, _ = powers(16, _BASE)
    for a in range(0, int(bounds[-1]), _BLOCK):
        b = min(a + _BLOCK, int(bounds[-1]))
        place = np.arange(a, min(b + 4 * max(SIZES), int(bounds[-1])))  # n-grams begin before b
        owner = np.searchsorted(bounds, place, side="right") - 1
        inside = place - bounds[owner] - 1
        letters = np.full(len(place), 0x20, dtype=np.uint8)
        real = (inside >= 0) & (inside < (size - 2)[owner])
        letters[real] = words.data[(words.starts[chosen][owner] + inside)[real]]
        lead = np.flatnonzero((letters & 0xC0) != 0x80)  # first byte of each character
        if not len(lead):
            continue
        byte = np.arange(len(letters)) - np.repeat(np.concatenate([[0], lead]), np.diff(np.concatenate([[0], lead, [len(letters)]])))
        character = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * power[np.minimum(byte, 7)], lead)
        owner = owner[lead]
        first = place[lead] < b
        for n in SIZES:
            at = np.arange(max(0, len(lead) - n + 1))
            at = at[first[at] & (owner[at] == owner[at + n - 1])]
            code = sum(mix(character[at + k]) * power[k] for k in range(n)) + np.uint64(n)
            yield (mix(code) % np.uint64(BUCKETS)).astype(np.int64), owner[at]


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct word of the slab, and the distinct word of each place."""
    _, first, which = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    return first, which


def document_counts(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and how often each comes, for every document of a slab; buckets may repeat."""
    first, which = distinct_words(words)
    found = list(character_ngrams(words, first))
    bucket = np.concatenate([b for b, _ in found]) if found else np.zeros(0, dtype=np.int64)
    owner = np.concatenate([o for _, o in found]) if found else np.zeros(0, dtype=np.int64)
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(first)))])
    for a, z in zip(words.first, words.first[1:], strict=False):
        own, times = np.unique(which[a:z], return_counts=True)
        n = starts[own + 1] - starts[own]
        shift = np.repeat(starts[own] - (np.cumsum(n) - n), n)
        yield bucket[np.arange(n.sum()) + shift], np.repeat(times, n)


@dataclass
class Space:
    keep: np.ndarray  # feature of each bucket, -1 for none
    idf: np.ndarray  # of each feature

    def values(self, bucket: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of a document and their values."""
        at = self.keep[bucket]
        total = np.bincount(at[at >= 0], times[at >= 0], len(self.idf))
        here = np.flatnonzero(total)
        return here, UNIT * self.idf[here] * total[here] / max(1.0, total.sum())


@dataclass
class LanguageModel:
    languages: list[str]
    space: Space
    weight: np.ndarray  # [feature, language]
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, words: Words) -> np.ndarray:
        """[document, language] for a slab."""
        docs, first = len(words.first) - 1, np.zeros(0, dtype=np.int64)
        logits = np.tile(self.bias, (docs, 1))
        if len(words.starts):
            first, which = distinct_words(words)
            known, each = np.zeros(len(first)), np.zeros((len(self.languages), len(first)))
            value = UNIT * self.space.idf[:, None] * self.weight
            for bucket, owner in character_ngrams(words, first):
                at = self.space.keep[bucket]
                at, owner = at[at >= 0], owner[at >= 0]
                known += np.bincount(owner, minlength=len(first))
                for c in range(len(self.languages)):
                    each[c] += np.bincount(owner, value[at, c], len(first))
            doc = words.doc
            total = np.maximum(np.bincount(doc, known[which], docs), 1.0)
            for c in range(len(self.languages)):
                logits[:, c] += np.bincount(doc, each[c][which], docs) / total
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights [feature, class] and biases after ``EPOCHS`` rounds of follow-the-regularised-leader;
    what the L1 penalty outweighs is exactly zero. The bias carries no penalty."""
    z, n = np.zeros((features, classes)), np.zeros((features, classes))
    z0, n0 = np.zeros(classes), np.zeros(classes)

    def leader(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + l2), 0.0)

    def moved(z: np.ndarray, n: np.ndarray, w: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more = n + g * g
        return z + g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w, more

    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in order.permutation(len(y)):
            at, x = examples[k]
            zk, nk = z[at], n[at]
            w, bias = leader(zk, nk, L1, L2), leader(z0, n0, 0.0, 0.0)
            error = softmax(x @ w + bias)
            error[y[k]] -= 1
            z[at], n[at] = moved(zk, nk, w, x[:, None] * error)
            z0, n0 = moved(z0, n0, bias, error)
    return leader(z, n, L1, L2), leader(z0, n0, 0.0, 0.0)


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss, between 0.1 and 10; 1 without rows."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(log_t))[np.arange(len(y)), y], 1e-300)).mean()

    low, high, golden = np.log(0.1), np.log(10.0), (5**0.5 - 1) / 2
    for _ in range(60):  # the loss is convex in the inverse temperature, so it has one valley
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, features: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, biases and temperature."""
    aside = np.arange(len(y)) % _ASIDE == _ASIDE - 1
    weight, bias = follow_leader([e for e, a in zip(examples, aside, strict=True) if not a], y[~aside], classes, features)
    held = [x @ weight[at] + bias for (at, x), a in zip(examples, aside, strict=True) if a]
    return weight, bias, calibrate(np.array(held).reshape(-1, classes), y[aside])


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, docs = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in slabs(batches):
        for bucket, _ in document_counts(words_of(batch.column("text"), lower=True)):
            seen[bucket] += 1  # once, however often a bucket stands in the index
            docs += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], docs))], ["bucket", "n"])


def fit_space(texts: DataFrame) -> Space:
    """Features and their inverse document frequencies over all of ``texts`` (text)."""
    counted = store(texts.select("text").mapInArrow(_document_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "frequencies")
    docs = counted.filter("bucket < 0").select("n").first()
    used = counted.filter(f"bucket >= 0 AND n >= {LEAST_DOCUMENTS}")
    rows = used.orderBy(F.col("n").desc(), "bucket").limit(FEATURES).collect()
    keep = np.full(BUCKETS, -1, dtype=np.int32)
    keep[[r["bucket"] for r in rows]] = np.arange(len(rows))
    total = docs["n"] if docs else 0
    return Space(keep, np.array([np.log((1 + total) / (1 + r["n"])) + 1 for r in rows], dtype=float))


def _sample(marked: DataFrame, languages: list[str], rows: int) -> DataFrame:
    """At most ``rows`` of ``marked`` (doc_id, lang, text), spread evenly over the languages."""
    each = max(1, rows // len(languages))
    known = marked.filter(F.col("lang").isin(languages))
    spread = F.xxhash64("doc_id")
    ranked = known.select("doc_id", "lang").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(spread, "doc_id")))
    drawn = cut_lineage(ranked.filter(F.col("rank") <= each).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")))
    texts = known.join(F.broadcast(drawn), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")))
    return texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def _fit_sample(space: Space, languages: list[str]):
    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            found = [space.values(*c) for c in document_counts(words_of(batch.column("text"), lower=True))]
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(a) for a, _ in found])]).astype(np.int32))
            at, x = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(x))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("lang"), *lists], ["id", "lang", "at", "x"])

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            sizes = batch.column("at").offsets.to_numpy()
            at, x = batch.column("at").values.to_numpy(), batch.column("x").values.to_numpy()
            spans = zip(sizes, sizes[1:], strict=False)
            rows += [(i or "", c, at[a:b].copy(), x[a:b].copy()) for i, c, (a, b) in zip(batch.column("id").to_pylist(), batch.column("lang").to_pylist(), spans, strict=True)]
        rows.sort(key=lambda r: (r[0], r[1]))
        order = np.random.default_rng(5).permutation(len(rows))  # what is kept aside has nothing to do with the id
        y = np.array([languages.index(rows[k][1]) for k in order], dtype=np.int64)
        weight, bias, temperature = fit([rows[k][2:] for k in order], y, len(languages), len(space.idf))
        used = np.flatnonzero(np.abs(weight).sum(axis=1))
        number = np.concatenate([used, [-1, -2]])
        table = np.concatenate([weight[used], [bias], np.full((1, len(languages)), temperature)])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(number) + 1, dtype=np.int32) * len(languages)), pa.array(table.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(number), lists], ["feature", "weight"])

    return examples, one


def fit_languages(docs: DataFrame, rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Fit on ``docs`` (doc_id, lang, text). Frequencies come from all of them, weights from at most
    ``rows``, which are brought together in one task; its size has that bound. None without languages."""
    marked = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    frequent = marked.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in frequent)
    if not languages:
        return None
    space = fit_space(marked)
    examples, one = _fit_sample(space, languages)
    pairs = _sample(marked, languages, rows).mapInArrow(examples, "id string, lang string, at array<int>, x array<double>")
    weight, bias, temperature = np.zeros((len(space.idf), len(languages))), np.zeros(len(languages)), 1.0
    for row in pairs.repartition(1).mapInArrow(one, "feature long, weight array<double>").collect():  # at most FEATURES + 2 rows
        if row["feature"] >= 0:
            weight[row["feature"]] = row["weight"]
        elif row["feature"] == -1:
            bias = np.array(row["weight"])
        else:
            temperature = row["weight"][0]
    return LanguageModel(languages, space, weight, bias, temperature)


def with_language(docs: DataFrame, model: LanguageModel | None, keep: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; with ``keep`` off only doc_id goes with them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")] if keep else ["doc_id"]
    needed = docs.select(F.struct(*columns).alias("row"), "text", has_letter(F.col("text")).alias("letters"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slabs(batches, LARGE_SLAB_BYTES):
            name, score = np.full(batch.num_rows, UNDETERMINED, dtype=object), np.zeros(batch.num_rows)
            letters = np.asarray(batch.column("letters").to_numpy(zero_copy_only=False), dtype=bool)
            if own is not None and letters.any():
                likely = own.probabilities(words_of(batch.column("text"), lower=True))
                which = likely.argmax(axis=1)
                name = np.where(letters, np.array(own.languages, dtype=object)[which], name)
                score = np.where(letters, likely[np.arange(len(which)), which], score)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(name, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    schema = T.StructType([needed.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return needed.mapInArrow(judge, schema).select("row.*", "lang_pred", "score")
