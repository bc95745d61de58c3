"""Language identification on held-out texts, and its parts against plain Python."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from skyloom.llm import language_id, text
from skyloom.llm.language_id import calibrate, character_ngrams, document_counts, fit_languages, follow_leader, softmax, with_language

from .conftest import frame, words_of

COMMON = {
    "en": "the of and to in is that it for was on are with his they at this from have not but what all were when we there".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus über".split(),
    "fr": "de la le et les des en un une du que est pour dans qui par sur avec ne pas plus être été où aux cette".split(),
    "xx": "ねこ いぬ とり さかな うま しか くま きつね たぬき さる".split(),
}


def sentence(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(COMMON[lang]) if r.random() < 0.7 else "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, sentence(lang, k, 5 + k % 60), lang) for k, lang in enumerate(list(COMMON) * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(corpus):
    return fit_languages(corpus.filter("doc_id % 3 != 0"))


def test_held_out_languages_are_found(corpus, model):
    held = with_language(corpus.filter("doc_id % 3 = 0"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(1 / len(model.languages) <= r["score"] <= 1 for r in held)
    assert model.languages == sorted(COMMON) and 0 < np.mean(model.weight == 0) < 1  # the L1 penalty leaves zeros


def test_hard_cases(spark, corpus, model, hard, empty):
    got = with_language(hard, model)
    assert [c for c in got.columns if c not in ("lang_pred", "score")] == [c for c in hard.columns if c != "score"]
    for r in got.collect():
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und" and r["score"] == 0) if blank else (r["lang_pred"] in COMMON and 0 < r["score"] <= 1)
    assert with_language(empty, model).count() == 0
    odd = spark.createDataFrame([(1, "123 $$ 4"), (2, "é"), (3, "Ǝ" * 4), (4, "x" * 3_000_000)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in with_language(odd, model, keep=False).collect()}
    assert found[1]["lang_pred"] == "und" and all(found[k]["lang_pred"] in COMMON for k in (2, 3, 4))


def test_one_language_none_and_nulls(spark, empty):
    assert fit_languages(empty) is None
    assert fit_languages(spark.createDataFrame([(1, "a b", None), (2, "123", "en"), (3, None, "en")], "doc_id long, text string, lang string")) is None
    texts = frame(spark, [(1, "one two"), (2, "1")])
    assert [(r["lang_pred"], r["score"]) for r in with_language(texts, None).collect()] == [("und", 0.0)] * 2
    alone = fit_languages(spark.createDataFrame([(None, "ein Wort", "de"), (1, "zwei", "de"), (1, "zwei", "de")], "doc_id long, text string, lang string"))
    assert [(r["lang_pred"], r["score"]) for r in with_language(texts, alone).orderBy("doc_id").collect()] == [("de", 1.0), ("und", 0.0)]


def test_sample_is_even_and_bounded(spark, corpus, model):
    many = corpus.unionByName(corpus).filter("lang != 'xx' OR doc_id < 40")
    drawn = language_id._sample(many, ["de", "en", "fr", "xx"], 80).collect()
    assert len(set(drawn)) == len(drawn)
    assert collections.Counter(r["lang"] for r in drawn) == {"de": 20, "en": 20, "fr": 20, "xx": 10}


def grams(t):
    """n-grams of a text as strings, the words lower-cased and closed by blanks."""
    closed = [f" {w} " for w in words_of(t.translate({c: c + 32 for c in range(65, 91)}))]
    return collections.Counter((n, w[k : k + n]) for w in closed for n in language_id.SIZES for k in range(len(w) - n + 1))


def test_ngrams_match_plain_python(monkeypatch):
    texts = ["Das ist schön, ÄÖ schön", "x", "", None, "ねこ いぬ ねこ", "a😀b " * 40]
    for block in (1 << 20, 37):
        monkeypatch.setattr(language_id, "_BLOCK", block)
        words = text.words_of(pa.array(texts), lower=True)
        for t, (bucket, times) in zip(texts, document_counts(words), strict=True):
            got = collections.Counter()
            for b, k in zip(bucket.tolist(), times.tolist(), strict=True):
                got[b] += k
            assert sorted(got.values()) == sorted(grams(t or "").values())
        found = [b for part in character_ngrams(words, np.arange(len(words.starts))) for b in part[0].tolist()]
        assert len(found) == sum(sum(grams(t or "").values()) for t in texts)
        assert len(set(found)) == len({g for t in texts for g in grams(t or "")})


def test_scores_match_one_document_at_a_time(model):
    texts = [sentence(lang, 900 + k, 3 + 40 * k) for k, lang in enumerate(COMMON)] + ["", None, "Der " * 5]
    slab = model.probabilities(text.words_of(pa.array(texts), lower=True))
    for row, (bucket, times) in zip(slab, document_counts(text.words_of(pa.array(texts), lower=True)), strict=True):
        at, x = model.space.values(bucket, times)
        assert np.allclose(row, softmax((x @ model.weight[at] + model.bias) / model.temperature))


def test_frequencies_cover_every_text(spark, corpus):
    space = language_id.fit_space(corpus.repartition(5))
    texts = [r["text"] for r in corpus.collect()]
    held = [set(b.tolist()) for b, _ in document_counts(text.words_of(pa.array(texts), lower=True))]
    n = collections.Counter(b for d in held for b in d)
    want = {b: math.log((1 + len(texts)) / (1 + c)) + 1 for b, c in n.items() if c >= language_id.LEAST_DOCUMENTS}
    assert set(np.flatnonzero(space.keep >= 0).tolist()) == set(want)
    assert all(abs(space.idf[space.keep[b]] - v) < 1e-12 for b, v in want.items())


def test_leader_matches_a_plain_loop():
    r = np.random.default_rng(1)
    y = r.integers(0, 3, 30)
    examples = [(np.sort(r.choice(12, 4, replace=False)), r.random(4) + 0.5 * (y[k] == 1)) for k in range(30)]
    weight, bias = follow_leader(examples, y, 3, 12)
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def lead(key, l1, l2):
        if abs(z[key]) <= l1:
            return 0.0
        return -(z[key] - math.copysign(l1, z[key])) / ((language_id.BETA + math.sqrt(n[key])) / language_id.ALPHA + l2)

    order = np.random.default_rng(11)
    for _ in range(language_id.EPOCHS):
        for k in order.permutation(30):
            at, x = examples[k]
            w = {(f, c): lead((f, c), language_id.L1, language_id.L2) for f in at for c in range(3)}
            b = {c: lead(("b", c), 0, 0) for c in range(3)}
            p = softmax(np.array([sum(x[i] * w[f, c] for i, f in enumerate(at)) + b[c] for c in range(3)]))
            for c in range(3):
                error = p[c] - (y[k] == c)
                for key, now, g in [*(((f, c), w[f, c], x[i] * error) for i, f in enumerate(at)), (("b", c), b[c], error)]:
                    z[key] += g - (math.sqrt(n[key] + g * g) - math.sqrt(n[key])) / language_id.ALPHA * now
                    n[key] += g * g
    assert np.allclose(weight, [[lead((f, c), language_id.L1, language_id.L2) for c in range(3)] for f in range(12)])
    assert np.allclose(bias, [lead(("b", c), 0, 0) for c in range(3)])


def test_temperature_is_the_best_of_a_grid():
    r = np.random.default_rng(0)
    logits = r.normal(0, 4, (500, 3))
    y = np.array([r.choice(3, p=p) for p in softmax(logits / 2.5)])
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(500), y]).mean()
    found = calibrate(logits, y)
    assert abs(found - 2.5) < 0.6 and loss(found) <= min(loss(t) for t in np.linspace(0.2, 9, 100)) + 1e-6
    assert calibrate(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0
