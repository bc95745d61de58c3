"""Classifiers, rules, mixing, token counts and url rules against held-out labels or brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyloom.llm import cube_mix, labels, quality_trees, rule_lists, toxicity_nb, trie_tokens, url_cascade
from skyloom.llm.text import words_of as numpy_words

from .conftest import frame, prose, words_of


@pytest.fixture(scope="module")
def marked(spark):
    """Documents and labels: bad ones shout or repeat, toxic ones hold an insult."""
    r = random.Random(1)
    rows, marks = [], []
    for k in range(600):
        t, good, toxic = prose(k, r.randint(60, 200)), 1, 0
        if k % 4 == 0:
            t, good = (t.upper().replace(" ", "!! ") if k % 8 else " ".join(w + "###" for w in t.split())), 0
        if k % 5 == 0:
            w = t.split(" ")
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(["dolt", "nitwit"])
            t, toxic = " ".join(w), 1
        rows.append((k, t))
        marks.append((k, good, toxic))
    marks += [(0, 1, 1), (None, 1, 0), (7, None, None)]
    return frame(spark, rows).cache(), spark.createDataFrame(marks, "doc_id long, quality int, toxic int").cache()


def test_sample_labels_drop_contradictions(marked):
    drawn = labels.sample_labels(marked[1], "quality", 100_000)
    assert drawn.count() == 599 and drawn.filter("doc_id = 0").count() == 0
    assert labels.sample_labels(marked[1], "quality", 10).count() == 10


def held_accuracy(scored, marks, label):
    both = scored.join(marks.filter("doc_id > 0"), "doc_id").filter(labels.held_out(F.col("doc_id"), 3, 1))
    return both.select(F.avg(((F.col("_score") >= 0.5).cast("int") == F.col(label)).cast("double"))).first()[0]


def test_quality_trees_on_held_out_rows(marked):
    docs, marks = marked
    forest = quality_trees.fit_quality(docs, marks.filter(~labels.held_out(F.col("doc_id"), 3, 1)))
    scored = quality_trees.with_quality(docs, forest)
    assert scored.columns == ["_score", *docs.columns]
    assert held_accuracy(scored, marks, "quality") > 0.98


def test_forest_walk_matches_single_rows():
    r = np.random.default_rng(0)
    x = r.normal(size=(800, len(quality_trees.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = quality_trees.fit(x, y)
    got = forest.scores(x[:50])
    for row, score in zip(x[:50], got, strict=True):
        total = forest.start
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += leaf[at - len(f)]
        assert math.isclose(score, 1 / (1 + math.exp(-total)))
    assert (((forest.scores(x) >= 0.5) == y).mean()) > 0.95


def test_statistics_match_plain_python():
    texts = [prose(3, 80), "A b. b\nA b. b\n\nc9 !", "", None, "wort " * 30]
    got = dict(zip(quality_trees.STATISTICS, quality_trees.statistics(numpy_words(pa.array(texts))).T, strict=True))
    for k, t in enumerate(texts):
        w, t = words_of(t), t or ""
        n = max(1, len(w))
        assert got["words"][k] == len(w) and got["bytes"][k] == len(t.encode())
        assert math.isclose(got["distinct"][k], len(set(w)) / n)
        assert math.isclose(got["repeats_next"][k], sum(a == b for a, b in zip(w, w[1:])) / n)
        assert math.isclose(got["share_upper"][k], sum("A" <= c <= "Z" for c in t) / max(1, len(t.encode())))
        lines = [tuple(words_of(x)) for x in t.split("\n") if words_of(x)]
        assert math.isclose(got["distinct_lines"][k], len(set(lines)) / max(1, len(lines)))
        assert math.isclose(got["top_word"][k], max((w.count(x) for x in set(w)), default=0) / n)


@pytest.mark.parametrize("fit, apply, mark", [(quality_trees.fit_quality, quality_trees.with_quality, "quality"), (toxicity_nb.fit_toxicity, toxicity_nb.with_toxicity, "toxic")])
def test_classifier_hard_cases(spark, marked, hard, empty, fit, apply, mark):
    model = fit(*marked)
    got = apply(hard, model)
    scores = [r[0] for r in got.select("_score").collect()]
    assert len(scores) == hard.count() and all(0 <= s <= 1 for s in scores) and got.columns == ["_score", *hard.columns]
    assert apply(empty, model).count() == 0 and apply(hard, model, keep=False).columns == ["_score", "doc_id"]
    one_class = marked[1].filter(f"{mark} = 1")
    assert apply(hard, fit(marked[0], one_class)).filter("_score < 0.9").count() == 0
    none = apply(hard, fit(marked[0], marked[1].limit(0)))
    assert none.filter("_score < 0 OR _score > 0.5").count() == 0


def test_toxicity_on_held_out_rows(marked):
    docs, marks = marked
    model = toxicity_nb.fit_toxicity(docs, marks.filter(~labels.held_out(F.col("doc_id"), 3, 1)))
    assert held_accuracy(toxicity_nb.with_toxicity(docs, model), marks, "toxic") > 0.97


def test_ngrams_match_plain_python():
    texts = ["Ab abc ab", "", None, "é " * 3, "x" * 40]
    doc, bucket = toxicity_nb.features(numpy_words(pa.array(texts), lower=True))
    for k, t in enumerate(texts):
        grams = {g for w in words_of((t or "").lower()) for n in toxicity_nb.SIZES for i in range(len(w.encode()) + 3 - n) for g in [b" " + w.encode() + b" "][0:1] for g in [g[i : i + n]]}
        assert (doc == k).sum() == len(grams)
    assert len(set(zip(doc.tolist(), bucket.tolist(), strict=True))) == len(doc)


def brute_base(t):
    t = t or ""
    w = words_of(t)
    trios = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    again = {k for k, x in enumerate(trios) if trios.count(x) > 1}
    lines = [x for x in t.split("\n") if words_of(x)]
    covered = {j for k in again for j in range(k, k + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_text_statistics_match_brute_force(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice("ab c\n d# é e f".split(" ")) for _ in range(r.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "a a a", "a a a a", "a b c a b c", prose(1, 300) * 2, "\n".join(["x y"] * 4)]
    got = rule_lists.text_statistics(frame(spark, list(enumerate(texts)))).select("doc_id", *rule_lists.BASE).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {k: brute_base(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("hashes", [1, 2, 5])
def test_repeats_survive_windows_of_one_hash(spark, monkeypatch, hashes):
    """Different windows that share a hash and alternate must not hide each other."""
    monkeypatch.setattr(rule_lists, "_window_hash", lambda *w: F.pmod(F.xxhash64(*w), F.lit(hashes)))
    r = random.Random(hashes)
    rows = [(k, " ".join(r.choice("abcd") for _ in range(r.randint(0, 30)))) for k in range(80)] + [(90, "a b c d a b c d x a b"), (91, "a a a a a")]
    got = rule_lists.text_statistics(frame(spark, rows)).select("doc_id", *rule_lists.BASE).collect()
    assert {x[0]: tuple(x)[1:] for x in got} == {k: brute_base(t) for k, t in rows}


def test_rules_find_bad_rows_and_spare_good_ones(marked):
    docs, marks = marked
    rules = rule_lists.rules_from(docs, marks.filter(~labels.held_out(F.col("doc_id"), 3, 1)))
    judged = rule_lists.apply_rules(docs, rules).join(marks.filter("doc_id > 0"), "doc_id")
    assert rules and judged.filter("quality = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert judged.filter("quality = 0 AND kept").count() < 8
    expected = [r for r in judged.collect() if r["base_failed"] != (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])]
    assert not expected


def brute_rules(rows, thresholds):
    """Sequential covering over plain rows: grow by information gain, prune on the rows held out."""
    left, rules = rows, []

    def fits(row, rule):
        return all((row[f] > t) if above else (row[f] <= t) for f, above, t in rule)

    while len(rules) < rule_lists.MAX_RULES:
        growing, rule = [x for x in left if not x["held"]], ()
        while len(rule) < rule_lists.MAX_TESTS:
            bad = sum(x["bad"] for x in growing)
            best, most = None, 1e-9
            for f, cuts in thresholds.items():
                for cut in cuts if 0 < bad < len(growing) else ():
                    for above in (False, True):
                        met = [x for x in growing if fits(x, [(f, above, cut)])]
                        p = sum(x["bad"] for x in met)
                        if p >= rule_lists.MIN_COVERED:
                            gain = p * (math.log2(p / len(met)) - math.log2(bad / len(growing)))
                            if gain > most:
                                best, most = (f, above, cut), gain
            if best is None:
                break
            rule = (*rule, best)
            growing = [x for x in growing if fits(x, [best])]
        held, scored = [x for x in left if x["held"]], []
        for k in range(len(rule)):
            met = [x for x in held if fits(x, rule[: k + 1])]
            p = sum(x["bad"] for x in met)
            if p:
                scored.append(((p + 1) / (len(met) + 2), -k, p, len(met)))
        if not scored:
            break
        _, k, p, n = max(scored)
        if p < rule_lists.MIN_PRECISION * n:
            break
        rules.append(rule[: 1 - k])
        left = [x for x in left if not fits(x, rules[-1])]
    return rules


def test_learned_lists_match_plain_covering(spark, marked):
    told = labels.sample_labels(marked[1], "quality", 100_000).select("doc_id", (1 - F.col("quality")).cast("int").alias("bad"))
    stats = rule_lists.text_statistics(marked[0])
    learned = rule_lists.learn_rules(stats, told)
    held = F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0
    frame_ = stats.join(told, "doc_id").withColumn("held", held)
    shares = [i / rule_lists.BINS for i in range(1, rule_lists.BINS)] + [0.995]
    cuts = frame_.agg(*[F.percentile_approx(F.col(f).cast("double"), shares).alias(f) for f in rule_lists.FEATURES]).first()
    want = brute_rules([r.asDict() for r in frame_.collect()], {f: sorted(set(cuts[f])) for f in rule_lists.FEATURES})
    assert [[(t.feature, t.above, t.threshold) for t in rule] for rule in learned] == [list(rule) for rule in want] and want


def test_rules_hard_cases(spark, marked, hard, empty):
    rules = rule_lists.rules_from(*marked)
    got = rule_lists.apply_rules(hard, rules)
    assert got.count() == hard.count() and got.filter("kept IS NULL OR (base_failed AND kept)").count() == 0
    assert rule_lists.apply_rules(empty, rules).count() == 0
    assert rule_lists.rules_from(marked[0], marked[1].limit(0)) == []
    assert rule_lists.rules_from(marked[0], marked[1].filter("quality = 1")) == []


def test_targets_share_by_weight_and_stop_at_the_limit():
    sizes = {"a": 100, "b": 1000, None: 1000, "c": 10}
    got = cube_mix.targets(sizes)
    assert got["a"] == 300 and math.isclose(sum(got.values()), 2110)
    left = 2110 - 300 - 30 if got["c"] == 30 else 2110 - 300 - got["c"]
    assert math.isclose(got["b"] + got[None], left) and math.isclose(got["b"], left * 2 / 7)
    assert cube_mix.targets({}) == {} and cube_mix.targets({"x": 0}) == {"x": 0}


def test_flight_keeps_totals_and_expectations():
    r = random.Random(3)
    size = [r.randint(1, 500) for _ in range(300)]
    hits, words = np.zeros(300), []
    for _ in range(400):
        p = cube_mix.fly([0.3] * 300, size, [r.random() for _ in size], True)
        assert set(p) <= {0.0, 1.0}
        hits += p
        words.append(sum(a * b for a, b in zip(p, size, strict=True)))
        assert abs(sum(p) - 90) < 6
    assert max(abs(x - 0.3 * sum(size)) for x in words) < 1000 and abs(hits.mean() / 400 - 0.3) < 0.01 and hits.min() > 60
    flown = cube_mix.fly([0.3] * 300, size, [0.5] * 300, False)
    assert math.isclose(sum(flown), 90) and math.isclose(sum(a * b for a, b in zip(flown, size, strict=True)), 0.3 * sum(size))
    assert sum(0 < x < 1 for x in flown) <= 2


def test_mix_meets_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(cube_mix, "BLOCK_ROWS", 20)
    rows = [(k, prose(k, 5 + k % 70), None if k % 11 == 0 else f"s{k % 5 if k % 3 else 0}") for k in range(900)]
    docs = frame(spark, rows)
    got = cube_mix.mix_documents(docs).collect()
    assert len(got) == 900 and sorted(got) == sorted(cube_mix.mix_documents(docs.repartition(7)).collect())
    by = {}
    for r in got:
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        key = (r["source_size"], r["target"])
        by[key] = by.get(key, 0) + r["taken"]
    assert len(by) == 6 and all(abs(t - key[1]) <= 75 for key, t in by.items())
    again = cube_mix.repeated(docs, cube_mix.mix_documents(docs))
    assert again.columns == docs.columns and again.count() == sum(r["copies"] for r in got)


@pytest.mark.parametrize("seed", range(8))
def test_landing_misses_by_a_small_document(seed):
    """Documents of very different sizes: words and documents of a source come out as they are due."""
    r = random.Random(seed)
    for n in (120, 300, 900):
        size = [min(5000, int(r.lognormvariate(5.3, 1.1))) + 1 for _ in range(n)]
        share = r.random() * 0.8 + 0.1
        landed = cube_mix.fly([share] * n, size, [r.random() for _ in size], True)
        missed = sum(a * b for a, b in zip(landed, size, strict=True)) - share * sum(size)
        assert set(landed) <= {0.0, 1.0} and abs(missed) <= sorted(size)[n // 10] and abs(sum(landed) - share * n) < 6
    size = [9000, *[r.randint(20, 60) for _ in range(20)]]  # one document outweighs all others
    landed = cube_mix.fly([0.4] * 21, size, [r.random() for _ in size], True)
    assert abs(sum(a * b for a, b in zip(landed, size, strict=True)) - 0.4 * sum(size)) <= 4500


def test_landing_keeps_expectations():
    r = random.Random(2)
    size = [r.randint(1, 400) for _ in range(60)] + [0, 0]
    hits = sum(np.array(cube_mix.fly([0.37] * 62, size, [r.random() for _ in size], True)) for _ in range(1500)) / 1500
    assert abs(hits.mean() - 0.37) < 0.02 and np.abs(hits - 0.37).max() < 0.2 and np.abs(hits - 0.37).mean() < 0.04


def test_sources_of_a_mix_come_near_their_targets(spark):
    """Every source of a table against its target, worked out here from the texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "source", "text").collect()
    size = {}
    for d in rows:
        size[d["source"]] = size.get(d["source"], 0) + len(words_of(d["text"]))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    due, free = {}, dict(size)
    rest = sum(size.values())
    while over := [s for s in free if rest * weight[s] > 3 * size[s] * sum(weight[x] for x in free)]:
        for s in over:
            due[s] = 3 * free.pop(s)
        rest = sum(size.values()) - sum(due.values())
    due |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
    taken = dict.fromkeys(size, 0)
    source = {d["doc_id"]: d["source"] for d in rows}
    for r in cube_mix.mix_documents(docs).collect():
        assert math.isclose(r["target"], due[source[r["doc_id"]]]) and r["source_size"] == size[source[r["doc_id"]]]
        taken[source[r["doc_id"]]] += r["taken"]
    print({s: (taken[s], round(due[s])) for s in size})
    # Fifty documents a source here, of 1 to some 5,000 words.
    assert all(abs(taken[s] - due[s]) <= 0.03 * due[s] for s in size), {s: (taken[s], due[s]) for s in size}
    assert sum(abs(taken[s] - due[s]) for s in size) <= 0.005 * sum(size.values())


def test_mix_hard_cases(spark, hard, empty):
    got = cube_mix.mix_documents(hard)
    assert got.count() == hard.count() and got.filter("taken IS NULL OR taken > 3 * size").count() == 0
    assert cube_mix.mix_documents(empty).count() == 0


def brute_tokens(word, pieces):
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        s, c = best[j - 1]
        n = len(word[j - 1].encode())
        options = [(s + trie_tokens.BYTE_SCORE * n, -(c + n))]
        options += [(best[i][0] + pieces[word[i:j]], -(best[i][1] + 1)) for i in range(max(0, j - 20), j) if word[i:j] in pieces]
        s, c = max(options)
        best.append((s, -c))
    return best[-1][1]


def test_token_counts_match_plain_viterbi(spark, hard, empty, monkeypatch):
    monkeypatch.setattr(trie_tokens, "MAX_NODES", 300)
    monkeypatch.setattr(trie_tokens, "LONG", 60)
    pieces = trie_tokens.load_pieces()
    texts = [prose(k, 60) for k in range(20)] + ["", None, "xy" * 400, "猫 é € ☃"]
    got = trie_tokens.count_tokens(frame(spark, list(enumerate(texts)))).collect()
    want = {k: (len(words_of(t)), sum(brute_tokens(trie_tokens.WORD_MARK + w, pieces) for w in words_of(t))) for k, t in enumerate(texts)}
    assert {r[0]: (r[1], r[2]) for r in got} == want
    texts = {r["doc_id"]: r["text"] for r in hard.collect() if r["doc_id"] not in (None, 9)}
    counted = [r for r in trie_tokens.count_tokens(hard).collect()]
    assert len(counted) == hard.count() and trie_tokens.count_tokens(empty).count() == 0
    for r in counted:
        if r[0] in texts:
            w = words_of(texts[r[0]])
            assert r[1] == len(w) and r[2] == sum(brute_tokens(trie_tokens.WORD_MARK + x, pieces) for x in w)


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return (host, path, best and best[1], best[0] if best else "allow")


def test_urls_match_brute_force(spark):
    r = random.Random(5)
    urls = [f"{r.choice(['http', 'HTTPS', ''])}{r.choice(['://', ':/', '://'])}{r.choice(['', 'www.', 'A.b.', 'x'])}{r.choice(['example.com', 'Example.NET', 'com', 'é.net', ''])}{r.choice(['', '/', '/en', '/en/', '/en/a', '/es/b', '/EN/'])}{r.choice(['', '?q=/en/', '#f', '?a://b'])}" for _ in range(600)]
    urls += [None, "", "://", "a://b://c/en/", "http://example.com\n/en/"]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    got = url_cascade.judge_urls(pages, RULES).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {k: brute_url(u) for k, u in enumerate(urls)}
    long = "http://" + "a." * 3000 + "example.com/en/" + "b/" * 3000
    again = spark.createDataFrame([(1, long), (1, long), (1, "http://x.net"), (2, "http://" + "q" * 20000)], "page_id long, url string")
    assert sorted(tuple(r)[1:] for r in url_cascade.judge_urls(again, RULES).collect()) == sorted(brute_url(u[0]) for u in again.select("url").collect())
    assert url_cascade.judge_urls(pages.limit(0), RULES).count() == 0
    assert url_cascade.judge_urls(pages, []).filter("rule IS NOT NULL OR verdict != 'allow'").count() == 0


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), F.col("id") % 15000).alias("key"))
    listed = universe.filter(F.xxhash64("key") % 7 == 0).unionByName(spark.createDataFrame([("elsewhere",)], "key string"))
    cascade = url_cascade.build_cascade(universe, listed)
    keys = universe.distinct().select("key", F.xxhash64("key").alias("one"), F.xxhash64("key", F.lit(1)).alias("two"), (F.xxhash64("key") % 7 == 0).alias("is")).toPandas()
    got = cascade.listed(*(keys[c].to_numpy().astype(np.uint64) for c in ("one", "two")))
    assert (got == keys["is"].to_numpy()).all() and len(cascade.levels) > 2
    with pytest.raises(ValueError):
        url_cascade._level(universe.limit(1), 10**9, 0.5, 0)
