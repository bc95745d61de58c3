"""Quality rules as a learned decision list, in DataFrame functions throughout.

Statistics of each text are Spark expressions. A list is learned by sequential covering: a rule
grows by the threshold test that gains most, is pruned on rows it was not grown on, and the rows it
covers are set aside for the next rule. Each step counts labels per statistic and quantile bin in
one aggregation; the driver sees those counts only. The result is one ordered conditional
expression.

Defined cases: null and empty texts have statistics of 0 and fail the base rules; rows without a
label, or with contradicting ones, teach nothing; without both labels the list is empty and keeps
all; an empty table gives an empty result; repeated rows are judged each; very long texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import doc_words, let
from skyloom.llm.labels import sample_labels
from skyloom.session import cut_lineage

#: Labelled rows a list is learned from, at most; the least by hash are taken.
SAMPLE_ROWS = 20_000
BINS = 32
MAX_RULES, MAX_TESTS = 8, 3
#: A rule is kept if at least this share of the pruning rows it covers is bad.
MIN_PRECISION = 0.95
MIN_COVERED = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _window_hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more. Windows are sorted as longs,
    the position in as many low bits as the text needs and the window's hash in the others;
    neighbours of equal hash count only if their words are equal. Should two neighbours of equal hash
    differ, the text's windows are sorted by their words instead."""

    def shifted(way: str, x: Column, by: Column) -> Column:
        return F.call_function(way, x, by)

    def covered(w: Column, bits: Column) -> Column:
        def head(x: Column) -> Column:
            return shifted("shiftright", x, bits)

        def place(x: Column) -> Column:
            return x.bitwiseAND(shifted("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

        def near(a: Column, b: Column) -> Column:
            """Whether two neighbours, the second perhaps none, have one hash."""
            return F.coalesce(shifted("shiftrightunsigned", a.bitwiseXOR(b), bits) == 0, F.lit(False))

        def equal(i: Column, j: Column) -> Column:
            return (w[i] == w[j]) & (w[i + 1] == w[j + 1]) & (w[i + 2] == w[j + 2])

        def places(pairs: Column) -> Column:
            return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

        def by_hash(s: Column) -> Column:
            def pair(a: Column, b: Column) -> Column:
                return F.when(near(a, b) & equal(place(a), place(b)), F.array(place(a), place(b)))

            return places(F.transform(s, lambda x, i: pair(x, F.get(s, i + 1))))

        def by_words(s: Column) -> Column:
            def pair(a: Column, b: Column) -> Column:
                return F.when(a["words"] == b["words"], F.array(a["at"], b["at"]))

            return places(F.transform(s, lambda x, i: pair(x, F.get(s, i + 1))))

        def repeats(s: Column) -> Column:
            clash = F.exists(F.transform(s, lambda x, i: near(x, F.get(s, i + 1)) & ~equal(place(x), place(F.coalesce(F.get(s, i + 1), x)))), lambda x: x)
            spelt = F.transform(at, lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("words"), i.alias("at")))
            return F.when(clash, let(F.sort_array(spelt), by_words)).otherwise(by_hash(s))

        at = F.sequence(F.lit(0), F.size(w) - 3)
        windows = F.transform(at, lambda i: shifted("shiftleft", head(_window_hash(w[i], w[i + 1], w[i + 2])), bits).bitwiseOR(i.cast("long")))

        def steps(at: Column) -> Column:
            # least() passes over the null after the last position
            return F.transform(at, lambda p, i: F.least(F.lit(3), F.get(at, i + 1) - p))

        def total(at: Column) -> Column:
            return F.aggregate(steps(at), F.lit(0), lambda a, x: a + x)

        return let(F.sort_array(windows), lambda s: let(repeats(s), total))

    def bound(w: Column) -> Column:
        return let(F.ceil(F.log2(F.size(w) + 1.0)).cast("int"), lambda bits: covered(w, bits))

    return F.when(F.size(words) > 3, let(words, bound)).otherwise(F.lit(0))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and one row of statistics per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("_text"), doc_words(F.col("text")).alias("_words"))

    def count(pattern: str) -> Column:
        return F.regexp_count("_text", F.lit(pattern))

    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    counted = base.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        count("[A-Z]").alias("_upper"),
        count(r"[!?.,;:'\"()_-]").alias("_marks"),
        count("[0-9]").alias("_digits"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.select(
        "doc_id",
        *BASE,
        (F.col("word_chars") / words).alias("mean_word"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("_upper") / chars).alias("upper_share"),
        (F.col("_marks") / chars).alias("mark_share"),
        (F.col("_digits") / chars).alias("digit_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("_distinct") / words).alias("distinct_share"),
    )


FEATURES = ["n_words", "n_dup_lines", "mean_word", "symbol_share", "upper_share", "mark_share", "digit_share", "repeat_share", "distinct_share"]


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _all(rule: Rule) -> Column:
    cond = F.lit(True)
    for test in rule:
        cond = cond & test.column()
    return cond


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the text of the first rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(_all(rule), " and ".join(map(str, rule))).otherwise(out)
    return out


def _histogram(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """Bad and good rows per statistic and bin; bin b holds values above b of the thresholds."""

    def above(feature: str):
        return lambda x: F.col(feature).cast("double") > x

    bins = [
        F.struct(F.lit(f).alias("feature"), F.size(F.filter(F.array(*map(F.lit, t)), above(f))).alias("bin"))
        for f, t in thresholds.items()
        if t
    ]
    if not bins:
        return {}
    long = rows.select("bad", F.explode(F.array(*bins)).alias("at")).select("bad", "at.*")
    counts = long.groupBy("feature", "bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counts.collect()}


def _best(rows: DataFrame, thresholds: dict[str, list[float]]) -> Test | None:
    """The test of largest information gain on the bad rows."""
    counts = _histogram(rows, thresholds)
    best, most = None, 1e-9
    for feature, cuts in thresholds.items():
        by_bin = [counts.get((feature, b), (0, 0)) for b in range(len(cuts) + 1)]
        bad, good = (sum(x[k] for x in by_bin) for k in (0, 1))
        if not bad or not good:
            continue
        low = [0, 0]
        for b, cut in enumerate(cuts):
            low = [low[k] + by_bin[b][k] for k in (0, 1)]
            for above, (p, n) in ((False, low), (True, [bad - low[0], good - low[1]])):
                if p >= MIN_COVERED:
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                    if gain > most:
                        best, most = Test(feature, above, cut), gain
    return best


def _pruned(rule: Rule, rows: DataFrame) -> Rule:
    """The shortest beginning of the rule that does best on the pruning rows; none if it is not
    precise there."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    sums = [F.sum(F.when(_all(h), x).otherwise(0)).alias(f"{name}{k}") for k, h in enumerate(heads) for name, x in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
    row = rows.agg(*sums).first()
    scored = [(((row[f"p{k}"] or 0) + 1) / ((row[f"p{k}"] or 0) + (row[f"n{k}"] or 0) + 2), -k) for k in range(len(heads)) if row[f"p{k}"]]
    if not scored:
        return ()
    _, k = max(scored)
    p, n = row[f"p{-k}"], row[f"n{-k}"]
    return heads[-k] if p >= MIN_PRECISION * (p + n) else ()


def learn_rules(statistics: DataFrame, labels: DataFrame) -> list[Rule]:
    """Learn an ordered list from statistics (doc_id and FEATURES) and labels (doc_id, bad 0/1)."""
    rows = cut_lineage(
        statistics.select("doc_id", *FEATURES)
        .join(labels.select("doc_id", "bad"), "doc_id")
        .withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0)
        .coalesce(8)
    )
    shares = [i / BINS for i in range(1, BINS)] + [0.995]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares).alias(f) for f in FEATURES]).first()
    thresholds = {f: sorted(set(found[f] or [])) for f in FEATURES}
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        growing, rule = left.filter(~F.col("held")), ()
        while len(rule) < MAX_TESTS and (test := _best(growing, thresholds)):
            rule = (*rule, test)
            growing = growing.filter(test.column())
        rule = _pruned(rule, left.filter("held")) if rule else ()
        if not rule:
            break
        rules.append(rule)
        left = left.filter(~_all(rule))
    return rules


def rules_from(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn a list from the documents whose ``quality`` label is among at most ``rows`` drawn."""
    drawn = sample_labels(labels, "quality", rows).select("doc_id", (1 - F.col("quality")).cast("int").alias("bad"))
    learned_on = docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi")
    return learn_rules(text_statistics(learned_on), drawn)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics of all documents, ``base_failed``, the ``rule`` that fits and ``kept``."""
    judged = text_statistics(docs).withColumn("rule", verdict(rules))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("rule").isNull())
