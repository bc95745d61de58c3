"""The filter audit against every order done one filter at a time."""

import itertools
import math
import random

import pytest

from skyloom.llm import filter_audit
from skyloom.llm.filter_audit import Diagram, adjacent_swaps, audit, audit_filters, audit_part

from .conftest import frame, prose, words_of


def fails(rows):
    """Failing filters of each (doc_id, text, source) row."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, s in rows:
        t, w = t or "", words_of(t)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)}
        bad |= {"D": any(c in "#$%&*|" for c in t), "E": d is not None and d > least[t]}
        yield s or "", d, {k for k, v in bad.items() if v}


def brute(rows, good, toxic, names="ABCDE"):
    judged = list(fails(rows))
    out = []
    for part in {p for p, _, _ in judged}:
        docs = [(d, f) for p, d, f in judged if p == part]
        steps, shapley = [], dict.fromkeys(names, 0)
        for order in map("".join, itertools.permutations(names)):
            left = docs
            for k, name in enumerate(order):
                lost = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                gone = len([x for x in docs if name in x[1]]) - len(lost)
                alone = sum(f == {name} for _, f in docs)
                shapley[name] += len(lost)
                steps.append((part, order, k + 1, len(left), len(lost), gone, alone, sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost), name))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def corpus():
    r = random.Random(4)
    rows = []
    for k in range(120):
        t = prose(k, r.choice([20, 60, 90]))
        t = r.choice([t, t.upper(), t + " 5 % off", (t[:80] + " ") * 9, rows[r.randrange(len(rows))][1] if rows else t])
        rows.append((k, t, r.choice(["a", "b", None])))
    return [*rows, (3, None, "a"), (7, "", "c"), (9, "", "c"), (None, "", "c"), (None, prose(1, 60), "b"), rows[5], rows[5], (5, rows[5][1], "other")]


def test_audit_matches_brute_force(spark):
    rows = corpus()
    r = random.Random(6)
    marks = [(d, r.randint(0, 1), r.randint(0, 1)) for d in range(0, 120, 2)] + [(4, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    good, toxic = {d for d, q, _ in marks if q == 1} - {None}, {d for d, _, t in marks if t == 1} - {None}
    got = audit_filters(frame(spark, rows), labels)
    assert sorted(map(tuple, got.collect())) == brute(rows, good, toxic)


def test_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in hard.collect()]
    assert sorted(map(tuple, audit_filters(hard, labels.limit(0)).collect())) == brute(rows, set(), set())
    assert sorted(map(tuple, audit_filters(hard, labels).collect())) == brute(rows, {1}, set())
    assert audit_filters(empty, labels).count() == 0


def test_clashing_names_change_nothing(spark, hard):
    labels = spark.createDataFrame([(2, 1, 1, "x", 3)], "doc_id long, quality int, toxic int, good string, n int")
    named = hard
    for c in ("part", "mask", "n", "good", "toxic", "digest", "own", "id", "first"):
        named = named.selectExpr("*", f"'z' AS {c}")
    assert sorted(map(tuple, audit_filters(named, labels).collect())) == sorted(map(tuple, audit_filters(hard, labels).collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swaps_see_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for k in adjacent_swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n) == 1 + sum(1 for _ in adjacent_swaps(n))


def test_swapped_diagrams_equal_built_ones_and_share_nodes():
    r = random.Random(2)
    cells = {m: (r.randint(0, 3), 0, 0) for m in range(32)}
    moved = Diagram(cells, 5)
    for k in adjacent_swaps(5):
        moved.swap(k)
        place = {which: at for at, which in enumerate(moved.order)}
        turned = {sum(1 << place[b] for b in range(5) if m >> b & 1): c for m, c in cells.items()}
        built = Diagram(turned, 5)
        assert [(a, b) for _, a, b in moved.steps()] == [(a, b) for _, a, b in built.steps()]
    flat = Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(flat.edges) == 6  # one node a level and one leaf


def test_large_counts_and_other_names():
    rows = audit_part({0: (10**15, 5, 0), 3: (10**14, 1, 2)}, "xy")
    assert rows == [
        ("xy", 1, 10**15, 10**14, 0, 0, 1, 2, 10**14), ("xy", 2, 10**15, 0, 10**14, 0, 0, 0, 10**14),
        ("yx", 1, 10**15, 10**14, 0, 0, 1, 2, 10**14), ("yx", 2, 10**15, 0, 10**14, 0, 0, 0, 10**14),
    ]


def test_names_are_checked(spark):
    for names in ("", "AA", "ABCDEFGH"):
        with pytest.raises(ValueError):
            audit(spark.range(1), names)
    assert filter_audit.FILTERS == "ABCDE"
