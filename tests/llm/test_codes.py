"""Vector codes against plain Python, and the GNAT against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import frames, vector_codes
from skyloom.llm.vector_codes import build_gnat, compress_vectors, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector string, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "v", 1) for r in rows], SCHEMA)


def plain(rows):
    """vec_id, code, error, label_error and digest of every kept row, all widths equal."""
    kept = sorted(
        ((i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)),
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    step = len(kept[0][1]) // 16
    books = [[v[p * step : (p + 1) * step] for i, v, _ in kept if i is not None][:64] for p in range(16)]

    def assign():
        out = []
        for _, v, _ in kept:
            parts = [v[p * step : (p + 1) * step] for p in range(16)]
            out.append([min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p])) for p, x in enumerate(parts)])
        return out

    for _ in range(2):
        found = assign()
        for p in range(16):
            for k in range(len(books[p])):
                own = [v[p * step : (p + 1) * step] for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        total[lab] = total.get(lab, 0) + e
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in f), e, total[lab], digest) for (i, _, lab), f, e in zip(kept, found, error, strict=True)),
        key=str,
    )


def coded(spark, rows):
    got = compress_vectors(vectors(spark, rows)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(map(tuple, got.collect()), key=str)


def made(seed, n, width=32, spread=0.3):
    r = random.Random(seed)
    return [(r.randrange(10 * n), [r.gauss(0, spread) for _ in range(width)], r.choice([0, 0, 0, 1, 2, None])) for _ in range(n)]


@pytest.mark.parametrize("n", [5, 64, 300])
def test_codes_match_plain_python(spark, n):
    rows = made(n, n) + [(1, None, 0), (2, [], 0), (3, [None] * 32, 1), (4, [float("nan")] + [0.0] * 31, 1), (5, [float("-inf")] * 32, None)]
    assert coded(spark, rows) == sorted([*plain([r for r in rows if r[0] != 2 or r[1]]), (2, None, None, plain_label(rows, 0), plain([r for r in rows if r[1]])[0][4])], key=str)


def plain_label(rows, label):
    found = plain([r for r in rows if r[1]])
    of = {r[0]: r[2] for r in rows if r[1]}
    return next(f[3] for f in found if of[f[0]] == label)


def test_ties_repeats_and_null_ids(spark):
    same = [0.25] * 16
    rows = [(k, same, 0) for k in range(70)] + [(9, same, 0), (None, [0.5] * 16, None), (None, same, 1), (200, [-0.001] * 16, 1), (200, [-0.5] * 16, 1)]
    got = coded(spark, rows)
    # Entry 0 is drawn away by what joined it, so the second of the equal entries wins.
    assert got == plain(rows) and [g[1] for g in got if g[0] == 3] == ["01" * 16]


def test_other_widths_get_no_code(spark):
    rows = [(1, [0.5] * 16, 0), (2, [0.1] * 32, 0), (3, [0.2] * 7, 1), (4, [1.0] * 16, 0)]
    got = {g[0]: g for g in coded(spark, rows)}
    assert got[2][1:3] == got[3][1:3] == (None, None) and got[3][3] is None
    assert [got[k] for k in (1, 4)] == plain([rows[0], rows[3]])


def test_empty_tables_and_reach(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 0)]) == []
    assert [g[:2] for g in coded(spark, [(1, [0.1] * 3, 0)])] == [(1, None)]
    with pytest.raises(Exception, match="cannot be coded"):
        coded(spark, [(1, [3e5] * 16, 0)])


@pytest.mark.parametrize("seed", range(6))
def test_gnat_finds_what_all_distances_find(seed):
    r = np.random.default_rng(seed)
    reach = [2, 5, 60, 1000, 1 << 25, 300][seed]  # small ones are full of ties
    entries = r.integers(-reach, reach + 1, (64, 4))
    points = np.concatenate([r.integers(-reach, reach + 1, (4000, 4)), entries, np.repeat(entries[:1], 50, axis=0)])
    index, best, spent = nearest(build_gnat(entries), entries, points)
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()
    if reach >= 60:
        assert spent < 0.75 * len(points) * len(entries)  # whole subtrees were left out


def test_equal_entries_go_to_the_lowest_index():
    entries = np.array([[1, 1]] * 40 + [[5, 5]] * 24)
    index, best, _ = nearest(build_gnat(entries), entries, np.array([[1, 1], [5, 5], [3, 3]]))
    assert index.tolist() == [0, 40, 0] and best.tolist() == [0, 0, 8]


def test_label_totals_with_a_hot_label(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))).alias("label"))
    got = frames.join_totals(df, "label", {"total": F.sum("id")})
    want = {None: sum(range(0, 5000, 3)), 7: sum(range(1, 5000, 3)) }
    found = got.collect()
    assert len(found) == 5000 and all(r["total"] == want.get(r["label"], r["id"]) for r in found if r["label"] != 7 or r["id"] % 3 == 1)


def test_files_of_many_batches_give_the_same_books(spark, monkeypatch):
    rows = made(3, 200, 16)
    assert compress_vectors(vectors(spark, rows).repartition(7)).select("codebooks_sha256").first() == compress_vectors(vectors(spark, rows)).select("codebooks_sha256").first()
    assert vector_codes.ENTRIES == 64
