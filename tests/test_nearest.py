"""Nearest-neighbour estimates against comparing every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyloom.operators import nearest
from skyloom.operators.nearest import fill_from_nearest


def brute(known, point, k=5):
    ranked = sorted(
        ((math.sqrt((a - point[0]) ** 2 + (b - point[1]) ** 2), a, b, t, v) for a, b, t, v in known)
    )[:k]
    exact = [r[4] for r in ranked if r[0] == 0]
    if exact:
        return sum(exact) / len(exact)
    return sum(r[4] / r[0] for r in ranked) / sum(1 / r[0] for r in ranked)


def check(spark, data):
    df = spark.createDataFrame(data, "lat double, lon double, t int, v double").repartition(3)
    got = fill_from_nearest(df, ["v"], lat="lat", lon="lon", tie=["t"]).collect()
    assert len(got) == len(data)
    known = [d for d in data if d[3] is not None and d[0] is not None]
    by_key = {(r["lat"], r["lon"], r["t"]): r["v"] for r in got}
    for a, b, t, v in data:
        if v is not None:
            assert by_key[(a, b, t)] == v
        elif a is None:
            assert by_key[(a, b, t)] is None
        else:
            assert by_key[(a, b, t)] == pytest.approx(brute(known, (a, b)), rel=1e-9)


def test_clustered_points_and_far_strangers(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        c = (10.0, 70.0) if i % 3 else (30.0, 95.0)
        data.append((c[0] + rng.gauss(0, 0.001), c[1] + rng.gauss(0, 0.001), i,
                     None if rng.random() < 0.2 else rng.random()))
    data += [(20.0, 80.0, 9000, None), (-60.0, 170.0, 9001, None), (None, 80.0, 9002, None)]
    check(spark, data)


def test_same_place_takes_all_the_weight(spark):
    data = [(1.0, 1.0, i, float(i)) for i in range(200)] + [(1.0, 1.0, 900, None), (2.0, 2.0, 901, None)]
    check(spark, data)


def test_copies_at_one_place_are_cut_before_the_shuffle(spark):
    from pyspark.sql import Window

    w = Window.partitionBy("lat").orderBy("t")
    df = spark.range(9).select((F.col("id") % 2).alias("lat"), F.col("id").alias("t"))
    plan = df.withColumn("slot", F.row_number().over(w)).where("slot <= 5")._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString() and "Partial" in plan.toString()


def test_fewer_than_k(spark):
    check(spark, [(0.0, 0.0, 0, 1.0), (0.0, 2.0, 1, 3.0), (0.0, 1.0, 2, None)])


def test_regular_grid_ties(spark):
    data = [(float(a), float(b), a * 10 + b, None if (a + b) % 3 == 0 else float(a * b))
            for a in range(10) for b in range(10)]
    check(spark, data)


def test_nothing_known_leaves_all_missing(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1, None)], "lat double, lon double, t int, v double")
    assert fill_from_nearest(df, ["v"], lat="lat", lon="lon", tie=["t"]).where(F.col("v").isNull()).count() == 1


def own_places(spark):
    """Six places of two pools: at some only the first rows miss a value, at (3, 0) all of them do."""
    data = [
        (f"p{p}", float(a), 0.0, t, None if a == 3 or t < 2 - a % 2 else float(100 * p + 10 * a + t))
        for p in range(2) for a in range(6) for t in range(9)
    ]
    data += [("p0", None, 0.0, 1, None), ("p2", 1.0, 0.0, 1, None)]
    return spark.createDataFrame(data, "pool string, lat double, lon double, t int, v double"), data


@pytest.mark.parametrize("windowed", [True, False])
def test_own_place_is_settled_without_a_walk(spark, monkeypatch, windowed):
    """Only the place where nothing is known walks, and filled values are not known ones to it."""
    walked = []
    walk = nearest.nearest_points
    monkeypatch.setattr(nearest, "nearest_points", lambda wanted, *a: walked.append(wanted.select("u_lat").distinct().collect()) or walk(wanted, *a))
    df, data = own_places(spark)
    near = dict(lat="lat", lon="lon", tie=["t"], pool=["pool"])
    frame, settled = nearest.place_estimates(df, ["v"], **near) if windowed else (df, None)
    got = fill_from_nearest(frame, ["v"], **near, settled=settled)
    assert got.columns == df.columns
    by_key = {tuple(r)[:4]: r["v"] for r in got.collect()}
    assert len(by_key) == len(data)
    for pool, a, b, t, v in data:
        known = [d[1:] for d in data if d[0] == pool and d[1] is not None and d[4] is not None]
        want = v if v is not None else brute(known, (a, b)) if known and a is not None else None
        assert by_key[(pool, a, b, t)] == (want if want is None else pytest.approx(want, rel=1e-9))
    assert [sorted(r[0] for r in w) for w in walked] == [[1.0, 3.0]]
    walked.clear()
    frame, settled = nearest.place_estimates(df.where("lat <> 3 and pool <> 'p2'"), ["v"], **near)
    assert fill_from_nearest(frame, ["v"], **near, settled=settled).where("v is null").isEmpty() and not walked
