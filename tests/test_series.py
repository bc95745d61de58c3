"""Series helpers and the quality chain, against brute force, whole and cut into chunks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyloom.operators.ordered import average_ranks, exact_quantiles, running_totals, split_groups
from skyloom.operators.quality import (
    MetricRule,
    flag_log_mad,
    flatlined,
    interpolated,
    out_of_range,
    quality_chain,
    step_exceeded,
)
from skyloom.operators.series import neighbourhood


def brute_interpolate(values, limit=3):
    known = [i for i, v in enumerate(values) if v is not None]
    out = list(values)
    for i, v in enumerate(values):
        if v is not None:
            continue
        before = [k for k in known if k < i]
        after = [k for k in known if k > i]
        if not before or i - before[-1] > limit:
            continue
        b = before[-1]
        if not after:
            out[i] = values[b]
        else:
            a = after[0]
            out[i] = values[b] + (values[a] - values[b]) * (i - b) / (a - b)
    return out


def brute_runs(values):
    out, i = [0] * len(values), 0
    while i < len(values):
        j = i
        if values[i] is not None:
            while j + 1 < len(values) and values[j + 1] == values[i]:
                j += 1
        for k in range(i, j + 1):
            out[k] = j - i + 1
        i = j + 1
    return out


def make_series(seed, sizes):
    rng = random.Random(seed)
    data = []
    for g, n in enumerate(sizes):
        t = 0
        level = 0.0
        for _ in range(n):
            t += rng.choice([1, 1, 1, 50])
            if rng.random() < 0.45:
                level = float(rng.randint(0, 3))
            data.append((f"g{g}", t, None if rng.random() < 0.3 else level))
    return data


@pytest.mark.parametrize("chunk_rows", [4_000_000, 9, 3])
def test_series_matches_brute_force(spark, chunk_rows):
    data = make_series(7, [120, 1, 45, 2, 30])
    df = spark.createDataFrame(data, "g string, t int, v double").repartition(4)
    rule = MetricRule("v", max_step=1.5, flat_window=3)
    out = neighbourhood(df, ["v"], groups=["g"], order=["t"], chunk_rows=chunk_rows)
    got = out.select(
        "g", "t", interpolated("v").alias("filled"), step_exceeded(rule).alias("step"),
        flatlined(rule).alias("flat"), "_run_v", "_position",
    )
    got = {(r["g"], r["t"]): r for r in got.collect()}
    assert len(got) == len(data)
    for g in {d[0] for d in data}:
        series = sorted(d for d in data if d[0] == g)
        values = [d[2] for d in series]
        filled, runs = brute_interpolate(values), brute_runs(values)
        for i, d in enumerate(series):
            r = got[(g, d[1])]
            assert r["_position"] == i + 1
            assert r["_run_v"] == runs[i], (g, i)
            assert r["flat"] == (values[i] is not None and runs[i] >= 3)
            expected_step = (
                i > 0 and None not in (values[i], values[i - 1])
                and abs(values[i] - values[i - 1]) > 1.5
            )
            assert r["step"] == expected_step
            if filled[i] is None:
                assert r["filled"] is None
            else:
                assert r["filled"] == pytest.approx(filled[i], abs=1e-12)


def test_ungrouped_series_is_cut_too(spark):
    data = [(i // 4, i % 4, float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(data, "t int, tie int, v double")
    layout = split_groups(df, [], ["t", "tie"], 10)
    assert layout.split
    sizes = [r["count"] for r in layout.df.groupBy(*layout.keys).count().collect()]
    assert max(sizes) <= 14 and sum(sizes) == 200
    whole = neighbourhood(df, ["v"], groups=[], order=["t", "tie"])
    cut = neighbourhood(df, ["v"], groups=[], order=["t", "tie"], chunk_rows=10)
    columns = ["t", "tie", "_prior_v", "_run_v", "_position"]
    assert rows(whole.select(columns), "t", "tie") == rows(cut.select(columns), "t", "tie")


def test_tied_instants_are_cut_by_the_next_column(spark):
    df = spark.range(300).select(F.lit(5).alias("t"), F.col("id").cast("int").alias("tie"),
                                 (F.col("id") % 7).cast("double").alias("v"))
    layout = split_groups(df, [], ["t", "tie"], 20)
    sizes = [r["count"] for r in layout.df.groupBy(*layout.keys).count().collect()]
    assert layout.split and max(sizes) <= 42
    cut = neighbourhood(df, ["v"], groups=[], order=["t", "tie"], chunk_rows=20)
    assert rows(cut.select("tie", "_position"), "tie") == [(i, i + 1) for i in range(300)]


@pytest.mark.parametrize("chunk_rows", [4_000_000, 11])
def test_quantiles_ranks_and_totals(spark, chunk_rows):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.7 else "cold", float(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.5},
                                              chunk_rows=chunk_rows).collect()}
    for g in ("hot", "cold"):
        values = sorted(v for k, v in data if k == g)
        for name, q in (("q1", 0.25), ("q2", 0.5)):
            at = q * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got[g][name] == pytest.approx(low + (high - low) * (at - math.floor(at)))
    ranked = average_ranks(df, ["g"], {"r": "v"}, chunk_rows).collect()
    for r in ranked:
        values = [v for k, v in data if k == r["g"]]
        below = sum(v < r["v"] for v in values)
        same = sum(v == r["v"] for v in values)
        assert r["r"] == below + (same + 1) / 2
    base = spark.range(100).select((F.col("id") % 2).alias("g"), "id", F.lit(2).alias("w"))
    totals = running_totals(base, ["g"], ["id"], {"before": "w"}, chunk_rows=chunk_rows)
    assert all(r["before"] == 2 * (r["id"] // 2) for r in totals.collect())
    overall = exact_quantiles(df, [], "v", {"q": 0.5}, chunk_rows=chunk_rows).first()
    values = sorted(v for _, v in data)
    assert overall["q"] == (values[199] + values[200]) / 2 and overall["_n"] == 400


# The unit cases of FIXTURES.md, part A.


def series(spark, values, metric="pm25"):
    data = [("A", f"2026-01-01T{i:02d}:00:00+00:00", v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"station string, timestamp string, {metric} double")


def test_range(spark):
    df = series(spark, [10.0, 450.0, -5.0, 1200.0, None])
    got = rows(df.select("timestamp", out_of_range("pm25", 0, 1000)), "timestamp")
    assert [g[1] for g in got] == [False, False, True, True, False]
    unbounded = df.select(out_of_range("pm25", None, None)).collect()
    assert not any(r[0] for r in unbounded)


def flags_of(spark, values, rule, groups=("station",)):
    df = series(spark, values, rule.column)
    out = neighbourhood(df, [rule.column], groups=groups, order=["timestamp"])
    return out, lambda c: [r[1] for r in rows(out.select("timestamp", c), "timestamp")]


def test_step(spark):
    rule = MetricRule("pm25", max_step=300)
    _, read = flags_of(spark, [50.0, 60.0, 400.0, 410.0], rule)
    assert read(step_exceeded(rule)) == [False, False, True, False]
    assert read(step_exceeded(MetricRule("pm25", max_step=0))) == [False] * 4


def test_step_circular(spark):
    rule = MetricRule("wind_dir", max_step=45, circular=True)
    _, read = flags_of(spark, [350.0, 10.0, 20.0, 200.0], rule)
    assert read(step_exceeded(rule)) == [False, False, False, True]


@pytest.mark.parametrize(
    "value,ignore,expected",
    [(0.0, True, False), (5.2, True, True), (0.0, False, True)],
)
def test_flatline(spark, value, ignore, expected):
    rule = MetricRule("rainfall", ignore_zero_runs=ignore)
    _, read = flags_of(spark, [value] * 14, rule)
    assert read(flatlined(rule)) == [expected] * 14
    assert read(flatlined(MetricRule("rainfall", flat_window=1))) == [False] * 14


def test_multi_flag_keeps_value(spark):
    df = series(spark, [50.0, 1500.0])
    rule = MetricRule("pm25", 0, 1000, 300)
    got = rows(quality_chain(df, [rule], groups=["station"], order=["timestamp"]), "timestamp")
    assert [g[3:] for g in got] == [("ok", 50.0, 0), ("range_fail,step_fail", 1500.0, 0)]


def test_spike_is_kept(spark):
    df = series(spark, [50.0, 100.0, 450.0, 420.0])
    rule = MetricRule("pm25", 0, 1000, 500)
    got = rows(quality_chain(df, [rule], groups=["station"], order=["timestamp"]), "timestamp")
    assert got[2][3:] == ("ok", 450.0, 0)


@pytest.mark.parametrize("groups", [[], ["station"]])
def test_log_mad(spark, groups):
    df = series(spark, [10.0, 12.0, 11.0, 13.0, 10.0, 12.0, 11.0, 14.0, 12.0, 10000.0])
    got = rows(flag_log_mad(df, "pm25", groups).select("timestamp", "mad_outlier"), "timestamp")
    assert got[-1][1] is True and got[0][1] is False


def test_log_mad_falls_back_to_quartiles(spark):
    spread = [5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 6.0, 6.0, 400.0]
    got = rows(flag_log_mad(series(spark, spread), "pm25").select("timestamp", "mad_outlier"), "timestamp")
    assert [g[1] for g in got][-1] is True and [g[1] for g in got][0] is False
    flat = rows(flag_log_mad(series(spark, [5.0] * 8 + [9.0]), "pm25").select("mad_outlier"))
    assert not any(f[0] for f in flat)


def test_interpolation(spark):
    df = series(spark, [10.0, None, 30.0])
    got = rows(
        quality_chain(df, [MetricRule("pm25")], groups=["station"], order=["timestamp"])
        .select("timestamp", "pm25_clean", "pm25_imputed", "pm25_qc_flag"), "timestamp")
    assert [g[1:] for g in got] == [(10.0, 0, "ok"), (20.0, 1, "ok"), (30.0, 0, "ok")]


def test_interpolation_limit_and_ends(spark):
    values = [None, 1.0, None, None, None, None, 6.0, None, None, None, None]
    df = series(spark, values)
    got = rows(quality_chain(df, [MetricRule("pm25")], groups=["station"], order=["timestamp"])
               .select("timestamp", "pm25_clean"), "timestamp")
    assert [g[1] for g in got] == [None, 1.0, 2.0, 3.0, 4.0, None, 6.0, 6.0, 6.0, 6.0, None]
