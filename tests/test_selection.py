"""Radix selection and ranks in ranges against plain Python."""

import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from skyloom.operators import ordered
from skyloom.operators.ordered import average_ranks, exact_quantiles
from skyloom.operators.selection import order_code, select_ranks

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
         float("inf"), float("-inf"), 1.0, 0.9999999999999999, 1.0000000000000002, 2.0, 1.9999999999999998, 0.1, 3.0, 1e-300]


def bits(x):
    """The format's own order: sign and size as an integer."""
    n = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return -n if x < 0 else n


def test_codes_are_the_bits_of_the_format(spark):
    r = random.Random(3)
    values = EDGES + [2.0**k for k in range(-1070, 1024, 7)] + [struct.unpack(">d", r.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_code("v").alias("c")).collect()
    assert [row["c"] for row in got] == [bits(row["v"]) for row in got]


def test_selected_ranks_match_sorted_values(spark):
    r = random.Random(5)
    rows = [(g, v) for g in ("a", None, "b") for v in [r.gauss(0, 10.0 ** r.randint(-3, 9)) for _ in range(400)] + [1.5] * 200 + [None] * 5]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    ranks = [(g, f"r{k}", k) for g in ("a", None) for k in (0, 1, 299, 300, 450, 599)]
    got = select_ranks(df, ["g"], "v", spark.createDataFrame(ranks, "g string, _name string, _rank bigint")).collect()
    values = {g: sorted(v for h, v in rows if h == g and v is not None) for g in ("a", None)}
    assert {(x["g"], x["_name"]): x["_value"] for x in got} == {(g, n): values[g][k] for g, n, k in ranks}


def test_a_pass_keeps_few_counts(spark, monkeypatch):
    """Neither the values nor their number reach the tables a pass writes."""
    seen = []
    real = ordered.select_ranks.__globals__["cut_lineage"]

    def counted(df, eager=True):
        out = real(df, eager)
        seen.append(out.count())
        return out

    monkeypatch.setitem(ordered.select_ranks.__globals__, "cut_lineage", counted)
    df = spark.range(60_000).select(F.rand(7).alias("v"))
    q = exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.25}, chunk_rows=1000).first()
    values = sorted(x["v"] for x in df.collect())
    assert q["m"] == values[29_999] + (values[30_000] - values[29_999]) * 0.5 and q["_n"] == 60_000
    assert seen == [4] * 4  # a row per wanted rank and pass


@pytest.mark.parametrize("chunk_rows", [40, 10**6])
def test_ranks_of_ties_across_splitters(spark, chunk_rows):
    r = random.Random(9)
    rows = [("hot", 7.0 if r.random() < 0.4 else float(r.randrange(60)), k) for k in range(900)]
    rows += [("cold", float(r.randrange(5)), 1000 + k) for k in range(30)] + [(None, 1.0, 2000), ("hot", None, 2001), ("one", 7.0, 2002)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    got = {x["id"]: x["r"] for x in average_ranks(df, ["g"], {"r": "v"}, chunk_rows).collect()}
    for g in ("hot", "cold", None, "one"):
        mine = sorted((v, k) for h, v, k in rows if h == g and v is not None)
        for v, k in mine:
            below, same = sum(w < v for w, _ in mine), sum(w == v for w, _ in mine)
            assert got[k] == below + (same + 1) / 2, (g, v, k)
    assert got[2001] is None and len(got) == len(rows)


def test_ranges_share_a_value_that_fills_them(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 11).alias("v"))
    ranges = ordered._ranked_in_ranges(df.withColumn("g", F.lit(1)), ["g"], "r", "v", 16)
    same = df.join(ranges.select("id", "r"), "id").groupBy("v").agg(F.count_distinct("r").alias("n"), F.count("*").alias("c"), F.max("r").alias("r"))
    found = {x["v"]: x for x in same.collect()}
    below = 0
    for v in sorted(found):
        assert found[v]["n"] == 1 and found[v]["r"] == below + (found[v]["c"] + 1) / 2
        below += found[v]["c"]


def test_no_join_on_the_value(spark):
    df = spark.range(500).select(F.lit(1).alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    plan = average_ranks(df, ["g"], {"r": "v"}, 50)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert any("_range" in line for line in joins) and not any(re.search(r"\bv#", line) for line in joins)
