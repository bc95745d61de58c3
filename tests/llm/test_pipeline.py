"""The pipeline against its stages done by brute force on a small corpus."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from skyloom.llm import line_chunks, queries

from .conftest import frame, prose, words_of
from .test_pairs import brute_chunks, brute_near, edited


def corpus():
    r = random.Random(8)
    rows, marks = [], []
    for k in range(260):
        t = prose(k, r.randint(60, 140))
        marks.append((k, int(k % 4 != 0), 0))
        rows.append((k, t if k % 4 else t.upper().replace(" ", "!! "), f"s{k % 3}"))
    bench = [(k, prose(900 + k, 30).replace("\n", " ")) for k in range(3)]
    block = "\n".join(prose(950 + k, 8).replace("\n", " ") for k in range(9))
    for k in range(300, 312):
        rows.append((k, edited(prose(7, 120), r, 1), "s1"))  # near copies
        rows.append((k + 100, f"{prose(k, 60)}\n{block}\n{prose(k + 40, 60)}", "s2"))  # shared lines
        rows.append((k + 200, f"{prose(k + 80, 50)} {bench[k % 3][1]} {prose(k + 90, 50)}", None))  # leaks
    rows.append((990, rows[410 - 300][1], "s0"))
    return rows, marks, bench


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows, marks, bench = corpus()
    sf = str(tmp_path)
    frame(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    source = {d: s for d, _, s in rows}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    states = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{sf}/stage{k}")
        docs = spark.read.parquet(f"{sf}/stage{k}")
        states.append(docs)
    kept = [sorted((r["doc_id"], r["text"]) for r in s.select("doc_id", "text").collect()) for s in states[:4]]
    bad = {d for d, good, _ in marks if not good}
    assert {d for d, _ in kept[0]} == {d for d, _, _ in rows} - bad
    left = brute_chunks(spark, kept[0])
    assert kept[1] == sorted((d, t) for d, t, gone in left if words_of(t) or not gone)
    # The stage and the query of the operator remove the same.
    whole = {r["doc_id"]: r for r in line_chunks.dedup_lines(spark.read.parquet(f"{sf}/stage0")).collect()}
    assert {d: t for d, t in kept[1]}.items() <= {d: r["text"] for d, r in whole.items()}.items()
    assert all(r["n_chars"] == len(r["text"]) for r in states[1].select("n_chars", "text").collect())
    stay = {d for d, _, _, own in brute_near(kept[1], 5, 80) if own}
    assert kept[2] == [x for x in kept[1] if x[0] in stay] and len(kept[2]) < len(kept[1])
    leaked = {d for d, t in kept[2] if any(b in t.replace("\n", " ") for _, b in bench)}
    assert kept[3] == [x for x in kept[2] if x[0] not in leaked] and len(leaked) == 12
    mix = states[4].collect()
    assert {r["doc_id"]: r["size"] for r in mix} == {d: len(words_of(t)) for d, t in kept[3]}
    taken = {}
    for r in mix:
        key = (source[r["doc_id"]], r["target"])
        taken[key] = taken.get(key, 0) + r["taken"]
    assert all(abs(t - due) < 200 for (_, due), t in taken.items())
    again = queries.QUERIES["pipeline"](spark, sf)
    assert sorted(again.collect()) == sorted(mix)


def test_stages_take_empty_and_hard_tables(spark, tmp_path, hard, empty):
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, prose(77, 30))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, hard, sf)
        if name != "source_mix":
            assert out.columns == hard.columns and out.filter(F.col("doc_id") == 1).count() == 1
        assert stage(spark, empty, sf).count() == 0
        named = hard.selectExpr("*", "0.1D AS _score", "'z' AS _removed", "1 AS removed", "2 AS `row`", "3 AS _id", "4 AS contaminated")
        clashing = stage(spark, named, sf)
        assert name == "source_mix" or clashing.columns == named.columns
        assert clashing.count() == out.count()


def test_every_operator_has_its_query():
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in queries.QUERIES and set(queries.ORACLES) <= set(queries.QUERIES)
