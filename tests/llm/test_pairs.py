"""Near-duplicates, substring dedup, line dedup and decontamination against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyloom.llm import components, exchange, frames, line_chunks, near_dups, substring_cover, template_decontam, text
from skyloom.llm.frames import sieve_of, sieved, without_ids

from .conftest import frame, prose, words_of


def test_words_and_windows_match_plain_python():
    r = random.Random(0)
    texts = ["".join(r.choice("ab \n\t\x0bé.") for _ in range(r.randint(0, 60))) for _ in range(200)] + [None, "", "a"]
    got = text.words_of(pa.array(texts))
    assert np.diff(got.first).tolist() == [len(words_of(t)) for t in texts]
    raw = got.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(got.starts, got.ends, strict=True)] == [w for t in texts for w in words_of(t)]
    hashes = text.word_hashes(got)
    assert len(set(hashes.tolist())) == len({w for t in texts for w in words_of(t)})
    at, h = text.windows(hashes, got.first, 3)
    want = [tuple(w[k : k + 3]) for w in map(words_of, texts) for k in range(len(w) - 2)]
    assert len(at) == len(want) and len(set(zip(h.tolist(), want, strict=True))) == len(set(want)) == len(set(h.tolist()))


def test_slabs_lose_no_rows(monkeypatch):
    monkeypatch.setattr(text, "SLAB_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["abc"] * 7 + [None, "x" * 50, "y"])], ["text"])
    parts = list(text.slabs([batch, batch.slice(0, 0)]))
    assert len(parts) > 3 and [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_a_sieve_never_loses_a_key(spark):
    keys = spark.range(0, 4000, 7)
    seen = sieved(spark.range(4000), sieve_of(keys, F.xxhash64("id")), F.xxhash64("id"))
    assert seen.filter("id % 7 = 0 AND NOT _maybe").count() == 0
    assert seen.filter("id % 7 != 0 AND _maybe").count() < 100


def test_without_ids_keeps_nulls_repeats_and_columns(spark, hard):
    left = without_ids(hard, spark.createDataFrame([(1,), (3,), (99,)], "doc_id long"))
    assert left.columns == hard.columns
    assert sorted((r[0] is None, r[0] or 0) for r in left.select("doc_id").collect()) == sorted((r[0] is None, r[0] or 0) for r in hard.select("doc_id").collect() if r[0] not in (1, 3))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 240)] + [(5, 5)]
    parent = {n: n for link in links for n in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {n: root(n) for link in links if link[0] != link[1] for n in link}
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def brute_near(rows, n, percent):
    sets = []
    for _, t in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(t)]
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), d), d)
    return sorted((d, len(sets[k]), least[root(k)], d == least[root(k)]) for k, (d, _) in enumerate(rows))


def edited(base, r, changes):
    w = base.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_match_all_pairs(spark, n):
    r = random.Random(n)
    base = [prose(k, 150) for k in range(6)]
    rows = [(k, edited(r.choice(base), r, r.randint(0, 12))) for k in range(150)] + [(200 + k, prose(k, 3)) for k in range(9)] + [(300, ""), (301, "a"), (302, "A")]
    got = near_dups.near_duplicates(frame(spark, rows), n, 80)
    assert sorted(map(tuple, got.collect())) == brute_near(rows, n, 80)


def test_near_duplicates_join_a_chain_across_hubs(spark, monkeypatch):
    """Neighbours in a chain are alike, its ends are not; no round of hubs may lose a link."""
    w = prose(5, 100).split()
    rows = []
    for k in range(40):
        w[(k * 7) % 100] = f"q{k}"
        w[(k * 7 + 1) % 100] = f"p{k}"
        rows.append((k, " ".join(w)))
    for rounds in (0, 2, 6):
        monkeypatch.setattr(near_dups, "HUB_ROUNDS", rounds)
        got = near_dups.near_duplicates(frame(spark, rows), 2, 80)
        assert sorted(map(tuple, got.collect())) == brute_near(rows, 2, 80)


def test_a_node_has_one_set(spark, monkeypatch):
    """Copies, rows that share an id and equal rows, with a sieve that lets everything through."""
    monkeypatch.setattr(frames, "SIEVE_ROWS", 1)
    a, b = prose(1, 80), prose(2, 80)
    rows = [(k, a) for k in range(40)] + [(k, b) for k in range(40, 60)] + [(3, b), (3, b), (3, a), (70, prose(7, 80))]
    docs = frame(spark, rows).select("doc_id", "text")
    _, nodes = near_dups._signed(docs, 5)
    assert nodes.count() == 3
    sets = near_dups._full(docs, nodes.select("node", "least_id"), 5)
    assert sorted(r["node"] for r in sets.collect()) == sorted(r["node"] for r in nodes.collect())


def test_clusters_in_blocks_lose_no_link(spark, monkeypatch):
    """Families of texts on one common passage, compared in small blocks of several levels."""
    monkeypatch.setattr(near_dups, "BLOCK_NODES", 4)
    monkeypatch.setattr(near_dups, "HUB_ROUNDS", 0)
    r = random.Random(5)
    passage, rows = prose(50, 60), []
    for family in range(8):
        base = passage + " " + prose(60 + family, 30 + 25 * family)
        for _ in range(9):
            rows.append((len(rows) * 3 % 73, edited(base, r, r.choice([0, 1, 4]))))
    got = near_dups.near_duplicates(frame(spark, rows), shingle=2).collect()
    assert sorted(tuple(x) for x in got) == sorted(brute_near(rows, 2, 80))


def test_near_duplicates_hard_cases(spark, hard, empty):
    got = near_dups.near_duplicates(hard, 2, 80)
    by = collections.defaultdict(set)
    for row in got.collect():
        by[row["doc_id"]].add((row["component_id"], row["kept"]))
    assert got.count() == hard.count() and got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert by[2] == {(1, False)} and by[13] == {(3, False)} and by[3] == {(3, True)}
    assert by[None] == {(None, True)} and by[4] == {(4, True)} and by[5] == {(5, True)}
    assert near_dups.near_duplicates(empty).count() == 0


def test_fewest_matches_are_safe():
    least = near_dups.fewest_matches(0.8)
    assert least == sorted(least) and 0 < least[0] < near_dups.BATCH and least[-1] < 0.8 * near_dups.BANDS * near_dups.ROWS


def brute_substrings(rows):
    first = {}
    for d, t in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            s = tuple(w[k : k + 13])
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        w = words_of(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < d for j in range(k, k + 13)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((d, " ".join(kept), len(w), len(gone)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_match_brute_force(spark, seed):
    r = random.Random(seed)
    shared = [prose(100 + k, n) for k, n in enumerate((12, 13, 14, 20, 60))]
    rows = [(k * 3 % 101, " ".join([prose(k, r.randint(0, 30)), r.choice(shared), prose(k + 500, r.randint(0, 30)), *([r.choice(shared)] * r.randint(0, 2))])) for k in range(80)]
    rows += [(200, "a " * 40), (201, "a " * 13), (202, "a " * 12)]
    got = substring_cover.dedup_substrings(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_substrings(rows)


def test_cover_anchors_every_equal_window():
    assert {(a - b) % substring_cover.PERIOD for a in substring_cover.COVER for b in substring_cover.COVER} == set(range(substring_cover.PERIOD))


def test_arrays_beyond_the_bound_are_split(monkeypatch):
    r = np.random.default_rng(1)
    hashes, docs = r.integers(0, 2**63, 1000).astype(np.uint64), r.integers(0, 40, 1000)
    part = docs % 3
    part[:700] = 1  # one part holds more than a row can
    for most in (50, 10**6):
        monkeypatch.setattr(exchange, "MOST", most)
        got = list(exchange.packed(exchange.PAIRS, 3, part, hashes, docs, hashes ^ np.uint64(5)))
        assert all(b.column("hashes").nbytes < 8 * most + 99 * 8 for b in got) and (len(got) > 15) == (most == 50)
        back = [[], [], []]
        for b in got:
            for p, h, c, d in zip(*(b.column(x).to_pylist() for x in ("part", "hashes", "checks", "docs"))):
                back[p] += list(zip(*(np.frombuffer(x, dtype=np.int64).tolist() for x in (h, c, d))))
        for p in range(3):
            assert back[p] == list(zip(hashes[part == p].view(np.int64).tolist(), (hashes ^ np.uint64(5))[part == p].view(np.int64).tolist(), docs[part == p].tolist()))
    monkeypatch.setattr(exchange, "MOST", 60)
    told = [x for b in exchange.answers(docs, hashes) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert [d for d, _ in told] == sorted(set(docs.tolist())) and sum(len(h) for _, h in told) == 8000
    with pytest.raises(OverflowError):
        exchange.binaries(hashes, np.array([0, 61]))


def test_substrings_with_many_small_parts(spark, monkeypatch):
    monkeypatch.setattr(exchange, "PART_BYTES", 500)
    monkeypatch.setattr(exchange, "MOST", 64)
    base = prose(5, 300)
    rows = [(k, prose(100 + k, 40) + " " + base[k * 9 : k * 9 + 500] + " " + prose(200 + k, 30)) for k in range(30)]
    got = substring_cover.dedup_substrings(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute_substrings(rows)


def test_substrings_hard_cases(spark, hard, empty):
    got = {}
    for row in substring_cover.dedup_substrings(hard).collect():
        got.setdefault(row["doc_id"], []).append(row)
    assert sum(map(len, got.values())) == hard.count()
    assert all(r["n_removed"] == 0 for r in got[1] + got[None] + got[3]) and len(got[3]) == 2
    assert got[2][0]["kept"] == "" and got[4][0]["n_words"] == 0 and got[11][0]["kept"] == ""
    assert substring_cover.dedup_substrings(empty).count() == 0


def chunks_of(spark, texts):
    """Chunks of each text as the operator cuts it."""
    df = frame(spark, list(enumerate(texts)))
    cut = line_chunks._split(df).select("id", line_chunks.chunks(line_chunks.line_hashes(F.col("lines")), line_chunks._word_lines(F.col("lines"))).alias("c"))
    return {r["id"]: [tuple(c) for c in r["c"]] for r in cut.collect()}


def brute_chunks(spark, rows):
    """Rows of (doc_id, text) without the chunks that stand earlier, each match carried on to the
    neighbouring boundaries; and the number of passages that went."""
    rows = sorted(rows)
    cut = chunks_of(spark, [t for _, t in rows])
    lines = [t.split("\n") for _, t in rows]
    first, out = {}, []
    for k, (d, _) in enumerate(rows):
        lost = set()
        for at, to, low, high in cut[k]:
            chunk = tuple(lines[k][at : to + 1])
            j, a, z, before, after = first.setdefault(chunk, (k, at, to, low, high))
            if (j, a) == (k, at) or (j == k and at <= z):
                continue
            while at - 1 > low and a - 1 > before and lines[k][at - 1] == lines[j][a - 1]:
                at, a = at - 1, a - 1
            while to + 1 < high and z + 1 < after and lines[k][to + 1] == lines[j][z + 1]:
                to, z = to + 1, z + 1
            lost.update(range(at, to + 1))
        out.append((d, "\n".join(x for i, x in enumerate(lines[k]) if i not in lost), len(lost - {i + 1 for i in lost})))
    return out


def brute_passages(rows):
    """Indexes of the lines of each row that stand, with a neighbour, at an earlier place."""
    first, out = {}, {}
    for d, text in sorted(rows):
        lines = text.split("\n")
        w = [i for i, x in enumerate(lines) if words_of(x)]
        out[d] = set()
        for k, (a, b) in enumerate(zip(w, w[1:])):
            at = first.setdefault("\n".join(lines[a : b + 1]), (d, k))
            if at not in ((d, k), (d, k - 1)):
                out[d].update(range(a, b + 1))
    return out


def line_corpus():
    r = random.Random(4)
    lines = [prose(k, 6).replace("\n", " ") for k in range(60)]
    block = lines[:12]
    rows = []
    for k in range(60):
        own = [f"own {k} {j}" for j in range(r.randint(0, 5))]
        at = r.randrange(len(own) + 1)
        rows.append((k * 7 % 61, "\n".join(own[:at] + (block if r.random() < 0.6 else []) + own[at:] + r.sample(lines, 3))))
    return [*rows, (100, "\n\n\n\n"), (101, "\n\n\n\n"), (102, "\n".join(block * 2)), (103, "q q\n" * 3), (104, "z z\n" * 9), (105, "a\nb\n" * 5)]


@pytest.mark.parametrize("share", [(15, 16), (1, 2), (1, 4)])
def test_line_chunks_match_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(line_chunks, "HITS", share[0])
    monkeypatch.setattr(line_chunks, "OF", share[1])
    got = line_chunks.dedup_lines(frame(spark, line_corpus())).select("doc_id", "text", "_removed")
    want = brute_chunks(spark, line_corpus())
    assert sorted(map(tuple, got.collect())) == want and sum(x[2] for x in want) > 30


def runs_of_lines():
    """Runs of 2 to 6 lines, each in several documents amid other lines."""
    r = random.Random(11)
    lines = [prose(k, 6).replace("\n", " ") for k in range(700)]
    runs = [lines[7 * k : 7 * k + 2 + k % 5] for k in range(100)]
    rows = []
    for k in range(300):
        rows.append((k, "\n".join([f"own {k} a", *runs[k % 100], f"own {k} b", "", *runs[r.randrange(100)], f"own {k} c"])))
    return rows


def test_repeated_runs_go_from_their_first_to_their_last_line(spark):
    rows = runs_of_lines()
    want = brute_passages(rows)
    got = {r["id"]: set(r["gone"]) for r in line_chunks.repeated_lines(frame(spark, rows)).collect()}
    text = dict(rows)
    for d, lost in got.items():  # nothing else goes but a blank line that stands beside a passage at both places
        assert all(not words_of(text[d].split("\n")[i]) for i in lost - want[d])
    found, due = collections.Counter(), collections.Counter()
    for d, text in rows[100:]:
        lines = text.split("\n")
        a = lines.index(f"own {d} b") - 1  # the first run is the one every third document has
        due[a] += 1
        found[a] += set(range(1, a + 1)) <= got.get(d, set())
    for n, least in ((2, 0.7), (3, 0.9), (4, 0.95), (5, 0.95), (6, 0.95)):
        assert found[n] >= least * due[n], (n, found[n], due[n])


def test_line_chunks_compare_bytes(spark, monkeypatch):
    """Where hashes hardly tell lines apart, nothing but equal lines may go."""
    monkeypatch.setattr(line_chunks, "line_hash", lambda line, salt=0: F.pmod(F.xxhash64(F.lit(salt), line), F.lit(3)))
    monkeypatch.setattr(line_chunks, "HITS", line_chunks.OF)
    rows = runs_of_lines()[:120]
    want = brute_passages(rows)
    lost = {r["id"]: set(r["gone"]) for r in line_chunks.repeated_lines(frame(spark, rows)).collect()}
    assert all(not words_of(dict(rows)[d].split("\n")[i]) for d, gone in lost.items() for i in gone - want[d])


def test_boundaries_resist_shifts(spark):
    lines = [f"line {k} {hashlib.md5(str(k).encode()).hexdigest()}" for k in range(200)]
    texts = [lines, ["new", *lines[:100], "more", *lines[100:]]]
    cut = chunks_of(spark, ["\n".join(t) for t in texts])
    a, b = ({tuple(t[c[0] : c[1] + 1]) for c in cut[k]} for k, t in enumerate(texts))
    assert len(a & b) > 0.95 * len(a) and len(cut[0]) < 199  # some lines are no boundary


def test_line_chunks_hard_cases(spark, hard, empty):
    got = line_chunks.dedup_lines(hard)
    assert got.columns == [*hard.columns, "_removed"] and got.count() == hard.count()
    by = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert by[1]["_removed"] == 0 and by[2]["text"].strip() == "" and by[4]["text"] is None and by[3]["_removed"] == 0
    assert got.filter("doc_id IS NULL AND _removed > 0").count() == 0
    assert line_chunks.dedup_lines(empty).count() == 0
    named = hard.selectExpr("*", "'z' AS _removed", "1 AS gone", "2 AS id", "3 AS part", "4 AS `row`", "5 AS kept_", "6 AS lines")
    again = line_chunks.dedup_lines(named)
    assert again.columns.count("_removed") == 1 and sorted(r["text"] or "" for r in again.collect()) == sorted(r["text"] or "" for r in got.collect())


def test_a_line_in_every_document_moves_nothing(spark):
    """A chunk of two lines that most documents share, and very long texts."""
    rows = [(k, f"own {k}\nshared one\nshared two\nother {k}") for k in range(400)] + [(1000, "\n".join(f"l {k % 4000}" for k in range(9000)))]
    got = {r["doc_id"]: r["text"] for r in line_chunks.dedup_lines(frame(spark, rows)).collect()}
    assert all(got[k] == f"own {k}\nother {k}" for k in range(1, 400)) and got[0] == rows[0][1]
    assert got[1000] == "\n".join(f"l {k}" for k in range(4000))


ITEM = "If a train with 12 wagons leaves town at 7 and Alice walks 3 km after which Alice takes a bus how long does Alice wait there"


def test_decontamination_finds_templates(spark):
    other = ITEM.replace("12", "40").replace("7", "9").replace("3 km", "5 miles").replace("Alice", "Robert")
    torn = other.replace("Robert takes", "Maria takes")  # one slot is filled inconsistently
    bench = spark.createDataFrame([(5, ITEM), (6, "too short"), (7, "what is the name of it"), (None, ITEM), (8, None)], "item_id long, text string")
    rows = [(1, prose(1, 40) + " " + ITEM + " " + prose(2, 30)), (2, prose(3, 20) + ". " + other), (3, prose(4, 200)), (4, "so: what is the name of it now"), (5, ITEM.split(" how ")[0][:40]), (None, ITEM), (6, None), (7, "")]
    got = {r["doc_id"]: r for r in template_decontam.mark_contaminated(frame(spark, rows), bench).collect()}
    assert {d for d, r in got.items() if r["contaminated"]} == {1, 2, 4}
    assert got[2]["first_item"] == 5 and got[4]["first_item"] == 7 and got[3]["n_items"] == 0
    assert not got[3]["contaminated"]
    assert not marked(spark, [ITEM], [torn])[0]["contaminated"]  # half of its windows agree, the others contradict them
    pattern = [{r["code"] for r in spark.createDataFrame([(1, t)], "item_id long, text string").mapInArrow(template_decontam._item_windows, "item_id long, n int, template long, code long").collect()} for t in (ITEM, other, torn)]
    assert pattern[0] == pattern[1] and pattern[2] != pattern[0]


def marked(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = template_decontam.mark_contaminated(frame(spark, list(enumerate(texts))), bench).collect()
    return {r["doc_id"]: r for r in got}


def test_names_at_sentence_starts_quotes_and_wraps(spark):
    apples = "Janet has 3 apples. Tom gives her 5 more. How many apples does she have now?"
    france = "What is the capital of France?"
    walk = "we saw that Alice and Robert went with Maria and Peter to the market near Vienna before Susan came"
    names = ["Alice", "Robert", "Maria", "Peter", "Vienna", "Susan"]
    wrapped = walk
    for name in names:
        wrapped = wrapped.replace(f" {name}", f"\n{name}")
    texts = [
        prose(1, 30) + " " + apples.replace("Janet", "Olga").replace("Tom", "Henry").replace("3", "8").replace("5", "2"),
        f'The quiz asked, "{france}" and nobody knew',
        prose(2, 30) + " " + wrapped,
        "so what is the capital of Spain he said",
        prose(3, 60),
        prose(5, 20) + " they ask: what is the capital of Peru? Nobody knows",
        "What Is The Capital Of France " * 3,
    ]
    got = marked(spark, [apples, france, walk], texts)
    assert [got[k]["first_item"] for k in range(6)] == [0, 1, 2, 1, None, 1]


def test_every_item_is_found_word_for_word(spark):
    inner = "these seven quiet birds sang below that old bridge"
    items = [prose(1, 40) + " " + inner + " " + prose(2, 40), inner, "Paris, Lima", "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan 12 kg 5", "法国的首都是哪里？", prose(1, 40) + " " + inner + " " + prose(2, 40), "Who wrote the novel Emma?", " ... "]
    texts = [prose(3, 30) + " " + inner + " " + prose(4, 30), "to paris lima", "x " + items[3] + " y", "请问法国的\n首都是哪里？谢谢", items[0], 'asked, "Who wrote the novel Emma?" twice', "Lima Paris 法国的首都", "... , ...", ""]
    got = marked(spark, items, texts)
    assert [got[k]["first_item"] for k in range(9)] == [1, 2, 3, 4, 0, 6, None, None, None]
    assert got[4]["n_items"] == 3 and got[0]["n_items"] == 1


def test_rows_that_share_an_id_are_judged_together(spark):
    bench = spark.createDataFrame([(5, ITEM)], "item_id long, text string")
    half = ITEM.split()
    other = ITEM.replace("Alice", "Robert")
    rows = [(1, prose(1, 30)), (1, ITEM), (1, ITEM), (2, " ".join(half[:14])), (2, " ".join(half[10:])), (3, " ".join(half[:12])), (4, other), (4, prose(3, 20))]
    got = template_decontam.mark_contaminated(frame(spark, rows), bench).collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["contaminated"]) for r in got} == {(1, True), (2, True), (3, False), (4, True)}
    assert template_decontam.decontaminate(frame(spark, rows), bench).count() == 1


def test_one_word_items_ask_for_a_line(spark):
    texts = ["the Yes of it", "first\n yes! \nlast", "yes", "yes yes", "no\nyes\tyes", "都", "首都", "x\n都。\ny", "a\nyes"]
    got = marked(spark, ["Yes", "都"], texts)
    assert [got[k]["first_item"] for k in range(9)] == [None, 0, 0, None, None, 1, None, 1, 0]


def brute_template(words):
    """(literal, value) per word: the literal is None for a slot. No word opens a sentence but the first."""
    out = []
    for k, w in enumerate(words):
        bare = w.strip(".,!?")
        kind = "#" if bare[:1].isdigit() else "unit" if bare.lower() in template_decontam.UNITS else "name" if bare[:1].isupper() and len(bare) > 1 and k else None
        out.append((kind or bare.lower(), bare.lower() if kind else None))
    return out


def brute_windows(words):
    t = brute_template(words)
    n = min(template_decontam.WINDOW, len(t))
    found = []
    for k in range(len(t) - n + 1):
        part = t[k : k + n]
        if sum(v is None for _, v in part) >= template_decontam.LEAST_LITERALS:
            values = [v for _, v in part if v is not None]
            found.append((k, tuple(x for x, _ in part), tuple(values.index(v) for v in values), values))
    return found


def brute_contaminated(item, words):
    mine, text = brute_windows(item), brute_windows(words)
    hits = [(k, a, va, vb) for k, (a, lit, pat, va) in enumerate(mine) for b, lit2, pat2, vb in text if lit == lit2 and pat == pat2]
    keys = {k: (m[1], m[2]) for k, m in enumerate(mine)}
    total = len(set(keys.values()))
    same = {keys[k] for k, _, va, vb in hits if va == vb}
    mapping = {}
    for _, _, va, vb in hits:
        for x, y in zip(va, vb):
            mapping.setdefault(x, set()).add(y)
    firm = all(len(v) == 1 for v in mapping.values()) and len({next(iter(v)) for v in mapping.values()}) == len(mapping)
    return len(same) >= 0.5 * total or (firm and len({keys[k] for k, *_ in hits}) >= 0.5 * total)


def test_decontamination_matches_brute_force(spark):
    """Items copied, asked again with other values, torn, cut and mixed, one copy a text."""
    r = random.Random(21)
    names, plain = ["Alice", "Robert", "Maria", "Peter", "Susan", "Olga"], [f"w{chr(97 + k)}{chr(97 + k // 7)}s" for k in range(40)]
    items = []
    for k in range(25):
        slots = r.sample(names, 2) + [str(r.randint(2, 99)) for _ in range(2)] + ["km"]
        items.append([plain[(3 * k + j) % 40] if j % 3 or j == 0 else r.choice(slots) for j in range(r.randint(9, 30))])
    texts = []
    for k in range(150):
        words = list(items[k % 25])
        other = dict(zip(names, r.sample(names, 6), strict=True)) | {str(n): str(n + 100) for n in range(100)} | {"km": "miles"}
        if k % 5:
            words = [other.get(w, w) for w in words]
        if k % 5 == 2:  # filled in differently somewhere
            at = [j for j, w in enumerate(words) if w in names]
            if at:
                words[r.choice(at)] = "Zoe"
        if k % 5 == 3:
            words = words[: max(8, len(words) * 2 // 3)]
        texts.append(["and", *[f"x{r.randrange(99)}y" for _ in range(9)], *words, *[f"z{r.randrange(99)}y" for _ in range(9)]])
    got = marked(spark, [" ".join(i) for i in items], [" ".join(t) for t in texts])
    want = {k: any(brute_contaminated(i, t) for i in items) for k, t in enumerate(texts)}
    wrong = [k for k in want if want[k] != got[k]["contaminated"]]
    # A torn copy is a matter of degree: windows that contradict the rest are taken off, here one is enough.
    assert all(k % 5 == 2 for k in wrong) and len(wrong) <= 6, wrong
    assert sum(want.values()) > 80 and all(got[k]["contaminated"] for k in want if k % 5 in (0, 1, 4))


def test_copies_of_one_item_do_not_contradict_each_other():
    at, values = list(range(6)), [[1], [1], [2], [2], [1], [3]]
    one, two = [[11], [11], [12], [12], [11], [13]], [[21], [21], [22], [22], [21], [23]]
    agree = template_decontam.agreeing_windows
    assert agree(at, at, [100 + a for a in at], values, one) == 6
    assert agree(at * 2, at * 2, [100 + a for a in at] + [500 + a for a in at], values * 2, one + two) == 6
    torn = [[11], [11], [12], [12], [99], [13]]
    assert agree(at, at, [100 + a for a in at], values, torn) == 4  # one contradicts, five agree
    assert agree(at, at, [100 + a for a in at], values, [[11], [11], [11], [11], [11], [13]]) == 2  # two values become one
    assert agree(at, at, [100 + a for a in at], values, values[:4] + [[8], [9]]) == 4  # word for word


def test_large_benchmarks_meet_through_salted_keys(spark, monkeypatch):
    before = {k: r["first_item"] for k, r in marked(spark, [ITEM, prose(9, 40)], [ITEM, prose(9, 40) + " x", prose(3, 50)]).items()}
    monkeypatch.setattr(template_decontam, "BROADCAST_WINDOWS", 3)
    assert before == {k: r["first_item"] for k, r in marked(spark, [ITEM, prose(9, 40)], [ITEM, prose(9, 40) + " x", prose(3, 50)]).items()} == {0: 0, 1: 1, 2: None}


def test_readings_of_crowded_openers_stay_bounded(monkeypatch):
    batch = pa.array(["Yes we. No they. " * 300, "Go. " * 50])
    whole = [np.concatenate(x) for x in zip(*[(a, m, h) for _, a, m, h, _ in template_decontam.window_codes(text.words_of(batch), [8])])]
    monkeypatch.setattr(template_decontam, "BLOCK_READINGS", 64)
    small = [np.concatenate(x) for x in zip(*[(a, m, h) for _, a, m, h, _ in template_decontam.window_codes(text.words_of(batch), [8])])]
    assert sorted(zip(*map(list, whole))) == sorted(zip(*map(list, small))) and len(whole[0]) > 1000


def test_decontamination_hard_cases(spark, hard, empty):
    bench = spark.createDataFrame([(1, prose(2, 90))], "item_id long, text string")
    got = template_decontam.mark_contaminated(hard, bench)
    assert got.count() == hard.count()
    assert {r[0] for r in got.filter("contaminated").select("doc_id").collect()} == {3, 11, 13}
    left = template_decontam.decontaminate(hard, bench)
    assert left.columns == hard.columns and left.filter("doc_id IS NULL").count() == 2
    assert template_decontam.mark_contaminated(hard, bench.limit(0)).filter("contaminated").count() == 0
    assert template_decontam.mark_contaminated(empty, bench).count() == 0
