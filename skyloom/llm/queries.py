"""Registered queries of the corpus operators over the given tables, with SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import cube_mix, filter_audit, language_id, line_chunks, near_dups, quality_trees, rule_lists, substring_cover, template_decontam, toxicity_nb, trie_tokens, url_cascade, vector_codes
from skyloom.llm.frames import in_small_batches
from skyloom.llm.labels import held_out
from skyloom.session import load_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = in_small_batches(build)
    return build


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query
def op1_quality_trees(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load_table(spark, sf, "documents"), load_table(spark, sf, "labels")
    forest = quality_trees.fit_quality(docs, labels.filter(~held_out(F.col("doc_id"), 3, 1)))
    scored = quality_trees.with_quality(docs.select("doc_id", "text"), forest, keep=False)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op2_template_decontam(spark: SparkSession, sf: str) -> DataFrame:
    return template_decontam.mark_contaminated(load_table(spark, sf, "documents"), load_table(spark, sf, "benchmark"))


@query
def op3_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.near_duplicates(load_table(spark, sf, "documents"), shingle=2, percent=80)


@query
def op4_url_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return url_cascade.judge_urls(load_table(spark, sf, "pages"), URL_RULES)


ORACLES["op4_url_cascade"] = """
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT row_number() OVER () AS n, page_id,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT n, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN fit USING (n)
"""


@query
def op5_substring_cover(spark: SparkSession, sf: str) -> DataFrame:
    kept = substring_cover.dedup_substrings(load_table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Windows compared by their text, which SQL can hold at this size.
ORACLES["op5_substring_cover"] = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
spot AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM words WHERE len(w) >= 13),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM spot),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY s) AS later FROM win), range(13) r(k) WHERE later),
lost AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(js, i)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
"""


@query
def op6_trie_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return trie_tokens.count_tokens(load_table(spark, sf, "documents"))


@query
def op7_cube_mix(spark: SparkSession, sf: str) -> DataFrame:
    return cube_mix.mix_documents(load_table(spark, sf, "documents"))


@query
def op8_toxicity_nb(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load_table(spark, sf, "documents"), load_table(spark, sf, "labels")
    model = toxicity_nb.fit_toxicity(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0)))
    scored = toxicity_nb.with_toxicity(docs.select("doc_id", "text"), model, keep=False)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Per document what is left of it: lines, removed passages and the digest of the text."""
    left = line_chunks.dedup_lines(load_table(spark, sf, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        F.col("_removed").alias("n_chunks_removed"),
        F.length("text").cast("long").alias("n_chars_kept"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query
def op10_rule_lists(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = load_table(spark, sf, "documents"), load_table(spark, sf, "labels")
    judged = rule_lists.apply_rules(docs, rule_lists.rules_from(docs, labels))
    return judged.select("doc_id", *rule_lists.BASE, "base_failed", "kept", "rule")


@query
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = vector_codes.compress_vectors(load_table(spark, sf, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


# A part's position is its 16th of the vector; books hold (part, entry, position, value).
_ASSIGN = """
apart{k} AS (SELECT v.n, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x)) AS d FROM cut v JOIN book{k} b USING (part, pos) GROUP BY v.n, v.part, b.entry),
near{k} AS (SELECT n, part, min(d) AS d, min_by(entry, (d, entry)) AS entry FROM apart{k} GROUP BY n, part),
"""
_MOVE = """
mean{k} AS (SELECT a.part, a.entry, v.pos, sum(v.x) AS s, count(*) AS n FROM near{k} a JOIN cut v USING (n, part) GROUP BY a.part, a.entry, v.pos),
book{j} AS (SELECT b.part, b.entry, b.pos, CASE WHEN m.n IS NULL THEN b.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM book{k} b LEFT JOIN mean{k} m USING (part, entry, pos)),
"""
ORACLES["op11_vector_codes"] = (
    """
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v, row_number() OVER (ORDER BY vec_id, embedding) AS n
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
spot AS (SELECT n, len(v) // 16 AS w, v, unnest(range(len(v))) AS i FROM kept),
cut AS (SELECT n, i // w AS part, i % w AS pos, v[i + 1] AS x FROM spot),
book0 AS (SELECT part, n - 1 AS entry, pos, x FROM cut WHERE n <= 64),
"""
    + _ASSIGN.format(k=0)
    + _MOVE.format(k=0, j=1)
    + _ASSIGN.format(k=1)
    + _MOVE.format(k=1, j=2)
    + _ASSIGN.format(k=2)
    + """
code AS (SELECT n, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d) AS error FROM near2 GROUP BY n)
SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book2) AS codebooks_sha256
FROM kept JOIN code USING (n)
"""
)


@query
def op12_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(spark, sf, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    model = language_id.fit_languages(docs.filter("NOT held_out"))
    return language_id.with_language(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_filters(load_table(spark, sf, "documents"), load_table(spark, sf, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts),
masks AS (SELECT part, doc_id, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS m FROM words),
cells AS (SELECT part, m, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, m),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT part, o AS filter_order, s::INT AS step, o[s:s] AS f,
    sum(CASE WHEN translate(m, o[1:s], '') = m THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(m, o[s:s]) AND translate(m, o[1:s - 1], '') = m THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(m, o[s:s]) AND translate(m, o[1:s - 1], '') <> m THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN m = o[s:s] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(m, o[s:s]) AND translate(m, o[1:s - 1], '') = m THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(m, o[s:s]) AND translate(m, o[1:s - 1], '') = m THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, orders, range(1, 6) r(s) GROUP BY part, o, s)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM steps
"""


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
