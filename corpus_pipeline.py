"""From raw documents to a weighted mix in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes every result as
Parquet into the session's shared checkpoint folder and reads it back for the next stage. All but
the last return the columns they were given, whatever their names.

Defined cases, beside those of each operator: a null or empty text is scored as a text without words,
loses no line, is no near-duplicate and no leak, and has size 0; a row with a null doc_id is scored by
its text and then stays as it is; repeated rows are judged each, except that near-duplicates and leaks
go by doc_id, so rows that share one go together if any is to go; of equal documents the smallest doc_id
stays; with labels of one kind only, the classifier keeps or rejects all; an empty table passes through
every stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import cube_mix, line_chunks, near_dups, quality_trees, template_decontam
from skyloom.llm.frames import in_small_batches, without_ids
from skyloom.llm.labels import held_out
from skyloom.session import load_table, store


@in_small_batches
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = load_table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 3, 1))
    packed = docs.select(F.struct("*").alias("row"), "text")
    scored = quality_trees.with_quality(packed, quality_trees.fit_quality(docs, labels))
    return scored.filter("_score >= 0.5").select("row.*")


@in_small_batches
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go from the texts; a document of which no word is left goes too."""
    left = line_chunks.without_repeats(docs)
    emptied = (F.col("removed") > 0) & ~F.rlike("kept", F.lit(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        n = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("removed") > 0, n).otherwise(F.col("row.n_chars"))
    return left.filter(~emptied).select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


@in_small_batches
def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    judged = near_dups.near_duplicates(docs)
    return without_ids(docs, store(judged.filter("NOT kept").select("doc_id")))


@in_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return template_decontam.decontaminate(docs, load_table(spark, sf_dir, "benchmark"))


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources come to their target weights."""
    return cube_mix.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("source_mix", mix_sources),
]

#: The classifier, the hashed boundaries and the sampling have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
