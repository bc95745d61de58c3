"""Labelled rows to learn from, in bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import cut_lineage


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def sample_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id and ``label`` of at most ``rows`` documents, the least by hash; contradicting labels
    of a document cancel out."""
    once = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias(label), F.max(label).alias("_other"))
        .filter(F.col(label) == F.col("_other"))
    )
    return cut_lineage(once.select("doc_id", label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
