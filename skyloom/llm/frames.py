"""Helpers of the corpus operators on DataFrames."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import cut_lineage, store

#: A sieve has this many rows of 64 bits, whatever it was made from.
SIEVE_ROWS = 1 << 16


#: Bytes of rows that are handed to Python at once; one longer row is handed over alone.
BATCH_BYTES = 8 << 20


def in_small_batches(job):
    """Run a job, whose first argument is the session, with Arrow batches bounded by ``BATCH_BYTES``: a
    batch of a fixed number of long texts would be held several times over, on both sides."""

    @functools.wraps(job)
    def bounded(spark: SparkSession, *args, **kwargs):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return job(spark, *args, **kwargs)

    return bounded


def doc_words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once for the row."""
    return F.transform(F.array(value), body)[0]


def fan_out(spark: SparkSession) -> int:
    """Number of partitions that the session deals shuffled rows to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _place(hashed: Column) -> tuple[Column, Column]:
    row = F.pmod(hashed, F.lit(SIEVE_ROWS)).cast("int")
    bit = F.pmod(F.shiftright(hashed, 20), F.lit(64)).cast("int")
    return row, F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def sieve_of(keys: DataFrame, hashed: Column) -> DataFrame:
    """Bitmap of 64-bit key hashes as a table of at most ``SIEVE_ROWS`` rows (one megabyte).

    Lets through every key it was made from and few others as long as keys are fewer than its
    bits; beyond that it lets more through, which costs time and nothing else.
    """
    row, bit = _place(hashed)
    return cut_lineage(keys.select(row.alias("_sieve_row"), bit.alias("_bit")).groupBy("_sieve_row").agg(F.bit_or("_bit").alias("_sieve_bits")))


def sieved(df: DataFrame, sieve: DataFrame, hashed: Column, name: str = "_maybe") -> DataFrame:
    """Add boolean ``name``: false only where the key is surely none of the sieve's. The sieve's
    size is bounded by its making, so it is broadcast and no row of ``df`` moves."""
    row, bit = _place(hashed)
    held = df.withColumn("_sieve_row", row).join(F.broadcast(sieve), "_sieve_row", "left")
    passes = F.coalesce(F.col("_sieve_bits").bitwiseAND(bit) != 0, F.lit(False))
    return held.withColumn(name, passes).drop("_sieve_row", "_sieve_bits")


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``ids`` (one column doc_id); null ids stay. Only
    documents that the sieve of the ids lets through are shuffled."""
    columns = docs.columns
    packed = docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("_row"))
    ids = ids.select(F.col("doc_id").alias("_gone"))
    marked = sieved(packed, sieve_of(ids, F.xxhash64("_gone")), F.xxhash64("_id"))
    stay = marked.filter(~F.col("_maybe"))
    asked = marked.filter("_maybe").join(ids, F.col("_id") == F.col("_gone"), "left_anti")
    return stay.unionByName(asked).select(*[F.col("_row").getField(c).alias(c) for c in columns])


def join_totals(df: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """``df`` with aggregates over the rows of equal ``key``, nulls together, however many share one.

    Keys that hold more than their share of the rows are few by arithmetic, so their totals are
    broadcast and their rows stay where they are; all other keys are joined by hash.
    """
    parts = 8 * fan_out(df.sparkSession)
    of_key = store(df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *[c.alias(n) for n, c in totals.items()]), "totals")
    n = of_key.agg(F.sum("_n")).first()[0] or 0
    hot = of_key.filter(F.col("_n") * parts >= n).drop("_n")  # at most `parts` rows
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), F.col(key).eqNullSafe(F.col("_key")), "left")
    done = marked.filter("_hot").select(*df.columns, *totals)
    rest = marked.filter("_hot IS NULL").select(*df.columns)
    cold = rest.join(of_key.filter(F.col("_n") * parts < n), F.col(key).eqNullSafe(F.col("_key")))
    return done.unionByName(cold.select(*df.columns, *totals))
