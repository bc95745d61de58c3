"""Tables of the lake: typed scans, partition-wise writes, run log, exports."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from skyloom.functions.scalars import parse_instant, payload_hash, utc_date
from skyloom.operators.ordered import BROADCAST_ROWS, match_null_safe
from skyloom.operators.upserts import insert_ignore, upsert
from skyloom.schemas import BRONZE_PAYLOAD, RUN_LOG
from skyloom.session import scratch_scoped, store

def scan_table(
    spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None
) -> DataFrame:
    """Read a parquet table under its declared schema; an absent one is empty, not an error."""
    full = schema
    if partition and partition not in schema.fieldNames():
        full = T.StructType([*schema.fields, T.StructField(partition, T.StringType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], full)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, *, column: str, lower: str, upper: str, parts: int,
    **options: str,
) -> DataFrame:
    """Read an external table in ``parts`` range slices of ``column``; filters reach the database."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=str(parts), **options,
    ).load()


# Columns of the availability catalogue.
CATALOGUE = {"data_id": "source", "min_date": "min_date", "max_date": "max_date"}


def scan_catalogue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(catalogue, rejected)`` of a CSV file or folder that says which source has which dates.

    The header is looked at first: a missing column raises, order and further columns do not
    matter, and files of one folder must agree. Rows whose cells do not fit the header, or whose
    source or dates cannot be read, are failure cases.
    """
    header = spark.read.option("header", True).csv(path).columns
    named = [h.strip().lower() for h in header]
    missing = [c for c in CATALOGUE if c not in named]
    if missing:
        raise ValueError(f"{path}: columns are absent: {missing}")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, "_corrupt"]])
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = spark.read.schema(schema).options(**options).csv(path).toDF(*named, "_corrupt")
    text = {c: F.nullif(F.trim(c), F.lit("")) for c in CATALOGUE}
    read = rows.select(
        "_corrupt",
        F.to_json(F.struct(*named)).alias("_row"),
        text["data_id"].alias("source"),
        *[text[c].try_cast("date").alias(c) for c in ("min_date", "max_date")],
    )
    failed = F.when(F.col("_corrupt").isNotNull(), "fits_header").when(F.col("source").isNull(), "not_null")
    for c in ("min_date", "max_date"):
        failed = failed.when(F.col(c).isNull(), "readable_date")
    judged = read.withColumn("_failed", failed)
    rejected = judged.where(F.col("_failed").isNotNull()).select(
        F.lit("catalogue").alias("failed_column"), F.col("_failed").alias("failed_check"),
        F.coalesce("_corrupt", "_row").alias("failed_value"),
    )
    return judged.where(F.col("_failed").isNull()).select(*CATALOGUE.values()), rejected


def context_window(df: DataFrame, day: str, days_back: int = 1, partition: str = "date") -> DataFrame:
    """Rows of the day and the ``days_back`` days before it; on a partition column this prunes
    directories."""
    last = dt.date.fromisoformat(day[:10])
    first = last - dt.timedelta(days=days_back)
    return df.where(F.col(partition).between(first.isoformat(), last.isoformat()))


def context_of(df: DataFrame, runs: DataFrame, days_back: int = 1, partition: str = "date") -> DataFrame:
    """Rows of each day of ``runs`` (a column named like the partition) and the ``days_back`` days before.

    The days are joined on the partition column, so a scan reads their folders alone although they are
    known only once ``runs`` has been read; their number is checked before they are sent to all tasks.
    """
    day = F.col(partition).cast("date")
    back = F.sequence(F.date_sub(day, days_back), day)
    days = runs.where(F.col(partition).isNotNull()).select(F.explode(back).alias("_day"))
    wanted = days.select(F.date_format("_day", "yyyy-MM-dd").alias(partition)).distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(wanted) if few else wanted, partition, "left_semi")


def observation_date(timestamp: str = "timestamp") -> Column:
    """Partition value of a row: the UTC date it was observed, never the date it was fetched.
    NULL where the time cannot be read."""
    return utc_date(parse_instant(timestamp))


def split_by_time(batch: DataFrame, timestamp: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """``(rows with their date, failure cases of rows whose time cannot be read)``."""
    dated = batch.withColumn("date", observation_date(timestamp))
    return dated.where(F.col("date").isNotNull()), unreadable_times(dated, timestamp)


def unreadable_times(dated: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Failure cases of the rows of a dated frame that have no date."""
    return dated.where(F.col("date").isNull()).drop("date").withColumns(
        {
            "failed_column": F.lit(timestamp),
            "failed_check": F.lit("readable_time"),
            "failed_value": F.col(timestamp).cast("string"),
        }
    )


def bronze_rows(df: DataFrame, *, payload: str, timestamp: str, fetched_at: Column) -> DataFrame:
    """Payloads with their content hash and date; a missing time takes the fetch time."""
    stamp = F.coalesce(F.nullif(F.col(timestamp), F.lit("")), fetched_at)
    return df.select(
        stamp.alias("payload_ts"),
        F.col(payload).alias("payload"),
        payload_hash(payload).alias("payload_hash"),
        *[F.col(c) for c in ("source", "is_synthetic")],
        F.substring(stamp, 1, 10).alias("date"),
    )


def _named(partition: str) -> Column:
    """Partition value as storage keeps it: a blank one is stored as NULL."""
    return F.nullif(F.col(partition).cast("string"), F.lit(""))


def in_touched_partitions(existing: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """Rows of ``existing`` in the partitions a batch touches, the NULL partition among them.

    The span of the touched names prunes directories, a null-safe semi-join then selects the
    partitions; both are the same for any number of them.
    """
    touched = batch.select(_named(partition).alias(partition)).distinct()
    span = touched.agg(
        F.min(partition).alias("low"), F.max(partition).alias("high"),
        F.bool_or(F.col(partition).isNull()).alias("unnamed"),
    ).first()
    within = F.col(partition).between(F.lit(span["low"]), F.lit(span["high"]))
    inside = within | F.col(partition).isNull() if span["unnamed"] else within
    return match_null_safe(existing.where(inside), touched, [partition], "left_semi")


def append_bronze(spark: SparkSession, batch: DataFrame, path: str) -> DataFrame:
    """Append payloads whose content the lake does not hold yet; returns the appended rows."""
    known = in_touched_partitions(scan_table(spark, path, BRONZE_PAYLOAD), batch, "date")
    keys = ["source", "date", "payload_hash"]
    fresh = store(insert_ignore(known, batch, keys, ["payload_ts"]), "fresh")
    by = ["source", "date"]
    fresh.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)
    return fresh


@scratch_scoped
def upsert_table(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    *,
    partition: str,
    keys: Sequence[str],
    order: Sequence[str],
    unique: bool = False,
) -> None:
    """Read-merge-write of the partitions the batch touches; running it twice changes nothing.

    ``unique`` says that the batch holds no key twice. The merge is written to the checkpoint folder
    before the table is touched, so the table is never overwritten while it is being read.
    """
    columns = [*schema.fieldNames()]
    if partition not in columns:
        columns.append(partition)
    incoming = batch.select(*columns, *[o for o in order if o not in columns]).withColumn(
        partition, _named(partition)
    )
    existing = scan_table(spark, path, schema, partition).select(*columns)
    affected = in_touched_partitions(existing, incoming, partition)
    merged = upsert(affected, incoming, [partition, *keys], order, unique=unique).select(*columns)
    overwrite_partitions(store(merged, "merged"), path, [partition])


def overwrite_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions present in ``df``; others stay.

    Rows are rebalanced by partition first: small partitions end in one file, and a partition
    that holds much of the table is split over many tasks.
    """
    out = df.hint("rebalance", *partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions
    ).parquet(path)


@scratch_scoped
def insert_ignore_table(
    spark: SparkSession, batch: DataFrame, path: str, schema: T.StructType, *,
    partition: str, keys: Sequence[str], order: Sequence[str],
) -> None:
    """Append rows whose key is new; what is stored is never changed. Equal keys must fall into
    equal partitions, so only those the batch touches are read."""
    columns = list(dict.fromkeys([*schema.fieldNames(), partition]))
    batch = batch.withColumn(partition, _named(partition))
    existing = in_touched_partitions(scan_table(spark, path, schema, partition), batch, partition)
    fresh = store(insert_ignore(existing, batch, keys, order).select(*columns), "fresh")
    fresh.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)


FAILURE_CASES = "source_key string, run_id string, row string, failed_column string, failed_check string, failed_value string"


def failure_rows(failures: DataFrame, source: str, run_id: str) -> DataFrame:
    """Failure cases of any feed in one schema: the row itself goes in as JSON."""
    told = ["failed_column", "failed_check", "failed_value"]
    row = F.to_json(F.struct(*[F.col(c) for c in failures.columns if c not in told]))
    return failures.select(
        F.lit(source).alias("source_key"), F.lit(run_id).alias("run_id"), row.alias("row"), *told
    )


def append_failures(path: str, source: str, run_id: str, *failures: DataFrame) -> None:
    """Keep the failure cases of a run, apart from every other run's; the same run again
    replaces its own."""
    rows = reduce(DataFrame.unionByName, [failure_rows(f, source, run_id) for f in failures])
    overwrite_partitions(rows, path, ["source_key", "run_id"])


class Outcome(NamedTuple):
    """What a run has to say for the log."""

    status: str
    rows: int = 0
    error: str | None = None


def outcome_of(returned) -> Outcome:
    """Read a job's return value: an outcome, its fields as a tuple, or a bare row count."""
    match returned:
        case (status, rows, error, *_):
            return Outcome(status, int(rows or 0), error)
        case int():
            return Outcome("success", int(returned))
        case None:
            return Outcome("failure", error="the job gave no result")
        case _:
            return Outcome("success")


def run_entry(
    spark: SparkSession, source: str, started_at: str, finished_at: str, result
) -> DataFrame:
    """The log row of one run."""
    told = outcome_of(result)
    return spark.createDataFrame(
        [(str(uuid.uuid4()), source, started_at, finished_at, *told)], RUN_LOG
    )


def log_run(spark: SparkSession, path: str, source: str, started_at: str, finished_at: str, result) -> None:
    run_entry(spark, source, started_at, finished_at, result).coalesce(1).write.mode("append").parquet(path)


def write_export(
    df: DataFrame,
    path: str,
    *,
    units: dict[str, str],
    notes: dict[str, object],
    partitions: Sequence[str] = (),
) -> None:
    """Self-describing export: units in the column metadata, notes beside the data."""
    described = df.select(
        *[
            F.col(c).alias(c, metadata={"unit": units[c]}) if c in units else F.col(c)
            for c in df.columns
        ]
    )
    dealt = described.hint("rebalance", *partitions)
    # Static: partitions of an earlier export that this one lacks must go.
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "zstd"
    ).partitionBy(*partitions).parquet(path)
    body = json.dumps({"units": units, **notes}, sort_keys=True)
    df.sparkSession.createDataFrame([(body,)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path.rstrip('/')}_notes")
