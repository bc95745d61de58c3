"""The polling jobs as Structured Streaming: payload dedup, hourly index, incremental quality
control, silver upserts and freshness of the monitored jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.scalars import air_quality_index, index_category, parse_instant, payload_hash
from skyloom.operators.contracts import Contract, validate
from skyloom.operators.ordered import match_null_safe
from skyloom.operators.quality import MetricRule
from skyloom.plans.health import freshness_of, newest_outcomes, recent_outcomes, with_instants
from skyloom.plans.silver import qc_with_context
from skyloom.session import cut_lineage, scratch_scope, store
from skyloom.sources.lake import (
    append_failures,
    context_window,
    in_touched_partitions,
    observation_date,
    overwrite_partitions,
    scan_table,
    split_by_time,
    upsert_table,
)


def dedup_payloads(stream: DataFrame, *, timestamp: str, payload: str, delay: str) -> DataFrame:
    """Payload stream without repeats of ``(timestamp, hash)`` inside the watermark delay."""
    return (
        stream.withColumns(
            {"event_time": parse_instant(timestamp), "payload_hash": payload_hash(payload)}
        )
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark([timestamp, "payload_hash"])
    )


def hourly_index(stream: DataFrame, *, delay: str = "2 hours") -> DataFrame:
    """Hourly index per city; late readings count until the watermark passes their hour.

    ``stream``: ``ts, city, station_id, pm25_clean, pm10_clean, source, is_synthetic``. Readings
    are summed per station first, so the hour counts its stations exactly; state is a few
    numbers per station and hour, then per city and hour.
    """
    rows = stream.where((F.col("is_synthetic") == 0) & F.col("city").isNotNull()).withColumn(
        "aqi", air_quality_index("pm25_clean", "pm10_clean", "source")
    )
    means = ("pm25", "pm10")
    stations = rows.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour"), "city", "station_id").agg(
        *[F.sum(f"{m}_clean").alias(f"{m}_sum") for m in means],
        *[F.count(f"{m}_clean").alias(f"{m}_n") for m in means],
        F.max("aqi").alias("aqi"),
        F.count(F.lit(1)).alias("n"),
    )
    hours = stations.groupBy(F.window(F.window_time("window"), "1 hour"), "city").agg(
        *[(F.sum(f"{m}_sum") / F.nullif(F.sum(f"{m}_n"), F.lit(0))).alias(f"{m}_mean") for m in means],
        F.max("aqi").alias("aqi_max"),
        F.count("station_id").alias("n_stations"),
        F.sum("n").alias("n_readings"),
    )
    return hours.select(
        "city", F.col("window.start").alias("hour_start"), "pm25_mean", "pm10_mean", "aqi_max",
        index_category("aqi_max").alias("aqi_category"), "n_stations", "n_readings",
    )


def scratch_batch(
    spark: SparkSession, run: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """The batch function with its intermediate tables removed after every batch."""

    def scoped(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            run(batch, batch_id)

    return scoped


def run_name(spark: SparkSession, batch_id: int) -> str:
    """Name of the batch that is being run: the stream's own id, which lives in its checkpoint, and the
    batch's. A replayed batch has the same name, another stream's batch of that number has not."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{batch_id}" if stream else str(batch_id)


def quality_sink(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rules: Sequence[MetricRule],
    *,
    station: str,
    time: str,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch quality control for ``foreachBatch``.

    Between batches only the last readings of each series are kept: as many as the longest
    flatline window looks back. A batch is checked behind those rows by the batch operator,
    which also splits a series that floods a batch. Rows already written are not flagged
    after the fact, so the first readings of a long run stay unflagged; the batch build is
    the reference for them. Flags are keyed by station and time: a reading polled again, or a
    stream begun anew, replaces its row. The tails table has two slots, so a replayed batch
    still finds the tail of the batch before it.
    """
    back = max([r.flat_window or 1 for r in rules] + [2]) - 1
    raw = [station, time, *[r.column for r in rules]]
    tail_schema = T.StructType([*[schema[c] for c in raw], T.StructField("batch_id", T.LongType())])

    def run(batch: DataFrame, batch_id: int) -> None:
        tails = scan_table(spark, f"{path}/tails", tail_schema, "slot")
        own = str(batch_id % 2)
        # The first batch of a stream follows whatever an earlier stream left.
        before = F.lit(True) if batch_id == 0 else (F.col("slot") != own) & (F.col("batch_id") == batch_id - 1)
        context = store(tails.where(before).select(*raw).dropDuplicates([station, time]))
        incoming = store(batch.select(*raw).withColumn("date", observation_date(time)))
        # A reading that is stored as it comes keeps the flags it has.
        flags = scan_table(spark, f"{path}/flags", T.StructType([schema[c] for c in raw]), "date")
        touched = in_touched_partitions(flags, incoming, "date")
        incoming = incoming.drop("date")
        fresh = store(match_null_safe(incoming, touched.select(*raw), raw, "left_anti"))
        flagged = qc_with_context(fresh, context, rules, station=station, time=time)
        dated = store(flagged.withColumn("date", observation_date(time)))
        upsert_table(
            spark, dated, f"{path}/flags", dated.schema, partition="date", keys=[station, time], order=[time],
            unique=True,  # as every batch that went through the context step
        )
        newest = Window.partitionBy(station).orderBy(F.desc(time))
        # A rank below a constant is cut inside every task before rows are shuffled.
        kept = (
            context.unionByName(incoming)
            .dropDuplicates([station, time])
            .withColumn("_rank", F.row_number().over(newest))
            .where(F.col("_rank") <= back)
            .drop("_rank")
        )
        told = cut_lineage(kept).withColumns({"batch_id": F.lit(batch_id).cast("long"), "slot": F.lit(own)})
        overwrite_partitions(told, f"{path}/tails", ["slot"])

    return scratch_batch(spark, run)


def silver_sink(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rules: Sequence[MetricRule],
    contract: Contract | None,
    *,
    station: str,
    tags: dict[str, object],
    failures_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch silver upsert for ``foreachBatch``: quality control behind the stored days,
    contract, then a keyed upsert that a replay leaves unchanged."""

    def run(batch: DataFrame, batch_id: int) -> None:
        dated, unreadable = split_by_time(store(batch))
        first, last = dated.agg(F.min("date"), F.max("date")).first()
        if first is None:
            if failures_path and not unreadable.isEmpty():
                append_failures(failures_path, path.rsplit("/", 1)[-1], run_name(spark, batch_id), unreadable)
            return
        stored = scan_table(spark, path, schema, "date").where(F.col("date") <= last)
        context = context_window(stored, last, _days_between(first, last) + 1)
        # Read by the valid and by the failed side.
        checked = store(
            qc_with_context(dated, context, rules, station=station, time="timestamp")
        )
        valid, failed = validate(
            checked.withColumns({c: F.lit(v) for c, v in tags.items()}), contract
        )
        if failures_path:
            append_failures(
                failures_path, path.rsplit("/", 1)[-1], run_name(spark, batch_id), failed, unreadable
            )
        upsert_table(
            spark, valid, path, schema, partition="date", keys=[station, "timestamp"],
            order=["timestamp"], unique=True,
        )

    return scratch_batch(spark, run)


_NEWEST = "source string, _last_success timestamp, last_error_status string, last_error string, clock timestamp, batch_id long"
_RECENT = "source string, _run_started_at timestamp, status string, rows_inserted bigint, batch_id long"


def newest_runs(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest success and newest problem of each source, for a stream in update mode: the state is one
    row per source however long the log is. ``clock`` is the latest start seen."""
    return with_instants(log).groupBy("source").agg(
        *newest_outcomes(order), F.max("_run_started_at").alias("clock")
    )


def newest_sink(spark: SparkSession, path: str, sources: DataFrame) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` of ``newest_runs``: keeps the newest row of every source and writes, after each
    batch, the freshness of all monitored ``sources``, also of those that never ran, as of the latest
    start seen so far."""

    def run(changed: DataFrame, batch_id: int) -> None:
        before = _slot_before(spark, f"{path}/newest", _NEWEST, batch_id)
        fresh = store(changed)
        rows = store(before.join(fresh, "source", "left_anti").unionByName(fresh))
        _write_slot(rows, f"{path}/newest", batch_id)
        clock = rows.agg(F.max("clock")).first()[0]
        if clock is not None:
            report = freshness_of(rows.drop("clock"), sources, F.lit(clock)).withColumn("as_of", F.lit(clock))
            report.coalesce(1).write.mode("overwrite").parquet(f"{path}/report")

    return scratch_batch(spark, run)


def recent_sink(spark: SparkSession, path: str, window_hours: int = 24) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` of the run log itself: keeps the runs of the last ``window_hours`` before the
    latest start seen, which is all that a report of that moment or a later one counts. No run is lost
    for coming late."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = ["source", "_run_started_at", "status", "rows_inserted"]
        before = _slot_before(spark, f"{path}/recent", _RECENT, batch_id)
        rows = store(before.unionByName(with_instants(batch).select(*kept)))
        clock = rows.agg(F.max(F.unix_seconds("_run_started_at"))).first()[0]
        if clock is not None:
            in_window = F.unix_seconds("_run_started_at") >= clock - window_hours * 3600
            _write_slot(rows.where(in_window), f"{path}/recent", batch_id)

    return scratch_batch(spark, run)


def streamed_freshness(
    spark: SparkSession, path: str, sources: DataFrame, as_of: Column | None = None, *, window_hours: int = 24
) -> DataFrame:
    """The report of ``health.freshness_report`` from what the two sinks keep. ``as_of`` must not lie
    before the latest start seen, which is its default."""
    newest = _slot_now(spark, f"{path}/newest", _NEWEST)
    if as_of is None:
        as_of = F.lit(newest.agg(F.max("clock")).first()[0]).cast("timestamp")
    recent = _slot_now(spark, f"{path}/recent", _RECENT)
    in_window = F.unix_seconds("_run_started_at") >= F.unix_seconds(as_of) - window_hours * 3600
    counted = recent.groupBy("source").agg(*recent_outcomes(in_window))
    return freshness_of(newest.drop("clock").join(counted, "source", "left"), sources, as_of)


def _slots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return scan_table(spark, path, T.StructType.fromDDL(schema), "slot")


def _slot_before(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """What the batch before this one left, nothing for the first of a stream. A batch writes the other
    of two slots, so one that is replayed still finds it."""
    rows = _slots(spark, path, schema)
    return rows.where((F.col("slot") != str(batch_id % 2)) & (F.col("batch_id") == batch_id - 1)).drop("slot", "batch_id")


def _write_slot(rows: DataFrame, path: str, batch_id: int) -> None:
    told = rows.withColumns({"batch_id": F.lit(batch_id).cast("long"), "slot": F.lit(str(batch_id % 2))})
    if batch_id == 0:  # a stream begun anew has nothing to do with what an earlier one left
        told.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("slot").parquet(path)
    else:
        overwrite_partitions(told, path, ["slot"])


def _slot_now(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = _slots(spark, path, schema)
    newest = rows.agg(F.max("batch_id")).first()[0]
    return rows.where(F.col("batch_id") == F.lit(newest)).drop("slot", "batch_id")


def _days_between(first: str, last: str) -> int:
    import datetime as dt

    return (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days
