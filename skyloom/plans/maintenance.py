"""Repairs and migrations of stored tables, as projections with counts to verify them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.scalars import iso_utc_text, payload_hash
from skyloom.operators.upserts import insert_ignore
from skyloom.plans.health import reconcile_counts
from skyloom.session import remove_path, scratch_scoped, store
from skyloom.sources.lake import overwrite_partitions

# The constants of the placeholder grid.
FALLBACK_VALUES = {
    "temperature_raw": 25.0,
    "precipitation_raw": 0.0,
    "u_wind_raw": 1.0,
    "v_wind_raw": 1.0,
}


def evolve_copy(
    old: DataFrame, schema: T.StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Copy a table into a newer schema: shared columns carry over, a hash and a fetch time are
    derived where they can be, and rows the new unique key forbids are dropped, first kept. A key
    with a NULL in it forbids nothing, so all its rows are copied."""
    derived = {}
    if "raw_data_hash" not in old.columns and "raw_data" in old.columns:
        derived["raw_data_hash"] = payload_hash("raw_data")
    if "fetched_at" not in old.columns and "timestamp" in old.columns:
        derived["fetched_at"] = F.col("timestamp")
    full = old.withColumns(derived) if derived else old
    first = insert_ignore(full.limit(0), full, keys, order)
    return first.select(
        *[
            (F.col(f.name) if f.name in full.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def backfill_valid_time(df: DataFrame) -> DataFrame:
    """Fill ``valid_time`` where it is absent, from the cycle hour on the fetch date plus the
    forecast hour; what does not parse takes the fetch time."""
    day = F.replace(F.substring("fetched_at", 1, 10), F.lit("-"), F.lit(""))
    label = F.coalesce(F.nullif(F.col("cycle"), F.lit("")), F.lit("00"))
    hour = F.when(label.contains("_"), F.get(F.split(label, "_"), F.lit(1))).otherwise(
        F.lpad(F.regexp_replace(F.lower(label), "z", ""), 2, "0")
    )
    hour = F.regexp_replace(F.lower(hour), "z", "")
    start = F.when(
        hour.rlike(r"^\d{1,2}$") & day.rlike(r"^\d{8}$"),
        F.try_to_timestamp(F.concat(day, F.lpad(hour, 2, "0")), F.lit("yyyyMMddHH")),
    )
    step = F.coalesce(F.nullif(F.col("fhr"), F.lit("")), F.lit("000")).try_cast("int")
    moved = iso_utc_text(F.timestamp_seconds(F.unix_seconds(start) + step.cast("bigint") * 3600))
    return df.withColumn("valid_time", F.coalesce("valid_time", moved, "fetched_at"))


def retag_synthetic(df: DataFrame, default_source: str) -> DataFrame:
    """Tag untagged rows with their feed, then rows that hold the placeholder constants."""
    untagged = F.col("source").isNull()
    df = df.withColumns(
        {
            "is_synthetic": F.when(untagged, F.lit(0)).otherwise(F.col("is_synthetic")),
            "source": F.coalesce("source", F.lit(default_source)),
        }
    )
    constant = F.col("is_synthetic") == 0
    for column, value in FALLBACK_VALUES.items():
        constant = constant & (F.col(column) == value)
    constant = F.coalesce(constant, F.lit(False))
    return df.withColumns(
        {
            "source": F.when(constant, F.lit("fallback_constant")).otherwise(F.col("source")),
            "is_synthetic": F.when(constant, F.lit(1)).otherwise(F.col("is_synthetic")),
        }
    )


def clear_unmeasured(df: DataFrame) -> DataFrame:
    """Clear precipitation of analysis hours, which have no interval; twice is the same as once."""
    at_analysis = F.coalesce(F.col("fhr").try_cast("int") == 0, F.lit(False))
    cleared = {
        c: F.when(~at_analysis, F.col(c))
        for c in ("precipitation_raw", "precipitation_clean", "precipitation_window_h")
        if c in df.columns
    }
    if "precipitation_window_h" not in df.columns:
        cleared["precipitation_window_h"] = F.lit(None).cast("int")
    if "precipitation_qc_flag" in df.columns:
        cleared["precipitation_qc_flag"] = F.when(
            at_analysis, F.lit("no_accumulation_window")
        ).otherwise(F.col("precipitation_qc_flag"))
    if "precipitation_imputed" in df.columns:
        kind = df.schema["precipitation_imputed"].dataType
        cleared["precipitation_imputed"] = F.when(at_analysis, F.lit(0).cast(kind)).otherwise(
            F.col("precipitation_imputed")
        )
    return df.withColumns(cleared)


def clear_preview(df: DataFrame) -> DataFrame:
    """What clearing would touch: the dry run."""
    touched = (F.col("fhr").try_cast("int") == 0) & F.col("precipitation_raw").isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(touched).alias("n_to_clear"))


def relabel(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))


def verify_relabel(before: DataFrame, after: DataFrame, column: str, old: str) -> DataFrame:
    """One row: rows before and after, how many carried the old label, how many still do."""
    a = before.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col(column) == old).alias("relabelled")
    ).withColumn("_k", F.lit(0))
    b = after.agg(
        F.count(F.lit(1)).alias("rows_after"), F.count_if(F.col(column) == old).alias("remaining")
    ).withColumn("_k", F.lit(0))
    return a.join(b, "_k").drop("_k").withColumn(
        "verified",
        ((F.col("rows_before") == F.col("rows_after")) & (F.col("remaining") == 0)).cast("int"),
    )


@scratch_scoped
def relabel_partition(spark: SparkSession, path: str, column: str, old: str, new: str) -> None:
    """Move the rows of one label of a table partitioned by ``column`` to another label. Only the
    two partitions are read and written; the old one is removed once its rows are counted in
    their new place."""
    kinds = [
        T.StructField(f.name, T.StringType()) if f.name == column else f
        for f in spark.read.parquet(path).schema
    ]
    # Labels are text even where all of them look like numbers.
    table = spark.read.schema(T.StructType(kinds))
    two = table.parquet(path).where(F.col(column).isin(old, new))
    after = store(relabel(two, column, old, new), "relabelled")
    expected = two.count()
    overwrite_partitions(after, path, [column])
    moved = table.parquet(path).where(F.col(column) == new).count()
    if moved != expected:
        raise RuntimeError(f"{expected} rows were to carry {new}, {moved} do; {old} is left in place")
    remove_path(spark, f"{path.rstrip('/')}/{column}={old}")


def migrate_to_lake(
    tables: dict[str, DataFrame], root: str, partitions: dict[str, str]
) -> DataFrame:
    """Write every table below ``root`` by its partition column and reconcile the counts."""
    from skyloom.plans.health import table_counts

    for name, df in tables.items():
        overwrite_partitions(df, f"{root}/{name}", [partitions[name]])
    spark = next(iter(tables.values())).sparkSession
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in tables}
    return reconcile_counts(table_counts(tables), table_counts(stored), "table_name")
