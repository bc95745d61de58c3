"""Contracts, merges, lake writes, accumulation, calendar planning, maintenance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyloom.operators import accumulation as A
from skyloom.operators import periods, upserts
from skyloom.operators.contracts import Contract, ColumnRule, ContractError, validate
from skyloom.plans import maintenance
from skyloom.plans.silver import silver_forecast
from skyloom.profiles import CONTRACTS, MODEL_AIR_START
from skyloom.schemas import BRONZE_PAYLOAD, KEYS, RUN_LOG, SILVER_FIRE, SILVER_GRID, SILVER_MODEL_AIR, \
    SILVER_AIR, SILVER_SATELLITE, SILVER_WEATHER
from skyloom.sources import lake


def filled(spark, schema, **values):
    """One row of a table, with the given columns set."""
    return spark.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


TABLES = {
    "bronze_payload": (BRONZE_PAYLOAD, {"payload_ts": "2026-09-09T00:00", "payload_hash": "h", "payload": "{}"}),
    "silver_air": (SILVER_AIR, {"station_id": "s", "timestamp": "2026-09-09T00:00:00+00:00", "pm25_raw": 1.0}),
    "silver_weather": (SILVER_WEATHER, {"station": "Delhi", "timestamp": "2026-09-09T00:00:00+00:00"}),
    "silver_grid": (SILVER_GRID, {"lat": 28.5, "lon": 77.0, "cycle": "20260909_00z", "fhr": "003",
                                  "precipitation_clean": 1.25, "precipitation_window_h": 3}),
    "silver_fire": (SILVER_FIRE, {"lat": 30.0, "lon": 75.0, "timestamp": "2026-09-09T08:00:00+00:00", "satellite": "N"}),
    "silver_satellite": (SILVER_SATELLITE, {"lat": 30.0, "lon": 75.0, "timestamp": "2026-09-09T08:00:00+00:00"}),
    "silver_model_air": (SILVER_MODEL_AIR, {"city": "delhi", "timestamp": "2026-09-09T08:00:00+00:00"}),
}


@pytest.mark.parametrize("table", TABLES)
def test_inserting_twice_stores_once(spark, table):
    schema, values = TABLES[table]
    row = filled(spark, schema, **values)
    order = [KEYS[table][0]]
    empty = spark.createDataFrame([], schema)
    first = upserts.insert_ignore(empty, row.union(row), KEYS[table], order)
    assert first.count() == 1
    assert upserts.insert_ignore(first, row, KEYS[table], order).count() == 0
    assert upserts.upsert(first, row, KEYS[table], order).count() == 1


def test_index_and_concentration_tables_share_no_measure():
    air = {c for c in SILVER_AIR.fieldNames() if c.endswith("_raw")}
    model = {c for c in SILVER_MODEL_AIR.fieldNames() if c.endswith("_ugm3")}
    assert "pm25_raw" in air and "pm25_ugm3" in model
    assert not air & set(SILVER_MODEL_AIR.fieldNames()) and not model & set(SILVER_AIR.fieldNames())


def test_null_keys_conflict_in_a_merge_but_not_in_an_insert(spark):
    old = spark.createDataFrame([(None, 1)], "k string, v int")
    new = spark.createDataFrame([(None, 2)], "k string, v int")
    assert rows(upserts.upsert(old, new, ["k"], ["v"])) == [(None, 2)]
    assert rows(upserts.insert_ignore(old, new, ["k"], ["v"])) == [(None, 2)]


def test_upsert_table_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "air")
    data = [("s", f"2026-01-0{d}T00:00:00+00:00", float(d)) for d in (1, 2, 3)]
    batch = spark.createDataFrame(data, "station_id string, timestamp string, pm25_raw double")
    batch = batch.select(*[
        F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in SILVER_AIR.fields
    ]).withColumn("date", lake.observation_date())
    for b in (batch, batch, batch.where(F.col("date") == "2026-01-02").withColumn("pm25_raw", F.lit(9.0))):
        lake.upsert_table(spark, b, path, SILVER_AIR, partition="date", keys=["station_id", "timestamp"],
                          order=["timestamp"])
    stored = lake.scan_table(spark, path, SILVER_AIR, "date")
    assert rows(stored.select("date", "pm25_raw"), "date") == [
        ("2026-01-01", 1.0), ("2026-01-02", 9.0), ("2026-01-03", 3.0)]
    near = lake.context_window(stored, "2026-01-03", 1)
    assert near.count() == 2
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_insert_ignore_table_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "wx")
    row = filled(spark, SILVER_WEATHER, station="Delhi", timestamp="2026-01-01T00:00:00+00:00", temperature_raw=1.0)
    dated = row.withColumn("date", lake.observation_date())
    for value in (1.0, 2.0):
        lake.insert_ignore_table(spark, dated.withColumn("temperature_raw", F.lit(value)), path, SILVER_WEATHER,
                                 partition="date", keys=["station", "timestamp"], order=["timestamp"])
    assert rows(spark.read.parquet(path).select("temperature_raw")) == [(1.0,)]


def test_absent_table_is_empty(spark, tmp_path):
    df = lake.scan_table(spark, str(tmp_path / "none"), SILVER_AIR, "date")
    assert df.count() == 0 and "date" in df.columns


def test_bronze_keeps_each_content_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    data = [("a", "2026-01-01T00:00", "x"), ("a", "2026-01-01T05:00", "x"), ("a", None, "µg"), ("b", "2026-01-01T00:00", "x")]
    df = spark.createDataFrame(data, "source string, ts string, body string").withColumn("is_synthetic", F.lit(0))
    made = lake.bronze_rows(df, payload="body", timestamp="ts", fetched_at=F.lit("2026-02-02T00:00"))
    assert lake.append_bronze(spark, made, path).count() == 3
    assert lake.append_bronze(spark, made, path).count() == 0
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("result,status,n,error", [
    (("partial", 3, "x"), "partial", 3, "x"), (7, "success", 7, None),
    (None, "failure", 0, "the job gave no result"), ("odd", "success", 0, None)])
def test_run_log(spark, result, status, n, error):
    row = lake.run_entry(spark, "cpcb", "a", "b", result).first()
    assert (row["status"], row["rows_inserted"], row["error_message"]) == (status, n, error)
    assert set(row.asDict()) == set(RUN_LOG.fieldNames())


def test_export_keeps_units(spark, tmp_path):
    path = str(tmp_path / "x")
    lake.write_export(spark.range(2).withColumn("t", F.lit(1.0)), path, units={"t": "degC"}, notes={"a": 1})
    assert spark.read.parquet(path).schema["t"].metadata == {"unit": "degC"}
    assert "degC" in spark.read.text(f"{path}_notes").first()[0]


# Contracts.


def test_contract_splits_rows_and_reports_every_failure(spark):
    data = [("a", "5", 0), ("b", "-5", 2), (None, "bad", 1), ("c", None, 0)]
    df = spark.createDataFrame(data, "k string, v string, s int")
    contract = Contract("t", [ColumnRule("k", "string", False), ColumnRule("v", minimum=0, maximum=10),
                              ColumnRule("s", "int", False, allowed=(0, 1))])
    valid, failures = validate(df, contract)
    assert rows(valid, "k") == [("a", 5.0, 0), ("c", None, 0)]
    got = rows(failures.select("failed_column", "failed_check", "failed_value"), "failed_column", "failed_check")
    assert got == [("k", "not_null", None), ("s", "isin", "2"), ("v", "coerce_double", "bad"),
                   ("v", "in_range(0, 10)", "-5")]
    with pytest.raises(ContractError):
        validate(df, contract, fail_on_violation=True)
    with pytest.raises(ContractError):
        validate(df.drop("v"), contract)


def test_unknown_contract_passes_everything(spark):
    valid, failures = validate(spark.range(3), None)
    assert valid.count() == 3 and failures.count() == 0


def test_optional_window_column(spark):
    row = filled(spark, SILVER_GRID, lat=28.5, lon=77.0, cycle="c", fhr="000", source="noaa", is_synthetic=0)
    assert validate(row, CONTRACTS["gfs"])[0].count() == 1
    assert validate(row.drop("precipitation_window_h"), CONTRACTS["gfs"])[0].count() == 1
    assert validate(row.withColumn("precipitation_window_h", F.lit(12)), CONTRACTS["gfs"])[0].count() == 0


# Accumulation.


def run_frame(spark, buckets, constant=False):
    data = [("c", float(i), 0.0, fhr, v, span, constant)
            for fhr, (values, span) in buckets.items() for i, v in enumerate(values)]
    return spark.createDataFrame(
        data, "cycle string, lat double, lon double, fhr int, bucket double, span_h int, constant_zero boolean")


def made(spark, buckets, **kw):
    out = A.increments_or_raise(run_frame(spark, buckets, **kw))
    return [r[0] for r in out.orderBy("fhr", "lat").select("increment").collect()]


def test_three_hour_bucket_passes_through(spark):
    assert made(spark, {3: ([1.0, 2.0], 3)}) == [1.0, 2.0]


def test_six_hour_bucket_is_differenced(spark):
    assert made(spark, {3: ([1.0, 2.0], 3), 6: ([4.0, 2.5], 6)}) == [1.0, 2.0, 3.0, 0.5]


def test_analysis_hour_stays_null(spark):
    assert made(spark, {0: ([None, None], None), 3: ([1.0, 2.0], 3)}) == [None, None, 1.0, 2.0]


def test_dry_run_packed_as_constant_is_accepted(spark):
    assert made(spark, {3: ([0.0, 0.0], 3)}, constant=True) == [0.0, 0.0]


@pytest.mark.parametrize("buckets", [
    {3: ([0.0, 0.0], 3)},                              # all zero although bits were packed
    {3: ([5.0, 5.0], 3), 6: ([1.0, 1.0], 6)},          # negative increment
    {6: ([1.0], 6)},                                   # no partner
    {3: ([1.0], 3), 9: ([2.0], 6)},                    # partner one step too far
])
def test_contradictory_runs_are_refused(spark, buckets):
    with pytest.raises(A.AccumulationError):
        made(spark, buckets)


def test_totals_must_reconcile(spark):
    frame = run_frame(spark, {3: ([1.0], 3), 6: ([4.0], 6)})
    totals = spark.createDataFrame([("c", 0.0, 0.0, 4.1)], "cycle string, lat double, lon double, run_total double")
    assert A.increments_or_raise(frame, totals).count() == 2
    with pytest.raises(A.AccumulationError):
        A.increments_or_raise(frame, totals.withColumn("run_total", F.lit(9.0)))


def test_forecast_series(spark):
    base = run_frame(spark, {0: ([None], None), 3: ([1.0], 3), 6: ([3.0], 6)}).withColumn(
        "cycle", F.lit("20260909_00z")).withColumns({
            "temperature_c": F.when(F.col("fhr") != 3, F.col("fhr").cast("double")),
            "u_wind_ms": F.lit(1.0), "v_wind_ms": F.lit(2.0), "fetched_at": F.lit("x")})
    out = rows(silver_forecast(base).select(
        "fhr", "valid_time", "temperature_c", "temperature_c_imputed", "precipitation_mm_3h",
        "precipitation_mm_3h_qc_flag"), "fhr")
    assert out == [
        (0, "2026-09-09T00:00:00+00:00", 0.0, False, None, "no_accumulation_window"),
        (3, "2026-09-09T03:00:00+00:00", 3.0, True, 1.0, "ok"),
        (6, "2026-09-09T06:00:00+00:00", 6.0, False, 2.0, "ok")]


# Calendar.


def test_spans_and_chunks(spark):
    months = spark.createDataFrame([(2022, m) for m in (1, 7, 8, 10, 11, 12)], "year int, month int")
    spans = rows(periods.contiguous_spans(months, coverage_start=MODEL_AIR_START).select("start_date", "end_date"), "start_date")
    assert spans == [(dt.date(2022, 8, 3), dt.date(2022, 8, 31)), (dt.date(2022, 10, 1), dt.date(2022, 12, 31))]
    chunks = rows(periods.date_chunks(months.where("month = 1")).select("start_date", "n_days"), "start_date")
    assert sum(c[1] for c in chunks) == 31 and chunks[-1] == (dt.date(2022, 1, 31), 1)


# Maintenance.


def test_clearing_keeps_boolean_columns_boolean(spark):
    df = spark.createDataFrame([("000", 0.0, True), ("003", 0.0, True)],
                               "fhr string, precipitation_raw double, precipitation_imputed boolean")
    out = maintenance.clear_unmeasured(df)
    assert rows(out.select("fhr", "precipitation_raw", "precipitation_imputed"), "fhr") == [
        ("000", None, False), ("003", 0.0, True)]


def test_relabel_partition(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.createDataFrame([(1, "00"), (2, "00"), (3, "20260906_00z")], "id int, cycle string")
    df.write.partitionBy("cycle").parquet(path)
    maintenance.relabel_partition(spark, path, "cycle", "00", "20260905_00z")
    assert not (tmp_path / "a" / "cycle=00").exists()
    assert rows(spark.read.parquet(path).groupBy("cycle").count(), "cycle") == [
        ("20260905_00z", 2), ("20260906_00z", 1)]


def test_stored_rows_of_null_and_blank_partitions_survive(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    path, other = str(tmp_path / "t"), str(tmp_path / "u")
    for batch in ([(1, 1, None), (2, 1, "")], [(3, 1, None), (4, 1, "2024-01-01")], [(2, 2, None), (2, 2, "")]):
        df = spark.createDataFrame(batch, "k long, v long, date string")
        lake.upsert_table(spark, df, path, schema, partition="date", keys=["k"], order=["v"])
        lake.insert_ignore_table(spark, df, other, schema, partition="date", keys=["k"], order=["v"])
    assert rows(spark.read.parquet(path).select("k", "v"), "k") == [(1, 1), (2, 2), (3, 1), (4, 1)]
    assert rows(spark.read.parquet(other).select("k", "v"), "k") == [(1, 1), (2, 1), (3, 1), (4, 1)]
