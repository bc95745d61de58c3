"""Scalars, payload parsers, grid messages, streaming sinks and the registry."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyloom.functions import scalars as S
from skyloom.functions.aggregates import circular_mean
from skyloom.operators import periods
from skyloom.operators.quality import MetricRule
from skyloom.plans import gold
from skyloom.plans.catalog import ORACLES, QUERIES
from skyloom.sources import grids as G
from skyloom.sources import lake
from skyloom.sources import payloads as P
from skyloom.streaming import jobs


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_index_scales(spark):
    got = one(
        spark,
        *[S.air_quality_index(F.lit(a).cast("double"), F.lit(b).cast("double"), F.lit(s).cast("string"))
          for a, b, s in [(112, 60, "cpcb"), (112, 60, "cams-openmeteo-archive"), (112, 60, None), (None, None, "cpcb")]],
    )
    assert got[0] == 112 and got[1] == pytest.approx(273.6, abs=0.05) and got[2] == 112 and got[3] is None
    assert one(spark, S.index_category(F.lit(112.0)), S.index_category(F.lit(273.6)),
               S.index_category(F.lit(None).cast("double"))) == ("Moderate", "Poor", "unknown")


def test_index_segments(spark):
    values = [0.0, 30.0, 30.1, 250.0, 500.0, 501.0, -1.0]
    got = one(spark, *[S.sub_index(F.lit(v), S.PM25_BREAKPOINTS) for v in values])
    assert got[:2] == (0.0, 50.0) and got[2] > 51 and got[3] == 400.0 and got[5] == 500.0 and got[6] is None


def test_sign_magnitude_and_packing(spark):
    raw = ["0000", "0001", "0002", "012C", "8004", "8001"]
    got = one(spark, *[S.sign_magnitude(F.unhex(F.lit(r)), 2) for r in raw])
    assert got == (0, 1, 2, 300, -4, -1)
    assert one(spark, S.unpack_simple(F.lit(655), F.lit(0.0), F.lit(-4), F.lit(0)))[0] == 40.9375


def test_valid_time(spark):
    cases = [("20260909_00z", "003"), ("20260909_12z", "024"), ("20260909_00", "003"), ("00", "000"), ("20260909_00z", "x")]
    got = one(spark, *[S.iso_utc_text(S.valid_time(F.lit(c), F.lit(f))) for c, f in cases])
    assert got == ("2026-09-09T03:00:00+00:00", "2026-09-10T12:00:00+00:00", "2026-09-09T03:00:00+00:00", None, None)


def test_times_of_any_spelling(spark):
    texts = ["2026-01-01T10:00", "2026-01-01 10:00:00", "2026-01-01T15:30:00+05:30", "2026-01-01T10:00:00.123Z", "10:00", "", "n/a"]
    got = one(spark, *[S.iso_utc_text(S.parse_instant(F.lit(t))) for t in texts])
    assert got == ("2026-01-01T10:00:00+00:00",) * 4 + (None,) * 3


def test_circular_mean_and_sectors(spark):
    df = spark.createDataFrame([(350.0,), (10.0,), (None,)], "d double")
    assert df.agg(circular_mean("d", 6)).first()[0] == 0.0
    assert df.where("d is null").agg(circular_mean("d")).first()[0] is None
    got = one(spark, *[S.wind_sector(F.lit(d).cast("double")) for d in (0, 22.5, 337.5, 359, 180, 337.4, None)])
    assert got == ("N", "NE", "N", "N", "S", "NW", "?")


def test_rain_sums_differ_over_nothing(spark):
    schema = ("station string, timestamp string, is_synthetic int, temperature_clean double, humidity_clean double, "
              "rainfall_clean double, wind_speed_clean double, wind_dir_clean double")
    wx = spark.createDataFrame([(" DELHI ", "2026-01-01T10:00", 0, 1.0, 2.0, None, 3.0, 350.0)], schema)
    assert gold.city_daily_weather(wx).first()["rainfall_daily_total"] == 0.0
    grid = spark.createDataFrame([("c", "v", 0, 1.0, 1.0, None, 3.0, 4.0)],
                                 "cycle string, valid_time string, is_synthetic int, lat double, temperature_clean double, "
                                 "precipitation_clean double, u_wind_clean double, v_wind_clean double")
    row = gold.grid_hourly(grid).first()
    assert row["precip_total"] is None and row["wind_speed_mean"] == 5.0


# Payloads.


def test_hourly_arrays_of_uneven_length(spark):
    body = ('{"hourly": {"time": ["2020-11-01T00:00", "2020-11-01 01:00", "2020-11-01T02:00:00+00:00"], '
            '"temperature_2m": [1.5, null], "precipitation": []}}')
    df = spark.createDataFrame([("Delhi", body), ("Agra", '{"hourly": {"time": []}}'), ("Pune", "oops")], "station string, payload string")
    got = rows(P.parse_hourly(df, P.WEATHER_VARIABLES, keep=["station"]).select(
        "station", "timestamp", "temperature_raw", "rainfall_raw"), "timestamp")
    assert got == [("Delhi", "2020-11-01T00:00:00+00:00", 1.5, None), ("Delhi", "2020-11-01T01:00:00+00:00", None, None),
                   ("Delhi", "2020-11-01T02:00:00+00:00", None, None)]


def test_station_feed(spark):
    body = '{"idx": 7, "query_city": "delhi", "time": {"s": "2026-01-01 10:00:00"}, "iaqi": {"pm25": {"v": 112}, "o3": {}}}'
    df = spark.createDataFrame([(body,), ('{"iaqi": {}}',)], "payload string")
    got = P.parse_station_feed(df, fetched_at=F.lit("now")).collect()
    assert (got[0]["station_id"], got[0]["timestamp"], got[0]["pm25_raw"], got[0]["o3_raw"]) == ("7", "2026-01-01 10:00:00", 112.0, None)
    assert len(got) == 1  # a body that names no station is no reading of station ''


GOOD = {
    "feed": '{"idx": 7, "iaqi": {"pm25": {"v": "-"}, "o3": {"v": 4}}}',  # one unreadable value does not cost the body
    "current": '{"current": {"temperature_2m": 4.5}}',
    "hourly": '{"hourly": {"time": ["2026-01-01T00:00"], "precipitation": [1.5]}}',
    "csv": "latitude,longitude,acq_date,acq_time\n30.5,75.25,2020-11-01,830\n",
}
SPLIT = {
    "feed": lambda df: P.split_station_feed(df, fetched_at=F.lit("now"), keep=["id"]),
    "current": lambda df: P.split_current(df, fetched_at=F.lit("now"), keep=["id"]),
    "hourly": lambda df: P.split_hourly(df, P.WEATHER_VARIABLES, keep=["id"]),
    "csv": lambda df: P.split_fire_csv(df, fallback=F.lit("now"), keep=["id"]),
}


@pytest.mark.parametrize("kind", list(GOOD))
def test_bad_bodies_become_failure_cases(spark, tmp_path, kind):
    bodies = [GOOD[kind], None, "", " \n", '{"current": {"tem', "<html>busy</html>", '{"status": "error"}', "[]", "null", "7", "\ufffd\x00"]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, payload string")
    read, rejected = SPLIT[kind](df)
    assert rows(read.select("id")) == [(0,)]
    told = dict(rows(rejected.select("id", "failed_check")))
    assert sorted(told) == list(range(1, 11)) and {told[k] for k in (1, 2, 3)} == {"empty_body"}
    if kind == "csv":
        assert {told[k] for k in range(4, 11)} == {"known_header"}
    else:
        assert told[4] == told[5] == "readable_json" and told[6] == "expected_fields" and "empty_body" not in {told[k] for k in range(4, 11)}
    lake.append_failures(str(tmp_path / "f"), kind, "run", rejected)
    assert spark.read.parquet(str(tmp_path / "f")).where("failed_column = 'payload'").count() == 10


def test_unreadable_value_in_a_good_body(spark):
    df = spark.createDataFrame([(0, GOOD["feed"])], "id int, payload string")
    got = P.parse_station_feed(df, fetched_at=F.lit("now")).first()
    assert got["pm25_raw"] is None and got["o3_raw"] == 4.0


def test_catalogue(spark, tmp_path):
    folder = tmp_path / "catalogue"
    folder.mkdir()
    (folder / "a.csv").write_text('data_id,min_date,max_date\n"MODIS, NRT",2020-11-01,2021-01-31\nVIIRS,2020-01-01,soon\nX,2020-01-01\n,2020-01-01,2020-02-01\n')
    good, rejected = lake.scan_catalogue(spark, str(folder))
    assert [(r[0], str(r[1]), str(r[2])) for r in good.collect()] == [("MODIS, NRT", "2020-11-01", "2021-01-31")]
    assert sorted(r["failed_check"] for r in rejected.collect()) == ["fits_header", "not_null", "readable_date"]
    wanted = spark.createDataFrame([("MODIS, NRT", 2020, m) for m in (10, 11, 12)], "source string, year int, month int")
    assert rows(periods.available_months(good, wanted), "month") == [("MODIS, NRT", 2020, 11), ("MODIS, NRT", 2020, 12)]
    (tmp_path / "more.csv").write_text("Note,MAX_DATE,data_id,min_date\nx,2020-02-01,V,2020-01-05\n")
    assert [r[0] for r in lake.scan_catalogue(spark, str(tmp_path / "more.csv"))[0].collect()] == ["V"]
    (tmp_path / "less.csv").write_text("data_id,min_date\nV,2020-01-05\n")
    with pytest.raises(ValueError, match="max_date"):
        lake.scan_catalogue(spark, str(tmp_path / "less.csv"))


def test_context_days_known_at_run_time_prune_folders(spark, tmp_path):
    path = str(tmp_path / "dated")
    days = spark.range(60).select("id", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")), "yyyy-MM-dd").alias("date"))
    lake.overwrite_partitions(days, path, ["date"])
    stored = lake.scan_table(spark, path, days.drop("date").schema, "date")
    runs = spark.createDataFrame([("2024-01-10", "a"), ("2024-01-20", "b"), (None, "a"), ("2024-01-30", "c")], "date string, kind string")
    out = lake.context_of(stored, runs.where("kind != 'c'"), days_back=1)
    assert rows(out.select("date").distinct(), "date") == [("2024-01-09",), ("2024-01-10",), ("2024-01-19",), ("2024-01-20",)]
    out.collect()
    scan = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x]
    assert any("PartitionFilters: [isnotnull(date" in x and "dynamicpruning" in x for x in scan), scan


def test_fire_csv(spark):
    modis = "latitude,longitude,brightness,acq_date,acq_time,satellite,confidence\r\n30.5,75.25,310.2,2020-11-01,830,Terra,80\r\n"
    viirs = "country_id,latitude,longitude,bright_ti4,acq_date,acq_time,satellite,confidence\nIND,31,76,330,2020-11-01,9999,N,n\n"
    df = spark.createDataFrame([(1, modis), (2, viirs), (3, "Invalid MAP_KEY")], "id int, payload string")
    got = rows(P.parse_fire_csv(df, fallback=F.lit("fb"), keep=["id"]).drop("line_no"), "id")
    assert got == [(1, 30.5, 75.25, 310.2, "2020-11-01T08:30:00+00:00", "Terra", "80"),
                   (2, 31.0, 76.0, 330.0, "fb", "N", "n")]
    assert P.csv_bodies(df)[1].count() == 1


# Grid messages, written here byte by byte.


def message(field=(0, 0), surface=103, level=2, values=(1, 2, 3, 4), nbits=12, reference=0.0, binary=0, decimal=0,
            template=0, span=0, rows_=2, columns=2, scan=0x40, packing=0, cut=0, points=None, level_scale=0, sections=(3, 4, 5, 7)):
    grid = bytearray(72)
    grid[0:5] = struct.pack(">IB", 72, 3)
    grid[6:10] = struct.pack(">I", columns * rows_ if points is None else points)
    grid[30:38] = struct.pack(">II", columns, rows_)
    grid[46:54] = struct.pack(">ii", 28_250_000, 77_000_000)
    grid[55:71] = struct.pack(">iiII", 28_500_000, 77_250_000, 250_000, 250_000)
    grid[71] = scan
    product = bytearray(58)
    product[0:5] = struct.pack(">IB", 58, 4)
    product[7:11] = struct.pack(">HBB", template, *field)
    product[22] = surface
    product[23] = level_scale
    product[24:28] = struct.pack(">I", level)
    product[49:53] = struct.pack(">I", span)
    bits = "".join(f"{v:0{nbits}b}" for v in values) if nbits else ""
    bits += "0" * (-len(bits) % 8)
    data = bytes(int(bits[i:i + 8], 2) for i in range(0, len(bits), 8))[: len(bits) // 8 - cut]
    pack = struct.pack(">IBIHfHHBB", 21, 5, len(values), packing, reference, binary, decimal, nbits, 0)
    parts = {3: bytes(grid), 4: bytes(product), 5: pack, 7: struct.pack(">IB", len(data) + 5, 7) + data}
    body = b"".join(parts[n] for n in sections) + b"7777"
    return b"GRIB" + bytes(4) + struct.pack(">Q", len(body) + 16) + body


def test_grid_messages(spark, tmp_path):
    files = {
        "a.bin": b"junk" + message(values=(0, 655, 100, 4095), binary=0x8004) + message(nbits=0, values=(), reference=0.0,
                 field=(1, 8), surface=1, level=0, template=8, span=3) + b"GRIB" + bytes(4) + struct.pack(">Q", 9999) + b"tail",
        "b.bin": message(cut=2) + message(scan=0) + message(packing=3) + message(decimal=0x8001, values=(7, 8, 9, 10)),
        "c.bin": b"<html>busy</html>",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    points = G.scan_messages(spark, str(tmp_path)).withColumn("file", F.substring_index("file", "/", -1))
    a = rows(points.where("file = 'a.bin'").select("msg", "lat", "lon", "value", "span_h", "constant_zero"), "msg", "lat", "lon")
    assert [r[3] for r in a[:4]] == [0.0, 40.9375, 6.25, 255.9375]
    assert [(r[1], r[2]) for r in a[:4]] == [(28.25, 77.0), (28.25, 77.25), (28.5, 77.0), (28.5, 77.25)]
    assert [(r[3], r[4], r[5]) for r in a[4:]] == [(0.0, 3, True)] * 4
    b = rows(points.where("file = 'b.bin'").select("msg", "error", "value"), "msg", "value")
    assert [r[1] for r in b[:3]] == ["truncated data section", "unsupported scanning mode", "unsupported packing"]
    assert [r[2] for r in b[3:]] == [70.0, 80.0, 90.0, 100.0]
    assert points.where("file = 'c.bin'").count() == 0


@pytest.fixture
def small_splits(spark):
    """Blocks of some hundred bytes, so that even a small file is read by many tasks."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(keys, (str(size), "1"), strict=True)]
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def odd_file(r, n):
    """Messages amid junk, some with the magic bytes or a whole message in their data, cut off or lying."""
    out = []
    for k in range(n):
        data = r.randbytes(r.randint(0, 120))
        kind = r.randrange(8)
        if kind == 0:
            data += b"GRIB" + r.randbytes(r.randint(0, 40))
        elif kind == 1:
            data += plain_message(r.randbytes(30)) + r.randbytes(5)
        elif kind == 2:
            data = b"GRIBGRIB" + data + b"GRI"
        body = plain_message(data)
        if kind == 3:
            body = body[: len(body) // 2]
        elif kind == 4:
            body = b"GRIB" + bytes(4) + struct.pack(">Q", r.choice([0, 16, 17, 60, 2**63 + 5, 10**6])) + data
        out.append(r.choice([b"", b"junk", b"G", b"GRIB"]) + body)
    return b"".join(out)


def plain_message(data):
    return b"GRIB" + bytes(4) + struct.pack(">Q", len(data) + 20) + data + b"7777"


@pytest.mark.parametrize("split", [150, 1100, 10**8])
def test_files_are_taken_apart_like_one_walk_through_them(spark, tmp_path, small_splits, split):
    r = random.Random(split)
    files = {f"f{k}.bin": odd_file(r, n) for k, n in enumerate([0, 1, 3, 24])} | {"g.bin": b"<html>", "h.bin": b"GRIB"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    small_splits(split)
    pieces = G._pieces(spark, str(tmp_path))
    assert split > 2000 or pieces.rdd.getNumPartitions() > 2
    got = {}
    for row in G.whole_messages(pieces).collect():
        got.setdefault(row["file"].rsplit("/", 1)[-1], {})[row["msg"]] = bytes(row["message"])
    for name, content in files.items():
        assert [got.get(name, {}).get(k) for k in range(len(got.get(name, {})))] == list(G._messages(content)), name


def test_one_file_is_decoded_by_several_tasks(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "all.bin").write_bytes(b"".join(message(values=(k, 2, 3, 4)) for k in range(200)))
    small_splits(4000)
    monkeypatch.setattr(G, "MESSAGE_BYTES", 5000)
    pieces = G._pieces(spark, str(tmp_path))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 5
    points = G.scan_messages(spark, str(tmp_path))
    assert points.select(F.spark_partition_id()).distinct().count() > 5
    assert rows(points.where("point = 0").select("msg", "value"), "msg") == [(k, float(k)) for k in range(200)]


def test_damaged_messages_become_error_rows(spark):
    short = message()
    short = short.replace(struct.pack(">IB", 58, 4), struct.pack(">IB", 9, 4))
    bad = [message(points=5), message(points=2**32 - 1, rows_=65537, columns=65535, nbits=0, values=()), message(sections=(3, 4, 5)), message(sections=()), short]
    files = spark.createDataFrame([("f", b"".join(bad) + message(level_scale=0x81))], "file string, content binary")
    got = rows(G.decode_messages(files).select("msg", "error", "level", "value"), "msg", "value")
    assert [r[1] is None for r in got] == [False] * 5 + [True] * 4
    assert [r[1] for r in got[:3]] == ["point count out of bounds"] * 2 + ["section 7 is missing"]
    assert {r[2] for r in got[5:]} == {20.0}


@pytest.mark.parametrize("bad,error", [
    (dict(binary=1024), "scale out of bounds"), (dict(decimal=0x8190), "scale out of bounds"), (dict(decimal=400), "scale out of bounds"),
    (dict(nbits=255), "values wider than 32 bits"), (dict(reference=float("inf")), "scale out of bounds"),
    (dict(reference=float("nan")), "scale out of bounds"), (dict(reference=3e38, decimal=0x8000 + 290), "values out of bounds")])
def test_claims_out_of_bounds_are_error_rows(spark, bad, error):
    files = spark.createDataFrame([("f", message(**bad) + message(values=(5, 6, 7, 8)))], "file string, content binary")
    got = rows(G.decode_messages(files).select("msg", "error", "value"), "msg", "value")
    assert [r[1] for r in got] == [error, None, None, None, None] and [r[2] for r in got[1:]] == [5.0, 6.0, 7.0, 8.0]


def test_fields_are_chosen_by_level(spark):
    skin, air = message(surface=1, level=0, values=(3000,) * 4, decimal=1), message(values=(2801,) * 4, decimal=1)
    files = spark.createDataFrame([("f", air + skin), ("g", skin)], "file string, content binary")
    points = G.decode_messages(files)
    got = rows(G.select_fields(points).select("file", "field", "value").distinct())
    assert got == [("f", "temperature_c", 6.95)]
    missing = rows(G.missing_fields(points, files), "file", "field")
    assert missing == [("f", "u_wind_ms"), ("f", "v_wind_ms"), ("g", "temperature_c"), ("g", "u_wind_ms"), ("g", "v_wind_ms")]


def test_standard_grid(spark):
    assert G.study_area(spark).count() == 125 * 117
    assert G.study_area(spark, 2.0).count() == 16 * 15


# Streaming.


def test_quality_sink_sees_the_batch_before(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("t", T.StringType()), T.StructField("v", T.DoubleType())])
    path = str(tmp_path / "qc")
    sink = jobs.quality_sink(spark, path, schema, [MetricRule("v", max_step=10, flat_window=3)], station="s", time="t")

    def batch(*data):
        return spark.createDataFrame([(s, f"2024-01-01T{t:02d}:00:00+00:00", v) for s, t, v in data], schema)

    def flags():
        got = spark.read.parquet(f"{path}/flags").select("s", F.substring("t", 12, 2).cast("int"), "v_qc_flag")
        return rows(got, "s", "t")

    second = batch(("a", 3, 5.0), ("b", 2, 50.0))
    sink(batch(("a", 1, 5.0), ("a", 2, 5.0), ("b", 1, 1.0)), 0)
    for _ in range(2):  # a replay writes the same rows
        sink(second, 1)
    want = [("a", 1, "ok"), ("a", 2, "ok"), ("a", 3, "flatline"), ("b", 1, "ok"), ("b", 2, "step_fail")]
    assert flags() == want
    # A reading polled again and a stream begun anew leave one row per reading.
    sink(second, 2)
    assert flags() == want
    sink(batch(("b", 3, 51.0)), 0)
    assert flags() == [*want, ("b", 3, "ok")]


# Registry.


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) >= 130


@pytest.mark.parametrize("name", ["qc_chain", "city_daily_summary", "upsert_last_wins", "fire_weather_daily",
                                  "interpolate_linear", "unpivot_long"])
def test_plans_hold_no_python_and_no_single_task_window(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "Exchange SinglePartition" not in plan
    if name in ("qc_chain", "interpolate_linear"):
        assert plan.count("Exchange") == 1 and plan.count("+- Sort") == 1
