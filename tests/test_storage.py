"""Tables on disk: pruning, overwriting, errors, chunks."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.test_candles import ticks
from tickloom.operators import candles, coverage
from tickloom.plans import jobs
from tickloom.schemas import TICK_SCHEMAS, empty_ticks
from tickloom.session import work_folder
from tickloom.sinks import tables, warehouse
from tickloom.sources import adapters as ad
from tickloom.sources import readers


@pytest.fixture(scope="module")
def stored(spark, sf):
    root = work_folder(spark, "test-ticks")
    for name, source in (("trades", ad.trades), ("derivative_ticker", ad.derivative_ticker)):
        tables.write_ticks(source(spark, sf), root, name)
    return root


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scan_prunes_and_pushes(spark, stored):
    df = readers.read_ticks(spark, stored, "2024-01-05 00:00:00", "2024-01-06 00:00:00", instruments=["BINANCE:SPOT_PAIR:U1-USDT"])
    text = plan(df.select("price"))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "PushedFilters" in line)
    assert "day#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(timestamp" in text and "instrument_key" in scan.split("PushedFilters")[1]
    assert "amount" not in scan.split("ReadSchema")[1]


def test_times_are_stored_as_int64(spark, stored):
    import glob

    import pyarrow.parquet as pq

    file = glob.glob(f"{stored}/day=*/data_type=trades/*.parquet")[0]
    assert str(pq.ParquetFile(file).schema.column(1).physical_type) in ("INT64", "BYTE_ARRAY")
    assert all(pq.ParquetFile(file).schema.column(i).physical_type != "INT96" for i in range(6))


def test_files_are_sorted_by_instrument_and_time(spark, stored):
    import glob

    import pandas as pd

    for file in glob.glob(f"{stored}/day=2024-01-0*/data_type=trades/*.parquet"):
        frame = pd.read_parquet(file)
        order = list(zip(frame.instrument_key, frame.timestamp))
        assert order == sorted(order)


def test_rewriting_a_day_leaves_the_others(spark, sf, stored):
    root = work_folder(spark, "test-overwrite")
    all_ticks = ad.trades(spark, sf)
    tables.write_ticks(all_ticks, root, "trades")
    tables.write_ticks(all_ticks.where(F.col("day") == "2024-01-03").limit(2), root, "trades")
    counts = {r.day: r.n for r in spark.read.parquet(root).groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts[dt.date(2024, 1, 3)] == 2 and len(counts) == all_ticks.select("day").distinct().count()


def test_chunks_cover_every_row(spark, stored):
    df = readers.read_ticks(spark, stored, "2024-01-01", "2024-02-01")
    sizes = [len(c) for c in readers.in_chunks(df, 70)]
    assert sum(sizes) == df.count() and set(sizes[:-1]) == {70}


def test_bad_arguments(spark, stored):
    with pytest.raises(ValueError):
        readers.read_candles(spark, stored, "2024-01-01", "2024-01-02", ["2m"])
    with pytest.raises(ValueError):
        readers.read_hft_features(spark, stored, "2024-01-01", "2024-01-02", "1h")
    with pytest.raises(ValueError):
        readers.read_ticks(spark, stored, "2024-01-01", "2024-01-02", ["news"])
    with pytest.raises(FileNotFoundError):
        readers.first_present(spark, [stored + "-no", stored + "-neither"])
    with pytest.raises(ValueError):
        tables.write_ticks(ticks(spark, [(0, 1.0, 1.0)]).drop("timestamp"), stored)


@pytest.mark.parametrize("data_type", sorted(TICK_SCHEMAS))
def test_empty_tables(spark, data_type):
    frame = empty_ticks(spark, data_type)
    assert frame.count() == 0 and frame.schema == TICK_SCHEMAS[data_type]


def test_absent_report_is_empty(spark):
    assert readers.read_report(spark, "/tmp/tickloom-no-such-report", "2024-01-01").count() == 0


def test_invalid_definitions_abort(spark):
    frame = spark.createDataFrame([("k", ["expiry"], dt.date(2024, 1, 1))], "instrument_key string, errors array<string>, day date")
    with pytest.raises(ValueError, match="expiry"):
        tables.write_instruments(frame, work_folder(spark, "test-bad"))


def test_quotes_are_strict(spark):
    raw = spark.createDataFrame([("1", "1", "x", "1", "2", "1")], "timestamp string, local_timestamp string, bid_price string, bid_amount string, ask_price string, ask_amount string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.typed(raw, "quotes").collect()


@pytest.mark.parametrize("folder,master,expected", [
    ("hdfs://x/shared/", "yarn", "hdfs://x/shared/tickloom/t-"), (None, "local[2]", "/"), (None, "yarn", None)])
def test_work_folder(folder, master, expected):
    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return folder if name == "spark.checkpoint.dir" else default

        class sparkContext:
            pass

    Session.sparkContext.master = master
    if expected is None:
        with pytest.raises(ValueError):
            work_folder(Session, "t")
    else:
        assert work_folder(Session, "t").startswith(expected)


def test_a_report_that_runs_again_replaces_its_days(spark, tmp_path):
    path = str(tmp_path / "missing")
    definitions = spark.createDataFrame(
        [("A:SPOT_PAIR:X-Y", "trades", "2024-01-01T00:00:00Z", "2024-01-10T00:00:00Z")],
        "instrument_key string, data_types string, available_from_datetime string, available_to_datetime string")
    expected = coverage.expected_types(definitions, "2024-01-02", "2024-01-05")
    everything = expected.select("day", "instrument_key", "data_type")

    def total(available, start="2024-01-02", end="2024-01-05"):
        rows = jobs.missing_job(definitions, available, path, start, end).where("level = 'total'").collect()
        return (rows[0].expected, rows[0].missing, rows[0].coverage_pct)

    assert total(everything) == (4, 0, 100.0)  # nothing missing, no table yet
    some = everything.where("day <> '2024-01-03' and day <> '2024-01-04'")
    assert total(some) == (4, 2, 50.0)
    assert total(some, "2024-01-04", "2024-01-05") == (2, 1, 50.0)  # another range
    assert total(everything.where("day <> '2024-01-04'")) == (4, 1, 75.0)
    assert [str(r.day) for r in spark.read.parquet(path).select("day").distinct().collect()] == ["2024-01-04"]
    assert total(everything) == (4, 0, 100.0)
    assert spark.read.parquet(path).count() == 0


def test_candles_of_a_range_leave_no_stale_day(spark, tmp_path):
    path = str(tmp_path / "candles")
    rows = [(i, 10.0, 1.0) for i in range(0, 4 * 86400, 43200)]
    frame = candles.ohlcv(ticks(spark, rows), "1h")
    tables.write_candles(frame, path)
    second = frame.where(F.to_date("timestamp") != F.lit("2024-01-16").cast("date"))
    tables.write_candles(second, path, days=("2024-01-15", "2024-01-17"))
    days = {str(r.day) for r in spark.read.parquet(path).select("day").distinct().collect()}
    assert "2024-01-16" not in days and {"2024-01-15", "2024-01-17", "2024-01-18"} <= days


def test_one_timeframe_is_replaced_and_others_stay(spark, tmp_path):
    path, days = str(tmp_path / "candles"), ("2024-01-15", "2024-01-17")
    t = ticks(spark, [(i, 10.0 + i // 5400 % 5, 1.0) for i in range(0, 4 * 86400, 5400)])
    tables.write_candles(candles.ohlcv(t, ("15s", "1m", "1h")), path)

    def counts():
        return {r.timeframe: r["count"] for r in spark.read.parquet(path).groupBy("timeframe").count().collect()}

    assert counts() == {"15s": 64, "1m": 64, "1h": 64}
    half = t.where(F.col("price") > 11)
    tables.write_candles(candles.ohlcv(half, "1m"), path, days=days)
    after = counts()
    assert after["15s"] == 64 and after["1h"] == 64 and after["1m"] < 64
    # A run that makes nothing names what it replaces; the day outside the range stays.
    tables.write_candles(candles.ohlcv(t.limit(0), "1m"), path, days=days, timeframes=["1m"])
    left = spark.read.parquet(path).where("timeframe = '1m'")
    assert counts()["1h"] == 64 and {str(r.day) for r in left.select("day").collect()} == {"2024-01-18", "2024-01-19"}
    tables.write_candles(candles.ohlcv(t.limit(0), "1m"), path, days=days)
    assert counts()["15s"] == 64


def test_a_job_of_one_timeframe_leaves_the_others(spark, tmp_path):
    root, days = str(tmp_path / "job"), ("2024-01-15", "2024-01-16")
    t = ticks(spark, [(i, 10.0, 1.0) for i in range(0, 86400, 1800)])
    jobs.candle_job(spark, root, t, days=days)
    whole = {(str(r.day), r.timeframe): r.rows for r in tables.stored_days(spark, f"{root}/candles").collect()}
    jobs.candle_job(spark, root, t, base_timeframes=("15s",), rollups=(), days=days)
    assert {(str(r.day), r.timeframe): r.rows for r in tables.stored_days(spark, f"{root}/candles").collect()} == whole
    jobs.candle_job(spark, root, t.where(F.to_date("timestamp") == "2024-01-15"), days=days)
    again = {(str(r.day), r.timeframe): r.rows for r in tables.stored_days(spark, f"{root}/candles").collect()}
    assert again == {k: n for k, n in whole.items() if k[0] == "2024-01-15"}


def test_a_backfilled_range_loses_its_empty_days(spark, tmp_path):
    path = str(tmp_path / "fill")
    frame = candles.ohlcv(ticks(spark, [(i, 10.0, 1.0) for i in range(0, 4 * 86400, 43200)]), "1h")
    tables.backfill(frame, path)
    left = tables.backfill(frame.where(F.dayofmonth("timestamp") != 16), path, ("2024-01-15", "2024-01-17"))
    assert sorted(str(r.day) for r in left.collect()) == ["2024-01-15", "2024-01-17", "2024-01-18", "2024-01-19"]


def test_sparse_reads_reach_over_midnight(spark, tmp_path):
    root = str(tmp_path / "ticks")
    t = ticks(spark, [(s, 1.0, 1.0) for s in range(0, 5 * 86400, 240)])  # from noon of the 15th on
    tables.write_ticks(t, root, "trades")
    times = ["2024-01-17 00:00:00", "2024-01-17 00:02:00", "2024-01-19 23:58:00"]
    got = readers.ticks_for_candles(spark, root, "2024-01-15", "2024-01-21", times, 24)
    want = readers.around(t, spark.createDataFrame([(x,) for x in times], "t string").select(F.col("t").cast("timestamp").alias("requested_at")), 24)
    assert got.count() == want.count() > 30
    assert {(r.id, str(r.requested_at)) for r in got.collect()} == {(r.id, str(r.requested_at)) for r in want.collect()}
    # Folders of days without a time are left out, and the ranges reach the row groups.
    optimized = got._jdf.queryExecution().optimizedPlan().toString()
    listed = re.search(r"day#\d+ IN \(([^)]*)\)", optimized)[1]
    assert listed.replace(" ", "") == "2024-01-16,2024-01-17,2024-01-19,2024-01-20"


def test_ranges_merge_and_stay_few():
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) for m in (0, 5, 60, 61, 600, 1200)]
    minute = dt.timedelta(minutes=1)
    assert [(int((a - at[0]) / minute), int((b - at[0]) / minute)) for a, b in readers.merged_ranges(at[::-1], 3 * minute)] == [
        (-3, 8), (57, 64), (597, 603), (1197, 1203)]
    assert [(int((a - at[0]) / minute), int((b - at[0]) / minute)) for a, b in readers.merged_ranges(at, minute, 3)] == [(-1, 62), (599, 601), (1199, 1201)]
    assert readers.merged_ranges(at, minute, 1) == [(at[0] - minute, at[-1] + minute)]


def test_warehouse_schema_grows(spark, tmp_path):
    root, days = str(tmp_path / "wh"), ("2024-01-15", "2024-01-16")
    frame = candles.ohlcv(ticks(spark, [(i, 10.0, 1.0) for i in range(0, 3 * 86400, 21600)]), "1h")
    first = frame.withColumn("grade", F.lit(1).cast("int"))
    status = {(str(r.day), r.timeframe): (r.rows, r.status) for r in warehouse.load(first, root, days, ["1h", "4h"]).collect()}
    assert status == {("2024-01-15", "1h"): (2, "loaded"), ("2024-01-16", "1h"): (4, "loaded"),
                      ("2024-01-15", "4h"): (0, "empty"), ("2024-01-16", "4h"): (0, "empty")}
    # The type is relaxed, a column comes, one is missing; the range overlaps.
    second = frame.drop("vwap").withColumns({"grade": F.lit(2**40), "remark": F.lit("new")})
    warehouse.load(second, root, ("2024-01-16", "2024-01-18"), ["1h"])
    rows = warehouse.read_table(spark, root, "candles_1h").orderBy("timestamp").collect()
    assert [r.grade for r in rows] == [1] * 2 + [2**40] * 10 and [r.remark for r in rows] == [None] * 2 + ["new"] * 10
    assert [r.vwap for r in rows] == [10.0] * 2 + [None] * 10 and rows[0].symbol == "A-B" and rows[0].exchange == "x"
    with pytest.raises(ValueError, match="grade"):
        warehouse.load(first.withColumn("grade", F.lit("text")), root, days, ["1h"])
    with pytest.raises(FileNotFoundError):
        warehouse.read_table(spark, root, "candles_5m")
    # A range without candles loses its days; the rest stays.
    warehouse.load(second.limit(0), root, ("2024-01-17", "2024-01-17"), ["1h"])
    assert warehouse.read_table(spark, root, "candles_1h").count() == 8
    plan_text = plan(warehouse.read_table(spark, root, "candles_1h").where(tables.days_between(*days)))
    assert "PartitionFilters: [isnotnull(day" in plan_text


def test_loads_read_their_range_only(spark, tmp_path):
    root = str(tmp_path / "src")
    tables.write_candles(candles.ohlcv(ticks(spark, [(i, 10.0, 1.0) for i in range(0, 4 * 86400, 21600)]), ("1m", "1h")), root)
    stored = spark.read.schema(readers.candle_table_schema()).parquet(root)
    report = stored.select("day", "instrument_key", F.lit("trades").alias("data_type")).distinct()
    chosen = stored.where(tables.days_between("2024-01-16", "2024-01-17") & F.col("timeframe").isin("1h"))
    assert "PartitionFilters" in plan(chosen) and chosen.count() == 8
    out = warehouse.load_available(stored, report.where("day <> '2024-01-16'"), str(tmp_path / "w"), ("2024-01-16", "2024-01-17"), ["1h"])
    assert {str(r.day): r.rows for r in out.collect()} == {"2024-01-16": 0, "2024-01-17": 4}
