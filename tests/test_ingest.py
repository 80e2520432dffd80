"""Landed files, their quarantine, loading again, and the catalog of what is stored."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tests.test_candles import START, ticks
from tickloom.operators import candles, coverage
from tickloom.plans import ingest, jobs
from tickloom.sinks import tables
from tickloom.sources import catalog, readers

DAY = dt.date(2024, 1, 15)
MICROS = 1_705_276_800_000_000  # the start of DAY
HEADER = "exchange,symbol,timestamp,local_timestamp,id,side,price,amount\n"


def line(i, price="10.0", exchange="binance", symbol="00123", day=0, more=""):
    at = MICROS + day * 86_400_000_000 + i * 1_000_000
    return f"{exchange},{symbol},{at},{at + 5},{i},buy,{price},1.5{more}\n"


def land(root, lines, day=DAY, source="binance", name="00123"):
    folder = f"{root}/data_type=trades/day={day}/source={source}/name={name}"
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/a.csv.gz", "wt") as out:
        out.write(HEADER + "".join(lines))


def wanted(spark, *rows):
    return spark.createDataFrame(rows, "day date, instrument_key string, data_type string, source string, name string")


A, B = (DAY, "X:SPOT:A", "trades", "binance", "00123"), (DAY, "X:SPOT:B", "trades", "okex", "b")


def run(spark, tmp_path, *targets):
    out = ingest.ingest_landed(spark, f"{tmp_path}/landing", f"{tmp_path}/ticks", wanted(spark, *targets), f"{tmp_path}/bad")
    return {r.instrument_key: (r.landed, r.rejected, r.stored_before, r.status) for r in out.collect()}


def stored(spark, tmp_path):
    rows = readers.read_ticks(spark, f"{tmp_path}/ticks", "2020-01-01", "2030-01-01").collect()
    return sorted((r.instrument_key, r.id, r.price) for r in rows)


def test_loading_again_replaces_targets_only(spark, tmp_path):
    land(f"{tmp_path}/landing", [line(0), line(1)])
    land(f"{tmp_path}/landing", [line(7, exchange="OKEX", symbol="B")], source="okex", name="b")
    assert run(spark, tmp_path, A) == {"X:SPOT:A": (2, 0, 0, "added")}
    assert run(spark, tmp_path, A, B) == {"X:SPOT:A": (2, 0, 2, "unchanged"), "X:SPOT:B": (1, 0, 0, "added")}
    both = [("X:SPOT:A", "0", 10.0), ("X:SPOT:A", "1", 10.0), ("X:SPOT:B", "7", 10.0)]
    assert stored(spark, tmp_path) == both
    before = {f for _, _, names in os.walk(f"{tmp_path}/ticks") for f in names}
    assert set(x[3] for x in run(spark, tmp_path, A, B).values()) == {"unchanged"}
    assert {f for _, _, names in os.walk(f"{tmp_path}/ticks") for f in names} == before
    # The same number of rows with another price is another file.
    land(f"{tmp_path}/landing", [line(0), line(1, "12.0")])
    assert run(spark, tmp_path, A, B)["X:SPOT:A"] == (2, 0, 2, "replaced")
    assert stored(spark, tmp_path) == [both[0], ("X:SPOT:A", "1", 12.0), both[2]]


def test_rows_and_files_are_quarantined_with_reasons(spark, tmp_path):
    land(f"{tmp_path}/landing", [line(0), line(1, "n/a"), line(2, "-3"), line(3, day=1), "binance,00123\n", line(5, more=",9,9"), line(0)])
    land(f"{tmp_path}/landing", [line(7, exchange="okex", symbol="b"), line(8, exchange="okex", symbol="c")], source="okex", name="b")
    assert run(spark, tmp_path, A, B) == {"X:SPOT:A": (7, 5, 0, "added"), "X:SPOT:B": (2, 2, 0, "quarantined")}
    assert stored(spark, tmp_path) == [("X:SPOT:A", "0", 10.0)] * 2  # repeated rows stay
    bad = spark.read.parquet(f"{tmp_path}/bad/trades").collect()
    reasons = sorted((r.instrument_key, r.id or "", sorted(r.errors)) for r in bad)
    assert reasons[0][2] == ["amount", "price", "side", "timestamp", "unreadable"]
    assert reasons[1:] == [("X:SPOT:A", "1", ["price"]), ("X:SPOT:A", "2", ["price"]), ("X:SPOT:A", "3", ["day"]), ("X:SPOT:A", "5", ["unreadable"]),
                           ("X:SPOT:B", "7", ["file_symbol"]), ("X:SPOT:B", "8", ["file_symbol"])]
    # A mended file leaves the quarantine; a broken one does not take stored rows away.
    land(f"{tmp_path}/landing", [line(7, exchange="okex", symbol="b")], source="okex", name="b")
    land(f"{tmp_path}/landing", [line(0, exchange="other")])
    assert run(spark, tmp_path, A, B) == {"X:SPOT:A": (1, 1, 2, "quarantined"), "X:SPOT:B": (1, 0, 0, "added")}
    assert len(stored(spark, tmp_path)) == 3
    assert [(r.instrument_key, r.errors) for r in spark.read.parquet(f"{tmp_path}/bad/trades").collect()] == [("X:SPOT:A", ["file_exchange"])]


def test_nothing_landed(spark, tmp_path):
    nobody = (DAY, "X:SPOT:C", "trades", None, None)
    quotes = (DAY, "X:SPOT:D", "quotes", "binance", "d")
    assert run(spark, tmp_path, A, nobody, quotes) == {k: (0, 0, 0, "not_landed") for k in ("X:SPOT:A", "X:SPOT:C", "X:SPOT:D")}
    assert run(spark, tmp_path) == {}
    with pytest.raises(ValueError, match="unknown data type"):
        run(spark, tmp_path, (DAY, "X:SPOT:A", "candy", "binance", "a"))


def test_reingest_tells_why_targets_are_left_out(spark, tmp_path):
    land(f"{tmp_path}/landing", [line(0)])
    missing = spark.createDataFrame([A[:3], (DAY, "X:FUTURE:Z-240105", "trades"), (DAY, "X:SPOT:Z", "trades")], "day date, instrument_key string, data_type string")
    known = spark.createDataFrame([("X:SPOT:A", "binance", "00123", "trades")], "instrument_key string, tardis_exchange string, tardis_symbol string, data_types string")
    out = ingest.reingest_job(spark, missing, known, f"{tmp_path}/landing", f"{tmp_path}/ticks").collect()
    assert {r.instrument_key: r.status for r in out} == {"X:SPOT:A": "added", "X:FUTURE:Z-240105": "expired", "X:SPOT:Z": "no_definition"}


def test_missing_report_is_made_once(spark, tmp_path):
    """What makes the report may read whole tables, the one that is loaded too: it runs once, before the table changes."""
    land(f"{tmp_path}/landing", [line(0)])
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(key):
        runs.add(1)
        return key

    missing = spark.createDataFrame([A[:3]], "day date, instrument_key string, data_type string").withColumn("instrument_key", counted("instrument_key"))
    known = spark.createDataFrame([("X:SPOT:A", "binance", "00123", "trades")], "instrument_key string, tardis_exchange string, tardis_symbol string, data_types string")
    out = ingest.reingest_job(spark, missing, known, f"{tmp_path}/landing", f"{tmp_path}/ticks", f"{tmp_path}/bad")
    assert [(r.instrument_key, r.status) for r in out.collect()] == [("X:SPOT:A", "added")] and runs.value == 1


def test_other_days_are_not_read(spark, tmp_path):
    """A file that cannot be read, landed or stored, on a day between the wanted ones."""
    later = (DAY + dt.timedelta(2), *A[1:])
    between = DAY + dt.timedelta(1)
    land(f"{tmp_path}/landing", [line(0)])
    land(f"{tmp_path}/landing", [line(1, day=2)], day=later[0])
    for folder, name in ((f"landing/data_type=trades/day={between}/source=binance/name=00123", "a.csv.gz"), (f"ticks/day={between}/data_type=trades", "a.parquet")):
        os.makedirs(f"{tmp_path}/{folder}")
        with open(f"{tmp_path}/{folder}/{name}", "w") as out:
            out.write("broken")
    for status in ("added", "unchanged"):
        got = ingest.ingest_landed(spark, f"{tmp_path}/landing", f"{tmp_path}/ticks", wanted(spark, A, later), f"{tmp_path}/bad").collect()
        assert sorted((r.day, r.landed, r.status) for r in got) == [(DAY, 1, status), (later[0], 1, status)]


def test_header_of_the_first_line_there_is(spark, tmp_path):
    """Files without a line do not hide the columns of others; without any line nothing has landed."""
    empty = f"{tmp_path}/landing/data_type=trades/day={DAY}/source=binance/name=a"
    os.makedirs(empty)
    with gzip.open(f"{empty}/a.csv.gz", "wt") as out:
        out.write("\n")
    assert ingest.read_landed(spark, f"{tmp_path}/landing", "trades") is None
    land(f"{tmp_path}/landing", [line(0)])
    assert {"exchange", "price", "amount", "file"} <= set(ingest.read_landed(spark, f"{tmp_path}/landing", "trades").columns)
    assert run(spark, tmp_path, A) == {"X:SPOT:A": (1, 0, 0, "added")}


def test_one_landed_file_a_day_and_instrument(spark, tmp_path):
    """p2_quarantined_rows: tasks that each hold all days do not each land their own file of every folder."""
    from checks import load_checks

    load_checks._land(two_instruments(spark, 400).repartition(6).withColumn("day", F.to_date("timestamp")), f"{tmp_path}/files", F.lit(False))
    files = [f for folder, _, names in os.walk(f"{tmp_path}/files") for f in names if f.endswith(".csv.gz")]
    folders = [folder for folder, _, names in os.walk(f"{tmp_path}/files") if any(f.endswith(".csv.gz") for f in names)]
    assert len(files) == len(folders) == 2


# -- catalog ---------------------------------------------------------------------------

def two_instruments(spark, rows):
    one = ticks(spark, [(i, 10.0, 1.0) for i in range(rows)])
    return one.unionByName(one.where(F.col("price") > 0).withColumn("instrument_key", F.lit("Y:SPOT:B")).limit(rows // 2))


def test_catalog_equals_a_count(spark, tmp_path):
    root = f"{tmp_path}/ticks"
    frame = two_instruments(spark, 2000).unionByName(ticks(spark, [(90_000, 1.0, 1.0)]).withColumn("instrument_key", F.lit(None).cast("string")))
    spark.conf.set("parquet.block.size", "20000")
    try:
        tables.write_ticks(frame, root, "trades")
    finally:
        spark.conf.unset("parquet.block.size")
    data = spark.read.parquet(root)
    found = catalog.stored(catalog.contents(spark, root))
    want = data.groupBy("day", "instrument_key", "data_type").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, found.select(*want.columns[:4], "first_time", "last_time").collect())) == sorted(map(key, want.collect()))
    totals = {r.day: r for r in catalog.totals(catalog.files(spark, root)).collect()}
    assert sum(r.rows for r in totals.values()) == data.count() and all(r.bytes > 0 for r in totals.values())
    assert catalog.contents(spark, root, days=("2024-01-15", "2024-01-15"), instruments=["Y:SPOT:B"]).agg(F.sum("rows")).first()[0] == 1000


def test_footers_alone_answer_for_single_instruments(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = pa.array([MICROS, MICROS + 1, MICROS + 2, MICROS + 3], pa.timestamp("us", "UTC"))
    pq.write_table(pa.table({"instrument_key": ["a", "a", "b", "c"], "timestamp": at}), f"{tmp_path}/x.parquet", row_group_size=2)

    class Footer:
        metadata = pq.ParquetFile(f"{tmp_path}/x.parquet").metadata
        asked: list = []

        def read_row_group(self, g, columns):
            self.asked.append((g, columns))
            return pq.ParquetFile(f"{tmp_path}/x.parquet").read_row_group(g, columns)

    file = Footer()
    assert list(catalog._entries(file, False)) == [(None, 2, MICROS, MICROS + 1), (None, 2, MICROS + 2, MICROS + 3)] and not file.asked
    assert list(catalog._entries(file, True)) == [("a", 2, MICROS, MICROS + 1), ("b", 1, MICROS + 2, MICROS + 2), ("c", 1, MICROS + 3, MICROS + 3)]
    assert file.asked == [(1, ["instrument_key", "timestamp"])]


def test_catalog_of_odd_files(spark, tmp_path):
    root = f"{tmp_path}/odd"
    spark.createDataFrame([(DAY, "notes", 1), (DAY, "notes", 2)], "day date, data_type string, n int").write.partitionBy("day", "data_type").parquet(root)
    rows = catalog.contents(spark, root).groupBy("instrument_key", "first_time").agg(F.sum("rows").alias("rows")).collect()
    assert [tuple(r) for r in rows] == [(None, None, 2)]
    empty = catalog.coverage(catalog.contents(spark, root, data_types=["trades"]), wanted(spark, A)).collect()
    assert [(r.venue, r.expected, r.found, r.rows, r.coverage_pct) for r in empty] == [("X", 1, 0, 0, 0.0)]


# -- the whole candle job ---------------------------------------------------------------

def test_candle_job_fills_its_grid(spark, tmp_path):
    trades = two_instruments(spark, 300)
    chain = spark.createDataFrame(
        [("U", "put", 90.0, -0.25, 0.6), ("U", "call", 110.0, 0.25, 0.5), ("U", "call", 100.0, 0.5, 0.4)],
        "underlying_index string, type string, strike_price double, delta double, mark_iv double").withColumns({
            "timestamp": F.lit(str(START + dt.timedelta(seconds=90))).cast("timestamp"), "local_timestamp": F.lit(str(START + dt.timedelta(seconds=91))).cast("timestamp"),
            "expiration": F.lit("2024-02-01").cast("timestamp"), "id": F.lit("1")})
    days = ("2024-01-15", "2024-01-15")
    mine = trades.select("instrument_key").where("instrument_key <> 'Y:SPOT:B'").distinct()
    pairs = mine.withColumn("day", F.lit("2024-01-15").cast("date"))
    jobs.candle_job(spark, str(tmp_path), trades, eligible=pairs, base_timeframes=["1m"], rollups=["1h"], days=days, grid=True,
                    chain=chain, underlyings=mine.withColumn("underlying_index", F.lit("U")))
    rows = spark.read.parquet(f"{tmp_path}/candles")
    assert {r.timeframe: r["count"] for r in rows.groupBy("timeframe").count().collect()} == {"1m": 1440, "1h": 24}
    hours = rows.where("timeframe = '1h'").orderBy("timestamp").collect()
    (at,) = [i for i, r in enumerate(hours) if r.trade_count]
    first, second = hours[at], hours[at - 1]
    plain = candles.ohlcv(trades.join(mine, "instrument_key", "left_semi"), "1h").first()
    assert (first.open, first.close, first.trade_count, first.volume) == (plain.open, plain.close, plain.trade_count, plain.volume)
    assert (round(first.skew_25d_put_call_ratio, 9), first.atm_mark_iv) == (1.2, 0.4)
    assert (second.open, second.close, second.volume, second.trade_count, second.atm_mark_iv) == (None, None, 0.0, 0, None)
    quoted = rows.where("timeframe = '1m' AND atm_mark_iv IS NOT NULL").select(F.date_format("timestamp", "HH:mm")).collect()
    assert [r[0] for r in quoted] == [f"{START + dt.timedelta(seconds=60):%H:%M}"]
    with pytest.raises(ValueError, match="underlyings"):
        jobs.candle_job(spark, str(tmp_path), trades, chain=chain)


def test_groups_are_judged_by_day(spark):
    names = "instrument_key string, instrument_type string, base_asset string, underlying string, available_from_datetime string, available_to_datetime string"
    life = ("2024-01-15T00:00:00Z", "2024-01-16T00:00:00Z")
    known = spark.createDataFrame([("a", "SPOT_PAIR", "U", "", *life), ("b", "PERPETUAL", "U", "", *life), ("c", "SPOT_PAIR", "V", "", *life)], names)
    there = spark.createDataFrame([(DAY, "a", "trades"), (DAY, "b", "trades"), (DAY + dt.timedelta(1), "a", "trades")], "day date, instrument_key string, data_type string")
    out = coverage.eligible_days(known, there, "2024-01-01", "2024-01-31", ["trades"]).collect()
    assert sorted((r.day, r.instrument_key) for r in out) == [(DAY, "a"), (DAY, "b")]
