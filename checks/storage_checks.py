"""Sources, sinks and batch jobs: each writes a table, reads it back and returns it."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.common import CANDLE_SQL, Checks, r, rounded
from checks.coverage_checks import _COVERAGE, END, START
from checks.instrument_checks import DEFINED, ELIGIBLE
from tickloom.functions.timegrid import calendar
from tickloom.operators import book, candles, coverage, features, instruments, quality
from tickloom.plans import jobs
from tickloom.session import work_folder
from tickloom.sinks import tables, warehouse
from tickloom.sources import adapters as ad
from tickloom.sources import readers

CHECKS = Checks()
check = CHECKS.add
LOW, HIGH = "2024-01-05 06:00:00", "2024-01-20 18:30:00"
_IN = f"\"timestamp\" BETWEEN TIMESTAMP '{LOW}' AND TIMESTAMP '{HIGH}'"
_TS0 = "TIMESTAMP '1970-01-01'"


def _tick_table(spark, sf):
    """All tick types of the test tables, written once per call."""
    root = work_folder(spark, "ticks")
    for name, source in (("trades", ad.trades), ("liquidations", ad.liquidations), ("derivative_ticker", ad.derivative_ticker)):
        tables.write_ticks(source(spark, sf), root, name)
    return root


# -- sources ---------------------------------------------------------------------

@check("a1_tick_scan", fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER) + f"""
SELECT 'trades' AS data_type, day, instrument_key, "timestamp", local_timestamp, side, price, amount, NULL::DOUBLE AS open_interest FROM trades WHERE {_IN}
UNION ALL SELECT 'derivative_ticker', day, instrument_key, "timestamp", local_timestamp, NULL, NULL, NULL, open_interest FROM ticker WHERE {_IN}""")
def _scan(spark, sf):
    ticks = readers.read_ticks(spark, _tick_table(spark, sf), LOW, HIGH, ["trades", "derivative_ticker"])
    return readers.sorted_ticks(ticks).select(
        "data_type", "day", "instrument_key", "timestamp", "local_timestamp", "side", "price", "amount", "open_interest")


@check("a2_pushed_down_scan", fx.with_(fx.TRADES) + f"""
SELECT instrument_key, "timestamp", price FROM trades WHERE {_IN} AND instrument_key IN ('BINANCE:SPOT_PAIR:U1-USDT', 'BINANCE:SPOT_PAIR:U6-USDT')""")
def _pushed(spark, sf):
    return readers.read_ticks(
        spark, _tick_table(spark, sf), LOW, HIGH, instruments=["BINANCE:SPOT_PAIR:U1-USDT", "BINANCE:SPOT_PAIR:U6-USDT"],
    ).select("instrument_key", "timestamp", "price")


@check("a3_chunked_scan", fx.with_(fx.TRADES) + """
SELECT side, CAST(count(*) AS BIGINT) AS "rows", round(sum(price * amount), 4) AS notional FROM trades GROUP BY 1""")
def _chunked(spark, sf):
    """Each Arrow chunk is folded to one row per side where it lies; the partial rows are summed."""
    def fold(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.append_column("n", pc.multiply(table["price"], table["amount"]))
            sums = table.group_by("side").aggregate([("n", "count"), ("n", "sum")])
            yield from sums.select(["side", "n_count", "n_sum"]).rename_columns(["side", "rows", "notional"]).to_batches()

    ticks = ad.trades(spark, sf).select("side", "price", "amount")
    partial = readers.map_chunks(ticks, fold, "side string, rows bigint, notional double")
    return partial.groupBy("side").agg(F.sum("rows").alias("rows"), F.round(F.sum("notional"), 4).alias("notional"))


@check("c1_closed_range", fx.with_(fx.TRADES) + f"SELECT id, \"timestamp\" FROM trades WHERE {_IN}")
def _closed(spark, sf):
    return ad.trades(spark, sf).where(F.col("timestamp").between(LOW, HIGH)).select("id", "timestamp")


@check("a4_sparse_ticks", fx.with_(fx.TRADES, fx.candles(14400)) + """
SELECT t.id, t.instrument_key, t.price, c."timestamp" AS requested_at FROM trades t JOIN candles c ON c.instrument_key = t.instrument_key
 AND abs(epoch_us(t."timestamp") - epoch_us(c."timestamp")) <= 7 * 60000000""")
def _sparse(spark, sf):
    trades = ad.trades(spark, sf)
    times = candles.ohlcv(trades, "4h").select("instrument_key", F.col("timestamp").alias("requested_at"))
    return readers.around(trades, times, 7).select("id", "instrument_key", "price", "requested_at")


_TIMES = ["2024-01-06 00:00:00", "2024-01-11 12:00:00", "2024-01-11 12:15:00", "2024-01-19 08:00:00"]


@check("a5_ticks_for_candles", fx.with_(fx.TRADES) + f"""
SELECT instrument_key, "timestamp", price, requested_at FROM trades, (SELECT CAST(unnest({_TIMES}) AS TIMESTAMP) AS requested_at)
WHERE abs(epoch_us("timestamp") - epoch_us(requested_at)) <= 20 * 60000000""")
def _for_candles(spark, sf):
    return readers.ticks_for_candles(spark, _tick_table(spark, sf), LOW, HIGH, _TIMES, 20).select(
        "instrument_key", "timestamp", "price", "requested_at")


def _candle_table(spark, sf, feature=False):
    root = work_folder(spark, "candles")
    trades = ad.trades(spark, sf)
    for tf in ("1h", "1m"):
        frame = features.candles_with_features(trades, tf) if feature else candles.ohlcv(trades, tf)
        tables.write_candles(frame, root)
    return root


@check("a6_candle_scan", fx.with_(fx.TRADES, fx.candles(3600), fx.candles(60, "c1m")) + f"""
SELECT timeframe, {CANDLE_SQL} FROM (SELECT '1h' AS timeframe, * FROM candles UNION ALL SELECT '1m', * FROM c1m) WHERE {_IN}""")
def _candle_scan(spark, sf):
    return rounded(readers.read_candles(spark, _candle_table(spark, sf), LOW, HIGH, ["1h", "1m"]).drop("day"))


_FEATURES = ("buy_volume_sum", "sell_volume_sum", "size_avg", "price_vwap", "delay_median", "delay_max", "delay_min", "delay_mean")


def _feature_scan_sql(n, tf):
    from checks.candle_checks import _trade_features_cte

    return fx.with_(fx.TRADES, fx.candles(n), _trade_features_cte(n)) + f"""
SELECT '{tf}' AS timeframe, c.instrument_key, c."timestamp", round(c."close", 6) AS "close", {r(*_FEATURES)} FROM candles c
JOIN tf ON tf.instrument_key = c.instrument_key AND tf.b = c."timestamp" WHERE {_IN.replace('"timestamp"', 'c."timestamp"')}"""


@check("a7_hft_feature_scan", _feature_scan_sql(60, "1m"))
def _hft(spark, sf):
    frame = readers.read_hft_features(spark, _candle_table(spark, sf, True), LOW, HIGH, "1m")
    return rounded(frame.select("timeframe", "instrument_key", "timestamp", "close", *_FEATURES))


@check("a8_mft_feature_scan", _feature_scan_sql(3600, "1h"))
def _mft(spark, sf):
    frame = readers.read_mft_features(spark, _candle_table(spark, sf, True), LOW, HIGH, "1h")
    return rounded(frame.select("timeframe", "instrument_key", "timestamp", "close", *_FEATURES))


def _instrument_table(spark, sf):
    path = work_folder(spark, "instruments")
    rows = ad.instruments(spark, sf).drop("p_partkey")
    tables.write_instrument_windows(instruments.windowed(rows, START, END), path)
    return path


@check("a9_instruments_for_day", fx.with_(fx.INSTRUMENTS) + """
SELECT DISTINCT instrument_key, venue, base_asset FROM instruments WHERE d0 <= DATE '1995-07-01' AND d1 >= DATE '1995-07-01' AND venue IN ('BINANCE', 'DERIBIT')""")
def _for_day(spark, sf):
    path = _instrument_table(spark, sf)
    return readers.instruments_for_day(spark, [path + "-none", path], "1995-07-01", venue=["binance", "deribit"]).select(
        "instrument_key", "venue", "base_asset").distinct()


@check("b5_instrument_ranges", fx.with_(fx.INSTRUMENTS) + """
SELECT DISTINCT instrument_key, venue, base_asset, CAST(greatest(d0, DATE '1995-01-01') AS DATE) AS first_day, CAST(least(d1, DATE '1996-06-30') AS DATE) AS last_day
FROM instruments WHERE d0 <= DATE '1996-06-30' AND d1 >= DATE '1995-01-01'""")
def _ranges(spark, sf):
    """Daily definitions, written as the aggregate of runs of equal days."""
    path = work_folder(spark, "b5r")
    rows = ad.instruments(spark, sf)
    tables.write_instrument_ranges(instruments.daily(rows, "1995-01-01", "1996-06-30"), path)
    return spark.read.parquet(path).select("instrument_key", "venue", "base_asset", "first_day", "last_day").distinct()


@check("a9_fall_back_by_day", fx.with_(fx.INSTRUMENTS) + """
SELECT CAST(day AS DATE) AS day, CASE WHEN extract(day FROM day) % 5 = 0 THEN 'range' ELSE 'daily' END AS source, count(*) AS instruments FROM (
  SELECT p_partkey, unnest(generate_series(greatest(CAST(d0 AS TIMESTAMP), TIMESTAMP '1995-03-01'), least(CAST(d1 AS TIMESTAMP), TIMESTAMP '1995-06-30'), INTERVAL 1 DAY)) AS day
  FROM instruments WHERE d0 <= DATE '1995-06-30' AND d1 >= DATE '1995-03-01') GROUP BY ALL""")
def _fall_back(spark, sf):
    """The daily table lacks every fifth day of a month; those come from the ranges."""
    path = work_folder(spark, "a9r")
    daily = instruments.daily(ad.instruments(spark, sf), "1995-01-01", "1995-12-31")
    tables.write_instrument_ranges(daily, path)
    both = instruments.definitions_by_day(daily.where(F.dayofmonth("day") % 5 != 0), spark.read.parquet(path), "1995-03-01", "1995-06-30")
    return both.groupBy("day", "source").agg(F.count(F.lit(1)).alias("instruments"))


@check("a10_missing_instrument_days", fx.with_(fx.INSTRUMENTS, """
cal AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS day)""") + """
SELECT day FROM cal WHERE NOT EXISTS (SELECT 1 FROM instruments WHERE d0 <= day AND d1 >= day)""")
def _missing_days(spark, sf):
    daily = instruments.daily(ad.instruments(spark, sf), "1994-11-01", "1999-12-31")
    return readers.missing_instrument_days(calendar(spark, "1994-11-01", "1999-12-31"), daily)


@check("a11_file_catalog", fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER) + """
SELECT DISTINCT day, 'trades' AS data_type FROM trades UNION SELECT DISTINCT day, 'liquidations' FROM liquidations UNION
SELECT DISTINCT day, 'derivative_ticker' FROM ticker""")
def _catalog(spark, sf):
    return readers.file_catalog(spark, _tick_table(spark, sf)).where(F.col("bytes") > 0).select("day", "data_type").distinct()


@check("a12_stored_instruments", fx.with_(fx.TRADES) + "SELECT DISTINCT instrument_key FROM trades WHERE day = DATE '2024-01-09' ORDER BY 1")
def _stored(spark, sf):
    return readers.stored_instruments(ad.trades(spark, sf), "2024-01-09")


@check("a13_catalog_totals", fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER) + """
SELECT day, data_type, count(*) AS "rows", TRUE AS has_files FROM (SELECT day, 'trades' AS data_type FROM trades UNION ALL SELECT day, 'liquidations' FROM liquidations
  UNION ALL SELECT day, 'derivative_ticker' FROM ticker) GROUP BY ALL""")
def _totals(spark, sf):
    root = _tick_table(spark, sf)
    rows = spark.read.parquet(root).groupBy("day", "data_type").agg(F.count(F.lit(1)).alias("rows"))
    totals = readers.catalog_totals(readers.file_catalog(spark, root))
    return totals.join(rows, ["day", "data_type"]).select(
        "day", "data_type", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@check("g5_latest_file", fx.with_(fx.TRADES) + "SELECT TRUE AS found, max(day) >= min(day) AS ordered FROM trades")
def _latest_file(spark, sf):
    root = _tick_table(spark, sf)
    latest = readers.latest_file(readers.file_catalog(spark, root))
    return latest.select(F.col("path").contains("data_type=").alias("found"), F.col("modified").isNotNull().alias("ordered"))


def _vendor_csv(spark, frame, name):
    path = work_folder(spark, name)
    frame.write.option("header", "true").option("compression", "gzip").csv(path)
    return path


def _micros(c):
    return F.unix_micros(c).cast("string").alias(c)


@check("a14_vendor_csv_trades", fx.with_(fx.TRADES) + """
SELECT id, instrument_key AS symbol, epoch_us("timestamp") AS "timestamp", CASE WHEN amount = 5.0 THEN NULL ELSE price END AS price, amount, side FROM trades""")
def _csv_trades(spark, sf):
    raw = ad.trades(spark, sf).select(
        F.lit("binance").alias("exchange"), F.col("instrument_key").alias("symbol"), _micros("timestamp"), _micros("local_timestamp"), "id", "side",
        F.when(F.col("amount") == 5.0, "n/a").otherwise(F.col("price").cast("string")).alias("price"), "amount")
    ticks = readers.read_vendor_csv(spark, _vendor_csv(spark, raw, "csv-trades"), "trades")
    return ticks.select("id", "symbol", "timestamp", "price", "amount", "side")


_BOOK_OUT = [f"{s}_{w}_{i}" for i in (1, 5) for s in ("bid", "ask") for w in ("price", "volume")]


@check("c8_vendor_csv_books", fx.with_(fx.EVENTS, fx.BOOKS) +
       'SELECT epoch_us("timestamp") AS "timestamp", ' + r(*_BOOK_OUT) + " FROM books")
def _csv_books(spark, sf):
    books = ad.book_snapshots(spark, sf)
    back = {ours: vendor for vendor, ours in readers.VENDOR_BOOK_NAMES.items()}
    raw = books.select(F.lit("binance").alias("exchange"), F.col("instrument_key").alias("symbol"), _micros("timestamp"), _micros("local_timestamp"),
                       *[F.col(c).alias(back[c]) for c in books.columns if c in back])
    return rounded(readers.read_vendor_csv(spark, _vendor_csv(spark, raw, "csv-books"), "book_snapshot_5").select("timestamp", *_BOOK_OUT))


_CHAIN_OUT = ["underlying_index", "timestamp", "expiration", "type", "strike_price", "delta", "mark_iv"]


@check("a14_vendor_csv_options", fx.with_(fx.OPTIONS) + """
SELECT underlying_index, epoch_us("timestamp") AS "timestamp", epoch_us(expiration) AS expiration, type, strike_price, round(delta, 6) AS delta, round(mark_iv, 6) AS mark_iv FROM chain""")
def _csv_options(spark, sf):
    chain = ad.options_chain(spark, sf)
    raw = chain.select("underlying_index", _micros("timestamp"), _micros("local_timestamp"), _micros("expiration"), "type", "strike_price", "delta", "mark_iv")
    return rounded(readers.read_vendor_csv(spark, _vendor_csv(spark, raw, "csv-options"), "options_chain").select(*_CHAIN_OUT))


@check("a14_vendor_csv_ticker", fx.with_(fx.EVENTS, fx.TICKER) + """
SELECT epoch_us("timestamp") AS "timestamp", round(funding_rate, 9) AS funding_rate, round(predicted_funding_rate, 9) AS predicted_funding_rate,
  round(open_interest, 9) AS open_interest FROM ticker""")
def _csv_ticker(spark, sf):
    ticker = ad.derivative_ticker(spark, sf)
    raw = ticker.select(_micros("timestamp"), _micros("local_timestamp"), "funding_rate", F.coalesce(
        F.col("predicted_funding_rate").cast("string"), F.lit("NaN")).alias("predicted_funding_rate"), "open_interest", "last_price", "index_price", "mark_price")
    frame = readers.read_vendor_csv(spark, _vendor_csv(spark, raw, "csv-ticker"), "derivative_ticker")
    return rounded(frame.select("timestamp", "funding_rate", "predicted_funding_rate", "open_interest"), 9)


@check("a14_vendor_csv_quotes", fx.with_(fx.EVENTS, fx.BOOKS) + """
SELECT epoch_us("timestamp") AS "timestamp", """ + r("bid_price", "bid_amount", "ask_price", "ask_amount") + """
FROM (SELECT "timestamp", bid_price_1 AS bid_price, bid_volume_1 AS bid_amount, ask_price_1 AS ask_price, ask_volume_1 AS ask_amount FROM books)""")
def _csv_quotes(spark, sf):
    b = ad.book_snapshots(spark, sf)
    raw = b.select(_micros("timestamp"), _micros("local_timestamp"), F.col("bid_price_1").alias("bid_price"), F.col("bid_volume_1").alias("bid_amount"),
                   F.col("ask_price_1").alias("ask_price"), F.col("ask_volume_1").alias("ask_amount"))
    frame = readers.read_vendor_csv(spark, _vendor_csv(spark, raw, "csv-quotes"), "quotes")
    return rounded(frame.select("timestamp", "bid_price", "bid_amount", "ask_price", "ask_amount"))


@check("a16_validated_ticks", fx.with_(fx.TRADES) + """
SELECT id, "timestamp", price, amount, side FROM trades WHERE amount <> 5.0 AND price > 0""")
def _validated(spark, sf):
    raw = ad.trades(spark, sf).select(
        _micros("timestamp"), _micros("local_timestamp"), "id", "side",
        F.when(F.col("amount") == 5.0, "-1").otherwise(F.col("price").cast("string")).alias("price"), F.col("amount").cast("string").alias("amount"))
    good, _ = quality.split_valid(readers.as_times(readers.typed(raw, "trades")), "trades")
    return good.select("id", "timestamp", "price", "amount", "side")


@check("a18_read_report", _COVERAGE + "SELECT instrument_key, data_type, status FROM missing_rows WHERE day = DATE '1995-03-05'".replace(
    "missing_rows", "(SELECT *, 'missing' AS status FROM missing)"))
def _read_report(spark, sf):
    path = work_folder(spark, "missing")
    definitions, available = ad.instruments(spark, sf), ad.available_ticks(spark, sf)
    jobs.missing_job(definitions, available, path, START, END)
    return readers.read_report(spark, path, "1995-03-05").select("instrument_key", "data_type", "status")


@check("a19_candle_file", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT 'all' AS symbol, '1h' AS timeframe, 'file' AS source, "timestamp", """ + r("open", "high", "low", "close", "volume") + " FROM candles")
def _candle_file(spark, sf):
    path = work_folder(spark, "ohlcv")
    candles.ohlcv(ad.trades(spark, sf), "1h").select(
        F.col("timestamp").alias("ts"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"),
        F.col("volume").alias("v")).write.parquet(path)
    return rounded(readers.read_ohlcv(spark, path, "all", "1h", "file"))


# -- sinks ------------------------------------------------------------------------

@check("b1_write_ticks", fx.with_(fx.TRADES) + "SELECT day, 'trades' AS data_type, id, instrument_key, \"timestamp\", price FROM trades")
def _write_ticks(spark, sf):
    root = work_folder(spark, "b1")
    tables.write_ticks(ad.trades(spark, sf).withColumn("exchange", F.lit("x")), root, "trades")
    return spark.read.parquet(root).select("day", "data_type", "id", "instrument_key", "timestamp", "price")


@check("c7_labels_dropped", fx.with_(fx.TRADES) + "SELECT id, price, FALSE AS has_exchange, FALSE AS has_symbol FROM trades")
def _labels(spark, sf):
    """Vendor labels are checked at ingest and not stored."""
    root = work_folder(spark, "c7")
    labelled = ad.trades(spark, sf).withColumns({"exchange": F.lit("binance"), "symbol": F.col("instrument_key")})
    tables.write_ticks(labelled, root, "trades")
    stored = spark.read.parquet(root)
    return stored.select("id", "price", F.lit("exchange" in stored.columns).alias("has_exchange"),
                         F.lit("symbol" in stored.columns).alias("has_symbol"))


@check("b2_write_sorted", fx.with_(fx.DENSE_TRADES) + "SELECT day, count(*) AS \"rows\", round(sum(amount), 4) AS amount FROM dense GROUP BY 1")
def _write_sorted(spark, sf):
    root = work_folder(spark, "b2")
    dense = ad.dense_trades(spark, sf).withColumn("year", F.year("day"))
    tables.write_sorted(dense, root, ["year"], ["timestamp", "id"])
    return spark.read.parquet(root).groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("amount"), 4).alias("amount"))


@check("b3_write_candles_twice", fx.with_(fx.TRADES, fx.candles(3600)) + f"""
SELECT '1h' AS timeframe, {CANDLE_SQL.replace('round("volume", 6)', 'round(volume * (CASE WHEN extract(day FROM "timestamp") = 9 THEN 2 ELSE 1 END), 6)')} FROM candles""")
def _write_candles(spark, sf):
    root = work_folder(spark, "b3")
    frame = candles.ohlcv(ad.trades(spark, sf), "1h")
    tables.write_candles(frame, root)
    tables.write_candles(frame.where(F.dayofmonth("timestamp") == 9).withColumn("volume", F.col("volume") * 2), root)
    return rounded(spark.read.parquet(root).drop("day"))


@check("b3_rewrite_one_timeframe", fx.with_(fx.TRADES, fx.candles(60, "c1"), fx.candles(3600, "c2")) + f"""
SELECT '1m' AS timeframe, {CANDLE_SQL} FROM c1 WHERE extract(day FROM "timestamp") NOT BETWEEN 5 AND 12 OR "close" > 200
UNION ALL SELECT '1h' AS timeframe, {CANDLE_SQL} FROM c2""")
def _rewrite(spark, sf):
    """A range of one timeframe is written again with fewer candles: the rest of the range goes, 1h and other days stay."""
    root = work_folder(spark, "b3b")
    frame = candles.ohlcv(ad.trades(spark, sf), ("1m", "1h"))
    tables.write_candles(frame, root)
    tables.write_candles(frame.where("timeframe = '1m' AND close > 200"), root, days=("2024-01-05", "2024-01-12"))
    return rounded(spark.read.parquet(root).drop("day"))


@check("b4_write_book_rows", fx.with_(fx.EVENTS, fx.BOOKS) + f"""
SELECT CAST(b AS DATE) AS day, count(*) AS "rows" FROM (SELECT DISTINCT instrument_key, time_bucket(INTERVAL 1 MINUTE, "timestamp", {_TS0}) AS b FROM books) GROUP BY 1""")
def _write_book(spark, sf):
    root = work_folder(spark, "b4")
    tables.write_candles(book.book_features(ad.book_snapshots(spark, sf), "1m"), root)
    return spark.read.parquet(root).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


@check("b5_write_instruments", fx.with_(fx.INSTRUMENTS) + """
SELECT CAST(day AS DATE) AS day, count(DISTINCT instrument_key) AS instruments FROM (SELECT instrument_key, unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM instruments) GROUP BY 1""")
def _write_instruments(spark, sf):
    return spark.read.parquet(_instrument_table(spark, sf)).groupBy("day").agg(
        F.count_distinct("instrument_key").alias("instruments"))


@check("b6_write_report", _COVERAGE + """
SELECT day, count(*) AS missing, 'all' AS venues_filter, TIMESTAMP '2024-02-01' AS generated_at FROM missing GROUP BY 1""")
def _write_report(spark, sf):
    path = work_folder(spark, "b6")
    jobs.missing_job(ad.instruments(spark, sf), ad.available_ticks(spark, sf), path, START, END, generated_at="2024-02-01 00:00:00")
    return spark.read.parquet(path).groupBy("day", "venues_filter", "generated_at").agg(F.count(F.lit(1)).alias("missing"))


@check("b7_warehouse_load", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT split_part(instrument_key, ':', 3) AS symbol, 'binance' AS exchange, instrument_key AS instrument_id, '1h' AS timeframe, CAST("timestamp" AS DATE) AS date,
  CAST(timestamp_out AS DATE) AS day_out, "timestamp", """ + r("open", "volume") + ", trade_count FROM candles")
def _warehouse(spark, sf):
    path = work_folder(spark, "b7")
    name = "tickloom_" + path.rstrip("/").split("-")[-1].replace(".", "_").lower()
    tables.load_warehouse(candles.ohlcv(ad.trades(spark, sf), "1h"), name, path, "overwrite")
    return rounded(spark.read.parquet(path).select(
        "symbol", "exchange", "instrument_id", "timeframe", "date", "day_out", "timestamp", "open", "volume", "trade_count"))


def _two_loads(spark, sf):
    """Days 1 to 14 without, then days 10 to 20 with a column more and other volumes, into tables of 1h and 4h."""
    root = work_folder(spark, "b7b")
    frame = candles.ohlcv(ad.trades(spark, sf), ("1h", "4h"))
    warehouse.load(frame.withColumn("trade_count", F.col("trade_count").cast("int")), root, ("2024-01-01", "2024-01-14"), ["1h", "4h"])
    more = frame.where("close > 50").withColumns({"volume": F.col("volume") * 2, "note": F.col("trade_count").cast("int")})
    return root, warehouse.load(more, root, ("2024-01-10", "2024-01-20"), ["1h", "4h"])


@check("b7_two_loads", fx.with_(fx.TRADES, fx.candles(3600, "c1"), fx.candles(14400, "c2"), """
c AS (SELECT 'candles_1h' AS name, * FROM c1 UNION ALL SELECT 'candles_4h', * FROM c2)""") + """
SELECT name, instrument_key AS instrument_id, CAST("timestamp" AS DATE) AS day, "timestamp", round("close", 6) AS "close",
  round(CASE WHEN extract(day FROM "timestamp") >= 10 THEN 2 ELSE 1 END * volume, 6) AS volume,
  CASE WHEN extract(day FROM "timestamp") >= 10 THEN trade_count END AS note
FROM c WHERE extract(day FROM "timestamp") < 10 OR (extract(day FROM "timestamp") <= 20 AND "close" > 50)""")
def _warehouse_two_loads(spark, sf):
    root, _ = _two_loads(spark, sf)
    out = None
    for name in ("candles_1h", "candles_4h"):
        one = warehouse.read_table(spark, root, name).select(
            F.lit(name).alias("name"), "instrument_id", "day", "timestamp", "close", "volume", F.col("note").cast("long").alias("note"))
        out = one if out is None else out.unionByName(one)
    return rounded(out)


@check("b8_range_status", fx.with_(fx.TRADES, fx.candles(3600, "c1"), fx.candles(14400, "c2"), """
c AS (SELECT '1h' AS timeframe, * FROM c1 UNION ALL SELECT '4h', * FROM c2)""", """
d AS (SELECT timeframe, CAST("timestamp" AS DATE) AS day, count(*) AS n FROM c WHERE "close" > 50 GROUP BY ALL)""", """
g AS (SELECT timeframe, CAST(day AS DATE) AS day FROM (SELECT unnest(['1h', '4h']) AS timeframe),
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS day))""") + """
SELECT g.day, g.timeframe, coalesce(n, 0) AS "rows", CASE WHEN n > 0 THEN 'loaded' ELSE 'empty' END AS status
FROM g LEFT JOIN d ON d.day = g.day AND d.timeframe = g.timeframe""")
def _range_status(spark, sf):
    return _two_loads(spark, sf)[1]


@check("p8_report_to_warehouse", fx.with_(fx.TRADES, """
a AS (SELECT DISTINCT instrument_key, CAST("timestamp" AS DATE) AS day FROM trades WHERE extract(day FROM "timestamp") % 3 <> 0)""", """
s AS (SELECT t.* FROM trades t JOIN a ON a.instrument_key = t.instrument_key AND a.day = CAST(t."timestamp" AS DATE) WHERE extract(day FROM t."timestamp") BETWEEN 5 AND 12)""",
    fx.candles(60, "c1", "s"), fx.candles(3600, "c2", "s")) + """
SELECT '1m' AS timeframe, count(*) AS "rows", count(DISTINCT CAST("timestamp" AS DATE)) AS days_loaded, 8 - count(DISTINCT CAST("timestamp" AS DATE)) AS days_empty FROM c1
UNION ALL SELECT '1h', count(*), count(DISTINCT CAST("timestamp" AS DATE)), 8 - count(DISTINCT CAST("timestamp" AS DATE)) FROM c2""")
def _report_to_warehouse(spark, sf):
    """Every third day is not available; two runs of the same range."""
    root = work_folder(spark, "p8b")
    trades = ad.trades(spark, sf)
    report = trades.select("instrument_key", F.to_date("timestamp").alias("day"), F.lit("trades").alias("data_type")).distinct().where(
        F.dayofmonth("day") % 3 != 0)
    for _ in range(2):
        out = jobs.warehouse_job(spark, root, f"{root}/warehouse", report, ("2024-01-05", "2024-01-12"), trades, ["1m"], ["1h"])
    return out


@check("b8_backfill", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT CAST("timestamp" AS DATE) AS day, '1h' AS timeframe, count(*) AS "rows" FROM candles GROUP BY ALL""")
def _backfill(spark, sf):
    root = work_folder(spark, "b8")
    frame = candles.ohlcv(ad.trades(spark, sf), "1h")
    tables.backfill(frame, root)
    return tables.backfill(frame.where(F.dayofmonth("timestamp") > 20), root)


@check("b11_retention", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS "rows" FROM candles
WHERE CAST("timestamp" AS DATE) >= (SELECT max(CAST("timestamp" AS DATE)) FROM candles) - 10 GROUP BY ALL""")
def _retention(spark, sf):
    root = work_folder(spark, "b11")
    tables.write_candles(candles.ohlcv(ad.trades(spark, sf), "1h"), root)
    tables.expire(spark, root, keep_days=10)
    return spark.read.parquet(root).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


@check("b13_message_archive", fx.with_(fx.EVENTS) + """
SELECT event_type AS type, 'binance' AS exchange, split_part(instrument_key, ':', 3) AS symbol, CAST(event_id AS BIGINT) AS id, value AS price FROM ev""")
def _archive(spark, sf):
    root = work_folder(spark, "b13")
    messages = ad.event_columns(ad.table(spark, sf, "events")).select(
        F.col("event_type").alias("type"), F.lit("binance").alias("exchange"), F.split_part("instrument_key", F.lit(":"), F.lit(3)).alias("symbol"),
        "timestamp", F.col("id").cast("long").alias("id"), F.col("value").alias("price"))
    tables.archive(messages, root)
    stored = spark.read.parquet(root)
    body = F.from_json("payload", "id bigint, price double")
    return stored.select("type", "exchange", "symbol", body["id"].alias("id"), body["price"].alias("price"))


@check("b14_export_csv", _COVERAGE + "SELECT CAST(day AS VARCHAR) AS day, instrument_key, data_type FROM missing")
def _export(spark, sf):
    path = work_folder(spark, "b14")
    expected = coverage.expected_types(ad.instruments(spark, sf), START, END)
    tables.export(coverage.missing_types(expected, ad.available_ticks(spark, sf)), path)
    return spark.read.option("header", "true").csv(path).select("day", "instrument_key", "data_type")


# -- jobs ----------------------------------------------------------------------------

@check("p1_instrument_job", ELIGIBLE + """
SELECT exchange, coalesce(skip_reason, 'eligible') AS outcome, count(*) AS symbols FROM eligible GROUP BY ALL""")
def _instrument_job(spark, sf):
    return jobs.instrument_job(ad.vendor_symbols(spark, sf), work_folder(spark, "p1"), "2024-03-01", "2024-06-30")


@check("p1_instrument_table", DEFINED + """
SELECT CAST(day AS DATE) AS day, venue, count(*) AS instruments FROM (
  SELECT venue, unnest(generate_series(greatest(CAST(CAST(substr(available_from_datetime, 1, 10) AS DATE) AS TIMESTAMP), TIMESTAMP '2024-03-01'),
    least(CAST(CAST(substr(available_to_datetime, 1, 10) AS DATE) AS TIMESTAMP), TIMESTAMP '2024-06-30'), INTERVAL 1 DAY)) AS day FROM defined) GROUP BY ALL""")
def _instrument_table_job(spark, sf):
    path = work_folder(spark, "p1t")
    jobs.instrument_job(ad.vendor_symbols(spark, sf), path, "2024-03-01", "2024-06-30")
    return spark.read.parquet(path).groupBy("day", "venue").agg(F.count(F.lit(1)).alias("instruments"))


@check("p2_ingest_job", fx.with_(fx.TRADES, """
hourly AS (SELECT * REPLACE (date_trunc('hour', "timestamp") AS "timestamp") FROM trades WHERE price > 0 AND amount > 0)""", fx.candles(14400, source="hourly")) +
       f"SELECT {CANDLE_SQL} FROM candles")
def _ingest(spark, sf):
    """Vendor CSV to the valid rows of the tick table to candles; many ticks share an instant, and the stored order number decides."""
    ticks = ad.trades(spark, sf).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    raw = ticks.select("instrument_key", _micros("timestamp"), _micros("local_timestamp"), "id", "side", "price", "amount")
    path = _vendor_csv(spark, raw, "p2-csv")
    root = work_folder(spark, "p2")
    typed = readers.typed(spark.read.option("header", "true").csv(path), "trades", keep=("instrument_key",))
    jobs.ingest_job(typed, "trades", root, root + "-rejected")
    stored = readers.read_ticks(spark, root, "1990-01-01", "2050-01-01")
    return rounded(candles.ohlcv(stored, "4h").drop("timeframe"))


@check("p3_targets_job", _COVERAGE + """
SELECT DISTINCT m.day, m.instrument_key, m.data_type FROM missing m JOIN instruments i ON i.instrument_key = m.instrument_key
WHERE i.tardis_exchange = 'okx' AND m.data_type = 'book_snapshot_5' AND EXISTS (
  SELECT 1 FROM available a WHERE a.day = m.day AND a.instrument_key = m.instrument_key AND a.data_type = 'trades')""")
def _targets(spark, sf):
    definitions = ad.instruments(spark, sf)
    available = ad.available_ticks(spark, sf)
    missing = coverage.missing_types(coverage.expected_types(definitions, START, END), available)
    landed = available.where(F.col("data_type") == "trades").withColumn("data_type", F.lit("book_snapshot_5"))
    # The venue list names exchanges through the venue table; OKX maps to okex, so the
    # fixture's own exchange name is used.
    definitions = definitions.withColumn("tardis_exchange", F.when(F.col("venue") == "OKX", "okex").otherwise(F.col("tardis_exchange")))
    out = jobs.targets_job(spark, missing, definitions, landed, venues=["OKX"], data_types=["book_snapshot_5"])
    return out.select("day", "instrument_key", "data_type").distinct()


@check("p4_missing_job", _COVERAGE + """
SELECT CASE g WHEN 3 THEN 'day' WHEN 5 THEN 'instrument' WHEN 6 THEN 'data_type' ELSE 'total' END AS level, day, instrument_key, data_type,
  CAST(e AS BIGINT) AS expected, CAST(m AS BIGINT) AS missing, round((e - m) / e * 100, 6) AS coverage_pct
FROM (SELECT grouping(day, instrument_key, data_type) AS g, day, instrument_key, data_type, sum(e) AS e, sum(m) AS m
      FROM (SELECT *, 1 AS e, 0 AS m FROM expected UNION ALL SELECT *, 0, 1 FROM missing)
      GROUP BY GROUPING SETS ((day), (instrument_key), (data_type), ()))""")
def _missing_job(spark, sf):
    """Two runs over one folder: what the first finds missing is gone when the second finds less."""
    definitions, available, path = ad.instruments(spark, sf), ad.available_ticks(spark, sf), work_folder(spark, "p4")
    jobs.missing_job(definitions, available.limit(0), path, START, END)
    return rounded(jobs.missing_job(definitions, available, path, START, END))


@check("p5_available_job", _COVERAGE + """
SELECT t.day, t.instrument_key, t.data_type
FROM (SELECT life.*, unnest(['trades', 'book_snapshot_5']) AS data_type FROM life) t
ANTI JOIN missing m ON m.day = t.day AND m.instrument_key = t.instrument_key AND m.data_type = t.data_type""")
def _available_job(spark, sf):
    definitions, available = ad.instruments(spark, sf), ad.available_ticks(spark, sf)
    missing = coverage.missing_types(coverage.expected_types(definitions, START, END), available)
    return jobs.available_job(definitions, missing, work_folder(spark, "p5"), START, END, ["trades", "book_snapshot_5"]).select(
        "day", "instrument_key", "data_type")


@check("p6_gap_check", fx.with_(fx.INSTRUMENTS) + """
SELECT day, CAST(count(i.p_partkey) AS BIGINT) AS files, count(i.p_partkey) > 0 AS available
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
LEFT JOIN instruments i ON i.d0 <= day AND i.d1 >= day GROUP BY 1""")
def _gap_check(spark, sf):
    daily = instruments.daily(ad.instruments(spark, sf), "1994-11-01", "1999-12-31")
    return coverage.availability_by_day(calendar(spark, "1994-11-01", "1999-12-31"), daily)


def _job_counts(timeframes):
    one = " UNION ALL ".join(
        f"SELECT day, '{tf}' AS timeframe, count(*) AS \"rows\" FROM (SELECT DISTINCT instrument_key, CAST(b AS DATE) AS day, b FROM "
        f"(SELECT instrument_key, time_bucket(INTERVAL {n} SECONDS, \"timestamp\", {_TS0}) AS b FROM trades)) GROUP BY day" for tf, n in timeframes)
    return fx.with_(fx.TRADES) + one


_ALL = (("15s", 15), ("1m", 60), ("5m", 300), ("15m", 900), ("1h", 3600), ("4h", 14400), ("24h", 86400))


@check("p7_candle_job", _job_counts(_ALL))
def _candle_job(spark, sf):
    return jobs.candle_job(spark, work_folder(spark, "p7"), ad.trades(spark, sf), ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf),
                           ad.book_snapshots(spark, sf))


@check("p7_book_job", fx.with_(fx.EVENTS, fx.BOOKS) + " UNION ALL ".join(
    f"SELECT '{tf}' AS timeframe, count(*) AS \"rows\", min(b) AS first_row FROM (SELECT DISTINCT instrument_key, "
    f"time_bucket(INTERVAL {n} SECONDS, \"timestamp\", {_TS0}) AS b FROM books)" for tf, n in _ALL))
def _book_job(spark, sf):
    root = work_folder(spark, "p7b")
    jobs.candle_job(spark, root, ad.trades(spark, sf), books=ad.book_snapshots(spark, sf))
    return spark.read.parquet(f"{root}/book").groupBy("timeframe").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_row"))


@check("p8_candles_to_warehouse", _job_counts((("1m", 60), ("1h", 3600))))
def _to_warehouse(spark, sf):
    root = work_folder(spark, "p8")
    jobs.candle_job(spark, root, ad.trades(spark, sf), base_timeframes=["1m"], rollups=["1h"])
    name = "tickloom_p8_" + root.rstrip("/").split("-")[-1].replace(".", "_").lower()
    return jobs.candles_to_warehouse(spark, root, name, root + "-warehouse")


@check("p10_validation_job", fx.with_(fx.TRADES) + """
SELECT unnest(['1h_to_4h', '4h_to_24h', 'three_rules_1h', 'three_rules_4h', 'three_rules_24h', 'first_source_4h', 'second_source_4h', 'between_sources_4h',
  'first_source_24h', 'second_source_24h', 'between_sources_24h']) AS test_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM trades""")
def _validation(spark, sf):
    trades = ad.trades(spark, sf)
    first = {tf: candles.ohlcv(trades, tf) for tf in ("1h", "4h", "24h")}
    base = first["1h"]
    second = {"1h": base, "4h": candles.rollup(base, "4h"), "24h": candles.rollup(base, "24h")}
    return jobs.validation_job(first, second, "1h")


