"""Coverage reports, groups, summaries and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.common import CANDLE_SQL, Checks, r, rounded
from tickloom.functions import keys as k
from tickloom.functions import timegrid as tg
from tickloom.operators import candles, coverage
from tickloom.sources import adapters as ad

CHECKS = Checks()
check = CHECKS.add
START, END = "1995-01-01", "2001-12-31"

_LIFE = f"""
life AS (
  SELECT *, CAST(unnest(generate_series(CAST(greatest(d0, DATE '{START}') AS TIMESTAMP), CAST(least(d1, DATE '{END}') AS TIMESTAMP),
                                        INTERVAL 1 DAY)) AS DATE) AS day FROM instruments
)"""
_EXPECTED = """
expected AS (
  SELECT DISTINCT day, instrument_key, trim(data_type) AS data_type
  FROM (SELECT day, instrument_key, unnest(string_split(data_types, ',')) AS data_type FROM life)
)"""
_MISSING = """
missing AS (SELECT e.* FROM expected e ANTI JOIN available a
            ON a.day = e.day AND a.instrument_key = e.instrument_key AND a.data_type = e.data_type)"""
_COVERAGE = fx.with_(fx.AVAILABLE, _LIFE, _EXPECTED, _MISSING)


def _parts(spark, sf, types=None):
    instruments = ad.instruments(spark, sf)
    available = ad.available_ticks(spark, sf).where(F.col("day").between(START, END))
    return instruments, available, coverage.expected_types(instruments, START, END, types)


@check("d1_missing_days", _COVERAGE + """
SELECT DISTINCT l.day, l.instrument_key, 'missing' AS status, TRUE AS expected, FALSE AS available FROM life l
ANTI JOIN available a ON a.day = l.day AND a.instrument_key = l.instrument_key""")
def _missing_days(spark, sf):
    instruments, available, _ = _parts(spark, sf)
    return coverage.missing_days(coverage.expected_days(instruments, START, END), available)


@check("d2_missing_by_type", _COVERAGE +
       "SELECT day, instrument_key, data_type, 'missing' AS status, TRUE AS expected, FALSE AS available FROM missing")
def _missing_types(spark, sf):
    _, available, expected = _parts(spark, sf)
    return coverage.missing_types(expected, available)


@check("d3_available_by_type", _COVERAGE + """
SELECT t.day, t.instrument_key, t.venue, t.instrument_type, t.base_asset, t.quote_asset, t.data_type
FROM (SELECT life.*, unnest(['trades', 'book_snapshot_5']) AS data_type FROM life) t
ANTI JOIN missing m ON m.day = t.day AND m.instrument_key = t.instrument_key AND m.data_type = t.data_type""")
def _available_types(spark, sf):
    instruments, available, expected = _parts(spark, sf)
    return coverage.available_types(instruments, coverage.missing_types(expected, available), START, END, ["trades", "book_snapshot_5"])


@check("e14_missing_report", _COVERAGE + """
SELECT CASE g WHEN 3 THEN 'day' WHEN 5 THEN 'instrument' WHEN 6 THEN 'data_type' ELSE 'total' END AS level, day, instrument_key, data_type,
  CAST(e AS BIGINT) AS expected, CAST(m AS BIGINT) AS missing, round((e - m) / e * 100.0, 6) AS coverage_pct
FROM (SELECT grouping(day, instrument_key, data_type) AS g, day, instrument_key, data_type, sum(e) AS e, sum(m) AS m
      FROM (SELECT *, 1 AS e, 0 AS m FROM expected UNION ALL SELECT *, 0, 1 FROM missing)
      GROUP BY GROUPING SETS ((day), (instrument_key), (data_type), ()))""")
def _report(spark, sf):
    _, available, expected = _parts(spark, sf)
    return rounded(coverage.missing_report(expected, coverage.missing_types(expected, available)))


@check("e15_known_data_types", fx.with_(fx.INSTRUMENTS) +
       "SELECT DISTINCT trim(t) AS data_type FROM (SELECT unnest(string_split(data_types, ',')) AS t FROM instruments) ORDER BY 1")
def _types(spark, sf):
    return coverage.known_types(ad.instruments(spark, sf))


@check("d11_missing_to_targets", _COVERAGE + """
SELECT m.day, m.instrument_key, m.data_type, i.tardis_exchange, i.tardis_symbol, i.data_types,
  CASE WHEN i.instrument_key IS NOT NULL AND i.tardis_exchange NOT IN ('binance', 'deribit', 'okex') THEN 'venue_filtered'
    WHEN i.instrument_key IS NOT NULL AND NOT (contains(m.instrument_key, 'SPOT_PAIR') OR contains(m.instrument_key, 'OPTION')) THEN 'type_filtered'
    WHEN i.instrument_key IS NOT NULL THEN 'found'
    WHEN (contains(m.instrument_key, 'OPTION') OR contains(m.instrument_key, 'FUTURE')) AND len(list_filter(string_split(m.instrument_key, '-'),
      lambda x: regexp_full_match(x, '[0-9]{6}') AND x < strftime(m.day, '%y%m%d'))) > 0 THEN 'expired'
    ELSE 'no_definition' END AS target_status
FROM (SELECT day + INTERVAL 400 DAYS AS day, instrument_key, data_type FROM missing WHERE data_type IN ('trades', 'options_chain')) m
LEFT JOIN (SELECT * FROM instruments WHERE p_partkey % 3 <> 0) i ON i.instrument_key = m.instrument_key""".replace(
    "day + INTERVAL 400 DAYS AS day", "CAST(day + INTERVAL 400 DAYS AS DATE) AS day"))
def _targets(spark, sf):
    instruments, available, expected = _parts(spark, sf)
    later = coverage.missing_types(expected, available).withColumn("day", F.date_add("day", 400))
    return coverage.missing_to_targets(
        later, instruments.where(F.col("p_partkey") % 3 != 0), ["BINANCE", "DERIBIT", "OKX"], ["SPOT_PAIR", "OPTION"],
        ["trades", "options_chain"])


@check("e16_availability_by_day", fx.with_(fx.AVAILABLE) + """
SELECT CAST(d AS DATE) AS day, CAST(coalesce(n, 0) AS BIGINT) AS files, n IS NOT NULL AS available
FROM (SELECT unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)
LEFT JOIN (SELECT day, count(*) AS n FROM available GROUP BY 1) a ON a.day = CAST(d AS DATE)""")
def _by_day(spark, sf):
    return coverage.availability_by_day(tg.calendar(spark, "1994-12-01", END), ad.available_ticks(spark, sf))


@check("e16_coverage_pct", fx.with_(fx.AVAILABLE) + """
SELECT count(*) AS days, count(a.day) AS available_days, round(count(a.day) * 100.0 / count(*), 6) AS coverage_pct
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT DISTINCT day FROM available) a ON a.day = d""")
def _pct(spark, sf):
    return rounded(coverage.coverage_pct(_by_day(spark, sf)))


_GROUPS = fx.with_(fx.AVAILABLE, """
u AS (SELECT DISTINCT CASE WHEN instrument_type <> 'OPTION' THEN base_asset WHEN underlying <> '' THEN underlying ELSE base_asset END AS underlying,
        instrument_key, instrument_type FROM instruments)""", """
c AS (SELECT u.*, coalesce(a.n, 0) = 2 AS complete FROM u
      LEFT JOIN (SELECT instrument_key, count(DISTINCT data_type) AS n FROM available GROUP BY 1) a ON a.instrument_key = u.instrument_key)""", """
g AS (SELECT *, bool_and(complete) OVER (PARTITION BY underlying) AS group_valid FROM c)""")


def _groups(spark, sf):
    return coverage.underlying_groups(ad.instruments(spark, sf), ad.available_ticks(spark, sf), ["trades", "book_snapshot_5"])


check("d13_underlying_groups", _GROUPS + "SELECT underlying, instrument_key, instrument_type, complete, group_valid FROM g")(_groups)


@check("c13_eligible_instruments", _GROUPS + """
SELECT underlying, instrument_key, instrument_type, complete, group_valid FROM g WHERE group_valid AND instrument_type IN ('SPOT_PAIR', 'PERPETUAL')""")
def _eligible(spark, sf):
    return coverage.eligible(_groups(spark, sf), ["SPOT_PAIR", "PERPETUAL"])


@check("e19_underlying_summary", _GROUPS + """
SELECT underlying, count(*) AS instruments, CAST(count(*) FILTER (WHERE group_valid) AS BIGINT) AS valid_instruments,
  CAST(count(*) FILTER (WHERE NOT group_valid) AS BIGINT) AS skipped_instruments,
  round(count(*) FILTER (WHERE group_valid) * 100.0 / count(*), 6) AS validation_rate
FROM g GROUP BY ROLLUP (underlying)""")
def _group_summary(spark, sf):
    return rounded(coverage.underlying_summary(_groups(spark, sf)))


# -- summaries ---------------------------------------------------------------------

_TAGGED = fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER, fx.BOOKS, """
ticks AS (
  SELECT instrument_key, "timestamp", 'trades' AS data_type FROM trades UNION ALL
  SELECT instrument_key, "timestamp", 'liquidations' FROM liquidations UNION ALL
  SELECT instrument_key, "timestamp", 'derivative_ticker' FROM ticker UNION ALL
  SELECT instrument_key, "timestamp", 'book_snapshot_5' FROM books
)""")


def _tagged(spark, sf):
    frames = {"trades": ad.trades, "liquidations": ad.liquidations, "derivative_ticker": ad.derivative_ticker,
              "book_snapshot_5": ad.book_snapshots}
    out = None
    for name, source in frames.items():
        frame = source(spark, sf).withColumn("data_type", F.lit(name))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


@check("e17_tick_summary", _TAGGED + """
SELECT instrument_key, data_type, count(*) AS "rows", min("timestamp") AS first_time, max("timestamp") AS last_time,
  CAST(sum(count(*)) OVER (PARTITION BY instrument_key) AS BIGINT) AS total_rows FROM ticks GROUP BY instrument_key, data_type""")
def _tick_summary(spark, sf):
    return coverage.tick_summary(_tagged(spark, sf))


@check("h1_union_of_types", _TAGGED + """
SELECT t.data_type, t.id, t.instrument_key, round(t.price, 6) AS price, round(t.open_interest, 6) AS open_interest, round(t.bid_price_1, 6) AS bid_price_1 FROM (
  SELECT 'trades' AS data_type, id, instrument_key, price, NULL::DOUBLE AS open_interest, NULL::DOUBLE AS bid_price_1 FROM trades UNION ALL
  SELECT 'liquidations', id, instrument_key, price, NULL, NULL FROM liquidations UNION ALL
  SELECT 'derivative_ticker', id, instrument_key, NULL, open_interest, NULL FROM ticker UNION ALL
  SELECT 'book_snapshot_5', id, instrument_key, NULL, NULL, bid_price_1 FROM books) t""")
def _union(spark, sf):
    return rounded(_tagged(spark, sf).select("data_type", "id", "instrument_key", "price", "open_interest", "bid_price_1"))


@check("e17_candle_summary", fx.with_(fx.TRADES, fx.candles(3600, "c1"), fx.candles(14400, "c4")) + """
SELECT instrument_key, timeframe, count(*) AS "rows", min("timestamp") AS first_time, max("timestamp") AS last_time, count(vwap) AS vwap_present
FROM (SELECT '1h' AS timeframe, * FROM c1 UNION ALL SELECT '4h', * FROM c4) GROUP BY ALL""")
def _candle_summary(spark, sf):
    trades = ad.trades(spark, sf)
    return coverage.candle_summary(candles.ohlcv(trades, "1h").unionByName(candles.ohlcv(trades, "4h")), ["vwap"])


@check("e20_rows_per_day", fx.with_(fx.TRADES, fx.candles(3600)) +
       """SELECT CAST("timestamp" AS DATE) AS day, '1h' AS timeframe, count(*) AS "rows" FROM candles GROUP BY ALL""")
def _per_day(spark, sf):
    return coverage.rows_per_day(candles.ohlcv(ad.trades(spark, sf), "1h"), "timestamp", "timeframe")


@check("e21_volume_by_minute", fx.with_(fx.TRADES, fx.candles(15)) + """
SELECT instrument_key, date_trunc('minute', "timestamp") AS "minute", round(sum(volume), 6) AS total_volume, round(avg(vwap), 6) AS avg_vwap,
  count(*) AS candles FROM candles GROUP BY ALL""")
def _minute(spark, sf):
    base = candles.ohlcv(ad.trades(spark, sf), "15s").withColumnRenamed("vwap", "price_vwap")
    return rounded(coverage.volume_by_minute(base))


@check("e22_job_totals", """
SELECT count(*) AS total, CAST(count(*) FILTER (WHERE o_orderstatus <> 'F') AS BIGINT) AS successful,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS failed,
  round(count(*) FILTER (WHERE o_orderstatus <> 'F') * 100.0 / count(*), 6) AS percentage,
  CAST(sum(o_custkey) AS BIGINT) AS total_records, round(round(sum(o_totalprice / 1000.0), 4), 6) AS total_seconds FROM orders""")
def _job_totals(spark, sf):
    jobs = ad.table(spark, sf, "orders").select(
        (F.col("o_orderstatus") != "F").alias("success"), F.col("o_custkey").alias("records"), (F.col("o_totalprice") / 1000.0).alias("seconds"))
    totals = coverage.job_totals(jobs)
    return rounded(totals.withColumn("total_seconds", F.round("total_seconds", 4)))


@check("e25_distinct_counts", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def _distinct(spark, sf):
    return ad.table(spark, sf, "events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@check("e26_signature", fx.with_(fx.TRADES, """
h AS (SELECT CAST('0x' || substr(sha256(concat(strlen(instrument_key), ':', instrument_key, strlen(id), ':', id, coalesce(concat(strlen(side), ':', side), '~'),
  strlen(CAST(epoch_us("timestamp") AS VARCHAR)), ':', CAST(epoch_us("timestamp") AS VARCHAR))), 1, 15) AS BIGINT) AS n FROM trades)""") + """
SELECT count(*) AS "rows", bit_xor(n) AS hash_xor, CAST(sum(n) AS VARCHAR) AS hash_sum FROM h""")
def _signature(spark, sf):
    frame = ad.trades(spark, sf).withColumn("micros", F.unix_micros("timestamp"))
    return coverage.signature(frame, ["instrument_key", "id", "side", "micros"])


@check("e27_latency_stats", fx.with_(fx.TRADES, """
d AS (SELECT instrument_key, CAST(epoch_us(local_timestamp) - epoch_us("timestamp") AS DOUBLE) / 1000.0 AS x FROM trades)""") + """
SELECT instrument_key, count(*) AS ticks, round(avg(x), 6) AS mean_ms, round(median(x), 6) AS median_ms,
  round(quantile_cont(x, 0.95), 6) AS p95_ms, min(x) AS min_ms, max(x) AS max_ms FROM d GROUP BY 1""")
def _latency(spark, sf):
    return rounded(coverage.latency_stats(ad.trades(spark, sf), ["instrument_key"]))


@check("g1_sorted_ticks", fx.with_(fx.TRADES) + 'SELECT id, "timestamp", price FROM trades ORDER BY "timestamp", local_timestamp, id')
def _sorted(spark, sf):
    return ad.trades(spark, sf).orderBy("timestamp", "local_timestamp", "id").select("id", "timestamp", "price")


@check("g4_recent_candles", fx.with_(fx.TRADES, fx.candles(60)) + f"""
SELECT {CANDLE_SQL} FROM candles WHERE instrument_key = 'BINANCE:SPOT_PAIR:U3-USDT' AND "timestamp" >= TIMESTAMP '2024-01-29'
ORDER BY "timestamp" DESC LIMIT 60""")
def _recent(spark, sf):
    where = (F.col("instrument_key") == "BINANCE:SPOT_PAIR:U3-USDT") & (F.col("timestamp") >= F.lit("2024-01-29").cast("timestamp"))
    return rounded(coverage.recent(candles.ohlcv(ad.trades(spark, sf), "1m"), where, 60).drop("timeframe"))


@check("g6_first_candles", fx.with_(fx.TRADES, fx.candles(3600)) +
       f'SELECT {CANDLE_SQL} FROM candles ORDER BY "timestamp", instrument_key LIMIT 1000')
def _first(spark, sf):
    frame = candles.ohlcv(ad.trades(spark, sf), "1h")
    return rounded(frame.orderBy("timestamp", "instrument_key").limit(1000).drop("timeframe"))


_TWO = fx.with_(fx.TRADES, """
a AS (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS t FROM trades WHERE side = 'buy')""", """
b AS (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS t FROM trades WHERE side = 'sell')""")


def _two(spark, sf):
    hours = ad.trades(spark, sf).select("side", tg.aligned("timestamp", "1h").alias("t"))
    return hours.where(F.col("side") == "buy").select("t"), hours.where(F.col("side") == "sell").select("t")


@check("h2_common_times", _TWO + "SELECT t FROM a INTERSECT SELECT t FROM b")
def _common(spark, sf):
    a, b = _two(spark, sf)
    return a.intersect(b)


@check("h3_all_times", _TWO + "SELECT t FROM a UNION SELECT t FROM b")
def _all_times(spark, sf):
    a, b = _two(spark, sf)
    return a.union(b).distinct()


@check("h4_difference", _TWO + "SELECT t FROM a EXCEPT SELECT t FROM b")
def _except(spark, sf):
    a, b = _two(spark, sf)
    return a.subtract(b)


@check("h5_distinct_instruments", fx.with_(fx.TRADES) + "SELECT DISTINCT instrument_key, side FROM trades")
def _distinct_rows(spark, sf):
    return ad.trades(spark, sf).select("instrument_key", "side").distinct()


@check("c2_half_open_interval", fx.with_(fx.TRADES) + """
SELECT time_bucket(INTERVAL 15 MINUTES, "timestamp", TIMESTAMP '1970-01-01') AS bucket, count(*) AS ticks FROM trades GROUP BY 1""")
def _half_open(spark, sf):
    return ad.trades(spark, sf).groupBy(tg.aligned("timestamp", "15m").alias("bucket")).agg(F.count(F.lit(1)).alias("ticks"))


@check("c10_drop_empty_columns", fx.with_(fx.INSTRUMENTS) +
       "SELECT instrument_key, expiry FROM instruments WHERE instrument_type = 'FUTURE'")
def _drop_empty(spark, sf):
    from tickloom.sinks.tables import drop_empty_columns

    futures = ad.instruments(spark, sf).where(F.col("instrument_type") == "FUTURE").select("instrument_key", "expiry")
    return drop_empty_columns(futures.withColumn("min_size", F.lit(None).cast("string")))


@check("c6_existing_columns", fx.with_(fx.TRADES, fx.candles(3600)) +
       'SELECT instrument_key, "timestamp", ' + r("vwap", "volume") + " FROM candles")
def _existing(spark, sf):
    from tickloom.sources.readers import present_columns

    wanted = ["instrument_key", "timestamp", "vwap", "volume", "oi_change"]
    return rounded(present_columns(candles.ohlcv(ad.trades(spark, sf), "1h"), wanted))


@check("i6_symbol_and_exchange", fx.with_(fx.TRADES) + """
SELECT split_part(instrument_key, ':', 3) AS symbol, lower(split_part(instrument_key, ':', 1)) AS exchange, count(*) AS ticks FROM trades GROUP BY ALL""")
def _labels(spark, sf):
    symbol, exchange = k.symbol_and_exchange("instrument_key")
    return ad.trades(spark, sf).groupBy(symbol.alias("symbol"), exchange.alias("exchange")).agg(F.count(F.lit(1)).alias("ticks"))

