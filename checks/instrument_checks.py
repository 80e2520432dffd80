"""Keys, symbols, definitions, lookups and instrument filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.common import Checks, rounded
from tickloom.functions import keys as k
from tickloom.functions import symbols as sy
from tickloom.functions import timegrid as tg
from tickloom.operators import instruments as ins
from tickloom.sources import adapters as ad

CHECKS = Checks()
check = CHECKS.add

_TS = "TIMESTAMP '1970-01-01'"


# -- time grid ---------------------------------------------------------------

@check("i1_aligned", fx.with_(fx.EVENTS) + "SELECT id, " + ", ".join(
    f"time_bucket(INTERVAL {n} SECONDS, \"timestamp\", {_TS}) AS at_{tf}" for tf, n in
    (("15s", 15), ("1m", 60), ("5m", 300), ("15m", 900), ("1h", 3600), ("4h", 14400), ("24h", 86400))) + " FROM ev")
def _aligned(spark, sf):
    return ad.trades(spark, sf).select("id", *[
        tg.aligned("timestamp", tf).alias(f"at_{tf}") for tf in ("15s", "1m", "5m", "15m", "1h", "4h", "24h")])


@check("i2_next_boundary", fx.with_(fx.EVENTS) + f"""
SELECT id, time_bucket(INTERVAL 15 MINUTES, "timestamp", {_TS}) + INTERVAL 15 MINUTES AS next_15m,
  round(CAST(epoch_us(time_bucket(INTERVAL 1 HOUR, "timestamp", {_TS}) + INTERVAL 1 HOUR) - epoch_us("timestamp") AS DOUBLE) / 1e6, 6)
    AS seconds_to_hour,
  (epoch_us("timestamp") % 15000000 = 0) AS on_15s,
  epoch_us(time_bucket(INTERVAL 4 HOURS, "timestamp", {_TS})) AS aligned_4h
FROM ev""")
def _next(spark, sf):
    return rounded(ad.trades(spark, sf).select(
        "id", tg.next_boundary("timestamp", "15m").alias("next_15m"),
        tg.seconds_to_next("timestamp", "1h").alias("seconds_to_hour"), tg.is_aligned("timestamp", "15s").alias("on_15s"),
        F.unix_micros(tg.alignments("timestamp")["4h"]).alias("aligned_4h")))


@check("i3_latency_ms", fx.with_(fx.EVENTS) +
       'SELECT id, round(CAST(epoch_us(local_timestamp) - epoch_us("timestamp") AS DOUBLE) / 1000.0, 6) AS latency_ms FROM ev')
def _latency(spark, sf):
    return rounded(ad.trades(spark, sf).select("id", tg.latency_ms("timestamp", "local_timestamp").alias("latency_ms")))


@check("i4_timeframe_seconds", """
SELECT p_partkey, ['15s', '1m', '5m', '15m', '1h', '4h', '24h', 'other'][p_size % 8 + 1] AS timeframe,
  CAST([15, 60, 300, 900, 3600, 14400, 86400, 0][p_size % 8 + 1] AS BIGINT) AS seconds FROM part""")
def _seconds(spark, sf):
    names = F.array(*[F.lit(x) for x in ("15s", "1m", "5m", "15m", "1h", "4h", "24h", "other")])
    tf = F.get(names, F.col("p_size") % 8)
    return ad.table(spark, sf, "part").select("p_partkey", tf.alias("timeframe"), F.coalesce(tg.seconds_column(tf), F.lit(0)).alias("seconds"))


# -- keys ----------------------------------------------------------------------

@check("i6_parse_key", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, split_part(instrument_key, ':', 1) AS key_venue, split_part(instrument_key, ':', 2) AS key_type,
  split_part(instrument_key, ':', 3) AS key_symbol, lower(split_part(instrument_key, ':', 1)) AS exchange,
  instrument_key || CASE WHEN expiry IS NOT NULL THEN ':' || substr(expiry, 1, 10) ELSE '' END
    || CASE WHEN option_type <> '' THEN ':' || substr(option_type, 1, 1) ELSE '' END AS long_key
FROM instruments""")
def _parse(spark, sf):
    parsed = k.parse_key(ad.instruments(spark, sf))
    _, exchange = k.symbol_and_exchange("instrument_key")
    built = k.build_key(F.col("key_venue"), F.col("key_type"), F.col("key_symbol"), F.substring("expiry", 1, 10),
                        F.substring("option_type", 1, 1))
    return parsed.select("instrument_key", "key_venue", "key_type", "key_symbol", exchange.alias("exchange"),
                         built.alias("long_key"))


@check("i9_option_side", """
SELECT p_partkey, ['C', 'p', 'Call', 'PUT', 'x', ''][p_size % 6 + 1] AS raw,
  ['CALL', 'PUT', 'CALL', 'PUT', 'X', ''][p_size % 6 + 1] AS side FROM part""")
def _side(spark, sf):
    raw = F.get(F.array(*[F.lit(x) for x in ("C", "p", "Call", "PUT", "x", "")]), F.col("p_size") % 6)
    return ad.table(spark, sf, "part").select("p_partkey", raw.alias("raw"), k.option_side(raw).alias("side"))


@check("i10_data_types", fx.with_(fx.INSTRUMENTS) + "SELECT instrument_key, data_types FROM instruments")
def _data_types(spark, sf):
    return ad.instruments(spark, sf).select("instrument_key", F.concat_ws(",", k.data_types(F.col("instrument_key"))).alias("data_types"))


_VENUE_LIST = ("BINANCE-SPOT", "binance", "okex", "huobi-dm", "COINBASE-PRO", "kraken", "nowhere", "bybit", "coinbase-pro")
_INFO = {
    "BINANCE-SPOT": ("BINANCE-SPOT", "binance", "binance", "venue"),
    "binance": ("BINANCE-MARGIN", "binance", "binance", "ccxt"),
    "okex": ("OKEX-FUTURES", "okx", "okex", "tardis"),
    "huobi-dm": ("HUOBI-FUTURES", "huobi", "huobi-dm", "tardis"),
    "COINBASE-PRO": ("COINBASE-PRO", "coinbase", "coinbase-pro", "venue"),
    "kraken": ("KRAKEN-FUTURES", "kraken", "kraken", "ccxt"),
    "nowhere": (None, None, None, "unknown"),
    "bybit": ("BYBIT-FUTURES", "bybit", "bybit", "ccxt"),
    "coinbase-pro": ("COINBASE-PRO", "coinbase", "coinbase-pro", "venue"),
}


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


@check("i13_exchange_info", "SELECT p_partkey, " + ", ".join(
    f"{_sql_list([_INFO[v][i] for v in _VENUE_LIST])}[p_partkey % 9 + 1] AS {name}"
    for i, name in enumerate(("venue", "ccxt_exchange", "tardis_exchange", "type"))) + " FROM part")
def _info(spark, sf):
    name = F.get(F.array(*[F.lit(v) for v in _VENUE_LIST]), (F.col("p_partkey") % 9).cast("int"))
    info = k.exchange_info(name)
    return ad.table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in info.items()])


@check("i13_symbol_spelling", """
WITH x AS (
  SELECT p_partkey, upper(split_part(p_name, ' ', 1)) AS b,
    ['binance', 'deribit', 'coinbase', 'kraken'][p_partkey % 4 + 1] AS exchange, p_size FROM part),
y AS (SELECT p_partkey, exchange, CASE WHEN p_size % 3 = 0 THEN b || '-USDT' WHEN p_size % 3 = 1 THEN b || 'USDT' ELSE b || '/USD' END AS symbol FROM x)
SELECT p_partkey, symbol,
  CASE exchange WHEN 'binance' THEN CASE WHEN contains(symbol, '-') THEN replace(symbol, '-', '/')
                                         ELSE regexp_replace(symbol, '^([A-Z]{2,})(USDT)$', '\\1/\\2') END
    WHEN 'deribit' THEN symbol WHEN 'coinbase' THEN replace(symbol, '/', '-') ELSE replace(symbol, '-', '/') END AS ccxt_symbol,
  replace(symbol, '/', '-') AS dashed, replace(symbol, '/', '') AS joined,
  CASE WHEN exchange = 'binance' THEN contains(symbol, '/') ELSE exchange IN ('deribit') END AS valid_pair
FROM y""")
def _spelling(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    b = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    exchange = F.get(F.array(*[F.lit(v) for v in ("binance", "deribit", "coinbase", "kraken")]), (key % 4).cast("int"))
    venue = F.when(exchange == "binance", "BINANCE-SPOT").when(exchange == "deribit", "deribit").otherwise("elsewhere")
    symbol = F.when(size % 3 == 0, F.concat(b, F.lit("-USDT"))).when(size % 3 == 1, F.concat(b, F.lit("USDT"))).otherwise(
        F.concat(b, F.lit("/USD")))
    return ad.table(spark, sf, "part").select(
        "p_partkey", symbol.alias("symbol"), k.to_ccxt_symbol(symbol, exchange).alias("ccxt_symbol"),
        k.from_ccxt_symbol(symbol).alias("dashed"), k.from_ccxt_symbol(symbol, "concat").alias("joined"),
        F.coalesce(k.mapping_is_valid(venue, symbol), F.lit(False)).alias("valid_pair"))


@check("i14_file_symbol", fx.with_(fx.INSTRUMENTS) +
       "SELECT instrument_key, replace(split_part(instrument_key, ':', 3), '-', '') AS file_symbol FROM instruments")
def _file_symbol(spark, sf):
    return ad.instruments(spark, sf).select("instrument_key", k.file_symbol(F.col("instrument_key")).alias("file_symbol"))


@check("i16_shards", "SELECT CAST(count(*) AS BIGINT) AS instruments, TRUE AS complete FROM part")
def _shards(spark, sf):
    keyed = ad.instruments(spark, sf).select("p_partkey", k.shard(F.col("instrument_key"), 7).alias("shard"))
    return keyed.agg(F.count(F.lit(1)).alias("instruments"), F.bool_and(F.col("shard").between(0, 6)).alias("complete"))


@check("i13_live_key", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, upper(tardis_exchange) || ':' || instrument_type || ':' || base_asset ||
  CASE WHEN instrument_type = 'OPTION' THEN '-' || substr(expiry, 1, 10) || '-' || strike || '-' || option_type
       WHEN instrument_type = 'FUTURE' THEN '-' || substr(expiry, 1, 10) ELSE '' END AS live_key FROM instruments""")
def _live_key(spark, sf):
    return ad.instruments(spark, sf).select("instrument_key", k.live_key(
        F.col("tardis_exchange"), F.lower("instrument_type"), F.lower("base_asset"), F.substring("expiry", 1, 10),
        F.col("strike"), F.lower("option_type")).alias("live_key"))


# -- symbols --------------------------------------------------------------------

_QUOTES = "['USDT', 'USDC', 'BUSD', 'USD', 'DAI', 'GBP', 'TUSD', 'EUR', 'TRY', 'BRL', 'JPY', 'KRW', 'CNY', 'HKD']"


def _quote(x: str) -> str:
    """The longest quote that x ends with, something being before it."""
    return f"list_filter(list_sort(list_transform({_QUOTES}, lambda q: {{'n': -length(q), 'q': q}})), lambda s: ends_with(upper({x}), s.q) AND length({x}) > length(s.q))[1].q"


_HEAD = "regexp_extract(CASE WHEN symbol_type = 'future' THEN regexp_replace(symbol_id, '[FGHJKMNQUVXZ][0-9]{2}$', '') ELSE symbol_id END, '^[^-_]*')"


PARSED = fx.with_(fx.SYMBOLS, f"""
q0 AS (
  SELECT *, split_part(symbol_id, '-', 1) AS f1, split_part(symbol_id, '-', 2) AS f2,
    len(string_split(symbol_id, '-')) AS np, {_HEAD} AS head, {_quote(_HEAD)} AS q_end, {_quote("split_part(symbol_id, '-', 1)")} AS q_first,
    list_filter({_QUOTES}, lambda q: q = upper(split_part(replace(symbol_id, '_', '-'), '-', 2)))[1] AS q_apart,
    symbol_type IN ('future', 'option') AS contract
  FROM symbols
)""", r"""
q1 AS (
  SELECT *, (exchange = 'deribit' AND contract) AS dc, (np = 2 AND NOT regexp_matches(symbol_id, '[0-9]')) AS word_pair,
    coalesce(q_first IN ('USD', 'USDC'), FALSE) AS own_quote
  FROM q0
)""", r"""
q2 AS (
  SELECT *,
    CASE WHEN exchange = 'upbit' THEN CASE WHEN np = 2 THEN f1 ELSE '' END
      WHEN dc THEN rtrim(left(f1, length(f1) - coalesce(length(q_first), 0)), '_-')
      WHEN word_pair THEN f1
      ELSE regexp_replace(CASE WHEN q_apart IS NOT NULL THEN head WHEN q_end IS NOT NULL THEN rtrim(left(head, length(head) - length(q_end)), '_-')
        ELSE regexp_extract(head, '^[0-9]*[A-Za-z]+') END, '^(1000000|10000|1000)([A-Za-z])', '\2') END AS base_asset,
    CASE WHEN exchange = 'upbit' THEN CASE WHEN np = 2 THEN f2 ELSE '' END
      WHEN dc THEN CASE WHEN own_quote THEN q_first ELSE 'USD' END
      WHEN word_pair THEN f2 ELSE coalesce(q_apart, q_end, 'USD') END AS quote_asset,
    coalesce(nullif(regexp_extract(symbol_id, '-([0-9][A-Z]{3}[0-9]{2})-', 1), ''),
             nullif(regexp_extract(symbol_id, '-([0-9]{2}[A-Z]{3}[0-9]{2})-', 1), ''),
             nullif(regexp_extract(symbol_id, '-([0-9]{2}[A-Z]{3}[0-9]{2})$', 1), '')) AS dm,
    CASE WHEN exchange = 'binance-futures' THEN nullif(regexp_extract(symbol_id, '_([0-9]{6})$', 1), '')
         WHEN exchange IN ('deribit', 'okex-futures', 'okex') THEN nullif(regexp_extract(symbol_id, '-([0-9]{6})$', 1), '') END AS six,
    nullif(regexp_extract(symbol_id, '([A-Z])([0-9]{2})$', 1), '') AS code,
    nullif(regexp_extract(symbol_id, '([A-Z])([0-9]{2})$', 2), '') AS yy
  FROM q1
)""", r"""
parsed AS (
  SELECT *,
    CASE WHEN base_asset = '' THEN '' WHEN dc THEN CASE WHEN own_quote THEN quote_asset ELSE base_asset END
      WHEN exchange = 'upbit' OR word_pair THEN quote_asset WHEN quote_asset = 'USD' THEN base_asset ELSE quote_asset END AS settle_asset,
    CASE WHEN contract THEN coalesce(
      CASE WHEN exchange IN ('deribit', 'bybit') THEN CAST(try_strptime(lpad(dm, 7, '0'), '%d%b%y') AS DATE) END,
      CAST(try_strptime(six, '%y%m%d') AS DATE),
      CASE WHEN exchange IN ('deribit', 'bybit') AND instr('FGHJKMNQUVXZ', code) > 0
           THEN last_day(make_date(2000 + CAST(yy AS INTEGER), CAST(instr('FGHJKMNQUVXZ', code) AS INTEGER), 1)) END) END AS symbol_expiry,
    CASE WHEN exchange = 'deribit' AND symbol_type = 'option'
         THEN replace(nullif(regexp_extract(symbol_id, '-([0-9]+d?[0-9]*)-', 1), ''), 'd', '.') END AS strike,
    CASE WHEN exchange = 'deribit' AND symbol_type = 'option'
         THEN CASE regexp_extract(symbol_id, '-(C|P)$', 1) WHEN 'C' THEN 'CALL' WHEN 'P' THEN 'PUT' END END AS option_type
  FROM q2
)""")


@check("i8_parse_symbols", PARSED + """
SELECT p_partkey, exchange, symbol_id, symbol_type, base_asset, quote_asset, settle_asset, symbol_expiry, strike, option_type FROM parsed""")
def _symbols(spark, sf):
    listing = ad.vendor_symbols(spark, sf)
    e, s, t = F.col("exchange"), F.col("symbol_id"), F.col("symbol_type")
    return sy.with_expiry(sy.with_assets(listing)).select(
        "p_partkey", "exchange", "symbol_id", "symbol_type", "base_asset", "quote_asset", "settle_asset", "symbol_expiry",
        sy.strike(e, s, t).alias("strike"), sy.option_type(e, s, t).alias("option_type"))


ELIGIBLE = PARSED.rstrip() + """,
w0 AS (
  SELECT *, exchange IN ('deribit', 'binance-futures', 'okex-futures', 'okex-swap', 'bybit') AND contract AS at_eight,
    strptime(available_since, '%Y-%m-%dT%H:%M:%SZ') AS f0,
    CASE WHEN available_to IS NOT NULL THEN strptime(available_to, '%Y-%m-%dT%H:%M:%SZ')
         WHEN symbol_type IN ('spot', 'perpetual') THEN TIMESTAMP '2099-12-31' ELSE CAST(symbol_expiry AS TIMESTAMP) END AS t0
  FROM parsed
),
w1 AS (
  SELECT *, CASE WHEN at_eight AND hour(f0) = 0 THEN f0 + INTERVAL 8 HOURS ELSE f0 END AS f,
    CASE WHEN at_eight AND hour(t0) = 0 THEN t0 - INTERVAL 16 HOURS ELSE t0 END AS t FROM w0
),
eligible AS (
  SELECT *, CASE
      WHEN symbol_id IN ('SPOT', 'PERPETUALS', 'FUTURES', 'COMBOS') THEN 'aggregate'
      WHEN (f IS NULL OR t IS NULL) AND symbol_type = 'combo' THEN 'silent_combo'
      WHEN f IS NULL OR t IS NULL THEN 'unparsed_expiry'
      WHEN CAST(f AS DATE) > DATE '2024-06-30' OR CAST(t AS DATE) < DATE '2024-03-01' THEN 'date_range'
      WHEN exchange = 'deribit' AND symbol_type = 'combo' THEN 'combo'
      WHEN regexp_matches(symbol_id, 'BTCUP|BTCDOWN|ETHUP|ETHDOWN|BNBUP|BNBDOWN|ADAUP|ADADOWN') THEN 'leveraged'
      WHEN NOT CASE exchange WHEN 'upbit' THEN quote_asset = 'KRW' WHEN 'deribit' THEN quote_asset IN ('USD', 'USDT', 'USDC')
                 ELSE quote_asset = 'USDT' END THEN 'quote_asset' END AS skip_reason,
    CASE WHEN at_eight THEN CAST(t AS DATE) ELSE symbol_expiry END AS expiry_date
  FROM w1
)
"""
_RANGE = ("2024-03-01", "2024-06-30")


@check("c12_eligibility", ELIGIBLE + """
SELECT coalesce(skip_reason, 'eligible') AS skip_reason, exchange, count(*) AS symbols FROM eligible GROUP BY ALL""")
def _eligibility(spark, sf):
    marked = ins.eligibility(ad.vendor_symbols(spark, sf), *_RANGE)
    return marked.groupBy(F.coalesce("skip_reason", F.lit("eligible")).alias("skip_reason"), "exchange").agg(
        F.count(F.lit(1)).alias("symbols"))


@check("i12_availability_window", ELIGIBLE + "SELECT p_partkey, f AS available_from, t AS available_to, expiry_date FROM eligible")
def _window(spark, sf):
    return ins.eligibility(ad.vendor_symbols(spark, sf), *_RANGE).select(
        "p_partkey", F.col("_from").alias("available_from"), F.col("_to").alias("available_to"), "expiry_date")


DEFINED = ELIGIBLE.rstrip() + """,
d0 AS (
  SELECT *, ['BINANCE', 'BINANCE-FUTURES', 'DERIBIT', 'BYBIT', 'BYBIT-SPOT', 'OKX', 'OKX-FUTURES', 'OKX-SWAP', 'UPBIT'][
      list_position(['binance', 'binance-futures', 'deribit', 'bybit', 'bybit-spot', 'okex', 'okex-futures', 'okex-swap', 'upbit'], exchange)] AS venue,
    CASE symbol_type WHEN 'spot' THEN 'SPOT_PAIR' WHEN 'perpetual' THEN 'PERPETUAL' WHEN 'future' THEN 'FUTURE' ELSE 'OPTION' END AS instrument_type,
    upper(base_asset) || '-' || upper(quote_asset) AS pair
  FROM eligible WHERE skip_reason IS NULL AND base_asset <> '' AND quote_asset <> ''
),
d1 AS (
  SELECT *, venue || ':' || instrument_type || ':' || pair ||
      CASE WHEN instrument_type = 'FUTURE' AND expiry_date IS NOT NULL THEN '-' || strftime(expiry_date, '%y%m%d')
           WHEN instrument_type = 'OPTION' AND expiry_date IS NOT NULL AND strike IS NOT NULL AND option_type IS NOT NULL
             THEN '-' || strftime(expiry_date, '%y%m%d') || '-' || strike || '-' || option_type ELSE '' END AS instrument_key
  FROM d0
),
defined AS (
  SELECT instrument_key, venue, instrument_type,
    strftime(f, '%Y-%m-%dT%H:%M:%S+00:00') AS available_from_datetime, strftime(t, '%Y-%m-%dT%H:%M:%S+00:00') AS available_to_datetime,
    CASE WHEN instrument_type = 'SPOT_PAIR' THEN 'trades,book_snapshot_5' WHEN instrument_type = 'OPTION' THEN 'trades,book_snapshot_5,options_chain'
         ELSE 'trades,book_snapshot_5,derivative_ticker,liquidations' END AS data_types,
    upper(base_asset) AS base_asset, upper(quote_asset) AS quote_asset, upper(settle_asset) AS settle_asset,
    symbol_id AS exchange_raw_symbol, symbol_id AS tardis_symbol, exchange AS tardis_exchange,
    'tardis' AS data_provider, 'exchange' AS venue_type, 'crypto' AS asset_class,
    (symbol_type = 'perpetual' AND settle_asset <> quote_asset) AS inverse, upper(symbol_type) AS symbol_type,
    coalesce(strike, '') AS strike, coalesce(option_type, '') AS option_type,
    CASE WHEN contract AND expiry_date IS NOT NULL THEN strftime(expiry_date, '%Y-%m-%d') || 'T08:00:00+00:00' ELSE '' END AS expiry,
    CASE WHEN contract THEN CAST(1.0 AS DOUBLE) END AS contract_size, CASE WHEN contract THEN 'cash' ELSE '' END AS settlement_type,
    CASE WHEN contract THEN pair ELSE '' END AS underlying
  FROM d1
  QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY f DESC, t DESC, symbol_id DESC) = 1
)
"""


@check("p1_definitions", DEFINED + "SELECT * FROM defined")
def _definitions(spark, sf):
    return ins.definitions(ad.vendor_symbols(spark, sf), *_RANGE)


@check("i7_canonical_keys", DEFINED + "SELECT instrument_key, tardis_exchange, data_types FROM defined")
def _canonical(spark, sf):
    return ins.definitions(ad.vendor_symbols(spark, sf), *_RANGE).select("instrument_key", "tardis_exchange", "data_types")


@check("i11_attributes", DEFINED + "SELECT instrument_key, underlying, inverse, expiry, contract_size, settlement_type FROM defined")
def _attributes(spark, sf):
    return ins.definitions(ad.vendor_symbols(spark, sf), *_RANGE).select(
        "instrument_key", "underlying", "inverse", "expiry", "contract_size", "settlement_type")


@check("p1_daily_definitions", DEFINED + """
SELECT CAST(day AS DATE) AS day, count(*) AS instruments FROM (
  SELECT unnest(generate_series(
    greatest(CAST(CAST(substr(available_from_datetime, 1, 10) AS DATE) AS TIMESTAMP), TIMESTAMP '2024-03-01'),
    least(CAST(CAST(substr(available_to_datetime, 1, 10) AS DATE) AS TIMESTAMP), TIMESTAMP '2024-06-30'), INTERVAL 1 DAY)) AS day
  FROM defined) GROUP BY ALL""")
def _daily(spark, sf):
    rows = ins.daily(ins.definitions(ad.vendor_symbols(spark, sf), *_RANGE), *_RANGE)
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("instruments"))


@check("d17_last_definition_per_key", fx.with_(fx.INSTRUMENTS) + """
SELECT base_asset, quote_asset, venue, max_by(instrument_key, row(available_from_datetime, instrument_key)) AS instrument_key
FROM instruments GROUP BY ALL""")
def _last(spark, sf):
    rows = ad.instruments(spark, sf).select("base_asset", "quote_asset", "venue", "available_from_datetime", "instrument_key")
    return ins.last_per_key(rows, ["base_asset", "quote_asset", "venue"], ["available_from_datetime", "instrument_key"]).drop(
        "available_from_datetime")


# -- filters ----------------------------------------------------------------------

@check("c3_membership", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, venue FROM instruments WHERE upper(venue) IN ('BINANCE', 'OKX') AND upper(instrument_type) = 'PERPETUAL' AND upper(quote_asset) = 'USDT'""")
def _membership(spark, sf):
    return ins.select_instruments(ad.instruments(spark, sf), venue=["binance", "okx"], instrument_type="perpetual",
                                  quote_asset="usdt").select("instrument_key", "venue")


@check("c4_expiry_substring", fx.with_(fx.INSTRUMENTS) +
       "SELECT instrument_key, expiry FROM instruments WHERE contains(expiry, '1995-0') OR contains(expiry, '1995-1')")
def _expiry(spark, sf):
    return ins.select_instruments(ad.instruments(spark, sf), expiry=["1995-0", "1995-1"]).select("instrument_key", "expiry")


@check("c5_valid_on_date", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, available_from_datetime, available_to_datetime FROM instruments
WHERE CAST(d0 AS TIMESTAMP) <= TIMESTAMP '1995-07-01' AND CAST(d1 AS TIMESTAMP) + INTERVAL 8 HOURS >= TIMESTAMP '1995-07-01'""")
def _valid_on(spark, sf):
    return ins.available_on(ad.instruments(spark, sf), "1995-07-01").select(
        "instrument_key", "available_from_datetime", "available_to_datetime")


@check("g2_first_n", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, base_asset FROM instruments WHERE venue = 'DERIBIT' ORDER BY instrument_key LIMIT 50""")
def _first_n(spark, sf):
    return ins.select_instruments(ad.instruments(spark, sf), venue="DERIBIT", max_results=50).select("instrument_key", "base_asset")


_MARKETS = fx.with_(fx.INSTRUMENTS, """
markets AS (
  SELECT ['binance', 'deribit', 'coinbase', 'kraken'][p_partkey % 4 + 1] AS exchange_id,
    CASE WHEN p_partkey % 7 = 0 THEN '1000' || base_asset ELSE base_asset END AS base, quote_asset AS quote, settle_asset AS settle,
    base_asset || '/' || quote_asset AS symbol, CASE WHEN p_partkey % 2 = 0 THEN base_asset || '/' || quote_asset ELSE base_asset || quote_asset END AS id,
    CASE instrument_type WHEN 'SPOT_PAIR' THEN 'spot' WHEN 'PERPETUAL' THEN 'swap' WHEN 'FUTURE' THEN 'future' ELSE 'option' END AS type,
    CASE WHEN instrument_type IN ('FUTURE', 'OPTION') AND p_partkey % 11 <> 0 THEN d1 END AS expiry,
    CASE WHEN instrument_type = 'OPTION' THEN CAST(strike AS DOUBLE) END AS strike,
    CASE WHEN instrument_type = 'OPTION' THEN lower(option_type) END AS option_type, (p_partkey % 13 <> 0) AS active
  FROM instruments
)""")


def _markets(spark, sf):
    i = ad.instruments(spark, sf)
    key, kind = F.col("p_partkey"), F.col("instrument_type")
    return i.select(
        F.get(F.array(*[F.lit(v) for v in ("binance", "deribit", "coinbase", "kraken")]), (key % 4).cast("int")).alias("exchange_id"),
        F.when(key % 7 == 0, F.concat(F.lit("1000"), "base_asset")).otherwise(F.col("base_asset")).alias("base"),
        F.col("quote_asset").alias("quote"), F.col("settle_asset").alias("settle"),
        F.concat_ws("/", "base_asset", "quote_asset").alias("symbol"),
        F.when(key % 2 == 0, F.concat_ws("/", "base_asset", "quote_asset")).otherwise(F.concat("base_asset", "quote_asset")).alias("id"),
        F.when(kind == "SPOT_PAIR", "spot").when(kind == "PERPETUAL", "swap").when(kind == "FUTURE", "future").otherwise("option").alias("type"),
        F.when(kind.isin("FUTURE", "OPTION") & (key % 11 != 0), F.to_date(F.substring("expiry", 1, 10))).alias("expiry"),
        F.when(kind == "OPTION", F.expr("try_cast(strike as double)")).alias("strike"),
        F.when(kind == "OPTION", F.lower("option_type")).alias("option_type"), (key % 13 != 0).alias("active"))


@check("c11_market_filters", _MARKETS + """
SELECT exchange_id, base, quote, type, count(*) AS markets FROM markets
WHERE active AND quote IN ('USDT') AND type IN ('swap', 'future') AND base IN ('SMALL7', '1000SMALL7', 'RED1', '1000RED1', 'HOT3', '1000HOT3')
GROUP BY ALL""")
def _market_filters(spark, sf):
    wanted = ins.market_matches(base="SMALL7") | ins.market_matches(base="RED1") | ins.market_matches(base="HOT3")
    rows = ins.active_markets(_markets(spark, sf), quotes=ins.combine_filters(["USDT", "USD"], ["USDT", "BTC"]),
                              types=["swap", "future"], predicate=wanted)
    return rows.groupBy("exchange_id", "base", "quote", "type").agg(F.count(F.lit(1)).alias("markets"))


@check("l1_custom_predicate", _MARKETS + "SELECT exchange_id, symbol, strike FROM markets WHERE active AND strike > 250")
def _predicate(spark, sf):
    return ins.active_markets(_markets(spark, sf), predicate=F.col("strike") > 250).select("exchange_id", "symbol", "strike")


@check("h6_filter_intersection", _MARKETS + "SELECT quote, count(*) AS markets FROM markets WHERE active AND quote IN ('USD') GROUP BY ALL")
def _intersection(spark, sf):
    quotes = ins.combine_filters(["USDT", "USD", "BTC"], ["USD", "EUR"])
    return ins.active_markets(_markets(spark, sf), quotes=quotes).groupBy("quote").agg(F.count(F.lit(1)).alias("markets"))


@check("i15_live_definitions", _MARKETS + """
SELECT v || ':' || CASE WHEN type = 'option' THEN 'OPTION' WHEN type IN ('future', 'swap') THEN CASE WHEN expiry IS NOT NULL THEN 'FUTURE' ELSE 'PERPETUAL' END ELSE 'SPOT_PAIR' END
    || ':' || base || '-' || quote || CASE
      WHEN type = 'option' THEN '-' || coalesce(strftime(expiry, '%y%m%d'), '000000') || '-' || CAST(CAST(strike AS INTEGER) AS VARCHAR) || '-' || upper(option_type)
      WHEN type IN ('future', 'swap') AND expiry IS NOT NULL THEN '-' || strftime(expiry, '%y%m%d') ELSE '' END AS instrument_key,
  v AS venue, upper(type) AS instrument_type,
  CASE WHEN type IN ('future', 'swap') THEN 'trades,book_snapshot_5,derivative_ticker,liquidations' WHEN type = 'option' THEN 'trades,book_snapshot_5,options_chain'
       ELSE 'trades,book_snapshot_5' END AS data_types,
  settle AS settle_asset, CASE exchange_id WHEN 'binance' THEN lower(replace(id, '/', '')) WHEN 'coinbase' THEN replace(id, '/', '-') ELSE id END AS tardis_symbol,
  CASE WHEN exchange_id = 'coinbase' THEN 'coinbase-pro' ELSE exchange_id END AS tardis_exchange
FROM (SELECT *, CASE exchange_id WHEN 'binance' THEN CASE WHEN type = 'spot' THEN 'BINANCE-SPOT' ELSE 'BINANCE-FUTURES' END WHEN 'deribit' THEN 'DERIBIT'
        ELSE upper(exchange_id) || '-SPOT' END AS v FROM markets)""")
def _live(spark, sf):
    return ins.live_definitions(_markets(spark, sf)).select(
        "instrument_key", "venue", "instrument_type", "data_types", "settle_asset", "tardis_symbol", "tardis_exchange")


# -- lookups ------------------------------------------------------------------------

@check("d14_find_instrument", fx.with_(fx.INSTRUMENTS, """
targets AS (
  SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN instrument_key
    WHEN instrument_type = 'OPTION' THEN venue || ':OPTION:' || base_asset || '-' || quote_asset || '-991231-' || strike || '-' || option_type
    WHEN p_partkey % 3 = 1 THEN venue || ':' || instrument_type || ':' || base_asset || '-' || quote_asset
    ELSE 'NOWHERE:' || instrument_type || ':' || base_asset || '-' || quote_asset END AS target FROM instruments
)""", """
p AS (SELECT target, split_part(target, ':', 1) AS v, split_part(target, ':', 2) AS ty, string_split(split_part(target, ':', 3), '-') AS s FROM targets)""") + """
SELECT target, coalesce(e.k, c.k, o.k) AS instrument_key,
  CASE WHEN e.k IS NOT NULL THEN 'exact' WHEN c.k IS NOT NULL THEN 'components' WHEN o.k IS NOT NULL THEN 'option_terms' ELSE 'none' END AS matched_by
FROM p LEFT JOIN (SELECT DISTINCT instrument_key AS k FROM instruments) e ON e.k = p.target
LEFT JOIN (SELECT venue, instrument_type, base_asset, quote_asset, min(instrument_key) AS k FROM instruments
           WHERE instrument_type IN ('PERPETUAL', 'SPOT_PAIR') GROUP BY ALL) c
  ON c.venue = p.v AND c.instrument_type = p.ty AND c.base_asset = p.s[1] AND c.quote_asset = p.s[2] AND len(p.s) = 2
LEFT JOIN (SELECT venue, instrument_type, base_asset, quote_asset, strike, option_type, min(instrument_key) AS k FROM instruments
           WHERE instrument_type = 'OPTION' GROUP BY ALL) o
  ON o.venue = p.v AND o.instrument_type = p.ty AND o.base_asset = p.s[1] AND o.quote_asset = p.s[2] AND len(p.s) >= 5
     AND o.strike = p.s[4] AND o.option_type = p.s[5]""")
def _find(spark, sf):
    i = ad.instruments(spark, sf)
    pair = F.concat_ws("-", "base_asset", "quote_asset")
    target = (
        F.when(F.col("p_partkey") % 3 == 0, F.col("instrument_key"))
        .when(F.col("instrument_type") == "OPTION", F.concat(
            "venue", F.lit(":OPTION:"), F.concat_ws("-", pair, F.lit("991231"), "strike", "option_type")))
        .when(F.col("p_partkey") % 3 == 1, F.concat_ws(":", "venue", "instrument_type", pair))
        .otherwise(F.concat_ws(":", F.lit("NOWHERE"), "instrument_type", pair)))
    return ins.find(i, i.select(target.alias("target")))


@check("d14_similar_instruments", fx.with_(fx.INSTRUMENTS) +
       "SELECT DISTINCT instrument_key FROM instruments WHERE contains(instrument_key, 'OKX') ORDER BY 1 LIMIT 10")
def _similar(spark, sf):
    return ins.similar(ad.instruments(spark, sf), "OKX:PERPETUAL:NONE-USDT", limit=10)


SNAPSHOTS = ("1995-04-01", "1995-05-01")
CHANGES = fx.with_(fx.INSTRUMENTS, *[f"""
s{i} AS (SELECT DISTINCT venue, exchange_raw_symbol FROM instruments WHERE d0 <= DATE '{day}' AND d1 >= DATE '{day}')"""
                                     for i, day in enumerate(SNAPSHOTS)], """
changed AS (
  SELECT coalesce(a.venue, b.venue) AS venue, coalesce(a.exchange_raw_symbol, b.exchange_raw_symbol) AS exchange_raw_symbol,
    CASE WHEN a.venue IS NULL THEN 'added' ELSE 'removed' END AS change
  FROM s0 a FULL JOIN s1 b ON a.venue = b.venue AND a.exchange_raw_symbol = b.exchange_raw_symbol
  WHERE a.venue IS NULL OR b.venue IS NULL
)""")


@check("d16_listing_changes", CHANGES + "SELECT * FROM changed")
def _changes(spark, sf):
    i = ad.instruments(spark, sf)
    before, after = (ins.available_on(i, day) for day in SNAPSHOTS)
    return ins.changes(before, after, ["venue", "exchange_raw_symbol"])


@check("d12_unknown_requests", fx.with_(fx.INSTRUMENTS) + """
SELECT DISTINCT 'X' || instrument_key AS instrument_key FROM instruments WHERE p_partkey % 4 = 0 ORDER BY 1 LIMIT 10""")
def _unknown(spark, sf):
    i = ad.instruments(spark, sf)
    asked = i.select(F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("X"), "instrument_key")).otherwise(
        F.col("instrument_key")).alias("instrument_key"))
    return ins.requested_but_unknown(asked, i, limit=10)


# -- validation, counts, shapes ---------------------------------------------------------

@check("j2_instrument_validity", fx.with_(fx.INSTRUMENTS) + """
SELECT p_partkey,
  list_filter([CASE WHEN p_partkey % 6 = 0 THEN 'available_to_datetime' END, CASE WHEN p_partkey % 8 = 0 THEN 'option_type' END],
    lambda x: x IS NOT NULL)::VARCHAR AS errors,
  list_filter([CASE WHEN p_partkey % 5 = 0 THEN 'unknown_data_type' END,
    CASE WHEN instrument_type = 'OPTION' AND p_partkey % 9 = 0 THEN 'missing_strike' END,
    CASE WHEN instrument_type = 'OPTION' AND option_type = '' AND p_partkey % 8 <> 0 THEN 'missing_option_type' END], lambda x: x IS NOT NULL)::VARCHAR AS warnings
FROM instruments""")
def _validity(spark, sf):
    key = F.col("p_partkey")
    bad = ad.instruments(spark, sf).withColumns({
        "available_to_datetime": F.when(key % 6 == 0, "soon").otherwise(F.col("available_to_datetime")),
        "option_type": F.when(key % 8 == 0, "CALLS").otherwise(F.col("option_type")),
        "data_types": F.when(key % 5 == 0, "trades, quotes").otherwise(F.col("data_types")),
        "strike": F.when(key % 9 == 0, "").otherwise(F.col("strike")),
    })
    text = lambda c: F.concat(F.lit("["), F.concat_ws(", ", c), F.lit("]")).alias(c)
    return ins.validate(bad).select("p_partkey", text("errors"), text("warnings"))


@check("e13_statistics", fx.with_(fx.INSTRUMENTS) + """
SELECT CASE WHEN g = 3 THEN 'venue' WHEN g = 5 THEN 'instrument_type' WHEN g = 1 THEN 'venue_and_type' WHEN g = 6 THEN 'base_asset' ELSE 'total' END AS level,
  venue, instrument_type, base_asset, n AS instruments
FROM (SELECT grouping(venue, instrument_type, base_asset) AS g, venue, instrument_type, base_asset, count(*) AS n FROM instruments
      GROUP BY GROUPING SETS ((venue), (instrument_type), (venue, instrument_type), (base_asset), ()))""")
def _statistics(spark, sf):
    return ins.statistics(ad.instruments(spark, sf))


@check("g3_top_bases", fx.with_(fx.INSTRUMENTS) +
       "SELECT base_asset, count(*) AS instruments FROM instruments GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _top(spark, sf):
    return ins.top_bases(ad.instruments(spark, sf))


@check("e18_by_underlying", fx.with_(fx.INSTRUMENTS, """
u AS (SELECT DISTINCT CASE WHEN instrument_type <> 'OPTION' THEN base_asset WHEN underlying <> '' THEN underlying ELSE base_asset END AS underlying,
  instrument_key FROM instruments)""") + "SELECT underlying, instrument_key, count(*) OVER (PARTITION BY underlying) AS instruments FROM u")
def _underlying(spark, sf):
    return ins.by_underlying(ad.instruments(spark, sf))


@check("i22_summary_rows", fx.with_(fx.INSTRUMENTS) + """
SELECT instrument_key, venue, instrument_type, base_asset, quote_asset, settle_asset, available_from_datetime AS available_from,
  available_to_datetime AS available_to, data_types, expiry, strike, option_type, inverse, underlying, exchange_raw_symbol,
  tardis_symbol, tardis_exchange FROM instruments""")
def _summary(spark, sf):
    return ins.summary(ad.instruments(spark, sf))


@check("c9_iso_times", fx.with_(fx.EVENTS) + """SELECT id, strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp" FROM ev""")
def _iso(spark, sf):
    return ins.iso_times(ad.trades(spark, sf).select("id", "timestamp"), ["timestamp"])
