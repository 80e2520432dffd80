"""SQL forms of the adapters in ``tickloom.sources.adapters``."""

EVENTS = """
ev AS (
  SELECT 'BINANCE:SPOT_PAIR:U' || (user_id % 8) || '-USDT' AS instrument_key,
         ts AS "timestamp", ts + to_milliseconds(k) AS local_timestamp, CAST(ts AS DATE) AS day,
         CAST(event_id AS VARCHAR) AS id, event_id, event_type, value, k
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
)"""

TRADES = EVENTS + """,
trades AS (
  SELECT instrument_key, "timestamp", local_timestamp, day, id,
         CASE WHEN event_type IN ('purchase', 'signup', 'view') THEN 'buy' ELSE 'sell' END AS side,
         value AS price, CAST((k + 1) / 10.0 AS DOUBLE) AS amount
  FROM ev
)"""

LIQUIDATIONS = """
liquidations AS (
  SELECT instrument_key, "timestamp", local_timestamp, day, id,
         CASE WHEN k % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         value AS price, CAST((k + 1) / 10.0 AS DOUBLE) AS amount
  FROM ev WHERE event_type = 'error'
)"""

TICKER = """
ticker AS (
  SELECT instrument_key, "timestamp", local_timestamp, day, id,
         CAST((k - 50) / 1e6 AS DOUBLE) AS funding_rate,
         CASE WHEN k % 10 <> 0 THEN CAST((k - 40) / 1e6 AS DOUBLE) END AS predicted_funding_rate,
         value * 10 + k AS open_interest, value AS last_price, value * 1.001 AS index_price, value AS mark_price
  FROM ev WHERE event_type = 'view'
)"""


def _book_levels() -> str:
    parts = []
    for i in range(1, 6):
        bid = f"value * (1 - CAST(0.0005 AS DOUBLE) * {i})"
        bid_volume = f"CAST((k + {2 * i}) / 10.0 AS DOUBLE)"
        if i == 5:
            bid = f"CASE WHEN k % 10 <> 0 THEN {bid} END"
            bid_volume = f"CASE WHEN k % 10 <> 0 THEN {bid_volume} END"
        parts.append(
            f"value * (1 + CAST(0.0005 AS DOUBLE) * {i}) AS ask_price_{i}, "
            f"CAST((k + {i}) / 10.0 AS DOUBLE) AS ask_volume_{i}, "
            f"{bid} AS bid_price_{i}, {bid_volume} AS bid_volume_{i}")
    return ",\n         ".join(parts)


BOOKS = f"""
books AS (
  SELECT instrument_key, "timestamp", local_timestamp, day, id,
         {_book_levels()}
  FROM ev WHERE event_type = 'click'
)"""

DENSE_TRADES = """
dense AS (
  SELECT 'BINANCE:PERPETUAL:P' || (l_partkey % 16) || '-USDT' AS instrument_key,
         l_shipdate AS "timestamp", l_shipdate + to_milliseconds(l_linenumber) AS local_timestamp,
         CAST(l_shipdate AS DATE) AS day,
         lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-' || l_partkey AS id,
         CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side,
         l_extendedprice / l_quantity AS price, l_quantity AS amount
  FROM lineitem
)"""

OPTIONS = """
chain0 AS (
  SELECT *, 'A' || (l_suppkey % 4) || '-USD' AS underlying_index,
         CAST(last_day(l_shipdate) + CAST((1 + l_partkey % 3) * 30 AS INTEGER) AS TIMESTAMP) AS expiration
  FROM lineitem
),
chain AS (
  SELECT underlying_index, l_shipdate AS "timestamp",
         l_shipdate + to_milliseconds(l_orderkey % 1000) AS local_timestamp,
         lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-' || l_partkey AS id,
         CASE WHEN l_linenumber % 2 = 0 THEN 'put' ELSE 'call' END AS type,
         CAST(CAST(l_quantity AS INTEGER) * 10 AS DOUBLE) AS strike_price, expiration,
         CAST((CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END) * (l_orderkey % 100) / 100.0 AS DOUBLE) AS delta,
         l_extendedprice / 100000.0 + l_tax AS mark_iv
  FROM chain0
)"""

INSTRUMENTS = """
ins0 AS (
  SELECT p_partkey, p_size, p_size % 4 AS kind,
         ['BINANCE', 'BYBIT', 'OKX', 'DERIBIT'][p_partkey % 4 + 1] AS venue,
         ['SPOT_PAIR', 'PERPETUAL', 'FUTURE', 'OPTION'][p_size % 4 + 1] AS instrument_type,
         upper(split_part(p_name, ' ', 1)) || (p_partkey % 50) AS base_asset,
         CASE WHEN p_partkey % 5 = 0 THEN 'USD' ELSE 'USDT' END AS quote_asset,
         DATE '1995-01-01' + CAST(p_partkey % 200 AS INTEGER) AS d0,
         DATE '1995-01-01' + CAST(p_partkey % 200 AS INTEGER) + CAST(p_size * 2 + 10 AS INTEGER) AS d1
  FROM part
),
instruments AS (
  SELECT p_partkey,
    venue || ':' || instrument_type || ':' || base_asset || '-' || quote_asset ||
      CASE WHEN kind >= 2 THEN '-' || strftime(d1, '%y%m%d') ELSE '' END ||
      CASE WHEN kind = 3 THEN '-' || (p_size * 10) || '-' || (CASE WHEN p_partkey % 2 = 0 THEN 'CALL' ELSE 'PUT' END)
           ELSE '' END AS instrument_key,
    venue, instrument_type,
    strftime(d0, '%Y-%m-%dT00:00:00Z') AS available_from_datetime,
    strftime(d1, '%Y-%m-%dT08:00:00Z') AS available_to_datetime,
    CASE WHEN kind = 0 THEN 'trades,book_snapshot_5' WHEN kind = 3 THEN 'trades,book_snapshot_5,options_chain'
         ELSE 'trades,book_snapshot_5,derivative_ticker,liquidations' END AS data_types,
    base_asset, quote_asset,
    CASE WHEN kind = 1 AND p_partkey % 3 = 0 THEN base_asset ELSE quote_asset END AS settle_asset,
    base_asset || quote_asset AS exchange_raw_symbol, lower(base_asset || quote_asset) AS tardis_symbol,
    lower(venue) AS tardis_exchange, 'tardis' AS data_provider, 'exchange' AS venue_type, 'crypto' AS asset_class,
    CASE WHEN kind = 3 THEN CAST(p_size * 10 AS VARCHAR) ELSE '' END AS strike,
    CASE WHEN kind = 3 THEN (CASE WHEN p_partkey % 2 = 0 THEN 'CALL' ELSE 'PUT' END) ELSE '' END AS option_type,
    CASE WHEN kind >= 2 THEN strftime(d1, '%Y-%m-%dT08:00:00Z') END AS expiry,
    CASE WHEN kind >= 2 THEN base_asset || '-' || quote_asset ELSE '' END AS underlying,
    (kind = 1 AND p_partkey % 3 = 0) AS inverse, d0, d1
  FROM ins0
)"""

AVAILABLE = INSTRUMENTS + """,
available AS (
  SELECT DISTINCT l.day, i.instrument_key, l.data_type
  FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
               unnest(CASE WHEN l_linestatus = 'F' THEN ['trades'] ELSE ['trades', 'book_snapshot_5'] END) AS data_type
        FROM lineitem) l
  JOIN instruments i ON i.p_partkey = l.l_partkey
)"""

_DAY_MONTH = "CAST(extract(day FROM e) AS VARCHAR) || upper(strftime(e, '%b%y'))"
_DAY2_MONTH = "upper(strftime(e, '%d%b%y'))"
SYMBOLS = f"""
sym0 AS (
  SELECT p_partkey, p_size, upper(split_part(p_name, ' ', 1)) AS b,
         ['binance', 'binance-futures', 'deribit', 'bybit', 'bybit-spot', 'okex', 'okex-futures', 'okex-swap',
          'upbit'][p_partkey % 9 + 1] AS exchange,
         DATE '2024-01-03' + CAST(p_size * 7 AS INTEGER) AS e,
         DATE '2023-06-01' + CAST(p_partkey % 300 AS INTEGER) AS s
  FROM part
),
sym1 AS (
  SELECT p_partkey, p_size, exchange, e, s,
    CASE
      WHEN exchange IN ('binance', 'bybit-spot') THEN
        CASE WHEN p_size % 13 = 0 THEN 'BTCUPUSDT' WHEN p_size % 5 = 0 THEN lower(b) || 'eur' ELSE lower(b) || 'usdt' END
      WHEN exchange = 'binance-futures' THEN
        CASE WHEN p_size % 2 = 1 THEN b || 'USDT_' || strftime(e, '%y%m%d') ELSE '1000' || b || 'USDT' END
      WHEN exchange = 'deribit' THEN
        CASE WHEN p_size % 4 = 0 THEN b || '-' || {_DAY_MONTH} || '-' || (p_size * 100) || '-C'
             WHEN p_size % 4 = 1 THEN b || '_USDC-' || {_DAY_MONTH} || '-' || p_size || 'd5-P'
             WHEN p_size % 4 = 2 THEN b || '-' || {_DAY2_MONTH}
             ELSE b || '-' || strftime(e, '%y%m%d') END
      WHEN exchange = 'bybit' THEN
        CASE WHEN p_size % 2 = 1 THEN b || 'USDT' || substr('FGHJKMNQUVXZ', CAST(extract(month FROM e) AS INTEGER), 1)
                                      || strftime(e, '%y')
             ELSE b || 'USDT-' || {_DAY2_MONTH} END
      WHEN exchange = 'okex' THEN CASE WHEN p_size % 13 = 0 THEN 'SPOT' ELSE b || '-USDT' END
      WHEN exchange = 'okex-futures' THEN b || '-USDT-' || strftime(e, '%y%m%d')
      WHEN exchange = 'okex-swap' THEN b || '-USDT-SWAP'
      ELSE CASE WHEN p_size % 2 = 1 THEN b || '-KRW' ELSE 'BTC-' || b END
    END AS symbol_id,
    CASE
      WHEN exchange IN ('binance', 'bybit-spot', 'okex', 'upbit') THEN 'spot'
      WHEN exchange = 'okex-swap' THEN 'perpetual'
      WHEN exchange = 'binance-futures' THEN CASE WHEN p_size % 2 = 1 THEN 'future' ELSE 'perpetual' END
      WHEN exchange = 'deribit' THEN
        CASE WHEN p_size % 16 = 0 THEN 'combo' WHEN p_size % 4 < 2 THEN 'option' ELSE 'future' END
      ELSE 'future'
    END AS symbol_type
  FROM sym0
),
symbols AS (
  SELECT p_partkey, exchange, symbol_id, symbol_type,
    strftime(s, '%Y-%m-%dT00:00:00Z') AS available_since,
    CASE WHEN NOT (symbol_type IN ('spot', 'perpetual') OR p_size % 3 = 0)
         THEN strftime(e + 1, '%Y-%m-%dT00:00:00Z') END AS available_to
  FROM sym1
)"""


def candles(timeframe_seconds: int, name: str = "candles", source: str = "trades") -> str:
    """CTE of candles; ``timestamp`` is the interval start."""
    order = "row(t.\"timestamp\", t.local_timestamp, t.id, t.price)"
    return f"""
{name} AS (
  SELECT instrument_key, b AS "timestamp", max(local_timestamp) + INTERVAL 200 MILLISECONDS AS timestamp_out,
         arg_min_null(price, o) AS "open", max(price) AS high, min(price) AS low, arg_max_null(price, o) AS "close",
         sum(amount) AS volume, sum(price * amount) / sum(amount) AS vwap, count(*) AS trade_count
  FROM (SELECT t.*, {order} AS o, time_bucket(INTERVAL {timeframe_seconds} SECONDS, t."timestamp",
                                              TIMESTAMP '1970-01-01') AS b FROM {source} t)
  GROUP BY instrument_key, b
)"""


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(p.strip() for p in parts) + "\n"
