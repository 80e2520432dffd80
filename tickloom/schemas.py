"""Fixed values and table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Timeframe name -> seconds. All divide a day, so epoch-aligned buckets are
# also midnight-aligned.
TIMEFRAMES = {"15s": 15, "1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "24h": 86400}
BASE_TIMEFRAMES = ("15s", "1m")
ROLLUP_TIMEFRAMES = ("5m", "15m", "1h", "4h", "24h")
LIVE_TIMEFRAMES = ("15s", "1m", "5m", "15m", "4h", "24h")
HFT_TIMEFRAMES = ("15s", "1m")
MFT_TIMEFRAMES = ("1m", "5m", "15m", "1h", "4h", "24h")

# Candles and book rows are available this long after their last input.
EMISSION_DELAY_MS = 200

VENUES = (
    "BINANCE", "BINANCE-FUTURES", "BYBIT", "BYBIT-SPOT", "OKX", "OKX-SWAP", "OKX-FUTURES",
    "DERIBIT", "AAVE_V3", "ETHERFI", "LIDO", "WALLET", "CME", "NASDAQ",
)
INSTRUMENT_TYPES = (
    "SPOT_ASSET", "SPOT_PAIR", "PERP", "PERPETUAL", "FUTURE", "OPTION",
    "EQUITY", "INDEX", "LST", "A_TOKEN", "DEBT_TOKEN",
)
DATA_TYPES = ("trades", "book_snapshot_5", "derivative_ticker", "options_chain", "liquidations")
SIDES = ("buy", "sell")
STATUSES = ("PASS", "FAIL", "WARNING", "SKIP")
BOOK_LEVELS = 5

# Instrument type -> data types that exist for it.
DATA_TYPES_BY_INSTRUMENT = {
    "SPOT_PAIR": ("trades", "book_snapshot_5"),
    "PERPETUAL": ("trades", "book_snapshot_5", "derivative_ticker", "liquidations"),
    "FUTURE": ("trades", "book_snapshot_5", "derivative_ticker", "liquidations"),
    "OPTION": ("trades", "book_snapshot_5", "options_chain"),
}

# ---------------------------------------------------------------------------
# Tick tables. Stored times are int64 microseconds since the epoch, UTC.
# ---------------------------------------------------------------------------


def _schema(longs: tuple = (), strings: tuple = (), doubles: tuple = ()) -> T.StructType:
    fields = [T.StructField(c, T.LongType()) for c in longs]
    fields += [T.StructField(c, T.StringType()) for c in strings]
    fields += [T.StructField(c, T.DoubleType()) for c in doubles]
    return T.StructType(fields)


_TIMES = ("timestamp", "local_timestamp")
BOOK_COLUMNS = tuple(
    f"{side}_{what}_{level}"
    for level in range(1, BOOK_LEVELS + 1)
    for side in ("ask", "bid")
    for what in ("price", "volume")
)

TICK_SCHEMAS = {
    "trades": _schema(_TIMES, ("id", "side"), ("price", "amount")),
    "liquidations": _schema(_TIMES, ("id", "side"), ("price", "amount")),
    "derivative_ticker": _schema(
        _TIMES + ("funding_timestamp",), (),
        ("funding_rate", "predicted_funding_rate", "open_interest", "last_price", "index_price", "mark_price"),
    ),
    "book_snapshot_5": _schema(_TIMES, (), BOOK_COLUMNS),
    "quotes": _schema(_TIMES, (), ("bid_price", "bid_amount", "ask_price", "ask_amount")),
    "options_chain": _schema(
        _TIMES + ("expiration",), ("type", "underlying_index"),
        ("strike_price", "open_interest", "last_price", "bid_price", "bid_amount", "bid_iv",
         "ask_price", "ask_amount", "ask_iv", "mark_price", "mark_iv", "underlying_price",
         "delta", "gamma", "vega", "theta", "rho"),
    ),
}

# ---------------------------------------------------------------------------
# Instrument table
# ---------------------------------------------------------------------------

INSTRUMENT_REQUIRED = (
    "instrument_key", "venue", "instrument_type", "available_from_datetime", "available_to_datetime",
    "data_types", "base_asset", "quote_asset", "settle_asset", "exchange_raw_symbol",
    "tardis_symbol", "tardis_exchange", "data_provider", "venue_type", "asset_class",
)
INSTRUMENT_OPTIONAL = (
    "symbol_type", "contract_type", "strike", "option_type", "expiry", "tick_size",
    "settlement_type", "underlying", "min_size", "ccxt_symbol", "ccxt_exchange",
)
INSTRUMENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in INSTRUMENT_REQUIRED + INSTRUMENT_OPTIONAL]
    + [T.StructField("inverse", T.BooleanType()), T.StructField("contract_size", T.DoubleType())]
)

# ---------------------------------------------------------------------------
# Candles, features, indicators
# ---------------------------------------------------------------------------

CANDLE_COLUMNS = (
    "timeframe", "timestamp", "timestamp_out", "open", "high", "low", "close", "volume", "vwap", "trade_count",
)
TRADE_FEATURES = (
    "buy_volume_sum", "sell_volume_sum", "size_avg", "price_vwap",
    "delay_median", "delay_max", "delay_min", "delay_mean",
)
LIQUIDATION_FEATURES = ("liquidation_buy_volume", "liquidation_sell_volume", "liquidation_count")
DERIVATIVE_FEATURES = ("funding_rate", "index_price", "mark_price", "open_interest", "predicted_funding_rate")
OI_FEATURES = ("oi_change", "liquidation_with_rising_oi", "liquidation_with_falling_oi")
OPTION_FEATURES = ("skew_25d_put_call_ratio", "atm_mark_iv")
BATCH_FEATURES = (
    TRADE_FEATURES + ("trade_count",) + LIQUIDATION_FEATURES + DERIVATIVE_FEATURES + OI_FEATURES + OPTION_FEATURES
)
INDICATORS = (
    "sma_5", "sma_10", "sma_20", "ema_5", "ema_10", "ema_20", "wma_5",
    "price_momentum_3", "price_momentum_5", "price_velocity", "price_acceleration",
    "volume_sma_5", "volume_ema_5", "volume_ratio", "vwap_deviation",
    "price_volatility_5", "price_volatility_10", "high_low_ratio", "close_to_close_return",
    "trade_intensity", "avg_trade_size", "price_impact", "bid_ask_spread_proxy",
    "rsi_5", "bollinger_position", "macd_signal",
)

# Warehouse column name -> type; anything not listed is a string.
WAREHOUSE_TYPES = {
    **{c: "string" for c in ("symbol", "exchange", "timeframe", "instrument_id")},
    **{c: "timestamp" for c in ("timestamp", "timestamp_out")},
    "date": "date",
    "trade_count": "bigint",
    **{c: "double" for c in ("open", "high", "low", "close", "volume", "vwap")},
    **{c: "double" for c in BATCH_FEATURES if c != "trade_count"},
    **{c: "double" for c in BOOK_COLUMNS},
    **{f"{side}_{what}_{i}": "double" for side in ("bid", "ask") for what in ("distance", "volume_ratio")
       for i in range(1, BOOK_LEVELS + 1)},
    **{c: "double" for c in (
        "mid_price", "spread_abs", "spread_bps", "bid_ask_ratio", "total_bid_volume", "total_ask_volume",
        "volume_imbalance", "bid_vwap", "ask_vwap", "vwap_spread", "bid_levels_filled", "ask_levels_filled",
        "book_imbalance")},
}


def empty_ticks(spark: SparkSession, data_type: str) -> DataFrame:
    """An empty frame with the schema of ``data_type``."""
    if data_type not in TICK_SCHEMAS:
        raise ValueError(f"unknown data type {data_type!r}; known: {sorted(TICK_SCHEMAS)}")
    return spark.createDataFrame([], TICK_SCHEMAS[data_type])
