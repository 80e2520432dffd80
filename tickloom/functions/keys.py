"""Instrument keys, venue names and symbol spellings as column expressions.

The name tables have a fixed handful of entries and are written into the plan
as map literals, so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vendor exchange -> venue.
EXCHANGE_TO_VENUE = {
    "binance": "BINANCE",
    "binance-futures": "BINANCE-FUTURES",
    "deribit": "DERIBIT",
    "bybit": "BYBIT",
    "bybit-spot": "BYBIT-SPOT",
    "okex": "OKX",
    "okex-futures": "OKX-FUTURES",
    "okex-swap": "OKX-SWAP",
    "upbit": "UPBIT",
}
# Vendor symbol type -> instrument type.
SYMBOL_TYPE_TO_INSTRUMENT = {
    "spot": "SPOT_PAIR",
    "perpetual": "PERPETUAL",
    "future": "FUTURE",
    "option": "OPTION",
    "combo": "OPTION",
}
# Live venue -> exchange id.
VENUE_TO_CCXT = {
    "BINANCE-SPOT": "binance",
    "BINANCE-FUTURES": "binance",
    "BINANCE-MARGIN": "binance",
    "DERIBIT": "deribit",
    "COINBASE-SPOT": "coinbase",
    "COINBASE-PRO": "coinbase",
    "KRAKEN-SPOT": "kraken",
    "KRAKEN-FUTURES": "kraken",
    "BITFINEX-SPOT": "bitfinex",
    "HUOBI-SPOT": "huobi",
    "HUOBI-FUTURES": "huobi",
    "OKEX-SPOT": "okx",
    "OKEX-FUTURES": "okx",
    "BYBIT-SPOT": "bybit",
    "BYBIT-FUTURES": "bybit",
}
# Exchange id -> vendor exchange.
CCXT_TO_TARDIS = {
    "binance": "binance",
    "deribit": "deribit",
    "coinbase": "coinbase-pro",
    "kraken": "kraken",
    "bitfinex": "bitfinex",
    "huobi": "huobi-dm",
    "okx": "okex",
    "bybit": "bybit",
}
# Where an exchange has several venues, the last one listed is its name.
CCXT_TO_VENUE = {exchange: venue for venue, exchange in VENUE_TO_CCXT.items()}
TARDIS_TO_CCXT = {vendor: exchange for exchange, vendor in CCXT_TO_TARDIS.items()}
# Quote assets recognised at the end of a joined symbol, in order.
JOINED_QUOTES = ("USDT", "BUSD", "USD", "BTC", "ETH", "BNB", "EUR", "GBP")


def lookup(values: dict[str, str], key: Column) -> Column:
    """The entry for ``key`` in a fixed table, NULL when absent."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


# -- keys --------------------------------------------------------------------

def part(key: Column | str, index: int) -> Column:
    """The ``index``-th (1-based) colon-separated part, NULL when absent."""
    return F.get(F.split(F.col(key) if isinstance(key, str) else key, ":"), F.lit(index - 1))


def parse_key(df: DataFrame, key: str = "instrument_key") -> DataFrame:
    """Add venue, instrument_type, symbol, expiry, option_type and ``valid_key``.

    A key needs three parts.
    """
    return df.select(
        "*",
        part(key, 1).alias("key_venue"), part(key, 2).alias("key_type"), part(key, 3).alias("key_symbol"),
        part(key, 4).alias("key_expiry"), part(key, 5).alias("key_option_type"),
        (F.size(F.split(key, ":")) >= 3).alias("valid_key"),
    )


def build_key(venue: Column, instrument_type: Column, symbol: Column, expiry: Column, option_type: Column) -> Column:
    """Inverse of :func:`parse_key`; empty parts are left out."""
    blank = lambda c: F.when(c != "", c)
    return F.concat_ws(":", venue, instrument_type, symbol, blank(expiry), blank(option_type))


def symbol_and_exchange(key: Column | str) -> tuple[Column, Column]:
    """Candle labels: the symbol and the lower-case exchange, else ``unknown``."""
    well_formed = part(key, 3).isNotNull()
    name = F.col(key) if isinstance(key, str) else key
    return F.when(well_formed, part(key, 3)).otherwise(name), F.when(
        well_formed, F.lower(part(key, 1))).otherwise("unknown")


def live_key(
    venue: Column, instrument_type: Column, symbol: Column, expiry: Column, strike: Column, option_type: Column
) -> Column:
    """Key of a live instrument; options and futures append their terms to the symbol."""
    there = lambda c: c.isNotNull() & (c != "")
    kind = F.upper(instrument_type)
    head = F.concat_ws(":", F.upper(venue), kind, F.upper(symbol))
    return (
        F.when((kind == "OPTION") & there(expiry) & there(strike) & there(option_type),
               F.concat_ws("-", head, expiry, strike, F.upper(option_type)))
        .when((kind == "FUTURE") & there(expiry), F.concat_ws("-", head, expiry))
        .otherwise(head)
    )


def canonical_key(
    exchange: Column, symbol_type: Column, base: Column, quote: Column, expiry: Column, strike: Column, option_type: Column
) -> Column:
    """``VENUE:TYPE:BASE-QUOTE[-YYMMDD[-STRIKE-CALL|PUT]]`` from vendor fields.

    NULL for an unknown exchange or type, or without base or quote. ``expiry``
    is a date.
    """
    kind = lookup(SYMBOL_TYPE_TO_INSTRUMENT, symbol_type)
    there = lambda c: c.isNotNull() & (c != "")
    pair = F.concat_ws("-", F.upper(base), F.upper(quote))
    ymd = F.date_format(expiry, "yyMMdd")
    full_option = expiry.isNotNull() & there(strike) & there(option_type)
    symbol = (
        F.when((kind == "FUTURE") & expiry.isNotNull(), F.concat_ws("-", pair, ymd))
        .when((kind == "OPTION") & full_option, F.concat_ws("-", pair, ymd, strike, option_side(option_type)))
        .otherwise(pair)
    )
    # concat (not concat_ws) keeps the key NULL when the venue or type is.
    key = F.concat(lookup(EXCHANGE_TO_VENUE, exchange), F.lit(":"), kind, F.lit(":"), symbol)
    return F.when(there(base) & there(quote), key)


def option_side(value: Column) -> Column:
    """``C``/``P`` in any case to CALL/PUT; other text in upper case; NULL to empty."""
    upper = F.upper(value)
    return (
        F.when(upper.isin("C", "CALL"), "CALL").when(upper.isin("P", "PUT"), "PUT").otherwise(F.coalesce(upper, F.lit("")))
    )


def data_types(key: Column) -> Column:
    """Data types of an instrument, as an array, from the type in its key."""
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    return (
        F.when(key.contains("SPOT_PAIR"), names("trades", "book_snapshot_5"))
        .when(key.contains("PERPETUAL") | key.contains("FUTURE"),
              names("trades", "book_snapshot_5", "derivative_ticker", "liquidations"))
        .when(key.contains("OPTION"), names("trades", "book_snapshot_5", "options_chain"))
        .otherwise(names("trades", "book_snapshot_5"))
    )


def underlying(instrument_type: Column, base: Column, stated: Column) -> Column:
    """The asset whose instruments are validated together; NULL for other types."""
    return (
        F.when(instrument_type.isin("SPOT_PAIR", "SPOT_ASSET", "PERPETUAL", "PERP", "FUTURE"), base)
        .when(instrument_type == "OPTION", F.when(stated != "", stated).otherwise(base))
    )


def shard(key: Column, total: int) -> Column:
    """Stable shard number in ``[0, total)``."""
    return F.pmod(F.xxhash64(key), F.lit(total)).cast("int")


def in_shard(df: DataFrame, index: int, total: int, key: str = "instrument_key") -> DataFrame:
    if not 0 <= index < total:
        raise ValueError(f"shard index {index} must be between 0 and {total - 1}")
    return df.where(shard(F.col(key), total) == index)


# -- exchange names and symbol spellings ---------------------------------------

def exchange_info(name: Column) -> dict[str, Column]:
    """Venue, exchange id and vendor exchange for any of the three names."""
    upper, lower = F.upper(name), F.lower(name)
    as_venue = lookup(VENUE_TO_CCXT, upper)
    as_ccxt = F.when(lookup(CCXT_TO_TARDIS, lower).isNotNull(), lower)
    as_vendor = lookup(TARDIS_TO_CCXT, lower)
    exchange = F.coalesce(as_venue, as_ccxt, as_vendor)
    return {
        "venue": F.when(as_venue.isNotNull(), upper).otherwise(lookup(CCXT_TO_VENUE, exchange)),
        "ccxt_exchange": exchange,
        "tardis_exchange": lookup(CCXT_TO_TARDIS, exchange),
        "type": F.when(as_venue.isNotNull(), "venue").when(as_ccxt.isNotNull(), "ccxt")
        .when(as_vendor.isNotNull(), "tardis").otherwise("unknown"),
    }


def split_joined(symbol: Column) -> Column:
    """``BTCUSDT`` to ``BTC/USDT``; the first known quote leaving two characters wins."""
    out = symbol
    for quote in reversed(JOINED_QUOTES):
        pattern = f"^(.{{2,}}){quote}$"
        out = F.when(F.upper(symbol).rlike(pattern), F.regexp_replace(F.upper(symbol), pattern, f"$1/{quote}")).otherwise(out)
    return out


def to_ccxt_symbol(symbol: Column, exchange: Column) -> Column:
    name = F.lower(exchange)
    slashed = F.replace(symbol, F.lit("-"), F.lit("/"))
    joined = F.when((symbol == F.upper(symbol)) & symbol.rlike("^[^/]{6,}$"), split_joined(symbol))
    return (
        F.when(name == "binance", F.when(symbol.contains("-"), slashed).otherwise(F.coalesce(joined, symbol)))
        .when(name == "deribit", symbol)
        .when(name == "coinbase", F.replace(symbol, F.lit("/"), F.lit("-")))
        .otherwise(slashed)
    )


def from_ccxt_symbol(symbol: Column, style: str = "dash") -> Column:
    if style not in ("dash", "concat"):
        return symbol
    return F.replace(symbol, F.lit("/"), F.lit("-" if style == "dash" else ""))


def mapping_is_valid(venue: Column, ccxt_symbol: Column) -> Column:
    exchange = lookup(VENUE_TO_CCXT, F.upper(venue))
    return exchange.isNotNull() & ~((exchange == "binance") & ~ccxt_symbol.contains("/"))


def file_symbol(key: Column) -> Column:
    """The symbol as spelled in file names: the third key part without dashes."""
    return F.replace(part(key, 3), F.lit("-"), F.lit(""))
