"""Vendor symbols parsed with built-in string functions.

Every function takes and gives columns, so a listing of any size is parsed in
one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quote assets of raw symbols.
QUOTES = ("USDT", "USDC", "BUSD", "USD", "DAI", "GBP", "TUSD", "EUR", "TRY", "BRL", "JPY", "KRW", "CNY", "HKD")
# Lot sizes written before a base asset.
LOTS = ("1000000", "10000", "1000")
# Futures month codes, January to December.
MONTH_CODES = "FGHJKMNQUVXZ"
# Exchanges whose contracts settle at 08:00 UTC.
SETTLE_AT_EIGHT = ("deribit", "binance-futures", "okex-futures", "okex-swap", "bybit")
# Leveraged tokens, and listing entries that stand for many symbols.
LEVERAGED = ("BTCUP", "BTCDOWN", "ETHUP", "ETHDOWN", "BNBUP", "BNBDOWN", "ADAUP", "ADADOWN")
AGGREGATES = ("SPOT", "PERPETUALS", "FUTURES", "COMBOS")


def quote_at_end(text: Column) -> Column:
    """The longest known quote that ``text`` ends with, something being before it; NULL when there is none."""
    known = F.array(*[F.lit(q) for q in sorted(QUOTES, key=len, reverse=True)])
    ends = F.filter(known, lambda q: F.endswith(F.upper(text), q) & (F.length(text) > F.length(q)))
    return F.get(ends, F.lit(0))


def before_quote(text: Column, quote: Column) -> Column:
    """What stands before the quote and the marks between; all of it when there is no quote."""
    rest = text.substr(F.lit(1), F.length(text) - F.length(quote))
    return F.regexp_replace(F.coalesce(rest, text), "[_-]+$", "")


def without_lot(base: Column) -> Column:
    """A base asset without the lot size some contracts put before it."""
    return F.regexp_replace(base, f"^(?:{'|'.join(LOTS)})(?=[A-Za-z])", "")


def staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once, however often they are used later.

    The optimizer copies expressions into every later filter and column, which
    for text parsing grows with each step. It does not do so across a generator,
    here one that gives one row per row.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_assets(listing: DataFrame) -> DataFrame:
    """Add base, quote and settlement asset; an unreadable symbol has an empty base.

    The quote is the part after the first dash if that is one, else what the first
    part ends with (a future's month code left out), USD if it ends with none; the
    base is what stands before it.
    Expects ``exchange``, ``symbol_id`` and ``symbol_type``.
    """
    exchange, symbol, kind = F.col("exchange"), F.col("symbol_id"), F.col("symbol_type")
    pieces = F.split(symbol, "-")
    first = F.get(pieces, F.lit(0))
    two = F.size(pieces) == 2
    spelled = staged(listing, {
        "_first": first, "_second": F.get(pieces, F.lit(1)), "_first_quote": quote_at_end(first),
        "_head": F.regexp_extract(
            F.when(kind == "future", F.regexp_replace(symbol, f"[{MONTH_CODES}]\\d{{2}}$", "")).otherwise(symbol), "^[^-_]*", 0),
         "_apart": F.upper(F.get(F.split(symbol, "[-_]"), F.lit(1))).isin(*QUOTES),
        "_shape": F.when(exchange == "upbit", F.when(two, "pair").otherwise("unreadable"))
        .when((exchange == "deribit") & kind.isin("future", "option"),
              F.when(symbol == "OPTIONS", "chain").when(symbol.contains("-"), "contract").otherwise("unreadable"))
        .when(two & ~symbol.rlike("[0-9]"), "pair").otherwise("joined"),
    })
    shape = F.col("_shape")
    own_quote = F.col("_first_quote").isin("USD", "USDC")
    named = staged(spelled, {
        "base_asset": F.when(shape == "pair", F.col("_first"))
        .when(shape == "contract", before_quote(F.col("_first"), F.col("_first_quote")))
        .when(shape == "chain", "BTC")
        .when(shape == "joined", without_lot(
            F.when(F.coalesce("_apart", F.lit(False)), F.col("_head"))
            .when(quote_at_end(F.col("_head")).isNotNull(), before_quote(F.col("_head"), quote_at_end(F.col("_head"))))
            # Nothing but a base, perhaps with a date code.
            .otherwise(F.regexp_extract("_head", "^[0-9]*[A-Za-z]+", 0))))
        .otherwise(""),
        "quote_asset": F.when(shape == "pair", F.col("_second"))
        .when(shape == "contract", F.when(own_quote, F.col("_first_quote")).otherwise("USD"))
        .when(shape == "chain", "USD")
        .when(shape == "joined", F.when(F.coalesce("_apart", F.lit(False)), F.upper(F.get(F.split(symbol, "[-_]"), F.lit(1))))
              .otherwise(F.coalesce(quote_at_end(F.col("_head")), F.lit("USD"))))
        .otherwise(""),
        "_coin_settled": F.when(shape == "contract", ~F.coalesce(own_quote, F.lit(False))).otherwise(shape != "pair"),
    })
    coin = F.col("_coin_settled") & (F.col("quote_asset") == "USD")
    settle = F.when(F.col("base_asset") == "", "").when(coin, F.col("base_asset")).otherwise(F.col("quote_asset"))
    return named.withColumn("settle_asset", settle).drop(
        "_first", "_second", "_head", "_apart", "_first_quote", "_shape", "_coin_settled")


def _found(symbol: Column, pattern: str, group: int = 1) -> Column:
    text = F.regexp_extract(symbol, pattern, group)
    return F.when(text != "", text)


def with_expiry(listing: DataFrame) -> DataFrame:
    """Add ``symbol_expiry``, the date written in a futures or options symbol.

    Read are day-month-year (``7NOV25``, ``29MAR24``), six digits (``240329``)
    and a futures month code (``M25``, the last day of that month).
    """
    exchange, symbol, kind = F.col("exchange"), F.col("symbol_id"), F.col("symbol_type")
    day_month = F.coalesce(
        _found(symbol, r"-(\d{1,2}[A-Z]{3}\d{2})-"), _found(symbol, r"-(\d{2}[A-Z]{3}\d{2})$"))
    dashed = F.coalesce(_found(symbol, r"-(\d{6})$"), _found(symbol, r"-(\d{6})-"))
    named = exchange.isin("deribit", "bybit")
    found = staged(listing, {
        "_day_month": F.when(named, F.initcap(F.lpad(day_month, 7, "0"))),
        "_digits": F.when(exchange == "binance-futures", _found(symbol, r"_(\d{6})$"))
        .when(exchange.isin("deribit", "okex-futures", "okex"), dashed),
        "_code": F.when(named, F.instr(F.lit(MONTH_CODES), _found(symbol, r"([A-Z])\d{2}$"))),
        "_year": F.lit(2000) + _found(symbol, r"[A-Z](\d{2})$").cast("int"),
    })
    dated = staged(found, {
        "symbol_expiry": F.when(kind.isin("future", "option"), F.coalesce(
            F.to_date(F.try_to_timestamp("_day_month", F.lit("ddMMMyy"))),
            F.to_date(F.try_to_timestamp("_digits", F.lit("yyMMdd"))),
            F.when(F.col("_code") > 0, F.last_day(F.make_date("_year", "_code", F.lit(1)))),
        )),
    })
    return dated.drop("_day_month", "_digits", "_code", "_year")


def strike(exchange: Column, symbol: Column, symbol_type: Column) -> Column:
    """Option strike as text; ``1d14`` means ``1.14``."""
    raw = _found(symbol, r"-(\d+d?\d*)-")
    return F.when((exchange == "deribit") & (symbol_type == "option"), F.replace(raw, F.lit("d"), F.lit(".")))


def option_type(exchange: Column, symbol: Column, symbol_type: Column) -> Column:
    side = _found(symbol, r"-(C|P)$")
    return F.when((exchange == "deribit") & (symbol_type == "option"), F.when(side == "C", "CALL").when(side == "P", "PUT"))
