"""Market tables derived from the test tables.

Each adapter is a projection (at most one lookup join), so filters and column
pruning reach the Parquet scan below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import BOOK_LEVELS

KEY = "instrument_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(props: Column) -> Column:
    return F.regexp_extract(props, r"(\d+)", 1).cast("long")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table(spark, sf_dir, "events"))


def event_columns(events: DataFrame) -> DataFrame:
    """Columns common to all tick tables taken from ``events``; also valid on a stream."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("BINANCE:SPOT_PAIR:U"), F.pmod("user_id", F.lit(8)), F.lit("-USDT")).alias(KEY),
        ts.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + _k(F.col("props")) * 1000).alias("local_timestamp"),
        F.to_date(ts).alias("day"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type"),
        F.col("value"),
        _k(F.col("props")).alias("k"),
    )


def _side() -> Column:
    return F.when(F.col("event_type").isin("purchase", "signup", "view"), "buy").otherwise("sell")


def trade_columns(events: DataFrame) -> DataFrame:
    return events.select(
        KEY, "timestamp", "local_timestamp", "day", "id", _side().alias("side"),
        F.col("value").alias("price"), ((F.col("k") + 1) / 10.0).alias("amount"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_columns(_events(spark, sf_dir))


def liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors as forced trades; an even ``k`` is a forced buy."""
    return (
        _events(spark, sf_dir)
        .where(F.col("event_type") == "error")
        .select(
            KEY, "timestamp", "local_timestamp", "day", "id",
            F.when(F.col("k") % 2 == 0, "buy").otherwise("sell").alias("side"),
            F.col("value").alias("price"), ((F.col("k") + 1) / 10.0).alias("amount"),
        )
    )


def derivative_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .where(F.col("event_type") == "view")
        .select(
            KEY, "timestamp", "local_timestamp", "day", "id",
            ((F.col("k") - 50) / 1e6).alias("funding_rate"),
            F.when(F.col("k") % 10 != 0, (F.col("k") - 40) / 1e6).alias("predicted_funding_rate"),
            (F.col("value") * 10 + F.col("k")).alias("open_interest"),
            F.col("value").alias("last_price"),
            (F.col("value") * 1.001).alias("index_price"),
            F.col("value").alias("mark_price"),
        )
    )


def book_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as five-level books; every tenth ``k`` misses its fifth bid."""
    levels = []
    for i in range(1, BOOK_LEVELS + 1):
        bid_there = F.lit(True) if i < BOOK_LEVELS else F.col("k") % 10 != 0
        levels += [
            (F.col("value") * (1 + 0.0005 * i)).alias(f"ask_price_{i}"),
            ((F.col("k") + i) / 10.0).alias(f"ask_volume_{i}"),
            F.when(bid_there, F.col("value") * (1 - 0.0005 * i)).alias(f"bid_price_{i}"),
            F.when(bid_there, (F.col("k") + 2 * i) / 10.0).alias(f"bid_volume_{i}"),
        ]
    return (
        _events(spark, sf_dir)
        .where(F.col("event_type") == "click")
        .select(KEY, "timestamp", "local_timestamp", "day", "id", *levels)
    )


def options_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as option quotes on four underlyings."""
    ts = F.col("l_shipdate").cast("timestamp")
    put = F.col("l_linenumber") % 2 == 0
    size = F.col("l_quantity").cast("int")
    expiry_days = (1 + F.pmod("l_partkey", F.lit(3))) * 30
    underlying = F.concat(F.lit("A"), F.pmod("l_suppkey", F.lit(4)), F.lit("-USD"))
    expiration = F.date_add(F.last_day(F.to_date(ts)), expiry_days.cast("int")).cast("timestamp")
    return table(spark, sf_dir, "lineitem").select(
        underlying.alias("underlying_index"),
        F.concat_ws("-", underlying, F.date_format(expiration, "yyMMdd"), size * 10,
                    F.when(put, "PUT").otherwise("CALL")).alias(KEY),
        ts.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + F.col("l_orderkey") % 1000 * 1000).alias("local_timestamp"),
        F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), "l_linenumber", "l_partkey").alias("id"),
        F.when(put, "put").otherwise("call").alias("type"),
        (size * 10).cast("double").alias("strike_price"),
        expiration.alias("expiration"),
        (F.when(put, -1.0).otherwise(1.0) * F.pmod(F.col("l_orderkey"), F.lit(100)) / 100.0).alias("delta"),
        (F.col("l_extendedprice") / 100000.0 + F.col("l_tax")).alias("mark_iv"),
    )


def dense_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades: many trades at the same instant."""
    ts = F.col("l_shipdate").cast("timestamp")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("BINANCE:PERPETUAL:P"), F.pmod("l_partkey", F.lit(16)), F.lit("-USDT")).alias(KEY),
        ts.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + F.col("l_linenumber") * 1000).alias("local_timestamp"),
        F.to_date(ts).alias("day"),
        F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), "l_linenumber", "l_partkey").alias("id"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("amount"),
    )


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as instrument definitions on four venues and four types."""
    kind = F.pmod("p_size", F.lit(4))
    venue = _pick(F.pmod("p_partkey", F.lit(4)), ["BINANCE", "BYBIT", "OKX", "DERIBIT"])
    instrument_type = _pick(kind, ["SPOT_PAIR", "PERPETUAL", "FUTURE", "OPTION"])
    base = F.concat(F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))), F.pmod("p_partkey", F.lit(50)))
    quote = F.when(F.col("p_partkey") % 5 == 0, "USD").otherwise("USDT")
    start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 200).cast("int"))
    end = F.date_add(start, (F.col("p_size") * 2 + 10).cast("int"))
    expiry = F.date_format(end, "yyMMdd")
    strike = (F.col("p_size") * 10).cast("string")
    side = F.when(F.col("p_partkey") % 2 == 0, "CALL").otherwise("PUT")
    symbol = (
        F.when(kind == 3, F.concat_ws("-", base, quote, expiry, strike, side))
        .when(kind == 2, F.concat_ws("-", base, quote, expiry))
        .otherwise(F.concat_ws("-", base, quote))
    )
    types = (
        F.when(kind == 0, "trades,book_snapshot_5")
        .when(kind == 3, "trades,book_snapshot_5,options_chain")
        .otherwise("trades,book_snapshot_5,derivative_ticker,liquidations")
    )
    return (
        table(spark, sf_dir, "part")
        .select(
            "p_partkey",
            F.concat_ws(":", venue, instrument_type, symbol).alias(KEY),
            venue.alias("venue"), instrument_type.alias("instrument_type"),
            F.date_format(start, "yyyy-MM-dd'T'00:00:00'Z'").alias("available_from_datetime"),
            F.date_format(end, "yyyy-MM-dd'T'08:00:00'Z'").alias("available_to_datetime"),
            types.alias("data_types"),
            base.alias("base_asset"), quote.alias("quote_asset"),
            F.when((kind == 1) & (F.col("p_partkey") % 3 == 0), base).otherwise(quote).alias("settle_asset"),
            F.concat(base, quote).alias("exchange_raw_symbol"),
            F.lower(F.concat(base, quote)).alias("tardis_symbol"),
            F.lower(venue).alias("tardis_exchange"),
            F.lit("tardis").alias("data_provider"), F.lit("exchange").alias("venue_type"),
            F.lit("crypto").alias("asset_class"),
            F.when(kind == 3, strike).otherwise("").alias("strike"),
            F.when(kind == 3, side).otherwise("").alias("option_type"),
            F.when(kind >= 2, F.date_format(end, "yyyy-MM-dd'T'08:00:00'Z'")).alias("expiry"),
            F.when(kind >= 2, F.concat_ws("-", base, quote)).otherwise("").alias("underlying"),
            ((kind == 1) & (F.col("p_partkey") % 3 == 0)).alias("inverse"),
        )
    )


def available_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which (day, instrument, data type) files exist: one per shipped part and day.

    Orders of status ``F`` delivered trades only.
    """
    listing = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("day"),
        F.when(F.col("l_linestatus") == "F", F.array(F.lit("trades")))
        .otherwise(F.array(F.lit("trades"), F.lit("book_snapshot_5"))).alias("types"),
    )
    keys = instruments(spark, sf_dir).select("p_partkey", KEY)
    return (
        listing.withColumn("data_type", F.explode("types"))
        .join(keys, "p_partkey")
        .select("day", KEY, "data_type")
        .distinct()
    )


def vendor_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an exchange listing with raw vendor symbols of every known form."""
    key, size = F.col("p_partkey"), F.col("p_size")
    exchange = _pick(F.pmod(key, F.lit(9)), [
        "binance", "binance-futures", "deribit", "bybit", "bybit-spot", "okex", "okex-futures", "okex-swap", "upbit"])
    base = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    odd = size % 2 == 1
    expiry = F.date_add(F.lit("2024-01-03").cast("date"), (size * 7).cast("int"))
    ymd = F.date_format(expiry, "yyMMdd")
    day_month = F.concat(F.dayofmonth(expiry).cast("string"), F.upper(F.date_format(expiry, "MMMyy")))
    day2_month = F.upper(F.date_format(expiry, "ddMMMyy"))
    month_code = F.substring(F.lit("FGHJKMNQUVXZ"), F.month(expiry), F.lit(1))
    symbol = (
        F.when(exchange.isin("binance", "bybit-spot"),
               F.when(size % 13 == 0, F.concat(F.lit("BTCUP"), F.lit("USDT")))
               .when(size % 5 == 0, F.concat(F.lower(base), F.lit("eur"))).otherwise(F.concat(F.lower(base), F.lit("usdt"))))
        .when(exchange == "binance-futures",
              F.when(odd, F.concat(base, F.lit("USDT_"), ymd)).otherwise(F.concat(F.lit("1000"), base, F.lit("USDT"))))
        .when(exchange == "deribit",
              F.when(size % 4 == 0, F.concat_ws("-", base, day_month, size * 100, F.lit("C")))
              .when(size % 4 == 1, F.concat_ws("-", F.concat(base, F.lit("_USDC")), day_month,
                                               F.concat(size.cast("string"), F.lit("d5")), F.lit("P")))
              .when(size % 4 == 2, F.concat_ws("-", base, day2_month))
              .otherwise(F.concat_ws("-", base, ymd)))
        .when(exchange == "bybit",
              F.when(odd, F.concat(base, F.lit("USDT"), month_code, F.date_format(expiry, "yy")))
              .otherwise(F.concat_ws("-", F.concat(base, F.lit("USDT")), day2_month)))
        .when(exchange == "okex", F.when(size % 13 == 0, "SPOT").otherwise(F.concat_ws("-", base, F.lit("USDT"))))
        .when(exchange == "okex-futures", F.concat_ws("-", base, F.lit("USDT"), ymd))
        .when(exchange == "okex-swap", F.concat_ws("-", base, F.lit("USDT"), F.lit("SWAP")))
        .otherwise(F.when(odd, F.concat_ws("-", base, F.lit("KRW"))).otherwise(F.concat_ws("-", F.lit("BTC"), base)))
    )
    kind = (
        F.when(exchange.isin("binance", "bybit-spot", "okex", "upbit"), "spot")
        .when(exchange == "okex-swap", "perpetual")
        .when(exchange == "binance-futures", F.when(odd, "future").otherwise("perpetual"))
        .when(exchange == "deribit",
              F.when(size % 16 == 0, "combo").when(size % 4 < 2, "option").otherwise("future"))
        .otherwise("future")
    )
    start = F.date_add(F.lit("2023-06-01").cast("date"), (key % 300).cast("int"))
    open_ended = kind.isin("spot", "perpetual") | (size % 3 == 0)
    return table(spark, sf_dir, "part").select(
        "p_partkey", exchange.alias("exchange"), symbol.alias("symbol_id"), kind.alias("symbol_type"),
        F.date_format(start, "yyyy-MM-dd'T'00:00:00'Z'").alias("available_since"),
        F.when(~open_ended, F.date_format(F.date_add(expiry, 1), "yyyy-MM-dd'T'00:00:00'Z'")).alias("available_to"),
    )
