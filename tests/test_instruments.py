"""Keys, symbols, definitions and coverage on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import keys as k
from tickloom.functions import symbols as sy
from tickloom.operators import coverage, instruments as ins


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text,expected", [("C", "CALL"), ("p", "PUT"), ("call", "CALL"), ("PUT", "PUT"), ("x", "X"), (None, "")])
def test_option_side(spark, text, expected):
    assert value(spark, k.option_side(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("kind,n", [("SPOT_PAIR", 2), ("PERPETUAL", 4), ("FUTURE", 4), ("OPTION", 3), ("INDEX", 2)])
def test_data_types(spark, kind, n):
    assert len(value(spark, k.data_types(F.lit(f"DERIBIT:{kind}:BTC-USD")))) == n


def test_canonical_keys(spark):
    def key(*parts):
        *text, expiry, strike, side = parts
        return value(spark, k.canonical_key(
            *[F.lit(t) for t in text], F.lit(expiry).cast("date"), F.lit(strike).cast("string"), F.lit(side).cast("string")))

    assert key("binance", "spot", "btc", "usdt", None, None, None) == "BINANCE:SPOT_PAIR:BTC-USDT"
    assert key("deribit", "option", "BTC", "USD", "2024-03-29", "50000", "C") == "DERIBIT:OPTION:BTC-USD-240329-50000-CALL"
    assert key("okex-futures", "future", "BTC", "USDT", "2024-03-29", None, None) == "OKX-FUTURES:FUTURE:BTC-USDT-240329"
    assert key("nowhere", "spot", "BTC", "USDT", None, None, None) is None
    assert key("binance", "swap", "BTC", "USDT", None, None, None) is None
    assert key("binance", "spot", "", "USDT", None, None, None) is None


# The month code stays on the base, as users of these keys know it.
SYMBOLS = [
    ("deribit", "option", "BTC-29MAR24-50000-C", "BTC", "USD", "BTC", "2024-03-29", "50000", "CALL"),
    ("deribit", "option", "XRP_USDC-7NOV25-1d14-P", "XRP", "USDC", "USDC", "2025-11-07", "1.14", "PUT"),
    ("deribit", "future", "ETH-26DEC25", "ETH", "USD", "ETH", "2025-12-26", None, None),
    ("binance-futures", "future", "BTCUSDT_240329", "BTC", "USDT", "USDT", "2024-03-29", None, None),
    ("binance-futures", "perpetual", "1000SHIBUSDT", "SHIB", "USDT", "USDT", None, None, None),
    ("bybit", "future", "BTCUSDM25", "BTC", "USD", "BTC", "2025-06-30", None, None),
    ("bybit", "future", "BTCUSDZ25", "BTC", "USD", "BTC", "2025-12-31", None, None),
    ("bybit", "future", "BTC-29DEC23", "BTC", "USD", "BTC", "2023-12-29", None, None),
    ("okex-futures", "future", "BTC-USDT-240329", "BTC", "USDT", "USDT", "2024-03-29", None, None),
    ("okex-swap", "perpetual", "BTC-USDT-SWAP", "BTC", "USDT", "USDT", None, None, None),
    ("binance", "spot", "btcusdt", "btc", "USDT", "USDT", None, None, None),
    ("binance", "spot", "USDTBRL", "USDT", "BRL", "BRL", None, None, None),
    ("binance", "spot", "1inchusdt", "1inch", "USDT", "USDT", None, None, None),
    ("binance", "spot", "C98USDT", "C98", "USDT", "USDT", None, None, None),
    ("binance", "spot", "BTCTUSD", "BTC", "TUSD", "TUSD", None, None, None),
    ("okex", "spot", "USDT-TRY", "USDT", "TRY", "TRY", None, None, None),
    ("upbit", "spot", "BTC-ETH", "BTC", "ETH", "ETH", None, None, None),
    ("upbit", "spot", "BTCETH", "", "", "", None, None, None),
    ("deribit", "option", "OPTIONS", "BTC", "USD", "BTC", None, None, None),
]


def test_symbols(spark):
    rows = [(e, t, s) for e, t, s, *_ in SYMBOLS]
    listing = spark.createDataFrame(rows, "exchange string, symbol_type string, symbol_id string")
    e, s, t = F.col("exchange"), F.col("symbol_id"), F.col("symbol_type")
    parsed = sy.with_expiry(sy.with_assets(listing)).select(
        "exchange", "symbol_type", "symbol_id", "base_asset", "quote_asset", "settle_asset", F.col("symbol_expiry").cast("string"),
        sy.strike(e, s, t).alias("strike"), sy.option_type(e, s, t).alias("side"))
    assert sorted(map(str, map(tuple, parsed.collect()))) == sorted(map(str, SYMBOLS))


def test_shards_are_disjoint_and_complete(spark):
    frame = spark.range(500).select(F.concat(F.lit("K"), "id").alias("instrument_key"))
    parts = [{r.instrument_key for r in k.in_shard(frame, i, 4).collect()} for i in range(4)]
    assert sum(map(len, parts)) == 500 == len(set().union(*parts)) and all(parts)
    with pytest.raises(ValueError):
        k.in_shard(frame, 4, 4)


def test_joined_symbols(spark):
    def ccxt(s, e="binance"):
        return value(spark, k.to_ccxt_symbol(F.lit(s), F.lit(e)))

    assert (ccxt("BTCUSDT"), ccxt("BTC-USDT"), ccxt("ETHBTC"), ccxt("AUSD")) == ("BTC/USDT", "BTC/USDT", "ETH/BTC", "AUSD")
    assert (ccxt("BTC/USD", "coinbase"), ccxt("BTC-PERPETUAL", "deribit"), ccxt("A-B", "kraken")) == ("BTC-USD", "BTC-PERPETUAL", "A/B")


def definitions(spark, rows):
    schema = ("instrument_key string, instrument_type string, base_asset string, underlying string, data_types string, "
              "available_from_datetime string, available_to_datetime string")
    return spark.createDataFrame(rows, schema)


def test_missing_and_available_make_expected(spark):
    i = definitions(spark, [("A", "SPOT_PAIR", "A", "", "trades, book_snapshot_5", "2024-01-01T00:00:00Z", "2024-01-03T08:00:00Z")])
    expected = coverage.expected_types(i, "2024-01-02", "2024-01-05")
    assert expected.count() == 4
    day = dt.date(2024, 1, 2)
    have = spark.createDataFrame([(day, "A", "trades")], "day date, instrument_key string, data_type string")
    missing = coverage.missing_types(expected, have)
    assert missing.count() == 3
    total = coverage.missing_report(expected, missing).where(F.col("level") == "total").first()
    assert (total.expected, total.missing, total.coverage_pct) == (4, 3, 25.0)
    assert coverage.missing_types(coverage.expected_types(i, "2030-01-01", "2030-01-02"), have).count() == 0


def test_group_needs_every_member(spark):
    rows = [(key, t, base, under, "", "", "") for key, t, base, under in (
        ("A1", "SPOT_PAIR", "A", ""), ("A2", "FUTURE", "A", ""), ("B1", "OPTION", "B", "B-USD"), ("C1", "INDEX", "C", ""))]
    have = spark.createDataFrame([("A1", "trades"), ("A2", "book"), ("B1", "trades")], "instrument_key string, data_type string")
    i = definitions(spark, rows)
    got = {r.instrument_key: r.group_valid for r in coverage.underlying_groups(i, have, ["trades"]).collect()}
    assert got == {"A1": False, "A2": False, "B1": True}
    assert not any(r.group_valid for r in coverage.underlying_groups(i, have.limit(0), ["trades"]).collect())


def test_targets(spark):
    day = dt.date(2024, 6, 1)
    keys = ["V:SPOT_PAIR:A-B", "V:OPTION:A-B-240105-1-CALL", "V:OPTION:A-B-240705-1-CALL", "V:FUTURE:A-B-240601"]
    missing = spark.createDataFrame([(day, x, "trades") for x in keys], "day date, instrument_key string, data_type string")
    known = spark.createDataFrame([(keys[0], "binance", "ab", "trades")], "instrument_key string, tardis_exchange string, tardis_symbol string, data_types string")
    got = {r.instrument_key: r.target_status for r in coverage.missing_to_targets(missing, known).collect()}
    assert [got[x] for x in keys] == ["found", "expired", "no_definition", "no_definition"]
    assert coverage.missing_to_targets(missing, known, venues=["DERIBIT"]).where(F.col("target_status") == "venue_filtered").count() == 1


def test_1000_lots_match_their_base(spark):
    markets = spark.createDataFrame([("1000SHIB/USDT", "x", "1000SHIB", "USDT", "swap", True), ("SHIB/USDT", "y", "SHIB", "USDT", "spot", True),
                                     ("SHIB/EUR", "z", "SHIB", "EUR", "spot", False)], "symbol string, id string, base string, quote string, type string, active boolean")
    assert markets.where(ins.market_matches(base="SHIB")).count() == 3
    assert markets.where(ins.market_matches(base="SHIB", product_type="perp")).count() == 1
    assert ins.active_markets(markets, bases=["SHIB"]).count() == 1


def test_days_merge_to_ranges_and_back(spark):
    days = [("A", "x", d) for d in (1, 2, 3, 5, 6, 9)] + [("A", "y", 4), ("B", None, 1), ("B", None, 1), ("B", None, 2)]
    daily = spark.createDataFrame(days, "instrument_key string, note string, d int").select(
        "instrument_key", "note", F.make_date(F.lit(2024), F.lit(1), "d").alias("day"))
    ranges = ins.merge_days(daily)
    got = {(r.instrument_key, r.note, r.first_day.day, r.last_day.day) for r in ranges.collect()}
    assert got == {("A", "x", 1, 3), ("A", "y", 4, 4), ("A", "x", 5, 6), ("A", "x", 9, 9), ("B", None, 1, 2)}
    back = ins.range_days(ranges, "2024-01-01", "2024-01-31").select(daily.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, daily.distinct().collect()))
    some = ins.definitions_by_day(daily.where("day <> '2024-01-02' AND day <> '2024-01-05'"), ranges, "2024-01-02", "2024-01-06")
    assert sorted((r.day.day, r.instrument_key, r.note or "", r.source) for r in some.collect()) == [
        (2, "A", "x", "range"), (2, "B", "", "range"), (3, "A", "x", "daily"), (4, "A", "y", "daily"), (5, "A", "x", "range"), (6, "A", "x", "daily")]
