"""Plans that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.operators import candles, coverage, features, indicators, quality, reconcile
from tickloom.sources import adapters as ad
from tickloom.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def build(spark, sf):
    trades = ad.trades(spark, sf)
    base = candles.ohlcv(trades, "1h")
    i = ad.instruments(spark, sf)
    expected = coverage.expected_types(i, "1995-01-01", "1995-12-31")
    return {
        "candles": base,
        "features": features.candles_with_features(trades, "1h", ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf)),
        "rollups": features.rollup_features(features.candles_with_features(
            trades, "15m", ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf))),
        "grid": candles.fill_grid(base, "1h"),
        "indicators": indicators.indicators(base, "1h"),
        "sparse": readers.around(trades, base.select("instrument_key", F.col("timestamp").alias("requested_at"))),
        "missing": coverage.missing_types(expected, ad.available_ticks(spark, sf)),
        "groups": coverage.underlying_groups(i, ad.available_ticks(spark, sf), ["trades"]),
        "overlap": reconcile.timestamp_overlap(base, base),
        "rules": reconcile.three_rules(base, base),
        "integrity": quality.integrity(trades, "trades", ["price", "amount"]),
        "stability": quality.stability(trades, 900),
    }


@pytest.mark.parametrize("name", ["candles", "features", "rollups", "grid", "indicators", "sparse", "missing", "groups", "overlap", "rules", "integrity", "stability"])
def test_no_nested_loops_and_no_python(spark, sf, name):
    text = plan(build(spark, sf)[name])
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert word not in text


def test_one_shuffle_per_candle_aggregation(spark, sf):
    assert plan(candles.ohlcv(ad.trades(spark, sf), "1h")).count("Exchange hashpartitioning") == 1


def test_numbered_ticks_use_hash_aggregation(spark, sf):
    ticks = ad.trades(spark, sf).withColumn("seq", F.lit(1).cast("long"))
    text = plan(candles.ohlcv(ticks, "1h"))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_scan_reads_only_what_candles_need(spark, sf):
    text = candles.ohlcv(ad.dense_trades(spark, sf), "24h")._jdf.queryExecution().toString()
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "l_tax" not in schema and "l_extendedprice" in schema


def test_series_joins_read_their_input_once(spark, sf):
    trades = ad.trades(spark, sf)
    frames = {
        1: indicators.indicators(candles.ohlcv(trades, "1m"), "1m"),
        3: features.candles_with_features(trades, ("15s", "1m"), ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf)),
    }
    for scans, df in frames.items():
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan") == scans and "ReusedExchange" in final


def test_no_fixed_inputs():
    """Each query takes the folder it reads."""
    assert len(entry.queries()) > 150
