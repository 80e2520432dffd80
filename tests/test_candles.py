"""Hand-made ticks and candles with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg
from tickloom.operators import book, candles, coverage, features, indicators, reconcile, selection
from tickloom.operators.series import numbered, time_blocks, unplaced, with_previous

START = dt.datetime(2024, 1, 15, 12, 0)
TICK = "instrument_key string, timestamp timestamp, local_timestamp timestamp, id string, side string, price double, amount double"


def ticks(spark, rows, key="X:SPOT_PAIR:A-B"):
    """``rows`` are (seconds, price, amount[, side])."""
    out = []
    for i, (s, price, amount, *side) in enumerate(rows):
        at = START + dt.timedelta(seconds=s)
        out.append((key, at, at + dt.timedelta(milliseconds=5 * (i + 1)), f"{i:04d}", side[0] if side else "buy", price, amount))
    return spark.createDataFrame(out, TICK)


def minute_candles(spark, values, step=60, key="X:SPOT_PAIR:A-B"):
    rows = [(key, "1m", START + dt.timedelta(seconds=step * i), *v) for i, v in enumerate(values)]
    schema = "instrument_key string, timeframe string, timestamp timestamp, open double, high double, low double, close double, volume double"
    return spark.createDataFrame(rows, schema)


FIVE = [(100.0, 105.0, 95.0, 100.0, 1000.0), (100.0, 106.0, 96.0, 101.0, 1100.0), (101.0, 107.0, 97.0, 102.0, 1200.0),
        (102.0, 108.0, 98.0, 103.0, 1300.0), (103.0, 109.0, 99.0, 104.0, 1400.0)]


def test_candle_fields(spark):
    t = ticks(spark, [(1, 10.0, 1.0), (2, 12.0, 3.0, "sell"), (59, 11.0, 1.0), (60, 20.0, 2.0)])
    first, second = candles.ohlcv(t, "1m").orderBy("timestamp").collect()
    assert (first.open, first.high, first.low, first.close, first.volume, first.trade_count) == (10, 12, 10, 11, 5, 3)
    assert first.vwap == pytest.approx((10 + 36 + 11) / 5)
    assert first.timestamp_out == START + dt.timedelta(seconds=59, milliseconds=15 + 200)
    assert second.timestamp == START + dt.timedelta(minutes=1)


def test_ties_at_one_instant_follow_arrival(spark):
    t = ticks(spark, [(5, 1.0, 1.0), (5, 2.0, 1.0), (5, 3.0, 1.0)])
    plain = candles.ohlcv(t, "1m").first()
    numbered_ticks = candles.ohlcv(candles.with_sequence(t), "1m").first()
    assert (plain.open, plain.close) == (1.0, 3.0) == (numbered_ticks.open, numbered_ticks.close)


def test_zero_volume_has_no_vwap(spark):
    assert candles.ohlcv(ticks(spark, [(1, 10.0, 0.0)]), "1m").first().vwap is None


def test_grid_keeps_empty_intervals(spark):
    full = candles.fill_grid(candles.ohlcv(ticks(spark, [(1, 10.0, 1.0)]), "1h"), "1h")
    rows = {r.timestamp.hour: r for r in full.collect()}
    assert len(rows) == 24 and rows[12].close == 10.0
    assert rows[3].close is None and rows[3].volume == 0.0 and rows[3].trade_count == 0 and rows[3].timeframe == "1h"
    assert rows[3].timestamp_out == rows[3].timestamp + dt.timedelta(milliseconds=200)


def test_five_minutes_from_one(spark):
    row = reconcile.aggregate(minute_candles(spark, FIVE), "5m").first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (100.0, 109.0, 95.0, 104.0, 6000.0)


def test_rollup_first_child_empty(spark):
    base = candles.fill_grid(candles.ohlcv(ticks(spark, [(61, 10.0, 1.0)]), "1m"), "1m")
    hour = F.col("timestamp") == F.lit(START)
    assert candles.rollup(base, "1h").where(hour).first().open is None
    assert candles.rollup(base, "1h", skip_empty=True).where(hour).first().open == 10.0


def test_rolling_up_in_steps_is_the_same(spark):
    t = ticks(spark, [(s * 37, 100.0 + (s * 7) % 13, 1.0 + s % 3) for s in range(400)])
    base = candles.ohlcv(t, "1m")
    direct, stepped = candles.rollup(base, "1h"), candles.rollup(candles.rollup(base, "15m"), "1h")
    keep = ["timestamp", "open", "high", "low", "close", "trade_count"]
    assert direct.select(keep).exceptAll(stepped.select(keep)).count() == 0
    assert candles.rollup_all(base, ["1h"]).select(keep).exceptAll(direct.select(keep)).count() == 0


def test_unknown_timeframe_raises():
    with pytest.raises(ValueError, match="7m"):
        tg.seconds("7m")


def test_trade_features(spark):
    row = features.trade_features(ticks(spark, [(1, 10.0, 1.0), (2, 20.0, 3.0, "sell")]), "1m").first()
    assert (row.buy_volume_sum, row.sell_volume_sum, row.size_avg) == (1.0, 3.0, 2.0)
    assert (row.delay_min, row.delay_max, row.delay_median) == (5.0, 10.0, 7.5)


def test_book_features(spark):
    row = {f"{s}_{w}_{i}": (100.0 + (-i if s == "bid" else i)) if w == "price" else float(i)
           for i in range(1, 6) for s in ("bid", "ask") for w in ("price", "volume")}
    frame = spark.createDataFrame([row])
    d = book.derived(frame).first()
    assert (d.mid_price, d.spread_abs, d.total_bid_volume, d.volume_imbalance, d.book_imbalance) == (100.0, 2.0, 15.0, 0.0, 0.0)
    assert d.spread_bps == pytest.approx(200.0) and d.bid_volume_ratio_5 == pytest.approx(5 / 15)
    gone = book.derived(frame.withColumn("bid_volume_3", F.lit(None).cast("double"))).first()
    assert gone.total_bid_volume is None and gone.bid_vwap is None


def test_options_features(spark):
    at, near, far = START, START + dt.timedelta(days=5), START + dt.timedelta(days=40)
    rows = [("U", at, at, "1", "put", 90.0, near, -0.24, 0.6), ("U", at, at, "2", "put", 80.0, near, -0.10, 0.9),
            ("U", at, at, "3", "call", 110.0, near, 0.26, 0.5), ("U", at, at, "4", "call", 100.0, near, 0.51, 0.4),
            ("U", at, at, "5", "put", 90.0, far, -0.25, 9.0), ("U", at, at, "0", "put", 90.0, near, -0.50, 7.0)]
    chain = spark.createDataFrame(rows, "underlying_index string, timestamp timestamp, local_timestamp timestamp, id string, type string, "
                                        "strike_price double, expiration timestamp, delta double, mark_iv double")
    row = features.options_features(chain, "1m").first()
    assert row.expiration == near and row.skew_25d_put_call_ratio == pytest.approx(0.6 / 0.5) and row.atm_mark_iv == 0.4


# -- series ----------------------------------------------------------------------------

def _series(spark, n):
    closes = [100.0 + ((i * 7919) % 101) / 7.0 for i in range(n)]
    rows = [(c, c + 1, c - 1, c, 10.0 + (i * 31) % 17) for i, c in enumerate(closes)]
    frame = minute_candles(spark, rows).withColumns({"vwap": F.col("close"), "trade_count": F.lit(3).cast("long")})
    return closes, frame


def _ema(values, k):
    out, current = [], None
    for i, v in enumerate(values):
        if i + 1 >= k:
            current = v if current is None else 2 / (k + 1) * v + (1 - 2 / (k + 1)) * current
        out.append(current)
    return out


@pytest.mark.parametrize("chunk", [64, 1024])
def test_indicators_do_not_depend_on_chunks(spark, chunk):
    """Chunk edges fall inside the series; values equal the plain recurrences."""
    closes, frame = _series(spark, 2500)
    rows = indicators.indicators(frame, "1m", chunk=chunk).orderBy("timestamp").collect()
    assert len(rows) == 2500
    for k in (5, 10, 20):
        expected = _ema(closes, k)
        for row, e in zip(rows, expected):
            got = row[f"ema_{k}"]
            assert (got is None) == (e is None) and (e is None or got == pytest.approx(e, rel=1e-12))
    for i in (4, 19, 63, 64, 1023, 1024, 2499):
        assert rows[i].sma_5 == pytest.approx(sum(closes[i - 4:i + 1]) / 5)
        assert (rows[i].sma_20 is not None) == (i >= 19)
    assert rows[3].sma_5 is None and rows[1].price_velocity is None and rows[2].price_velocity is not None


def test_rsi_without_losses(spark):
    frame = minute_candles(spark, [(c, c, c, c, 1.0) for c in map(float, range(1, 9))]).withColumns(
        {"vwap": F.col("close"), "trade_count": F.lit(1).cast("long")})
    assert [r.rsi_5 for r in indicators.indicators(frame, "1m").orderBy("timestamp").collect()] == [None] * 5 + [100.0] * 3


def test_volumes_equal_but_for_rounding_have_no_impact(spark):
    frame = minute_candles(spark, [(c, c, c, c, v) for c, v in ((1.0, 0.1 + 0.2 + 0.3), (2.0, 0.3 + 0.2 + 0.1), (3.0, 0.1 + 0.2 + 0.3), (4.0, 1.0))]).withColumns(
        {"vwap": F.col("close"), "trade_count": F.lit(1).cast("long")})
    found = [r.price_impact for r in indicators.indicators(frame, "1m").orderBy("timestamp").collect()]
    assert found[:3] == [None] * 3 and found[3] == pytest.approx(2.5)


@pytest.mark.parametrize("split", [None, 3])
def test_previous_row_over_blocks(spark, split):
    t = ticks(spark, [(s, float(i), 1.0) for i, s in enumerate([0, 1, 1, 2, 30, 31, 400, 4000, 4001, 4002])])
    got = with_previous(t, ["instrument_key"], "timestamp", ["price"], ["id"], 60, split).orderBy("id").collect()
    assert [r.prev_price for r in got] == [None] + [float(i) for i in range(9)]
    numbers = numbered(t, ["instrument_key"], block_seconds=60, split_rows=split, ties=["id"]).orderBy("id").collect()
    assert [r._rn for r in numbers] == list(range(1, 11))


@pytest.mark.parametrize("split", [1000, 9999, 30_000])
def test_bursts_are_cut_by_rank(spark, split):
    """20,000 ticks in one millisecond, half of them in one instant, between calm ones: no piece is above the bound."""
    rows = [(0, 0.0, 1.0)] + [(60.0 + (i // 2 * 2 % 1000 if i % 2 else 500) / 1e6, float(i + 1), 1.0) for i in range(20_000)] + [(3600, -1.0, 1.0)]
    t = ticks(spark, rows).withColumn("n", F.col("id").cast("int")).repartition(7)
    marked = time_blocks(t, ["instrument_key"], "timestamp", 60, split, ["n"])
    sizes = [r["count"] for r in marked.groupBy("instrument_key", "_block", "_piece").count().collect()]
    assert sum(sizes) == 20_002 and max(sizes) <= split
    order = [r.n for r in t.orderBy("timestamp", "n").collect()]
    got = {r.n: r.prev_n for r in with_previous(t, ["instrument_key"], "timestamp", ["n"], ["n"], 60, split).collect()}
    assert got == dict(zip(order, [None, *order[:-1]]))
    numbers = numbered(t, ["instrument_key"], block_seconds=60, split_rows=split, ties=["n"]).collect()
    assert [r.n for r in sorted(numbers, key=lambda r: r._rn)] == order and sorted(r._rn for r in numbers) == list(range(1, 20_003))


def test_small_pieces_take_no_task_each(spark):
    """2,000 ticks of one instant in pieces of 10: their ranges follow the session's tasks, not the pieces."""
    t = ticks(spark, [(60, float(i), 1.0) for i in range(2000)]).withColumn("n", F.col("id").cast("int"))
    marked = time_blocks(t, ["instrument_key"], "timestamp", 60, 10, ["n"])
    pieces = {r["_piece"]: r["count"] for r in marked.groupBy("_piece").count().collect()}
    assert len(pieces) >= 200 and max(pieces.values()) <= 10
    # A range numbers its rows from 2**33 times its own number.
    assert len({(piece - 1) * 10 >> 33 for piece in pieces}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_without_time_are_counted(spark):
    t = ticks(spark, [(1, 1.0, 1.0), (2, 1.0, 1.0)])
    none = t.withColumn("timestamp", F.lit(None).cast("timestamp")).unionByName(t.withColumn("instrument_key", F.lit(None).cast("string")))
    found = {r.instrument_key: (r.without_time, r.without_key) for r in unplaced(t.unionByName(none), ["instrument_key"]).collect()}
    assert found == {"X:SPOT_PAIR:A-B": (2, 0), None: (0, 2)} and unplaced(t, ["instrument_key"]).count() == 0


def test_stored_ticks_get_their_order(spark, tmp_path):
    from tickloom.sinks import tables
    from tickloom.sources import readers

    t = ticks(spark, [(1, 10.0, 1.0), (1, 12.0, 1.0), (30, 11.0, 1.0), (30, 13.0, 1.0)])
    tables.write_ticks(t, str(tmp_path / "t"), "trades")
    stored = readers.read_ticks(spark, str(tmp_path / "t"), "2024-01-15", "2024-01-16")
    row = candles.ohlcv(stored, "1m").first()
    assert (row.open, row.close) == (10.0, 13.0)
    unranked = candles.ohlcv(stored.withColumn("seq", F.lit(None).cast("long")), "1m").first()
    assert unranked.open in (10.0, 12.0) and unranked.close in (11.0, 13.0)
    with pytest.raises(Exception, match="too many ticks"):
        candles.ohlcv(stored.withColumn("seq", F.lit(1 << 26)), "1m").collect()


def test_intervals_without_a_trade_keep_their_liquidations(spark):
    trades = ticks(spark, [(1, 10.0, 1.0)])
    liquidations = ticks(spark, [(61, 9.0, 2.0, "sell"), (62, 9.0, 3.0)])
    first, second = features.candles_with_features(trades, "1m", liquidations).orderBy("timestamp").collect()
    assert (first.trade_count, first.liquidation_count) == (1, 0)
    assert (second.trade_count, second.volume, second.open, second.liquidation_count) == (0, 0.0, None, 2)
    assert (second.liquidation_buy_volume, second.liquidation_sell_volume) == (3.0, 2.0)


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_quantiles_by_selection(spark, bits):
    """Against Spark's own exact percentile: many equal values, wide gaps, negative ones, a NULL key, single values."""
    rows = [("a", i % 7) for i in range(500)] + [("a", 10**9)] + [("b", -(i * i)) for i in range(100)] + [("c", 5), ("d", None), (None, 3), (None, 4)]
    df = spark.createDataFrame(rows, "k string, v long")
    wanted = {"low": 0.0, "median": 0.5, "p95": 0.95, "odd": 1 / 3, "high": 1.0}
    got = {r.k: tuple(r)[1:] for r in selection.quantiles(df, ["k"], F.col("v"), wanted, bits, 2.0).collect()}
    want = {r.k: tuple(r)[1:] for r in df.groupBy("k").agg(*[(F.percentile("v", q) / 2.0).alias(n) for n, q in wanted.items()]).collect()}
    assert {k: v for k, v in want.items() if v[0] is not None}.keys() == got.keys() == {"a", "b", "c", None}
    for k, values in got.items():
        assert values == pytest.approx(want[k])
    total = selection.quantiles(df, [], F.col("v"), {"median": 0.5}, bits).first()
    assert total.median == df.agg(F.median("v")).first()[0]
    assert selection.quantiles(df.limit(0), ["k"], F.col("v"), wanted).count() == 0


def test_latency_stats_hold_no_list_of_delays(spark):
    t = ticks(spark, [(i, 1.0, 1.0) for i in range(101)])
    frame = coverage.latency_stats(t.unionByName(t.limit(3).withColumn("local_timestamp", F.lit(None).cast("timestamp")).withColumn(
        "instrument_key", F.lit("X:SPOT_PAIR:NO-DELAY"))), ["instrument_key"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = {r.instrument_key: r for r in frame.collect()}
    assert (rows["X:SPOT_PAIR:A-B"].median_ms, rows["X:SPOT_PAIR:A-B"].p95_ms, rows["X:SPOT_PAIR:A-B"].ticks) == (255.0, 480.0, 101)
    assert rows["X:SPOT_PAIR:NO-DELAY"].ticks == 3 and rows["X:SPOT_PAIR:NO-DELAY"].median_ms is None
    assert coverage.latency_stats(t).first().median_ms == 255.0
