"""Streams over files that arrive one after another."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_candles import FIVE, START, minute_candles, ticks
from tickloom.operators import candles, indicators
from tickloom.schemas import INDICATORS, LIVE_TIMEFRAMES
from tickloom.session import work_folder
from tickloom.streaming import cascade, cross, live


def drop(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    at = 1_700_000_000 + len(os.listdir(folder))  # files are taken in order of age
    os.utime(f"{folder}/{name}.txt", (at, at))


def trade(seconds, price, **more):
    at = START + dt.timedelta(seconds=seconds)
    return {"symbol": "A-B", "exchange": "binance", "type": "trade", "timestamp": at.isoformat() + "Z", "price": price, "amount": 1.0,
            "side": "buy", "id": str(seconds), **more}


def stream(spark, folder):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)


def run(df, handle, checkpoint, mode):
    live.start(df, handle, checkpoint, mode).awaitTermination()


def live_ticks(messages):
    return messages.withColumnRenamed("symbol", "instrument_key").withColumn("local_timestamp", F.col("timestamp"))


def test_bad_messages_are_dropped(spark):
    rows = ["not json", json.dumps({"exchange": "x", "timestamp": "2024-01-01"}), json.dumps({**trade(0, 1.0), "timestamp": "soon"}),
            json.dumps({**trade(0, 1.0), "timestamp": 1705320000000, "type": None}), json.dumps(trade(1, 2.0))]
    got = live.parse_messages(spark.createDataFrame([(r,) for r in rows], "value string")).orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [START, START + dt.timedelta(seconds=1)] and got[0].data_type == "trade"


def test_candles_across_batches_match_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), work_folder(spark, "t-candles")
    drop(source, "a", [trade(1, 10.0), trade(30, 12.0)])
    drop(source, "b", [trade(50, 9.0), trade(70, 11.0)])
    drop(source, "c", [trade(130, 8.0)])
    messages = live_ticks(live.parse_messages(stream(spark, source)))
    run(live.candle_stream(messages, "1m", "5 minutes"), live.keep_updates(out), str(tmp_path / "cp"), "update")
    got = live.current_candles(spark, out).orderBy("timestamp").select("open", "high", "low", "close", "trade_count").collect()
    assert [tuple(r) for r in got] == [(10.0, 12.0, 9.0, 9.0, 3), (11.0, 11.0, 11.0, 11.0, 1), (8.0, 8.0, 8.0, 8.0, 1)]


def test_late_ticks_are_dropped_in_append_mode(spark, tmp_path):
    source, out = str(tmp_path / "in"), work_folder(spark, "t-late")
    drop(source, "a", [trade(1, 10.0)])
    drop(source, "b", [trade(600, 20.0)])
    drop(source, "c", [trade(700, 25.0)])  # the watermark of one batch judges the rows of the next
    drop(source, "d", [trade(2, 99.0), trade(1200, 30.0)])
    messages = live_ticks(live.parse_messages(stream(spark, source)))
    run(live.candle_stream(messages, "1m", "1 minute"), live.keep_updates(out), str(tmp_path / "cp"), "append")
    got = spark.read.parquet(out).orderBy("timestamp").collect()
    assert [(r.close, r.trade_count) for r in got] == [(10.0, 1), (20.0, 1), (25.0, 1)]


def test_restart_continues(spark, tmp_path):
    source, out, cp = str(tmp_path / "in"), work_folder(spark, "t-restart"), str(tmp_path / "cp")
    for name, rows in (("a", [trade(1, 10.0)]), ("b", [trade(2, 15.0)])):
        drop(source, name, rows)
        messages = live_ticks(live.parse_messages(stream(spark, source)))
        run(live.candle_stream(messages, "1m"), live.keep_updates(out), cp, "update")
    row = live.current_candles(spark, out).first()
    assert (row.open, row.close, row.trade_count) == (10.0, 15.0, 2)


def test_table_sink_repeats_safely(spark):
    root = work_folder(spark, "t-sink")
    sink = live.TableSink(root)
    frame = live.route(live.parse_messages(spark.createDataFrame([(json.dumps(trade(i, 1.0)),) for i in range(3)], "value string")))["trades"]
    for batch in (0, 1, 1):
        sink(frame, batch)
    assert live.read_table(spark, root, "ticks_trades").count() == 6


def test_large_trades_count_as_liquidations(spark):
    rows = [json.dumps(trade(0, 1.0, amount=11.0)), json.dumps(trade(1, 1.0, amount=10.0))]
    got = live.route(live.parse_messages(spark.createDataFrame([(r,) for r in rows], "value string")))["liquidations"].collect()
    assert [(r.amount, r.liquidation_type) for r in got] == [(11.0, "derived_from_trade")]


def test_live_indicators_equal_batch(spark):
    """5,000 candles of two series in uneven batches, each by a new sink, one batch run twice; 20 rows are carried."""
    closes = [100.0 + (i * 37) % 23 + (i % 211) / 7 for i in range(5000)]
    one = minute_candles(spark, [(c, c + 1, c - 1, c, 5.0 + i % 7) for i, c in enumerate(closes)])
    other = minute_candles(spark, [(c, c + 2, c - 2, c, 1.0) for c in closes[:7]], key="X:SPOT_PAIR:C-D")
    frame = one.unionByName(other).withColumns({"vwap": F.col("close"), "trade_count": F.lit(2).cast("long")})
    out, at = work_folder(spark, "t-ind"), (F.unix_seconds("timestamp") - F.unix_seconds(F.lit(START).cast("timestamp"))) / 60
    steps = [(0, 3), (3, 12), (12, 12), (12, 40), (40, 2500), (2500, 4999), (4999, 5000)]
    for batch, (low, high) in enumerate(steps):
        for _ in range(2 if batch in (3, 5) else 1):
            live.IndicatorSink(f"{out}/rows", f"{out}/state", rows=20)(frame.where((at >= low) & (at < high)), batch)
    want = {(r.instrument_key, r.timestamp): r for r in indicators.indicators(frame, "1m").collect()}
    got = spark.read.parquet(f"{out}/rows").collect()
    assert len(got) == len(want) == 5007
    for r in got:
        for c in INDICATORS:
            expected = want[r.instrument_key, r.timestamp][c]
            assert r[c] == pytest.approx(expected, rel=1e-9, abs=1e-9) if r[c] is not None else expected is None, (r, c, expected)
    sink = live.IndicatorSink(f"{out}/rows", f"{out}/state", rows=20)
    assert sink.history(spark, 6).count() == 27 and sorted(os.listdir(f"{out}/state")) == ["turn=0", "turn=1"]
    with pytest.raises(ValueError):  # the state of batch 6 is not that of batch 8
        sink(frame.limit(1), 9)
    with pytest.raises(ValueError):
        live.IndicatorSink(out, out, rows=19)


def test_validation_pauses_and_resumes(spark):
    out, now, calls = work_folder(spark, "t-val"), [0.0], []
    checks = live.LiveValidation(f"{out}/f", f"{out}/h", "1m", max_failures=2, cooldown=100, clock=lambda: now[0],
                                 callbacks=[lambda df, i: calls.append(i)])
    good = candles.ohlcv(ticks(spark, [(60 * i, 10.0, 1.0) for i in range(5)]), "1m")
    bad = good.withColumn("high", F.lit(0.0))

    def outcome(batch):
        return {r.status for r in spark.read.parquet(f"{out}/f/batch_id={batch}").collect()}

    for batch, (frame, clock) in enumerate([(bad, 0), (bad, 1), (bad, 2), (good, 200)]):
        now[0] = clock
        checks(frame.withColumn("timestamp", F.col("timestamp") + F.make_interval(hours=F.lit(batch * 5))), batch)
    assert "FAIL" in outcome(0) and "FAIL" in outcome(1) and {"FAIL", "SKIP"} <= outcome(2) and outcome(3) == {"PASS"}
    assert calls == [0, 1, 3] and checks.failures == 0


def test_validation_checks_every_new_candle(spark):
    out = work_folder(spark, "t-all")
    checks = live.LiveValidation(f"{out}/f", f"{out}/h", "15s")
    bad = candles.ohlcv(ticks(spark, [(15 * i, 10.0, 1.0) for i in range(600)]), "15s").withColumn("high", F.lit(0.0))
    checks(bad, 0)
    found = {r.test_name: r.problems for r in spark.read.parquet(f"{out}/f/batch_id=0").collect()}
    assert found["candle_sanity"] == 600


def test_channels(spark):
    frame = candles.ohlcv(ticks(spark, [(0, 1.0, 1.0)]), "1m").withColumn("symbol", F.lit("A-B"))
    got = live.candle_messages(frame).collect()
    assert {r.channel for r in got} == {"candles:A-B:1m", "candles:A-B"}
    assert json.loads(got[0].value)["candle"]["close"] == 1.0


def cascade_run(spark, root, folder, **more):
    ticks = cascade.with_control(live_ticks(live.parse_messages(stream(spark, folder))), f"{root}/control")
    query = cascade.live_job(ticks, root, once=True, history_rows=20, **more)
    query.awaitTermination()
    return query


CANDLE = ("instrument_key", "timeframe", "timestamp", "timestamp_out", "open", "high", "low", "close", "volume", "vwap", "trade_count")


def same_candles(got, want):
    assert got.count() == want.count()
    for a, b in zip(*(f.select(*CANDLE).orderBy("instrument_key", "timeframe", "timestamp").collect() for f in (got, want))):
        assert tuple(a)[:4] == tuple(b)[:4] and tuple(a)[4:] == pytest.approx(tuple(b)[4:], rel=1e-12)


def test_one_stream_for_all_timeframes(spark, tmp_path):
    """Several files, a restart between them, a flush at the end: tables equal the batch result, the last candles included."""
    root, source = work_folder(spark, "t-cascade"), str(tmp_path / "in")
    cascade.start_control(spark, f"{root}/control")
    rows = [trade(s, 100.0 + (s * 7) % 31, amount=1.0 + s % 3, symbol=("A-B", "C-D")[s % 4 == 3]) for s in range(0, 30_000, 47)]
    listener = cascade.LiveStatistics()
    spark.streams.addListener(listener)
    for k in range(4):
        drop(source, f"f{k}", rows[k * 160: (k + 1) * 160])
        if k in (1, 3):
            query = cascade_run(spark, root, source)
    before = spark.read.parquet(f"{root}/candles").where("table = 'candles_24h'").count()
    cascade.flush(spark, f"{root}/control", START + dt.timedelta(seconds=30_000))
    query = cascade_run(spark, root, source)
    spark.streams.removeListener(listener)
    batch = live_ticks(live.parse_messages(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")))
    got = spark.read.parquet(f"{root}/candles").drop("table", "batch_id")
    assert before == 0 and {r.timeframe for r in got.select("timeframe").distinct().collect()} == set(LIVE_TIMEFRAMES)
    same_candles(got, candles.ohlcv(batch, LIVE_TIMEFRAMES))
    # Indicators of every series, from 20 carried rows.
    want = {(r.instrument_key, r.timeframe, r.timestamp): r for r in indicators.indicators(candles.ohlcv(batch, LIVE_TIMEFRAMES)).collect()}
    scored = spark.read.parquet(f"{root}/indicators").collect()
    assert len(scored) == len(want)
    for r in scored:
        for c in INDICATORS:
            expected = want[r.instrument_key, r.timeframe, r.timestamp][c]
            assert r[c] == pytest.approx(expected, rel=1e-9, abs=1e-9) if r[c] is not None else expected is None
    # One state of the finest candles, one look at each source.
    progress = query.lastProgress
    assert len(progress["stateOperators"]) == 1 and len(progress["sources"]) == 2
    listener.store(spark, f"{root}/statistics")
    stored = spark.read.parquet(f"{root}/statistics")
    totals = {r.measure: r.value for r in cascade.live_totals(stored, got).collect()}
    assert totals["ticks"] == len(rows) and totals["errors"] == 0 and totals["per_second"] > 0
    assert totals["candles_24h"] == 2 and cascade.late_ticks(stored, got.where("timeframe = '15s'")) == 0


def test_late_ticks_are_counted(spark, tmp_path):
    root, source = work_folder(spark, "t-late2"), str(tmp_path / "in")
    cascade.start_control(spark, f"{root}/control")
    listener = cascade.LiveStatistics()
    spark.streams.addListener(listener)
    for name, rows in (("a", [trade(s, 1.0) for s in range(0, 900, 10)]), ("b", [trade(1000, 2.0), trade(1001, -1.0)]),
                       ("c", [trade(s, 9.0, id=f"late{s}") for s in (3, 3, 3, 20, 1002)])):
        drop(source, name, rows)
        cascade_run(spark, root, source)
    cascade.flush(spark, f"{root}/control", START + dt.timedelta(seconds=1002))
    cascade_run(spark, root, source)
    spark.streams.removeListener(listener)
    listener.store(spark, f"{root}/statistics")
    stored, finest = spark.read.parquet(f"{root}/statistics"), spark.read.parquet(f"{root}/candles").where("timeframe = '15s'")
    assert cascade.late_ticks(stored, finest) == 4 and stored.agg(F.sum("errors")).first()[0] == 1
    assert finest.agg(F.sum("trade_count")).first()[0] == 93


def test_a_repeated_batch_changes_nothing(spark):
    """The handler by itself: a batch run twice, an empty batch, a state that is not there."""
    root, seen = work_folder(spark, "t-repeat"), {}

    def keep(closed, batch_id):
        seen[batch_id] = sorted((r.timeframe, r.timestamp, r.open, r.close, r.trade_count) for r in closed.collect())

    base = candles.ohlcv(ticks(spark, [(s, float(s), 1.0) for s in range(0, 700, 5)]), "15s")
    base = base.withColumns({"_notional": F.col("vwap") * F.col("volume"), "_last_seen": F.col("timestamp_out")}).drop(
        "vwap", "timeframe", "timestamp_out")
    at = F.unix_seconds("timestamp") - F.unix_seconds(F.lit(START).cast("timestamp"))
    for batch, low, high in ((0, 0, 200), (1, 200, 330), (1, 200, 330), (2, 330, 330), (3, 330, 700), (3, 330, 700)):
        first = seen.get(batch)
        cascade.Cascade(f"{root}/state", [keep], ("15s", "1m", "5m"))(base.where((at >= low) & (at < high)), batch)
        assert first is None or first == seen[batch]
    assert seen[2] == [] and [r[4] for b in range(4) for r in seen[b] if r[0] == "5m"] == [60, 60]
    assert sum(r[0] == "1m" for b in range(4) for r in seen[b]) == 11
    with pytest.raises(ValueError):
        cascade.Cascade(f"{root}/state", [keep], ("15s", "1m"))(base, 7)


def test_second_source_over_batches_and_a_restart(spark, tmp_path):
    """A partner that comes a batch later is found, one that never comes is reported once its time has passed."""
    schema = "instrument_key string, timestamp timestamp, open double, high double, low double, close double, volume double, received timestamp"
    out = work_folder(spark, "t-cross")

    def add(side, name, minutes, close=1.0, delay=62, shift=0):
        at = [START + dt.timedelta(minutes=m) for m in minutes]
        rows = [("A", t + dt.timedelta(seconds=shift), 1.0, 2.0, 0.5, close, 3.0, t + dt.timedelta(seconds=delay)) for t in at]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / side / name))

    def go():
        sides = [spark.readStream.schema(schema).parquet(str(tmp_path / side / "*")) for side in ("a", "b")]
        run(cross.against_second_source(*sides, "1m", "5 minutes"), live.keep_updates(out), str(tmp_path / "cp"), "append")

    add("a", "1", [0, 1, 2])
    add("b", "1", [0])
    go()
    add("b", "2", [1], close=1.1)
    add("a", "2", [3], delay=1000)
    add("b", "3", [3], delay=-7200)
    go()
    add("a", "3", [30])
    add("b", "4", [30], shift=7)
    add("a", "4", [31, 40])
    add("b", "5", [31, 40])
    go()
    found = {(r.timestamp - START, r.source, r.test_name): (r.status, r.detail) for r in spark.read.parquet(out).collect()}
    minute = dt.timedelta(minutes=1)
    assert [found[minute * m, "both", "cross_source"] for m in (0, 1, 2, 3)] == [
        ("PASS", None), ("FAIL", "close"), ("FAIL", "other: missing"), ("PASS", None)]
    assert found[minute * 3, "live", "freshness"][0] == "WARN" and found[minute * 3, "live", "utc"][0] == "PASS"
    assert found[minute * 3, "other", "utc"][0] == "FAIL" and found[minute * 3, "other", "freshness"][0] == "PASS"
    shifted = minute * 30 + dt.timedelta(seconds=7)
    assert found[shifted, "both", "cross_source"] == ("FAIL", "live: missing") and found[shifted, "other", "utc"][0] == "FAIL"
    assert found[minute * 30, "both", "cross_source"] == ("FAIL", "other: missing") and found[minute * 40, "both", "cross_source"] == ("PASS", None)


def test_second_source_of_batches(spark):
    """Without arrival times, with nulls and with nothing on one side."""
    a = minute_candles(spark, FIVE[:2]).withColumn("open", F.lit(None).cast("double"))
    got = cross.by_source(cross.against_second_source(a, a.withColumn("volume", F.col("volume") * 2), "1m")).collect()
    assert {(r.source, r.test_name): (r.candles, r.problems, r.status) for r in got} == {
        ("both", "cross_source"): (2, 2, "FAIL"), ("live", "freshness"): (2, 0, "SKIP"), ("live", "utc"): (2, 0, "SKIP"),
        ("other", "freshness"): (2, 0, "SKIP"), ("other", "utc"): (2, 0, "SKIP")}
    alone = cross.against_second_source(a, a.limit(0), "1m").where("test_name = 'cross_source'").collect()
    assert [(r.status, r.detail) for r in alone] == [("FAIL", "other: missing")] * 2


def test_each_message_is_parsed_once(spark):
    """Filters on parsed columns stay above the parsing, whatever the route."""
    raw = spark.range(10).select(F.to_json(F.struct(F.col("id").cast("string").alias("symbol"))).alias("value"))
    for name, frame in live.route(live.parse_messages(raw)).items():
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1, name


def test_text_that_is_no_message_is_dropped(spark):
    rows = [('{"symbol": "A", "exchange": "x", "timestamp": "2024-01-01T00:00:00Z"}',), ("no json",), (None,), ('{"symbol": "", "exchange": "x"}',), ("[]",)]
    assert [r.symbol for r in live.parse_messages(spark.createDataFrame(rows, "value string")).collect()] == ["A"]


def test_late_ticks_of_a_step_with_several_files(spark, tmp_path, monkeypatch):
    """The events of a step are written by several tasks, and none of its files is late by the others."""
    from checks import live_checks

    start, n = dt.datetime(2024, 1, 1), 30 * 24 * 4
    events = spark.range(n, numPartitions=6).select(
        F.col("id").alias("event_id"), F.expr(f"timestamp'{start}' + make_interval(0, 0, 0, 0, 0, 15 * int(id * 7 % {n}), 30)").alias("ts"),
        F.lit(8).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    folders = {}
    monkeypatch.setattr(live_checks, "work_folder", lambda s, name: folders.setdefault(name, work_folder(s, name)))
    got = live_checks._late(spark, str(tmp_path)).agg(F.sum("trade_count").alias("n"), F.max("timestamp").alias("last")).first()
    late = (F.col("id") % 100 % 20 == 0) & (F.dayofmonth(F.expr(f"timestamp'{start}' + make_interval(0, 0, 0, 0, 0, 15 * int(id * 7 % {n}), 30)")) <= 10)
    assert got.last == dt.datetime(2024, 1, 30, 22)
    assert got.n == spark.range(n).where(~late).count() - 4
    assert len([f for f in os.listdir(f"{folders['k5-in']}/step=0") if f.endswith(".parquet")]) > 1
