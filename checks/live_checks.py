"""The live path, run as streams over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.candle_checks import _indicator_sql
from checks.common import CANDLE_SQL, Checks, rounded
from checks.instrument_checks import CHANGES, SNAPSHOTS
from tickloom.functions import timegrid as tg
from tickloom.operators import candles as cd
from tickloom.operators import instruments as ins
from tickloom.schemas import INDICATORS, LIVE_TIMEFRAMES
from tickloom.session import work_folder
from tickloom.sources import adapters as ad
from tickloom.streaming import cascade, cross, live

CHECKS = Checks()
check = CHECKS.add


# -- messages ------------------------------------------------------------------------
# Events as exchange messages: every tenth lacks its symbol, half carry epoch milliseconds.

_MESSAGES = fx.with_(fx.EVENTS, """
msg AS (
  SELECT *, event_id % 10 = 0 AS broken,
    CASE WHEN event_id % 2 = 0 THEN make_timestamp(CAST(epoch_us("timestamp") // 1000 * 1000 AS BIGINT)) ELSE "timestamp" END AS t,
    CASE event_type WHEN 'view' THEN 'derivative_ticker' WHEN 'click' THEN 'book_change' WHEN 'error' THEN 'liquidation'
      WHEN 'signup' THEN 'options_chain' ELSE 'trade' END AS type,
    split_part(instrument_key, ':', 3) AS symbol, 'binance' AS exchange, CAST((k + 1) / 5.0 AS DOUBLE) AS amount
  FROM ev
),
good AS (SELECT * FROM msg WHERE NOT broken)""")


def _as_json(events):
    e = ad.event_columns(events)
    number = F.col("id").cast("long")
    kind = (
        F.when(F.col("event_type") == "view", "derivative_ticker").when(F.col("event_type") == "click", "book_change")
        .when(F.col("event_type") == "error", "liquidation").when(F.col("event_type") == "signup", "options_chain"))
    level = lambda sign: F.array(*[
        F.struct((F.col("value") * (1 + sign * 0.0005 * i)).alias("price"), (F.col("k") + i).cast("double").alias("amount")) for i in (1, 2)])
    is_book, is_ticker, is_option = (F.col("event_type") == x for x in ("click", "view", "signup"))
    body = F.struct(
        F.when(number % 10 != 0, F.split_part("instrument_key", F.lit(":"), F.lit(3))).alias("symbol"), F.lit("binance").alias("exchange"),
        kind.alias("type"),
        F.when(number % 2 == 0, F.unix_millis("timestamp").cast("string"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("timestamp"),
        "id", F.col("value").alias("price"), ((F.col("k") + 1) / 5.0).alias("amount"),
        F.when(F.col("k") % 3 != 0, F.when(F.col("k") % 2 == 0, "buy").otherwise("sell")).alias("side"),
        F.when(is_book, level(-1)).alias("bids"), F.when(is_book & (F.col("k") % 4 != 0), level(1)).alias("asks"),
        F.when(is_ticker & (F.col("k") % 2 == 0), F.col("value") * 1.5).alias("markPrice"),
        F.when(is_ticker & (F.col("k") % 5 != 0), F.col("k") / 1e6).alias("fundingRate"),
        F.when(is_ticker, F.col("value") * 10).alias("open_interest"),
        F.when(is_option, (F.col("k") * 10).cast("double")).alias("strike_price"), F.when(is_option, F.lit("2024-06-28T08:00:00Z")).alias("expiry"),
        F.when(is_option & (F.col("k") % 2 == 0), F.col("k").cast("double")).alias("bid"))
    return e.select(F.to_json(body).alias("value"))


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _run(spark, stream, handle, mode="append", name="run"):
    query = live.start(stream, handle, work_folder(spark, f"{name}-checkpoint"), mode)
    query.awaitTermination()


def _routed(spark, sf, kind):
    """Messages through a stream into the table of their kind, read back."""
    root = work_folder(spark, f"live-{kind}")
    frame = live.route(live.parse_messages(_as_json(_event_stream(spark, sf))))[kind]
    _run(spark, frame, live.TableSink(root), name=kind)
    return live.read_table(spark, root, f"ticks_{kind}").drop("timestamp_out", "data_type")


@check("k1_parsed_messages", _MESSAGES + "SELECT id, symbol, exchange, type AS data_type, t AS \"timestamp\" FROM good")
def _parsed(spark, sf):
    root = work_folder(spark, "k1")
    _run(spark, live.parse_messages(_as_json(_event_stream(spark, sf))), live.TableSink(root), name="k1")
    return spark.read.parquet(root).select("id", "symbol", "exchange", "data_type", "timestamp")


_SIDE = "coalesce(CASE WHEN k % 3 <> 0 THEN CASE WHEN k % 2 = 0 THEN 'buy' ELSE 'sell' END END, 'unknown') AS side"


@check("k2_routed_trades", _MESSAGES + f"""
SELECT symbol, exchange, t AS "timestamp", value AS price, amount, {_SIDE}, id AS trade_id FROM good WHERE type = 'trade'""")
def _trades(spark, sf):
    return _routed(spark, sf, "trades")


@check("k2_routed_books", _MESSAGES + """
SELECT symbol, exchange, t AS "timestamp", CAST(2 AS INTEGER) AS bid_count, CAST(CASE WHEN k % 4 <> 0 THEN 2 ELSE 0 END AS INTEGER) AS ask_count,
  round(value * (1 - CAST(0.0005 AS DOUBLE)), 6) AS best_bid FROM good WHERE type = 'book_change'""")
def _books(spark, sf):
    frame = _routed(spark, sf, "book_snapshots")
    best = F.get(F.from_json("bids", live.SIDE), F.lit(0))["price"]
    return rounded(frame.select("symbol", "exchange", "timestamp", "bid_count", "ask_count", best.alias("best_bid")))


@check("k3_routed_liquidations", _MESSAGES + f"""
SELECT symbol, exchange, t AS "timestamp", value AS price, amount, {_SIDE}, CASE WHEN type = 'trade' THEN 'derived_from_trade' ELSE 'unknown' END AS liquidation_type
FROM good WHERE type = 'liquidation' OR (type = 'trade' AND amount > 10)""")
def _liquidations(spark, sf):
    return _routed(spark, sf, "liquidations")


@check("k15_routed_tickers", _MESSAGES + """
SELECT symbol, exchange, t AS "timestamp", round(CASE WHEN k % 2 = 0 THEN value * 1.5 ELSE value END, 6) AS mark_price, round(value, 6) AS index_price,
  CAST(CASE WHEN k % 5 <> 0 THEN k / 1e6 ELSE 0 END AS DOUBLE) AS funding_rate, round(value * 10, 6) AS open_interest FROM good WHERE type = 'derivative_ticker'""")
def _tickers(spark, sf):
    frame = _routed(spark, sf, "derivative_ticker")
    return frame.withColumns({c: F.round(F.col(c) + 1.37e-7, 6) for c in ("mark_price", "index_price", "open_interest")})


@check("k3_funding_rates", _MESSAGES + """
SELECT symbol, exchange, t AS "timestamp", CAST(k / 1e6 AS DOUBLE) AS funding_rate FROM good WHERE type = 'derivative_ticker' AND k % 5 <> 0""")
def _funding(spark, sf):
    return _routed(spark, sf, "funding_rates").drop("next_funding_time")


@check("k2_routed_options", _MESSAGES + """
SELECT symbol, exchange, t AS "timestamp", CAST(k * 10 AS DOUBLE) AS strike_price, TIMESTAMP '2024-06-28 08:00:00' AS expiry, 'call' AS option_type,
  CASE WHEN k % 2 = 0 AND k <> 0 THEN CAST(k AS DOUBLE) END AS bid, CAST(0 AS DOUBLE) AS volume FROM good WHERE type = 'options_chain'""")
def _options(spark, sf):
    return _routed(spark, sf, "options_chain").drop("ask")


@check("a17_message_stream", _MESSAGES + "SELECT type AS data_type, symbol, count(*) AS messages, max(t) AS newest FROM good GROUP BY ALL")
def _message_stream(spark, sf):
    root = work_folder(spark, "a17")
    _run(spark, live.parse_messages(_as_json(_event_stream(spark, sf))), live.TableSink(root), name="a17")
    return spark.read.parquet(root).groupBy("data_type", "symbol").agg(
        F.count(F.lit(1)).alias("messages"), F.max("timestamp").alias("newest"))


@check("k13_all_routes", _MESSAGES + " UNION ALL ".join(
    f"SELECT '{name}' AS data_type, count(*) AS \"rows\" FROM good WHERE {where}" for name, where in {
        "trades": "type = 'trade'", "book_snapshots": "type = 'book_change'",
        "liquidations": "type = 'liquidation' OR (type = 'trade' AND amount > 10)", "derivative_ticker": "type = 'derivative_ticker'",
        "options_chain": "type = 'options_chain'", "funding_rates": "type = 'derivative_ticker' AND k % 5 <> 0"}.items()))
def _all_routes(spark, sf):
    """One query per data type, each with its own trigger when run for good."""
    root = work_folder(spark, "k13")
    messages = live.parse_messages(_as_json(_event_stream(spark, sf)))
    for query in live.start_routes(messages, root, f"{root}-checkpoint", once=True).values():
        query.awaitTermination()
    out = None
    for name in live.ROUTES:
        one = spark.read.parquet(f"{root}/{name}").select("data_type")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("data_type").agg(F.count(F.lit(1)).alias("rows"))


@check("i19_message_times", _MESSAGES + """SELECT event_id AS n, t AS "timestamp" FROM msg""")
def _times(spark, sf):
    values = _as_json(ad.table(spark, sf, "events")).select(F.from_json("value", "id string, timestamp string").alias("m"))
    return values.select(F.col("m.id").cast("long").alias("n"), live.event_time(F.col("m.timestamp")).alias("timestamp"))


@check("l3_added_route", _MESSAGES + "SELECT symbol, count(*) AS messages FROM good WHERE type = 'options_chain' GROUP BY 1")
def _added(spark, sf):
    messages = live.parse_messages(_as_json(ad.table(spark, sf, "events")))
    routes = {**live.ROUTES, "option_counts": lambda m: m.where(F.col("data_type") == "options_chain").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("messages"))}
    return live.route(messages, routes)["option_counts"]


@check("i21_json_round_trip", _MESSAGES + "SELECT id, value AS price, round(amount, 6) AS amount FROM msg")
def _json(spark, sf):
    values = _as_json(ad.table(spark, sf, "events"))
    return rounded(values.select(F.from_json("value", "id string, price double, amount double").alias("m")).select("m.*").select(
        "id", "price", "amount"))


@check("e24_tick_statistics", _MESSAGES + """
SELECT type AS data_type, count(*) AS ticks, CAST(count(*) FILTER (WHERE NOT value > 0) AS BIGINT) AS errors,
  round(count(*) FILTER (WHERE NOT value > 0) / count(*), 6) AS error_rate FROM good GROUP BY 1""")
def _statistics(spark, sf):
    out = work_folder(spark, "e24")
    stats = live.tick_statistics(live.parse_messages(_as_json(_event_stream(spark, sf))))

    def latest(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _run(spark, live.with_metrics(live.parse_messages(_as_json(_event_stream(spark, sf)))), lambda b, i: b.count(), name="e24-metrics")
    _run(spark, stats, latest, "complete", "e24")
    stored = spark.read.parquet(out)
    return rounded(stored.where(F.col("batch_id") == stored.agg(F.max("batch_id")).first()[0]).drop("batch_id"))


# -- candles ------------------------------------------------------------------------------

def _ticks(spark, sf):
    return ad.trade_columns(ad.event_columns(_event_stream(spark, sf)))


def _live_candles(spark, sf, timeframes):
    out = work_folder(spark, "live-candles")
    for tf in timeframes:
        _run(spark, live.candle_stream(_ticks(spark, sf), tf), live.keep_updates(f"{out}/tf_{tf}"), "update", f"candles-{tf}")
    frames = [live.current_candles(spark, f"{out}/tf_{tf}") for tf in timeframes]
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def _live_sql(pairs):
    return fx.with_(fx.TRADES, *[fx.candles(n, f"c{n}") for _, n in pairs]) + " UNION ALL ".join(
        f"SELECT '{tf}' AS timeframe, {CANDLE_SQL} FROM c{n}" for tf, n in pairs)


@check("k4_live_candles", _live_sql((("1m", 60), ("15m", 900), ("4h", 14400))))
def _candles(spark, sf):
    return rounded(_live_candles(spark, sf, ["1m", "15m", "4h"]))


@check("k8_batch_replay", _live_sql((("15s", 15), ("5m", 300), ("24h", 86400))))
def _replay(spark, sf):
    return rounded(live.candle_streams(ad.trades(spark, sf), ["15s", "5m", "24h"]))


@check("k6_closed_at_end", fx.with_(fx.TRADES, fx.candles(3600)) +
       f'SELECT {CANDLE_SQL} FROM candles WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT max("timestamp") - INTERVAL 1 MINUTE FROM trades)')
def _closed(spark, sf):
    """Append mode: a candle is final once the watermark has passed its end."""
    out = work_folder(spark, "k6")
    _run(spark, live.candle_stream(_ticks(spark, sf), "1h"), live.keep_updates(out), "append", "k6")
    return rounded(spark.read.parquet(out).drop("batch_id", "timeframe"))


_LATE = "k % 20 = 0 AND extract(day FROM ts) <= 10"


@check("k5_late_ticks", fx.with_(fx.TRADES, f"""
ontime AS (SELECT t.* FROM trades t JOIN (SELECT event_id, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
           ON CAST(e.event_id AS VARCHAR) = t.id WHERE NOT ({_LATE}))""", fx.candles(3600, source="ontime")) +
       f'SELECT {CANDLE_SQL} FROM candles WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT max("timestamp") - INTERVAL 1 MINUTE FROM trades)')
def _late(spark, sf):
    """Events arrive in four steps, a batch each; part of the first ten days comes with the last one, behind the watermark."""
    source, out, checkpoint = work_folder(spark, "k5-in"), work_folder(spark, "k5"), work_folder(spark, "k5-checkpoint")
    events = ad.table(spark, sf, "events")
    day = F.dayofmonth("ts")
    late = (F.regexp_extract("props", r"(\d+)", 1).cast("long") % 20 == 0) & (day <= 10)
    arrival = F.when(late, 3).when(day <= 15, 0).when(day <= 20, 1).when(day <= 25, 2).otherwise(3)
    for step in range(4):  # however many files a step has, the stream takes them together and goes on with the next
        events.where(arrival == step).write.parquet(f"{source}/step={step}")
        ticks = ad.trade_columns(ad.event_columns(spark.readStream.schema(events.schema).parquet(f"{source}/*")))
        live.start(live.candle_stream(ticks, "1h"), live.keep_updates(out), checkpoint, "append").awaitTermination()
    return rounded(spark.read.parquet(out).drop("batch_id", "timeframe"))


def _in_files(spark, sf, name, arrival, steps=3):
    """The events in files that arrive one after another, as a stream of ticks; and the folder to add to."""
    source = work_folder(spark, f"{name}-in")
    events = ad.table(spark, sf, "events")
    for step in range(steps):
        events.where(arrival == step).coalesce(1).write.parquet(f"{source}/step={step}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    return ad.trade_columns(ad.event_columns(stream))


def _job(spark, sf, name, arrival, timeframes, listener=None):
    """The live job over the files, stopped and started again, then flushed; returns its folder."""
    root = work_folder(spark, name)
    cascade.start_control(spark, f"{root}/control")
    ticks = cascade.with_control(_in_files(spark, sf, name, arrival), f"{root}/control")
    newest = ad.table(spark, sf, "events").agg(F.max("ts")).first()[0].replace(tzinfo=None)
    if listener:
        spark.streams.addListener(listener)
    for flushed in (False, True):
        if flushed:
            cascade.flush(spark, f"{root}/control", newest, timeframes)
        cascade.live_job(ticks, root, timeframes, once=True, history_rows=20).awaitTermination()
    if listener:
        spark.streams.removeListener(listener)
    return root


def _by_days():
    """Three files of eleven days each."""
    return F.floor((F.dayofmonth("ts") - 1) / 11)


@check("k6_flushed_candles", _live_sql((("15s", 15), ("1m", 60), ("5m", 300), ("15m", 900), ("4h", 14400), ("24h", 86400))))
def _flushed(spark, sf):
    """All live timeframes from one stream with one state, the candles still open at the end included."""
    root = _job(spark, sf, "k6b", _by_days(), LIVE_TIMEFRAMES)
    return rounded(spark.read.parquet(f"{root}/candles").drop("table", "batch_id"))


@check("p9_live_job_indicators", _indicator_sql(14400))
def _job_indicators(spark, sf):
    """Indicators of the live job's 4h candles, across batches and a restart."""
    root = _job(spark, sf, "p9b", _by_days(), ("1m", "4h"))
    return rounded(spark.read.parquet(f"{root}/indicators").where("timeframe = '4h'").select("instrument_key", "timestamp", *INDICATORS))


@check("e24_live_totals", fx.with_(fx.TRADES, f"""
e AS (SELECT t.*, {_LATE} AS late FROM trades t JOIN (SELECT event_id, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
      ON CAST(e.event_id AS VARCHAR) = t.id)""", """
m AS (SELECT 'ticks' AS measure, count(*) AS "value" FROM e UNION ALL SELECT 'late_ticks', count(*) FILTER (WHERE late) FROM e
  UNION ALL SELECT 'errors', count(*) FILTER (WHERE NOT price > 0) FROM e
  UNION ALL SELECT 'error_rate', count(*) FILTER (WHERE NOT price > 0) / count(*) FROM e
  UNION ALL SELECT 'candles_' || tf, count(DISTINCT (instrument_key, time_bucket(to_seconds(n), "timestamp", TIMESTAMP '1970-01-01')))
    FROM e, (SELECT unnest(['1m', '24h']) AS tf, unnest([60, 86400]) AS n) WHERE NOT late GROUP BY tf)""") + """
SELECT measure, round(CAST("value" AS DOUBLE), 6) AS "value" FROM m""")
def _totals(spark, sf):
    """Part of the first ten days comes with the last file: what the watermark drops is counted tick by tick."""
    day = F.dayofmonth("ts")
    late = (F.regexp_extract("props", r"(\d+)", 1).cast("long") % 20 == 0) & (day <= 10)
    listener = cascade.LiveStatistics()
    root = _job(spark, sf, "e24b", F.when(late, 2).otherwise(_by_days()), ("1m", "24h"), listener)
    listener.store(spark, f"{root}/statistics")
    stored, candles = spark.read.parquet(f"{root}/statistics"), spark.read.parquet(f"{root}/candles")
    dropped = cascade.late_ticks(stored, candles.where("timeframe = '1m'"))
    totals = cascade.live_totals(stored, candles).where("measure <> 'per_second'")
    return rounded(totals.unionByName(spark.range(1).select(F.lit("late_ticks").alias("measure"), F.lit(dropped).cast("double").alias("value"))))


@check("k7_open_candles", fx.with_(fx.TRADES, fx.candles(14400)) +
       f'SELECT {CANDLE_SQL} FROM candles WHERE "timestamp" + INTERVAL 4 HOURS > (SELECT max("timestamp") FROM trades)')
def _open(spark, sf):
    current = _live_candles(spark, sf, ["4h"])
    now = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts").cast("timestamp")).scalar()
    return rounded(live.open_candles(current.withColumn("now", now), F.col("now")).drop("now", "timeframe"))


@check("k14_emission_stamp", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT instrument_key, "timestamp" AS timestamp_in, TIMESTAMP '2024-02-01' AS timestamp_out,
  CAST(epoch_us(TIMESTAMP '2024-02-01') - epoch_us("timestamp") AS DOUBLE) / 1000.0 AS latency_ms FROM candles""")
def _emitted(spark, sf):
    frame = cd.ohlcv(ad.trades(spark, sf), "1h")
    return live.emitted(frame, F.lit("2024-02-01 00:00:00").cast("timestamp")).select(
        "instrument_key", "timestamp_in", "timestamp_out", "latency_ms")


@check("k9_live_indicators", _indicator_sql(3600))
def _indicators(spark, sf):
    """Candles arriving in steps of six days; each step goes on from 20 rows of the one before."""
    source, out = work_folder(spark, "k9-in"), work_folder(spark, "k9-out")
    frame = cd.ohlcv(ad.trades(spark, sf), "1h").withColumn("step", F.floor((F.dayofmonth("timestamp") - 1) / 6))
    frame.repartition(1, "step").sortWithinPartitions("step").write.partitionBy("step").parquet(source)
    sink = live.IndicatorSink(f"{out}/rows", f"{out}/state", rows=20)
    stored = spark.read.parquet(source)
    for step in range(6):
        sink(stored.where(F.col("step") == step).drop("step"), step)
    return rounded(spark.read.parquet(f"{out}/rows").select("instrument_key", "timestamp", *INDICATORS))


@check("k10_bounded_history", fx.with_(fx.TRADES, fx.candles(900)) + """
SELECT instrument_key, "timestamp", round("close", 6) AS "close" FROM candles QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY "timestamp" DESC) <= 200""")
def _history(spark, sf):
    out = work_folder(spark, "k10")
    sink = live.IndicatorSink(f"{out}/rows", f"{out}/state", rows=200)
    frame = cd.ohlcv(ad.trades(spark, sf), "15m")
    sink(frame.where(F.dayofmonth("timestamp") < 15), 0)
    sink(frame.where(F.dayofmonth("timestamp") >= 15), 1)
    return rounded(sink.history(spark, 1).select("instrument_key", "timestamp", "close"))


# -- sinks and channels ----------------------------------------------------------------------

@check("b9_b10_live_candle_table", fx.with_(fx.TRADES, fx.candles(300)) + f"SELECT {CANDLE_SQL} FROM candles")
def _candle_sink(spark, sf):
    root, source = work_folder(spark, "b9"), work_folder(spark, "b9-in")
    cd.ohlcv(ad.trades(spark, sf), "5m").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    _run(spark, stream, live.TableSink(root, "timeframe", "candles_"), name="b9")
    return rounded(live.read_table(spark, root, "candles_5m").drop("timeframe"))


@check("b12_candle_channels", fx.with_(fx.TRADES, fx.candles(14400), """
m AS (SELECT split_part(instrument_key, ':', 3) AS symbol, * FROM candles)""") + """
SELECT channel, "timestamp", round("close", 6) AS "close", trade_count FROM (
  SELECT 'candles:' || symbol || ':4h' AS channel, * FROM m UNION ALL SELECT 'candles:' || symbol, * FROM m)""")
def _channels(spark, sf):
    frame = cd.ohlcv(ad.trades(spark, sf), "4h").withColumn("symbol", F.split_part("instrument_key", F.lit(":"), F.lit(3)))
    body = F.from_json("value", "candle struct<timestamp_in: timestamp, close: double, trade_count: bigint>")["candle"]
    return rounded(live.candle_messages(frame).select("channel", body["timestamp_in"].alias("timestamp"), body["close"].alias("close"),
                                                      body["trade_count"].alias("trade_count")))


@check("b12_tick_channels", _MESSAGES + "SELECT 'ticks:' || symbol || ':trades' AS channel, count(*) AS messages FROM good WHERE type = 'trade' GROUP BY 1")
def _tick_channels(spark, sf):
    ticks = live.route(live.parse_messages(_as_json(ad.table(spark, sf, "events"))))["trades"]
    return live.tick_messages(ticks).groupBy("channel").agg(F.count(F.lit(1)).alias("messages"))


@check("k16_subscription", fx.with_(fx.TRADES, fx.candles(14400)) + """
SELECT 'candles:U3-USDT:4h' AS channel, "timestamp" FROM candles WHERE instrument_key = 'BINANCE:SPOT_PAIR:U3-USDT'""")
def _subscription(spark, sf):
    frame = cd.ohlcv(ad.trades(spark, sf), "4h").withColumn("symbol", F.split_part("instrument_key", F.lit(":"), F.lit(3)))
    mine = live.subscribe(live.candle_messages(frame), "U3-USDT", "4h")
    return mine.select("channel", F.from_json("value", "candle struct<timestamp_in: timestamp>")["candle"]["timestamp_in"].alias("timestamp"))


# -- live validation ---------------------------------------------------------------------------

@check("k11_live_findings", fx.with_(fx.TRADES, fx.candles(900), """
st AS (SELECT instrument_key, CAST(epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY instrument_key ORDER BY "timestamp")) AS DOUBLE) / 1e6 AS x FROM candles)""", """
q AS (SELECT instrument_key, count(*) FILTER (WHERE abs(x - 900) > 1) AS drift, count(*) FILTER (WHERE x > 1350) AS gap FROM st GROUP BY 1)""", """
u AS (SELECT instrument_key, unnest(['duplicate_timestamps', 'timestamp_ordering', 'interval_consistency', 'timestamp_gaps', 'candle_sanity']) AS test_name,
        unnest([0, 0, drift, gap, 0]) AS problems FROM q)""") + """
SELECT instrument_key, test_name, CASE WHEN problems > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(problems AS BIGINT) AS problems FROM u""")
def _findings(spark, sf):
    return live.live_findings(cd.ohlcv(ad.trades(spark, sf), "15m"), "15m")


_CROSS = """
o AS (SELECT *, CASE WHEN extract(hour FROM "timestamp") = 5 THEN high * 1.01 ELSE high END AS high2 FROM candles WHERE extract(hour FROM "timestamp") <> 7),
l AS (SELECT * FROM candles WHERE extract(hour FROM "timestamp") <> 9),
mark AS (SELECT least((SELECT max("timestamp") FROM l), (SELECT max("timestamp") FROM o)) - INTERVAL 2 HOUR AS t),
j AS (SELECT coalesce(l.instrument_key, o.instrument_key) AS instrument_key, coalesce(l."timestamp", o."timestamp") AS "timestamp",
        l."timestamp" AS lt, o."timestamp" AS ot, l.high AS lh, o.high2 AS oh
      FROM l FULL OUTER JOIN o ON l.instrument_key = o.instrument_key AND l."timestamp" = o."timestamp"),
k AS (SELECT j.*, extract(hour FROM "timestamp") AS hr FROM j, mark WHERE (lt IS NOT NULL AND ot IS NOT NULL) OR "timestamp" <= mark.t),
f AS (SELECT instrument_key, 'both' AS source, 'cross_source' AS test_name, CASE WHEN lt IS NULL OR ot IS NULL OR abs(lh - oh) > 1e-4 * greatest(abs(lh), abs(oh)) THEN 'FAIL' ELSE 'PASS' END AS status FROM k
  UNION ALL SELECT instrument_key, 'live', 'freshness', 'PASS' FROM k WHERE lt IS NOT NULL
  UNION ALL SELECT instrument_key, 'live', 'utc', 'PASS' FROM k WHERE lt IS NOT NULL
  UNION ALL SELECT instrument_key, 'other', 'freshness', CASE WHEN hr = 11 THEN 'WARN' ELSE 'PASS' END FROM k WHERE ot IS NOT NULL
  UNION ALL SELECT instrument_key, 'other', 'utc', CASE WHEN hr = 13 THEN 'FAIL' ELSE 'PASS' END FROM k WHERE ot IS NOT NULL)"""


@check("k11_second_source", fx.with_(fx.TRADES, fx.candles(900), _CROSS) + """
SELECT instrument_key, source, test_name, count(*) AS candles, count(*) FILTER (WHERE status IN ('FAIL', 'WARN')) AS problems,
  CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS status
FROM f GROUP BY 1, 2, 3""")
def _second_source(spark, sf):
    """Two streams of candles. The second lacks an hour of each day, has wrong highs in one, is late in one and two hours ahead in one; the first lacks one."""
    stored, out = work_folder(spark, "k11-in"), work_folder(spark, "k11")
    cd.ohlcv(ad.trades(spark, sf), "15m").write.parquet(stored)
    stream = spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored)
    hour, end = F.hour("timestamp"), F.col("timestamp") + F.expr("INTERVAL 15 MINUTES")
    first = stream.where(hour != 9).withColumn("received", end + F.expr("INTERVAL 2 SECONDS"))
    late = F.when(hour == 11, end + F.expr("INTERVAL 20 MINUTES")).when(hour == 13, end - F.expr("INTERVAL 2 HOURS")).otherwise(end)
    second = stream.where(hour != 7).withColumn("high", F.when(hour == 5, F.col("high") * 1.01).otherwise(F.col("high"))).withColumn("received", late)
    _run(spark, cross.against_second_source(first, second, "15m", "2 hours"), live.keep_updates(out), "append", "k11")
    return cross.by_source(spark.read.parquet(out))


@check("k12_skips_after_failures", fx.with_(fx.TRADES) + """
SELECT CAST(n AS BIGINT) AS batch, 'FAIL' AS overall, n >= 5 AS silent FROM (SELECT unnest(range(0, 7)) AS n)
WHERE (SELECT count(*) FROM trades) > 0""")
def _skips(spark, sf):
    """Sparse candles fail the gap check in every batch; after five failed batches callbacks pause."""
    out = work_folder(spark, "k12")
    checks = live.LiveValidation(f"{out}/findings", f"{out}/history", "15s", clock=lambda: 1000.0, window_seconds=864000)
    frame = cd.ohlcv(ad.trades(spark, sf), "15s")
    for batch in range(7):
        checks(frame.where(F.dayofmonth("timestamp") == batch + 1), batch)
    stored = spark.read.parquet(f"{out}/findings")
    worst = F.when(F.bool_or(F.col("status") == "FAIL"), "FAIL").otherwise("PASS")
    return stored.groupBy(F.col("batch_id").cast("long").alias("batch")).agg(
        worst.alias("overall"), F.bool_or(F.col("status") == "SKIP").alias("silent"))


@check("l2_callbacks", CHANGES + "SELECT venue, change, count(*) AS symbols FROM changed GROUP BY ALL")
def _callbacks(spark, sf):
    """A callback per snapshot receives what changed since the one before."""
    out = work_folder(spark, "l2")
    i = ad.instruments(spark, sf)
    counted = f"{out}/counts"

    def count(changed, batch_id):
        changed.groupBy("venue", "change").agg(F.count(F.lit(1)).alias("symbols")).write.mode("overwrite").parquet(counted)

    watch = live.ListingWatch(f"{out}/listing", on=["venue", "exchange_raw_symbol"], callbacks=[count])
    for batch, day in enumerate(SNAPSHOTS):
        watch(ins.available_on(i, day), batch)
    return spark.read.parquet(counted)


@check("p9_live_job", fx.with_(fx.TRADES, fx.candles(60)) + f"SELECT {CANDLE_SQL} FROM candles")
def _live_job(spark, sf):
    """Ticks to candles to the live table, in update mode; the latest state per candle."""
    return rounded(_live_candles(spark, sf, ["1m"]).drop("timeframe"))


@check("i2_alignment_map", fx.with_(fx.EVENTS) + """
SELECT id, tf AS timeframe, time_bucket(to_seconds(n), "timestamp", TIMESTAMP '1970-01-01') AS boundary
FROM ev, (SELECT unnest(['15s', '1m', '5m', '15m', '4h', '24h']) AS tf, unnest([15, 60, 300, 900, 14400, 86400]) AS n)""")
def _map(spark, sf):
    from tickloom.schemas import LIVE_TIMEFRAMES

    return ad.trades(spark, sf).select("id", F.explode(tg.alignments("timestamp", LIVE_TIMEFRAMES)).alias("timeframe", "boundary"))
