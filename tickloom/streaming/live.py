"""The live path: messages, routed ticks, candles, indicators, sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import timegrid as tg
from tickloom.operators import candles as cd
from tickloom.operators import indicators as ind
from tickloom.operators import instruments, quality

SIDE = "array<struct<price: double, amount: double>>"
MESSAGE_SCHEMA = (
    "symbol string, exchange string, type string, timestamp string, id string, price double, amount double, side string, "
    f"bids {SIDE}, asks {SIDE}, liquidation_type string, "
    "mark_price double, markPrice double, index_price double, indexPrice double, last_price double, lastPrice double, "
    "funding_rate double, fundingRate double, open_interest double, openInterest double, next_funding_time string, "
    "strike_price double, expiry string, option_type string, bid double, ask double, volume double"
)
# How often each kind of data is written, the amount from which a
# trade is taken for a liquidation, and candles kept per series.
TRIGGERS = {
    "trades": "60 seconds", "book_snapshots": "60 seconds", "liquidations": "15 minutes",
    "derivative_ticker": "15 minutes", "options_chain": "15 minutes", "funding_rates": "15 minutes",
}
LARGE_TRADE = 10.0
HISTORY_ROWS = 1000


# -- messages -----------------------------------------------------------------------------

def event_time(text: Column) -> Column:
    """ISO text, with or without ``Z``, or epoch milliseconds."""
    millis = F.when(text.rlike(r"^-?\d+$"), F.timestamp_millis(text.try_cast("bigint")))
    return F.coalesce(millis, F.try_to_timestamp(text))


def parse_messages(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to typed rows; rows without symbol, exchange or time are dropped.

    The text is parsed by a generator: Spark would copy a projection into every filter
    above it, and parse each message once for each column that a filter names.
    """
    parsed = raw.select(F.inline(F.array(F.from_json(F.col(column).cast("string"), MESSAGE_SCHEMA))))
    known = parsed.withColumns({
        "data_type": F.coalesce("type", F.lit("trade")),
        "timestamp": event_time(F.col("timestamp")),
        "mark_price": F.coalesce("mark_price", "markPrice"), "index_price": F.coalesce("index_price", "indexPrice"),
        "last_price": F.coalesce("last_price", "lastPrice"), "funding_rate": F.coalesce("funding_rate", "fundingRate"),
        "open_interest": F.coalesce("open_interest", "openInterest"),
    }).drop("type", "markPrice", "indexPrice", "lastPrice", "fundingRate", "openInterest")
    return known.where((F.col("symbol") != "") & (F.col("exchange") != "") & F.col("timestamp").isNotNull())


def _base(df: DataFrame, kind: str, *columns: Column) -> DataFrame:
    return df.select("symbol", "exchange", "timestamp", F.current_timestamp().alias("timestamp_out"), *columns,
                     F.lit(kind).alias("data_type"))


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def trades(m: DataFrame) -> DataFrame:
    return _base(m.where(F.col("data_type").isin("trade", "trades")), "trades", _or("price", 0.0), _or("amount", 0.0), _or("side", "unknown"),
                 F.coalesce("id", F.lit("")).alias("trade_id"))


def book_snapshots(m: DataFrame) -> DataFrame:
    rows = m.where(F.col("data_type").isin("book_snapshot", "book_snapshots", "book_change"))
    side = lambda c: F.coalesce(F.col(c), F.array().cast(SIDE))
    return _base(rows, "book_snapshots", F.to_json(side("bids")).alias("bids"), F.to_json(side("asks")).alias("asks"),
                 F.size(side("bids")).alias("bid_count"), F.size(side("asks")).alias("ask_count"))


def liquidations(m: DataFrame) -> DataFrame:
    """Liquidation messages, and trades large enough to be taken for one."""
    own = F.col("data_type").isin("liquidation", "liquidations")
    large = F.col("data_type").isin("trade", "trades") & (F.col("amount") > LARGE_TRADE)
    kind = F.when(own, F.coalesce("liquidation_type", F.lit("unknown"))).otherwise("derived_from_trade")
    return _base(m.where(own | large), "liquidations", _or("price", 0.0), _or("amount", 0.0), _or("side", "unknown"),
                 kind.alias("liquidation_type"))


def derivative_ticker(m: DataFrame) -> DataFrame:
    price = lambda c: F.coalesce(c, "price", F.lit(0.0)).alias(c)
    return _base(m.where(F.col("data_type") == "derivative_ticker"), "derivative_ticker", price("mark_price"), price("index_price"),
                 _or("funding_rate", 0.0), _or("open_interest", 0.0))


def options_chain(m: DataFrame) -> DataFrame:
    present = lambda c: F.when(F.col(c) != 0, F.col(c)).alias(c)
    return _base(m.where(F.col("data_type") == "options_chain"), "options_chain", _or("strike_price", 0.0),
                 event_time(F.col("expiry")).alias("expiry"), _or("option_type", "call"), present("bid"), present("ask"), _or("volume", 0.0))


def funding_rates(m: DataFrame) -> DataFrame:
    """Funding messages, and the rate inside derivative tickers."""
    own = F.col("data_type").isin("funding_rate", "funding_rates")
    inside = (F.col("data_type") == "derivative_ticker") & F.col("funding_rate").isNotNull()
    return _base(m.where(own | inside), "funding_rates", _or("funding_rate", 0.0), event_time(F.col("next_funding_time")).alias("next_funding_time"))


Route = Callable[[DataFrame], DataFrame]
ROUTES: dict[str, Route] = {
    "trades": trades, "book_snapshots": book_snapshots, "liquidations": liquidations,
    "derivative_ticker": derivative_ticker, "options_chain": options_chain, "funding_rates": funding_rates,
}


def route(messages: DataFrame, routes: dict[str, Route] = ROUTES) -> dict[str, DataFrame]:
    """One frame per data type. A type is added or replaced through ``routes``."""
    return {name: build(messages) for name, build in routes.items()}


# -- candles --------------------------------------------------------------------------------

def candle_stream(ticks: DataFrame, timeframe: str, watermark: str = "1 minute", keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Tumbling UTC candles; ticks later than the watermark are dropped.

    The same call on a batch frame gives the batch candles.
    """
    source = ticks.withWatermark("timestamp", watermark) if ticks.isStreaming else ticks
    frame = source.groupBy(*keys, F.window("timestamp", f"{tg.seconds(timeframe)} seconds").alias("_w")).agg(
        *cd.candle_aggregates(ticks.drop("seq"), timeframe))
    flat = frame.withColumn("timestamp", F.col("_w.start")).drop("_w")
    out = cd.stamp(flat, timeframe, keys)
    return out


def candle_streams(ticks: DataFrame, timeframes: Sequence[str], watermark: str = "1 minute", keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Candles of several timeframes in one stream."""
    out = None
    for tf in timeframes:
        one = candle_stream(ticks, tf, watermark, keys)
        out = one if out is None else out.unionByName(one)
    return out


def start(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``handle`` on each micro-batch; without ``every``, on what is there now."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def keep_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for ``update`` mode: each batch's changed candles in its own folder.

    A batch that is run again replaces its folder.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return handle


def current_candles(spark: SparkSession, path: str, keys: Sequence[str] = ("instrument_key", "timeframe", "timestamp")) -> DataFrame:
    """Latest state of every candle, open ones included."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in (*keys, "batch_id")]
    return stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_c")).select(*keys, "_c.*")


def open_candles(current: DataFrame, now: Column) -> DataFrame:
    """Candles whose interval has not ended at ``now``."""
    end = F.unix_micros("timestamp") + tg.seconds_column(F.col("timeframe")) * F.lit(1_000_000)
    return current.where(end > F.unix_micros(now))


def emitted(candles: DataFrame, now: Column | None = None) -> DataFrame:
    """Stamp candles with the processing time and their latency."""
    at = F.current_timestamp() if now is None else now
    return candles.withColumn("timestamp_in", F.col("timestamp")).withColumn("timestamp_out", at).withColumn(
        "latency_ms", tg.latency_ms("timestamp_in", "timestamp_out"))


# -- indicators on closed candles ------------------------------------------------------------

class IndicatorSink:
    """Batch handler: indicators of newly closed candles, carried on from the batch before.

    What is carried is the last ``rows`` scored candles of each series (20 suffice;
    more are kept to be looked at), with their averages and positions. Batch ``n``
    reads the state of batch ``n - 1`` and writes its own beside it, in two folders
    that take turns: a repeated batch gives the same result, a restart goes on, and
    nothing grows. A state of another batch is an error.
    """

    def __init__(self, out: str, state: str, rows: int = HISTORY_ROWS, keep: Sequence[str] = (), keys: Sequence[str] = ind.SERIES):
        if rows < ind.REACH:
            raise ValueError(f"{rows} rows are fewer than the {ind.REACH} that windows reach back")
        self.out, self.state, self.rows, self.keep, self.keys = out, state, rows, tuple(keep), tuple(keys)

    def history(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The last candles of each series after a batch."""
        return turn(spark, self.state, batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{self.out}/batch_id={batch_id}"
        before = self.history(spark, batch_id - 1) if batch_id else None
        rows = ind.scored(batch, keys=self.keys, keep=self.keep, before=before)
        rows.write.mode("overwrite").parquet(path)
        carried = spark.read.schema(rows.schema).parquet(path).select(*self.keys, *ind.CARRIED)
        if before is not None:
            carried = carried.unionByName(before)
        take_turn(ind.latest(carried, self.rows, self.keys), self.state, batch_id)


def take_turn(df: DataFrame, path: str, batch_id: int) -> None:
    """Keep a batch's state beside the one of the batch before it, in place of the one before that."""
    folder = f"{path}/turn={batch_id % 2}"
    df.write.mode("overwrite").parquet(f"{folder}/rows")
    named = df.sparkSession.range(1).select(F.lit(batch_id).alias("batch"), F.lit(df.schema.json()).alias("schema"))
    named.write.mode("overwrite").parquet(f"{folder}/batch")


def turn(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The state that :func:`take_turn` kept for a batch."""
    folder = f"{path}/turn={batch_id % 2}"
    row = spark.read.parquet(f"{folder}/batch").first()
    if row is None or row.batch != batch_id:
        raise ValueError(f"{folder} holds the state of batch {row and row.batch}, not of {batch_id}")
    return spark.read.schema(T.StructType.fromJson(json.loads(row.schema))).parquet(f"{folder}/rows")


# -- sinks --------------------------------------------------------------------------------------

class TableSink:
    """Batch handler: append rows, in emission order, to the table of their kind.

    ``column`` names the kind (``data_type`` or ``timeframe``). A missing
    emission time is filled in.
    """

    def __init__(self, root: str, column: str = "data_type", prefix: str = "ticks_"):
        self.root, self.column, self.prefix = root, column, prefix

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stamped = batch
        if "timestamp_out" in batch.columns:
            stamped = batch.withColumn("timestamp_out", F.coalesce("timestamp_out", F.current_timestamp()))
        else:
            stamped = batch.withColumn("timestamp_out", F.current_timestamp())
        out = stamped.withColumn("table", F.concat(F.lit(self.prefix), F.col(self.column))).withColumn("batch_id", F.lit(batch_id))
        (
            out.sortWithinPartitions("table", "timestamp_out").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("table", "batch_id").parquet(self.root)
        )


def start_routes(
    messages: DataFrame, root: str, checkpoint: str, routes: dict[str, Route] = ROUTES, once: bool = False
) -> dict[str, StreamingQuery]:
    """One query per data type into its table, each at its own pace; ``once`` runs on what is there now."""
    return {
        name: start(frame, TableSink(f"{root}/{name}"), f"{checkpoint}/{name}", every=None if once else TRIGGERS.get(name, "60 seconds"))
        for name, frame in route(messages, routes).items()
    }


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(root).where(F.col("table") == table).drop("table", "batch_id")


def candle_messages(candles: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Each candle on its timeframe's channel and on its symbol's."""
    there = [c for c in features if c in candles.columns]
    candle = F.struct(
        F.col("timestamp").alias("timestamp_in"), "timestamp_out", "open", "high", "low", "close", "volume", "trade_count", "vwap")
    fields = [F.lit("candle_with_features").alias("type"), "symbol", "timeframe", candle.alias("candle")]
    if there:
        fields.append(F.struct(*there).alias("hft_features"))
    channels = F.array(F.concat_ws(":", F.lit("candles"), "symbol", "timeframe"), F.concat_ws(":", F.lit("candles"), "symbol"))
    return candles.select(F.explode(channels).alias("channel"), F.to_json(F.struct(*fields)).alias("value"))


def tick_messages(ticks: DataFrame) -> DataFrame:
    fields = [F.lit("tick").alias("type"), "symbol", "exchange", "data_type", F.struct(*ticks.columns).alias("data")]
    return ticks.select(
        F.concat_ws(":", F.lit("ticks"), "symbol", "data_type").alias("channel"), F.to_json(F.struct(*fields)).alias("value"))


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send channel messages to a Kafka topic, keyed by channel."""
    keyed = messages.select(F.col("channel").alias("key"), "value")
    return keyed.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option(
        "checkpointLocation", checkpoint).start()


def subscribe(messages: DataFrame, symbol: str, timeframe: str | None = None) -> DataFrame:
    channel = f"candles:{symbol}:{timeframe}" if timeframe else f"candles:{symbol}"
    return messages.where(F.col("channel") == channel)


class ListingWatch:
    """Batch handler: compare each listing with the one before and report changes.

    Listings are kept one folder per batch. Callbacks get the added and removed
    rows; the first listing has nothing to be compared with.
    """

    def __init__(self, path: str, on: Sequence[str], callbacks: Sequence[Callable[[DataFrame, int], None]] = ()):
        self.path, self.on, self.callbacks = path, list(on), callbacks

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.select(*self.on).distinct().write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if batch_id == 0:
            return
        before, after = (spark.read.parquet(f"{self.path}/batch_id={i}") for i in (batch_id - 1, batch_id))
        changed = instruments.changes(before, after, self.on)
        for call in self.callbacks:
            call(changed, batch_id)


# -- validation of live candles -------------------------------------------------------------------

class LiveValidation:
    """Batch handler: checks on all new candles, with history before the oldest of them.

    The findings of every batch go to ``out``. After ``max_failures`` failed batches
    in a row ``callbacks`` are silent for ``cooldown`` seconds, which a ``SKIP`` row
    of the test ``callbacks`` says; else they receive the findings of each batch.
    ``window_seconds`` and ``rows`` bound the history only.
    """

    def __init__(
        self, out: str, history: str, timeframe: str, max_failures: int = 5, cooldown: float = 300.0,
        callbacks: Sequence[Callable[[DataFrame, int], None]] = (), clock: Callable[[], float] | None = None,
        window_seconds: int = 3600, rows: int = 100,
    ):
        import time

        self.out, self.history, self.timeframe = out, history, timeframe
        self.max_failures, self.cooldown, self.callbacks = max_failures, cooldown, callbacks
        self.window_seconds, self.rows = window_seconds, rows
        self.clock = clock or time.time
        self.failures, self.failed_at = 0, 0.0

    def _recent(self, batch: DataFrame, batch_id: int) -> DataFrame:
        series = batch.select("instrument_key", "timeframe", "timestamp", "open", "high", "low", "close")
        try:
            stored = batch.sparkSession.read.parquet(self.history).where(F.col("batch_id") == batch_id - 1).drop("batch_id")
            series = series.unionByName(stored)
        except AnalysisException:
            pass
        oldest = batch.groupBy("instrument_key").agg(F.min("timestamp").alias("_oldest"))
        context = series.join(oldest, "instrument_key", "left").where(
            F.col("_oldest").isNull()
            | (F.unix_micros("timestamp") > F.unix_micros("_oldest") - self.window_seconds * 1_000_000)).drop("_oldest")
        ind.latest(series, self.rows).write.mode("overwrite").parquet(f"{self.history}/batch_id={batch_id}")
        return context

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        recent = self._recent(batch, batch_id)
        silent = self.failures >= self.max_failures and self.clock() - self.failed_at < self.cooldown
        findings = live_findings(recent, self.timeframe)
        if silent:
            findings = findings.unionByName(spark.range(1).select(
                F.lit("all").alias("instrument_key"), F.lit("callbacks").alias("test_name"), F.lit("SKIP").alias("status"),
                F.lit(0).cast("long").alias("problems")))
        path = f"{self.out}/batch_id={batch_id}"
        findings.write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        overall = quality.report(stored).first()["overall_status"]
        if silent:
            return
        if overall == "FAIL":
            self.failures, self.failed_at = self.failures + 1, self.clock()
        elif overall == "PASS":
            self.failures = 0
        for call in self.callbacks:
            call(stored, batch_id)


def live_findings(candles: DataFrame, timeframe: str) -> DataFrame:
    """Time stability and price sanity of a series of candles, per instrument."""
    keys = ["instrument_key"]
    times = quality.stability(candles, tg.seconds(timeframe), keys=keys, block_seconds=86400, arrival=None)
    broken = F.count_if((F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close")))
    sane = candles.groupBy(*keys).agg(broken.alias("problems")).select(
        *keys, F.lit("candle_sanity").alias("test_name"), F.when(F.col("problems") > 0, "FAIL").otherwise("PASS").alias("status"), "problems")
    return times.unionByName(sane)


# -- statistics ------------------------------------------------------------------------------------

def tick_statistics(ticks: DataFrame) -> DataFrame:
    """Ticks, rejected ticks and their share, per data type (complete mode on a stream)."""
    bad = F.col("price").isNull() | (F.col("price") <= 0)
    return ticks.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("ticks"), F.count_if(bad).alias("errors"),
        (F.count_if(bad) / F.count(F.lit(1))).alias("error_rate"))


def with_metrics(df: DataFrame, name: str = "ticks") -> DataFrame:
    """Attach row counts that a query listener receives with each batch."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("price") > 0).alias("good_rows"))
