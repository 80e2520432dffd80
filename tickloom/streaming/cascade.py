"""Candles of all timeframes from one stream with one state.

Spark's state holds candles of the finest timeframe only. Each batch delivers those
that the watermark has closed; longer candles are put together from them and kept
open in a small table until their end has passed. The ticks are read once, whatever
the number of timeframes, and one checkpoint covers candles, indicators and tables.

A stream that ends leaves its last candles open: nothing pushes the watermark on.
:func:`with_control` joins a folder of control rows to the ticks, and
:func:`flush` puts rows in it that move the watermark over the end of the longest
open candle. Control rows have a time and no key.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.functions import timegrid as tg
from tickloom.operators import candles as cd
from tickloom.schemas import LIVE_TIMEFRAMES
from tickloom.streaming import live

KEYS = ("instrument_key",)
Handler = Callable[[DataFrame, int], None]
# What an open candle carries: sums and extremes, so that candles merge in any number of steps.
PARTS = ("open", "high", "low", "close", "volume", "_notional", "trade_count", "_last_seen", "_first", "_last")


def with_control(ticks: DataFrame, folder: str) -> DataFrame:
    """A tick stream joined by the control rows of a folder, which must exist."""
    control = ticks.sparkSession.readStream.schema("timestamp timestamp").json(folder)
    return ticks.unionByName(control, allowMissingColumns=True)


def start_control(spark: SparkSession, folder: str) -> None:
    """Make an empty control folder."""
    spark.createDataFrame([], "timestamp timestamp").write.mode("append").json(folder)


def flush(spark: SparkSession, folder: str, newest: dt.datetime, timeframes: Sequence[str] = LIVE_TIMEFRAMES, watermark_seconds: int = 60) -> None:
    """Close all candles up to the one of the longest timeframe that holds ``newest`` (UTC).

    The first control row stands at the end of that candle and comes out of the
    stream when everything before it has; the second moves the watermark over it.
    Ticks before that time are late from then on.
    """
    width, base = max(map(tg.seconds, timeframes)), min(map(tg.seconds, timeframes))
    end = (int(newest.replace(tzinfo=dt.timezone.utc).timestamp()) // width + 1) * width
    rows = [(dt.datetime.fromtimestamp(s, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),) for s in (end, end + base + watermark_seconds + 1)]
    frame = spark.createDataFrame(rows, "timestamp string").select(F.to_timestamp("timestamp").alias("timestamp"))
    frame.coalesce(1).write.mode("append").json(folder)


def base_stream(ticks: DataFrame, timeframe: str, watermark: str = "1 minute", keys: Sequence[str] = KEYS) -> DataFrame:
    """Closed candles of the finest timeframe, with what longer ones need of them (for append mode)."""
    source = ticks.withWatermark("timestamp", watermark)
    frame = source.groupBy(*keys, F.window("timestamp", f"{tg.seconds(timeframe)} seconds").alias("_w")).agg(
        *cd.candle_aggregates(ticks.drop("seq"), timeframe), F.sum(F.col("price") * F.col("amount")).alias("_notional"))
    return frame.withColumn("timestamp", F.col("_w.start")).drop("_w", "vwap")


class Cascade:
    """Batch handler: all timeframes from closed candles of the finest one, to ``sinks`` in order.

    A longer candle is closed once every finer one up to its end has come, which the
    end of the newest finer candle of any series tells. Open candles are kept in two
    folders that take turns (see :func:`live.take_turn`), so a batch can be repeated
    and a restart goes on.
    """

    def __init__(self, state: str, sinks: Sequence[Handler], timeframes: Sequence[str] = LIVE_TIMEFRAMES, keys: Sequence[str] = KEYS):
        self.base, *self.longer = sorted(timeframes, key=tg.seconds)
        uneven = [tf for tf in self.longer if tg.seconds(tf) % tg.seconds(self.base)]
        if uneven:
            raise ValueError(f"{uneven} are no multiples of {self.base}")
        self.state, self.sinks, self.keys = state, sinks, list(keys)

    def _merged(self, parts: DataFrame) -> DataFrame:
        """Parts of one candle put together; ``_first`` and ``_last`` are the times of its ends."""
        return parts.groupBy(*self.keys, "timeframe", "timestamp").agg(
            F.min_by("open", "_first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "_last").alias("close"), F.sum("volume").alias("volume"), F.sum("_notional").alias("_notional"),
            F.sum("trade_count").alias("trade_count"), F.max("_last_seen").alias("_last_seen"),
            F.min("_first").alias("_first"), F.max("_last").alias("_last"))

    def _columns(self, start, timeframe) -> list:
        return [*self.keys, timeframe.alias("timeframe"), start.alias("timestamp"), *PARTS]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, F.unix_micros("timestamp")
        # The batch is written once: every further look at it would run the stream's aggregation again.
        live.take_turn(batch, f"{self.state}/base", batch_id)
        base = live.turn(spark, f"{self.state}/base", batch_id).withColumns({"_first": F.col("timestamp"), "_last": F.col("timestamp")})
        width = tg.seconds(self.base) * 1_000_000
        horizon = base.agg(F.max(at + width)).first()[0]
        real = base.where(" OR ".join(f"{k} IS NOT NULL" for k in self.keys))
        steps = F.inline(F.array(*[
            F.struct(F.lit(tf).alias("_tf"), F.lit(tg.seconds(tf) * 1_000_000).alias("_width")) for tf in self.longer]))
        parts = real.select(*real.columns, steps).select(*self._columns(F.timestamp_micros(at - F.pmod(at, F.col("_width"))), F.col("_tf")))
        if batch_id:
            before = live.turn(spark, f"{self.state}/open", batch_id - 1)
            reached = before.where("timeframe IS NULL").agg(F.max("_horizon")).first()[0]
            horizon = max((h for h in (horizon, reached) if h is not None), default=None)
            parts = parts.unionByName(before.where("timeframe IS NOT NULL AND NOT _closed").select(*parts.columns))
        end = at + tg.seconds_column(F.col("timeframe")) * F.lit(1_000_000)
        merged = self._merged(parts).withColumns(
            {"_closed": F.coalesce(end <= F.lit(horizon).cast("long"), F.lit(False)), "_horizon": F.lit(None).cast("long")})
        mark = spark.range(1).select(F.lit(horizon).cast("long").alias("_horizon"))
        live.take_turn(merged.unionByName(mark, allowMissingColumns=True), f"{self.state}/open", batch_id)
        done = live.turn(spark, f"{self.state}/open", batch_id).where("_closed").select(*parts.columns)
        finest = real.select(*self._columns(F.col("timestamp"), F.lit(self.base)))
        closed = finest.unionByName(done).withColumn("vwap", F.try_divide("_notional", "volume")).drop("_notional", "_first", "_last")
        closed = cd.stamp(closed, self.longer or (self.base,), self.keys)
        for sink in self.sinks:
            sink(closed, batch_id)


def live_job(
    ticks: DataFrame, root: str, timeframes: Sequence[str] = LIVE_TIMEFRAMES, watermark: str = "1 minute", once: bool = False,
    every: str = "15 seconds", sinks: Sequence[Handler] = (), history_rows: int = live.HISTORY_ROWS, name: str | None = None,
) -> StreamingQuery:
    """Ticks to candles of all timeframes, their indicators and tables: one query, one scan, one checkpoint.

    Below ``root``: ``candles`` (a table per timeframe), ``indicators``, ``state`` and
    ``checkpoint``. ``sinks`` get the closed candles of each batch too. Started again,
    the job goes on where it stopped.
    """
    handler = Cascade(f"{root}/state", [
        live.TableSink(f"{root}/candles", "timeframe", "candles_"),
        live.IndicatorSink(f"{root}/indicators", f"{root}/state/indicators", history_rows),
        *sinks,
    ], timeframes)
    metered = ticks.observe("ticks", F.count_if(F.col("instrument_key").isNotNull()).alias("rows"),
                            F.count_if(F.col("instrument_key").isNotNull() & ~F.coalesce(F.col("price") > 0, F.lit(False))).alias("errors"))
    stream = base_stream(metered, handler.base, watermark)
    return live.start(stream, handler, f"{root}/checkpoint", "append", None if once else every, name)


# -- statistics ------------------------------------------------------------------------------

STATISTICS = ("run string, batch long, at string, seconds double, input_rows long, ticks long, errors long, ticks_per_second double, "
              "state_rows long, late_groups long")


class LiveStatistics(StreamingQueryListener):
    """What each batch of the observed queries did: ticks, errors, rate, open state.

    ``late_groups`` is Spark's own count of what the watermark dropped, which counts
    partial aggregates; :func:`late_ticks` counts ticks.
    """

    def __init__(self):
        self.rows: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("ticks")
        seconds = p.batchDuration / 1000.0
        ticks = int(seen["rows"]) if seen else 0
        row = (str(p.runId), p.batchId, p.timestamp, seconds, p.numInputRows, ticks, int(seen["errors"]) if seen else 0,
               ticks / seconds if seconds else 0.0, sum(s.numRowsTotal for s in p.stateOperators),
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        with self.lock:
            self.rows.append(row)

    def store(self, spark: SparkSession, path: str) -> None:
        """Append what has come since the last call to a table."""
        with self.lock:
            rows, self.rows = self.rows, []
        spark.createDataFrame(rows, STATISTICS).write.mode("append").parquet(path)


def live_totals(statistics: DataFrame, candles: DataFrame) -> DataFrame:
    """Ticks, errors, error rate and ticks a second of a live job, and its candles per timeframe, one row each."""
    ticks = statistics.agg(
        F.sum("ticks").alias("ticks"), F.sum("errors").alias("errors"), F.try_divide(F.sum("errors"), F.sum("ticks")).alias("error_rate"),
        F.try_divide(F.sum("ticks"), F.sum("seconds")).alias("per_second"))
    values = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in ticks.columns]
    counted = candles.groupBy("timeframe").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return ticks.select(F.inline(F.array(*values))).unionByName(
        counted.select(F.concat(F.lit("candles_"), "timeframe").alias("measure"), "value"))


def late_ticks(statistics: DataFrame, finest: DataFrame) -> int:
    """Ticks that came too late for their candle: those that came less those in closed candles, of a job that was flushed."""
    came = statistics.agg(F.sum("ticks")).first()[0] or 0
    return came - (finest.agg(F.sum("trade_count")).first()[0] or 0)
