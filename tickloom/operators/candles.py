"""OHLCV candles: from ticks, on a grid, and rolled up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg
from tickloom.schemas import ROLLUP_TIMEFRAMES

KEYS = ("instrument_key",)
TIE_BITS = 26


# One timeframe, or several that are computed in the same pass.
Timeframes = str | Sequence[str]


def longest(timeframe: Timeframes) -> str:
    return timeframe if isinstance(timeframe, str) else max(timeframe, key=tg.seconds)


def series_keys(timeframe: Timeframes, keys: Sequence[str]) -> list[str]:
    """Keys of one candle series: with several timeframes, their name too."""
    return list(keys) if isinstance(timeframe, str) else [*keys, "timeframe"]


def tick_order(ticks: DataFrame, timeframe: Timeframes) -> Column:
    """A total order of the ticks inside one interval.

    With a ``seq`` column (rank among ticks of equal time, written at ingest) the
    order is one LONG, and first/last run as a hash aggregation. A NULL ``seq``
    counts as 0: the tick keeps its time, only ties are then open. A rank that
    does not fit its bits is an error. Without the column the order is a struct,
    and Spark sorts.
    """
    if "seq" in ticks.columns:
        # Shorter intervals lie inside the longest, so its offset orders them too.
        offset = F.pmod(F.unix_micros("timestamp"), F.lit(tg.seconds(longest(timeframe)) * 1_000_000))
        rank = F.coalesce("seq", F.lit(0))
        fits = F.when(rank < (1 << TIE_BITS), rank).otherwise(F.raise_error(F.lit("too many ticks at one instant")).cast("long"))
        return F.shiftleft(offset, TIE_BITS) + fits
    return F.struct(*[c for c in ("timestamp", "local_timestamp", "id", "price") if c in ticks.columns])


def with_sequence(ticks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add ``seq``, the rank among ticks of one instrument at one instant."""
    from pyspark.sql import Window

    ties = Window.partitionBy(*keys, "timestamp").orderBy("local_timestamp", "id", "price")
    return ticks.withColumn("seq", F.row_number().over(ties).cast("long"))


def candle_aggregates(ticks: DataFrame, timeframe: Timeframes) -> list[Column]:
    order = tick_order(ticks, timeframe)
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("amount").alias("volume"),
        F.try_divide(F.sum(F.col("price") * F.col("amount")), F.sum("amount")).alias("vwap"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max("local_timestamp").alias("_last_seen"),
    ]


def interval_frame(ticks: DataFrame, timeframe: Timeframes, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregate rows by key and interval; the interval start becomes ``timestamp``.

    Several timeframes are served by one scan: each row is repeated per timeframe
    inside its task and combined there before the shuffle. The result then has a
    ``timeframe`` column.
    """
    at = F.unix_micros("timestamp")
    if isinstance(timeframe, str):
        source, width = ticks, F.lit(tg.seconds(timeframe) * 1_000_000)
    else:
        steps = F.array(*[
            F.struct(F.lit(tf).alias("timeframe"), F.lit(tg.seconds(tf) * 1_000_000).alias("_width")) for tf in timeframe])
        source, width = ticks.drop("timeframe").select("*", F.inline(steps)), F.col("_width")
    start = F.timestamp_micros(at - F.pmod(at, width))
    return (
        source.groupBy(*series_keys(timeframe, keys), start.alias("_start"))
        .agg(*aggregates)
        .withColumnRenamed("_start", "timestamp")
    )


def ohlcv(ticks: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    """Candles of the intervals that hold at least one trade.

    One shuffle of partially aggregated rows, on key and interval.
    """
    frame = interval_frame(ticks, timeframe, keys, candle_aggregates(ticks, timeframe))
    return stamp(frame, timeframe, keys)


def stamp(frame: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    """Put labels first and turn ``_last_seen`` into the emission time."""
    rest = [c for c in frame.columns if c not in (*keys, "timeframe", "timestamp", "_last_seen")]
    return frame.select(
        *keys,
        F.lit(timeframe).alias("timeframe") if isinstance(timeframe, str) else F.col("timeframe"),
        "timestamp",
        tg.emission_time(F.col("_last_seen"), F.col("timestamp")).alias("timestamp_out"),
        *rest,
    )


def fill_grid(candles: DataFrame, timeframe: str, keys: Sequence[str] = KEYS, days: DataFrame | None = None) -> DataFrame:
    """Add the empty intervals of each (key, day): NULL prices, zero volume and count.

    ``days`` lists the (key, day) pairs to cover; by default those that have a
    candle. The join is on the key and interval the candles are already
    partitioned by.
    """
    if days is None:
        days = candles.select(*keys, F.to_date("timestamp").alias("day")).distinct()
    grid = tg.day_grid(days.select(*keys, "day"), timeframe).drop("day")
    joined = grid.join(candles, [*keys, "timestamp"], "left")
    zero = {c for c in ("volume", "trade_count") if c in candles.columns}
    columns = []
    for c in candles.columns:
        if c == "timeframe":
            columns.append(F.lit(timeframe).alias(c))
        elif c == "timestamp_out":
            columns.append(F.coalesce(c, tg.emission_time(F.lit(None).cast("timestamp"), F.col("timestamp"))).alias(c))
        elif c in zero:
            columns.append(F.coalesce(c, F.lit(0).cast(candles.schema[c].dataType)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def fill_grids(
    candles: DataFrame, timeframes: Sequence[str], days: DataFrame, keys: Sequence[str] = KEYS, zero: Sequence[str] = ("volume", "trade_count")
) -> DataFrame:
    """As :func:`fill_grid` for several timeframes, with one join.

    ``days`` lists the (key, day) pairs to cover. Candles outside of these stay
    as they are. Of an added interval the ``zero`` columns are 0, the rest NULL.
    """
    pairs = days.select(*keys, "day").distinct()
    steps = None
    for timeframe in timeframes:
        one = tg.day_grid(pairs, timeframe).drop("day").withColumn("timeframe", F.lit(timeframe))
        steps = one if steps is None else steps.unionByName(one)
    joined = candles.join(steps, [*keys, "timeframe", "timestamp"], "full_outer")
    fill = {c: F.coalesce(c, F.lit(0).cast(candles.schema[c].dataType)).alias(c) for c in zero if c in candles.columns}
    fill["timestamp_out"] = F.coalesce("timestamp_out", tg.emission_time(F.lit(None).cast("timestamp"), F.col("timestamp"))).alias("timestamp_out")
    return joined.select(*[fill.get(c, F.col(c)) for c in candles.columns])


def describe(candles: DataFrame) -> DataFrame:
    """Add latency, change and colour of each candle."""
    change = F.col("close") - F.col("open")
    return candles.select(
        "*",
        tg.latency_ms("timestamp", "timestamp_out").alias("latency_ms"),
        change.alias("price_change"),
        F.when(F.col("open") == 0, 0.0).otherwise(change / F.col("open") * 100).alias("price_change_pct"),
        (F.col("close") >= F.col("open")).alias("is_green"),
    )


def rollup_aggregates(skip_empty: bool = False) -> list[Column]:
    """Aggregates that turn candles into one longer candle.

    By default an empty first or last child leaves a NULL open or close;
    ``skip_empty`` looks only at children with trades.
    """
    at = F.when(F.col("close").isNotNull(), F.col("timestamp")) if skip_empty else F.col("timestamp")
    return [
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.when(F.sum("volume") > 0, F.sum(F.col("vwap") * F.col("volume")) / F.sum("volume")).alias("vwap"),
        F.sum("trade_count").alias("trade_count"),
        F.max("timestamp_out").alias("_last_seen"),
    ]


def rollup(
    candles: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS, skip_empty: bool = False, extra: Sequence[Column] = ()
) -> DataFrame:
    """Candles of one or several longer timeframes from shorter ones, in one pass."""
    frame = interval_frame(candles, timeframe, keys, [*rollup_aggregates(skip_empty), *extra])
    return stamp(frame, timeframe, keys)


def rollup_all(
    candles: DataFrame, timeframes: Sequence[str] = ROLLUP_TIMEFRAMES, keys: Sequence[str] = KEYS, skip_empty: bool = False
) -> DataFrame:
    return rollup(candles, tuple(timeframes), keys, skip_empty)


def shifted(
    ticks: DataFrame,
    timeframe: str = "1m",
    latency_ms: int = 200,
    boundary_shift_seconds: int = 60,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Candles labelled by their close, from the time a trade is received.

    A trade counts for the day on which it is received, and for the interval
    holding its receive time plus the shift.
    """
    received = tg.plus_ms("local_timestamp", latency_ms)
    moved = ticks.withColumn("_received", received)
    order = F.struct("_received", "timestamp", "id")
    return (
        moved.groupBy(
            *keys,
            F.to_date("_received").alias("day"),
            tg.aligned(tg.plus_ms("_received", boundary_shift_seconds * 1000), timeframe).alias("candle_time"),
        )
        .agg(
            F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max_by("price", order).alias("close"), F.sum("amount").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
