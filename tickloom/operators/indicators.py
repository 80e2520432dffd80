"""Rolling technical indicators over candles.

History means candles with a price; an empty candle gets no row. Windows run
over chunks of the numbered series (see ``series.chunked``), never over a whole
series, so a long history is spread over tasks.

Exponential averages use the closed form of the recurrence inside a chunk:
``ema[j] = f^j * sum(w[i] * x[i] * f^-i)`` with ``f = 1 - alpha``. What a chunk
does not see weighs less than ``f^HALO`` (2e-17 for 20 periods), below the
resolution of a double. The largest scale factor, ``(2/3)^-(CHUNK + HALO)``, is
about 1e248. A series that goes on from an earlier run starts from the averages
carried over, not from copied history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg
from tickloom.operators.series import chunked, numbered, running_position
from tickloom.schemas import INDICATORS

CHUNK = 1024
HALO = 384
SERIES = ("instrument_key", "timeframe")
# Exponential averages: column and periods. What a series carries to its next run: rows as far back as windows reach, with these.
AVERAGES = {"ema_5": ("close", 5), "ema_10": ("close", 10), "ema_20": ("close", 20), "volume_ema_5": ("volume", 5)}
REACH = 20
CARRIED = ("timestamp", "high", "low", "close", "volume", "vwap", "trade_count", "row", *AVERAGES)

#: Volumes that differ by less than this share are the same sum, added up in another order.
SAME_VOLUME = 1e-9


def indicators(
    candles: DataFrame,
    timeframe: str | None = None,
    keys: Sequence[str] = SERIES,
    chunk: int = CHUNK,
    halo: int = HALO,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The 26 indicators of each candle.

    With ``timeframe`` None the candles may mix timeframes, named by their
    ``timeframe`` column.
    """
    out = scored(candles, timeframe, keys, chunk, halo, keep)
    return out.select(*keys, "timestamp", *[c for c in keep if c not in (*keys, "timestamp")], *INDICATORS)


def scored(
    candles: DataFrame,
    timeframe: str | None = None,
    keys: Sequence[str] = SERIES,
    chunk: int = CHUNK,
    halo: int = HALO,
    keep: Sequence[str] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """Each candle with its indicators and its position ``row`` in the series, the columns a later run needs of it.

    ``before`` holds the last rows an earlier run returned for each series, at least
    ``REACH`` where there are so many. The series goes on behind them: positions are
    counted on, windows reach back into them and averages start from their values,
    so the result is that of one run over everything.
    """
    if timeframe is not None:
        tg.seconds(timeframe)
        candles = candles.where(F.col("timeframe") == timeframe)
    used = [*keys, *[c for c in CARRIED if c not in ("row", *AVERAGES)]]
    used += [c for c in keep if c not in used]
    history = numbered(candles.where(F.col("close").isNotNull()).select(*used), keys).withColumn("_old", F.lit(False))
    if before is not None:
        past = before.groupBy(*keys).agg(F.max("row").alias("_seen"))
        old = before.join(past, [*keys]).withColumnRenamed("row", "_rn").withColumn("_old", F.lit(True))
        history = history.join(past, [*keys], "left").withColumns(
            {"_seen": F.coalesce("_seen", F.lit(0)), "_rn": F.col("_rn") + F.coalesce("_seen", F.lit(0))})
        history = history.unionByName(old.withColumnsRenamed({a: f"_{a}" for a in AVERAGES}), allowMissingColumns=True)
    series = chunked(history, chunk, halo).withColumn("_j", running_position(chunk, halo))

    part = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    rn, close, volume = F.col("_rn"), F.col("close"), F.col("volume")

    def since(n: int, value: Column) -> Column:
        return F.when(rn >= n, value)

    def mean(column: Column, n: int) -> Column:
        return since(n, F.avg(column).over(part.rowsBetween(-(n - 1), 0)))

    def ema(name: str) -> Column:
        source, n = AVERAGES[name]
        alpha, first, value = 2.0 / (n + 1), F.lit(n), F.col(source)
        if before is not None:  # the average starts at the last row seen before, with the value it had there
            first = F.greatest(first, "_seen")
            value = F.when((rn == F.col("_seen")) & (rn >= n), F.col(f"_{name}")).otherwise(value)
        factor = F.lit(1 - alpha)
        weight = F.when(rn < first, 0.0).when(rn == first, 1.0).otherwise(alpha)
        scaled = weight * value * F.pow(factor, -F.col("_j"))
        return since(n, F.pow(factor, F.col("_j")) * F.sum(scaled).over(part.rowsBetween(Window.unboundedPreceding, 0)))

    lags = {f"_p{i}": F.lag("close", i).over(part) for i in range(1, 6)}
    stepped = series.withColumns({**lags, "_v1": F.lag("volume", 1).over(part)})
    p = [close] + [F.col(f"_p{i}") for i in range(1, 6)]
    gain = F.greatest(p[0] - p[1], F.lit(0.0))
    loss = F.greatest(p[1] - p[0], F.lit(0.0))

    stepped = stepped.withColumns({"_gain": gain, "_loss": loss})
    rolled = stepped.withColumns({
        "sma_5": mean(close, 5), "sma_10": mean(close, 10), "sma_20": mean(close, 20),
        "volume_sma_5": mean(volume, 5), **{name: ema(name) for name in AVERAGES},
        "price_volatility_5": since(5, F.stddev_pop("close").over(part.rowsBetween(-4, 0))),
        "price_volatility_10": since(10, F.stddev_pop("close").over(part.rowsBetween(-9, 0))),
        "_avg_gain": since(6, F.avg("_gain").over(part.rowsBetween(-4, 0))),
        "_avg_loss": since(6, F.avg("_loss").over(part.rowsBetween(-4, 0))),
    })

    band = 2 * F.col("price_volatility_10")
    lower, upper = F.col("sma_20") - band, F.col("sma_20") + band
    volume_change = volume - F.col("_v1")
    length = F.lit(tg.seconds(timeframe)) if timeframe else tg.seconds_column(F.col("timeframe"))
    out = rolled.where("_own AND NOT _old").withColumns({
        "wma_5": since(5, (5 * p[0] + 4 * p[1] + 3 * p[2] + 2 * p[3] + p[4]) / 15.0),
        "price_momentum_3": since(4, F.try_divide(p[0] - p[3], p[3])),
        "price_momentum_5": since(6, F.try_divide(p[0] - p[5], p[5])),
        "price_velocity": since(3, p[0] - p[1]),
        "price_acceleration": since(4, (p[0] - p[1]) - (p[1] - p[2])),
        "volume_ratio": F.when(F.col("volume_sma_5") > 0, volume / F.col("volume_sma_5")),
        "vwap_deviation": F.when(F.col("vwap") > 0, (close - F.col("vwap")) / F.col("vwap")),
        "high_low_ratio": F.when(close > 0, (F.col("high") - F.col("low")) / close),
        "close_to_close_return": since(2, F.when((p[0] > 0) & (p[1] > 0), F.log(p[0] / p[1]))),
        "trade_intensity": F.col("trade_count") / length,
        "avg_trade_size": F.when(F.col("trade_count") > 0, volume / F.col("trade_count")),
        "price_impact": since(2, F.when(
            (volume_change > SAME_VOLUME * volume) & (F.col("trade_count") > 0), F.abs(p[0] - p[1]) / volume_change)),
        "bid_ask_spread_proxy": F.col("high") - F.col("low"),
        "rsi_5": F.when(F.col("_avg_loss") == 0, 100.0)
        .otherwise(100 - 100 / (1 + F.col("_avg_gain") / F.col("_avg_loss"))),
        "bollinger_position": F.when(
            (F.col("sma_20") != 0) & (F.col("price_volatility_10") != 0) & (upper != lower),
            (close - lower) / (upper - lower)),
        "macd_signal": F.when((F.col("ema_5") != 0) & (F.col("ema_10") != 0), F.col("ema_5") - F.col("ema_10")),
    })
    return out.select(*used, F.col("_rn").alias("row"), *[c for c in INDICATORS if c not in used])


def latest(frame: DataFrame, n: int = 1, keys: Sequence[str] = SERIES, time: str = "timestamp") -> DataFrame:
    """The last ``n`` rows of each series; Spark limits each input partition first."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    return frame.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n).drop("_place")


def feature_summary(frame: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Rows, time span and number of values present per indicator, for each series."""
    return frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        *[F.count(c).alias(c) for c in INDICATORS],
    )
