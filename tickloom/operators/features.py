"""Per-candle features from trades, liquidations, derivative tickers and options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg
from tickloom.operators.candles import KEYS, Timeframes, candle_aggregates, interval_frame, rollup, series_keys, stamp
from tickloom.operators.series import with_previous
from tickloom.schemas import DERIVATIVE_FEATURES, LIQUIDATION_FEATURES, OPTION_FEATURES, ROLLUP_TIMEFRAMES


def _volume(side: str) -> Column:
    return F.sum(F.when(F.col("side") == side, F.col("amount")).otherwise(0.0))


def trade_aggregates() -> list[Column]:
    # Delays are whole microseconds, so the exact median holds at most one entry
    # per distinct delay, however many trades the interval has.
    delay = tg.latency_ms("timestamp", "local_timestamp")
    return [
        _volume("buy").alias("buy_volume_sum"),
        _volume("sell").alias("sell_volume_sum"),
        F.avg("amount").alias("size_avg"),
        F.try_divide(F.sum(F.col("price") * F.col("amount")), F.sum("amount")).alias("price_vwap"),
        F.median(delay).alias("delay_median"),
        F.max(delay).alias("delay_max"),
        F.min(delay).alias("delay_min"),
        F.avg(delay).alias("delay_mean"),
    ]


def trade_features(trades: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("trade_count"), *trade_aggregates()]
    return interval_frame(trades, timeframe, keys, aggregates)


def liquidation_features(liquidations: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    return interval_frame(liquidations, timeframe, keys, [
        F.count(F.lit(1)).alias("liquidation_count"),
        _volume("buy").alias("liquidation_buy_volume"),
        _volume("sell").alias("liquidation_sell_volume"),
    ])


def derivative_features(ticker: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    """The last value present in each interval, per column."""
    order = F.struct(*[c for c in ("timestamp", "local_timestamp", "id") if c in ticker.columns])
    return interval_frame(ticker, timeframe, keys, [
        F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in DERIVATIVE_FEATURES
    ])


def carry_forward(frame: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Fill NULLs with the latest earlier value of the same key and day."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys, F.to_date("timestamp")).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def oi_features(frame: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Open-interest change since the previous candle and liquidations by its sign."""
    change = F.col("open_interest") - F.col("prev_open_interest")
    liquidated = F.col("liquidation_buy_volume") + F.col("liquidation_sell_volume")
    stepped = with_previous(frame, keys, "timestamp", ["open_interest"], block_seconds=86400)
    return stepped.withColumns({
        "oi_change": change,
        "liquidation_with_rising_oi": F.when(change > 0, liquidated),
        "liquidation_with_falling_oi": F.when(change < 0, liquidated),
    }).drop("prev_open_interest")


def options_features(chain: DataFrame, timeframe: Timeframes) -> DataFrame:
    """25-delta put/call ratio and at-the-money level of mark volatility.

    Per underlying and interval: the latest quote of each contract, the nearest
    expiry after the interval start, then the contract whose absolute delta is
    closest (ties to the lower strike). Three aggregations, each narrower than
    the one before; no list is collected. Several timeframes take one scan and
    add a ``timeframe`` column.
    """
    series = series_keys(timeframe, ["underlying_index"])
    bucket = [*series, "timestamp"]
    order = F.struct(*[c for c in ("timestamp", "local_timestamp", "id") if c in chain.columns])
    if isinstance(timeframe, str):
        start = tg.aligned("timestamp", timeframe)
    else:
        chain = chain.drop("timeframe").withColumn("timeframe", F.explode(F.array(*[F.lit(tf) for tf in timeframe])))
        start = tg.aligned_by("timestamp", F.col("timeframe"))
    latest = (
        chain.groupBy(*series, start.alias("_start"), "type", "strike_price", "expiration")
        .agg(F.max_by(F.struct("delta", "mark_iv"), order).alias("q"))
        .select(*series, F.col("_start").alias("timestamp"), "type", "strike_price", "expiration",
                "q.delta", "q.mark_iv")
        .where(F.col("expiration") >= F.col("timestamp"))
    )

    def nearest(target: float, side: str | None) -> Column:
        gap = F.round(F.abs(F.abs(F.col("delta")) - F.lit(target)), 9)
        usable = F.col("mark_iv").isNotNull() & F.col("delta").isNotNull()
        if side:
            usable = usable & (F.col("type") == side)
        return F.min_by("mark_iv", F.when(usable, F.struct(gap, F.col("strike_price"), F.col("type"))))

    per_expiry = latest.groupBy(*bucket, "expiration").agg(
        nearest(0.25, "put").alias("put_iv"),
        nearest(0.25, "call").alias("call_iv"),
        nearest(0.50, None).alias("atm_mark_iv"),
    )
    first = per_expiry.groupBy(*bucket).agg(
        F.min_by(F.struct("expiration", "put_iv", "call_iv", "atm_mark_iv"), F.col("expiration")).alias("f"))
    return first.select(
        *bucket, "f.expiration",
        F.try_divide("f.put_iv", "f.call_iv").alias("skew_25d_put_call_ratio"), "f.atm_mark_iv")


def with_options(candles: DataFrame, chain: DataFrame, underlyings: DataFrame, timeframe: Timeframes) -> DataFrame:
    """Add the option features of each instrument's underlying to its candles.

    ``underlyings`` has one row (instrument_key, underlying_index) per instrument.
    A candle without quotes in its interval has NULLs, as has an instrument
    without an underlying.
    """
    found = options_features(chain, timeframe).select(*series_keys(timeframe, ["underlying_index"]), "timestamp", *OPTION_FEATURES)
    named = candles.join(underlyings.select("instrument_key", "underlying_index"), "instrument_key", "left")
    joined = named.join(found, [*series_keys(timeframe, ["underlying_index"]), "timestamp"], "left")
    return joined.select(*candles.columns, *OPTION_FEATURES)


def candles_with_features(
    trades: DataFrame,
    timeframe: Timeframes,
    liquidations: DataFrame | None = None,
    ticker: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Candles with all tick features of the interval.

    An interval that holds any of the three kinds has a row; without a trade its
    prices are NULL, its volume and count 0. Candle and trade features come from
    one aggregation, several timeframes from one scan. The joins are on the key
    and interval every side is already partitioned by.
    """
    base = interval_frame(trades, timeframe, keys, candle_aggregates(trades, timeframe) + trade_aggregates())
    series = series_keys(timeframe, keys)
    on = [*series, "timestamp"]
    none = {c: F.coalesce(c, F.lit(0)) for c in ("volume", "trade_count", "buy_volume_sum", "sell_volume_sum")}
    if liquidations is not None:
        base = base.join(liquidation_features(liquidations, timeframe, keys), on, "full_outer")
        none |= {c: F.coalesce(c, F.lit(0)) for c in LIQUIDATION_FEATURES}
    if ticker is not None:
        base = base.join(derivative_features(ticker, timeframe, keys), on, "full_outer")
    base = stamp(base.withColumns(none), timeframe, keys)
    if liquidations is not None and ticker is not None:
        base = oi_features(base, series)
    return base


def last_values(columns: Sequence[str]) -> list[Column]:
    """The value of the latest child that has one, per column."""
    return [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("timestamp"))).alias(c) for c in columns]


def feature_rollup_aggregates(spec_delays: bool = False) -> list[Column]:
    """Aggregates of feature columns over child candles.

    Delays become the median of the child values; ``spec_delays`` takes the
    maximum and minimum for ``delay_max`` and ``delay_min`` instead.
    """
    sums = ("buy_volume_sum", "sell_volume_sum", *LIQUIDATION_FEATURES)
    weighted = {"size_avg": "trade_count", "price_vwap": "volume"}
    out = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    for c, by in weighted.items():
        weight = F.when(F.col(c).isNotNull(), F.col(by))
        out.append(F.try_divide(F.sum(F.col(c) * weight), F.sum(weight)).alias(c))
    for c in ("delay_median", "delay_max", "delay_min", "delay_mean"):
        if spec_delays and c == "delay_max":
            out.append(F.max(c).alias(c))
        elif spec_delays and c == "delay_min":
            out.append(F.min(c).alias(c))
        else:
            out.append(F.median(c).alias(c))
    return out + last_values(DERIVATIVE_FEATURES)


def rollup_features(
    candles: DataFrame,
    timeframes: Sequence[str] = ROLLUP_TIMEFRAMES,
    keys: Sequence[str] = KEYS,
    spec_delays: bool = False,
    skip_empty: bool = False,
) -> DataFrame:
    """Candles and features of all longer timeframes, in one pass; option features, where there are any, by their last value."""
    options = last_values([c for c in OPTION_FEATURES if c in candles.columns])
    return rollup(candles, tuple(timeframes), keys, skip_empty, [*feature_rollup_aggregates(spec_delays), *options])
