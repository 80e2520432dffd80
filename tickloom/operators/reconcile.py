"""Comparison of candle sets: between timeframes and between sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg

PRICES = ("open", "high", "low", "close")
FIELDS = (*PRICES, "volume")
PRICE_TOLERANCE = 0.0001
VOLUME_TOLERANCE = 0.01
SERIES = ("instrument_key",)


def aggregate(base: DataFrame, timeframe: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """OHLCV of a longer timeframe from base candles."""
    return (
        base.groupBy(*keys, tg.aligned("timestamp", timeframe).alias("_start"))
        .agg(
            F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "timestamp").alias("close"), F.sum("volume").alias("volume"))
        .withColumnRenamed("_start", "timestamp")
    )


def one_per_time(candles: DataFrame, keys: Sequence[str] = SERIES, order: str | None = None) -> DataFrame:
    """One candle per time; of repeated ones the greatest by ``order`` (or by value) stays."""
    row = F.struct(*FIELDS)
    return candles.groupBy(*keys, "timestamp").agg(
        F.max_by(row, F.struct(order, *FIELDS) if order else row).alias("_c")).select(*keys, "timestamp", "_c.*")


def _relative(expected: Column, actual: Column) -> Column:
    return F.try_divide(F.abs(actual - expected), F.abs(expected))


def compare(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] = SERIES,
    price_tolerance: float = PRICE_TOLERANCE,
    volume_tolerance: float = VOLUME_TOLERANCE,
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """One row per common time and field: both values, difference, within tolerance.

    A value that one side lacks is an error, two missing ones agree. Against an
    expected zero, which has no relative difference, the tolerance is absolute.
    """
    a = expected.select(*keys, "timestamp", *[F.col(f).alias(f"e_{f}") for f in fields])
    b = actual.select(*keys, "timestamp", *[F.col(f).alias(f"a_{f}") for f in fields])
    cells = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"e_{f}").alias("expected"), F.col(f"a_{f}").alias("actual"),
                 F.lit(volume_tolerance if f == "volume" else price_tolerance).alias("tolerance")) for f in fields])
    joined = a.join(b, [*keys, "timestamp"]).select(*keys, "timestamp", F.inline(cells))
    difference = _relative(F.col("expected"), F.col("actual"))
    absolute = F.abs(F.col("actual")) <= F.col("tolerance")
    within = F.when(F.col("expected").isNull() | F.col("actual").isNull(), F.col("expected").isNull() & F.col("actual").isNull())
    within = within.when(F.col("expected") == 0, absolute).otherwise(difference <= F.col("tolerance"))
    return joined.withColumn("difference_pct", difference * 100).withColumn("within", within)


def errors(compared: DataFrame) -> DataFrame:
    return compared.where(~F.col("within")).drop("within", "tolerance")


def preserved(
    base: DataFrame, parents: DataFrame, timeframe: str, keys: Sequence[str] = SERIES, tolerance_seconds: int = 1,
    fields: Sequence[str] = PRICES, price_tolerance: float = PRICE_TOLERANCE, volume_tolerance: float = VOLUME_TOLERANCE,
) -> DataFrame:
    """Parents against their children, matched within ``tolerance_seconds``.

    Volume is compared only where the children traded.
    """
    expected = aggregate(base, timeframe, keys)
    compared = compare(expected, nearest_parent(expected, parents, keys, tolerance_seconds), keys, price_tolerance,
                       volume_tolerance, fields)
    return compared.where((F.col("field") != "volume") | (F.col("expected") > 0))


def nearest_parent(boundaries: DataFrame, parents: DataFrame, keys: Sequence[str], tolerance_seconds: int) -> DataFrame:
    """For each boundary the first parent candle within the tolerance.

    Both sides carry a coarse time bucket; the boundary side takes the three
    buckets that can hold a match, so this is an equi join on few rows.
    """
    width = max(2 * tolerance_seconds, 1) * 1_000_000
    at = tg.bucket_micros("timestamp", width)
    left = boundaries.select(*keys, F.col("timestamp").alias("_boundary")).withColumn(
        "_bucket", F.explode(F.array(*[tg.bucket_micros("_boundary", width) + F.lit(d * width) for d in (-1, 0, 1)])))
    right = parents.select(*keys, "timestamp", *FIELDS).withColumn("_bucket", at)
    gap = F.abs(F.unix_micros("timestamp") - F.unix_micros("_boundary"))
    near = left.join(right, [*keys, "_bucket"]).where(gap <= tolerance_seconds * 1_000_000)
    return near.groupBy(*keys, F.col("_boundary")).agg(
        F.min_by(F.struct(*FIELDS), F.col("timestamp")).alias("_c")).select(
        *keys, F.col("_boundary").alias("timestamp"), "_c.*")


def off_grid(candles: DataFrame, timeframe: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """Candles that do not start on a boundary, and by how much."""
    start = tg.aligned("timestamp", timeframe)
    return candles.where(F.col("timestamp") != start).select(
        *keys, "timestamp", start.alias("boundary"),
        ((F.unix_micros("timestamp") - F.unix_micros(start)) / 1e6).alias("offset_seconds"))


def verdict(compared: DataFrame, test_name: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row: common candles, number of errors and PASS or FAIL."""
    out = compared.groupBy(*keys).agg(
        F.count_if(F.col("field") == "open").alias("common_candles"), F.count_if(~F.col("within")).alias("error_count"))
    good = (F.col("error_count") == 0) & (F.col("common_candles") > 0)
    return out.select(*keys, F.lit(test_name).alias("test_name"), F.when(good, "PASS").otherwise("FAIL").alias("status"),
                      "common_candles", "error_count")


def aggregation_consistency(
    base: DataFrame, direct: DataFrame, timeframe: str, keys: Sequence[str] = SERIES, test_name: str = "aggregation_consistency",
    by_key: bool = False,
) -> DataFrame:
    """Base candles rolled up, against direct candles at common times."""
    return verdict(compare(aggregate(base, timeframe, keys), one_per_time(direct, keys), keys), test_name, keys if by_key else ())


def three_rules(a: DataFrame, b: DataFrame, keys: Sequence[str] = SERIES, by_key: bool = True) -> DataFrame:
    """Alignment, prices within 0.01 % and volume within 1 % between two sources.

    All three hold: PASS; only the volume rule fails: WARNING; else FAIL. A key of
    one source without a common time has no aligned candle and fails.
    """
    compared = compare(one_per_time(a, keys), one_per_time(b, keys), keys)
    price = F.col("field") != "volume"
    out = compared.groupBy(*(keys if by_key else ())).agg(
        F.count_if(F.col("field") == "open").alias("aligned_candles"),
        F.count_if(price & ~F.col("within")).alias("price_errors"), F.count_if(~price & ~F.col("within")).alias("volume_errors"))
    if by_key:
        counts = ("aligned_candles", "price_errors", "volume_errors")
        every = a.select(*keys).unionByName(b.select(*keys)).distinct()
        out = every.join(out, list(keys), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    rules = [F.col("aligned_candles") > 0, F.col("price_errors") == 0, F.col("volume_errors") == 0]
    status = F.when(rules[0] & rules[1] & rules[2], "PASS").when(rules[0] & rules[1], "WARNING").otherwise("FAIL")
    return out.withColumn("status", status)


def cross_source_aggregation(
    a_base: DataFrame, a_direct: DataFrame, b_base: DataFrame, b_direct: DataFrame, timeframe: str, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Each source's rollup against its own candles, and the sources against each other."""
    return (
        aggregation_consistency(a_base, a_direct, timeframe, keys, "first_source")
        .unionByName(aggregation_consistency(b_base, b_direct, timeframe, keys, "second_source"))
        .unionByName(verdict(compare(one_per_time(a_direct, keys), one_per_time(b_direct, keys), keys), "between_sources"))
    )


def timestamp_overlap(
    a: DataFrame, b: DataFrame, keys: Sequence[str] = SERIES, threshold: float = 0.8, tolerance_seconds: int = 1
) -> DataFrame:
    """Share of candle times the sources have in common, and the gaps of near pairs.

    Overlap comes from one aggregation of tagged times. Near pairs are found in
    time buckets as wide as the tolerance; candle times are at least 15 s apart,
    so a time has at most one partner at the default.
    """
    tagged = a.select(*keys, "timestamp", F.lit(1).alias("side")).unionByName(
        b.select(*keys, "timestamp", F.lit(2).alias("side")))
    times = tagged.groupBy(*keys, "timestamp").agg(F.bit_or("side").alias("sides"))
    overlap = times.groupBy(*keys).agg(
        F.count_if(F.col("sides") == 3).alias("common_timestamps"), F.count(F.lit(1)).alias("total_timestamps"))
    width = max(tolerance_seconds, 1) * 1_000_000
    left = times.where(F.col("sides").bitwiseAND(F.lit(1)) > 0).select(
        *keys, F.unix_micros("timestamp").alias("_x"),
        F.explode(F.array(*[tg.bucket_micros("timestamp", width) + F.lit(d * width) for d in (-1, 0, 1)])).alias("_bucket"))
    right = times.where(F.col("sides").bitwiseAND(F.lit(2)) > 0).select(
        *keys, F.unix_micros("timestamp").alias("_y"), tg.bucket_micros("timestamp", width).alias("_bucket"))
    gap = F.abs(F.col("_x") - F.col("_y")) / 1e6
    near = left.join(right, [*keys, "_bucket"]).where(gap <= tolerance_seconds).groupBy(*keys).agg(
        F.avg(gap).alias("avg_timestamp_diff"), F.max(gap).alias("max_timestamp_diff"))
    ratio = F.col("common_timestamps") / F.col("total_timestamps")
    return overlap.join(near, list(keys), "left").withColumn("overlap_ratio", ratio).withColumn(
        "status", F.when(ratio >= threshold, "PASS").otherwise("FAIL"))


def sweep(by_timeframe: dict[str, DataFrame], keys: Sequence[str] = SERIES) -> DataFrame:
    """Each timeframe rolled up to the next, against that one; reports unioned."""
    names = sorted(by_timeframe, key=tg.seconds)
    out = None
    for short, long in zip(names, names[1:]):
        row = aggregation_consistency(by_timeframe[short], by_timeframe[long], long, keys, f"{short}_to_{long}")
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("a sweep needs at least two timeframes")
    return out
