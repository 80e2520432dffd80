"""UTC timeframe arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import EMISSION_DELAY_MS, TIMEFRAMES


def seconds(timeframe: str) -> int:
    """Length of a timeframe; an unknown name raises ``ValueError``."""
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unsupported timeframe {timeframe!r}; known: {list(TIMEFRAMES)}")
    return TIMEFRAMES[timeframe]


def seconds_column(timeframe: Column) -> Column:
    """Length of a timeframe held in a column; NULL when unknown."""
    lookup = F.create_map(*[F.lit(x) for pair in TIMEFRAMES.items() for x in pair])
    return F.element_at(lookup, timeframe).cast("long")


def _col(ts: Column | str) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def bucket_micros(ts: Column | str, micros: int | Column) -> Column:
    """Start of the bucket holding ``ts``, in microseconds; correct before 1970 too."""
    at = F.unix_micros(_col(ts))
    width = F.lit(micros).cast("long") if isinstance(micros, int) else micros
    return at - F.pmod(at, width)


def aligned(ts: Column | str, timeframe: str) -> Column:
    """Start of the timeframe interval holding ``ts``."""
    return F.timestamp_micros(bucket_micros(ts, seconds(timeframe) * 1_000_000))


def aligned_by(ts: Column | str, timeframe: Column) -> Column:
    """As :func:`aligned`, with the timeframe in a column."""
    return F.timestamp_micros(bucket_micros(ts, seconds_column(timeframe) * F.lit(1_000_000)))


def next_boundary(ts: Column | str, timeframe: str) -> Column:
    return F.timestamp_micros(
        bucket_micros(ts, seconds(timeframe) * 1_000_000) + F.lit(seconds(timeframe) * 1_000_000)
    )


def seconds_to_next(ts: Column | str, timeframe: str) -> Column:
    width = seconds(timeframe) * 1_000_000
    return (bucket_micros(ts, width) + F.lit(width) - F.unix_micros(_col(ts))) / F.lit(1e6)


def is_aligned(ts: Column | str, timeframe: str) -> Column:
    return F.pmod(F.unix_micros(_col(ts)), F.lit(seconds(timeframe) * 1_000_000)) == 0


def alignments(ts: Column | str, timeframes: tuple[str, ...] = tuple(TIMEFRAMES)) -> Column:
    """Map of timeframe name to the interval start holding ``ts``."""
    return F.create_map(*[x for tf in timeframes for x in (F.lit(tf), aligned(ts, tf))])


def latency_ms(earlier: Column | str, later: Column | str) -> Column:
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(1000.0)


def plus_ms(ts: Column | str, ms: int) -> Column:
    return F.timestamp_micros(F.unix_micros(_col(ts)) + F.lit(ms * 1000))


def emission_time(last_input: Column, boundary: Column) -> Column:
    """When a row built from an interval becomes available."""
    return plus_ms(F.coalesce(last_input, boundary), EMISSION_DELAY_MS)


def day_grid(days: DataFrame, timeframe: str, day: str = "day") -> DataFrame:
    """One row per boundary of each row's day, in column ``timestamp``.

    The rows are generated inside the task that holds the day; nothing is
    crossed or broadcast.
    """
    step = seconds(timeframe)
    start = F.col(day).cast("timestamp")
    last = F.timestamp_micros(F.unix_micros(start) + F.lit((86400 - step) * 1_000_000))
    return days.withColumn(
        "timestamp", F.explode(F.sequence(start, last, F.expr(f"INTERVAL {step} SECONDS")))
    )


def calendar(spark, start: str, end: str) -> DataFrame:
    """All days from ``start`` to ``end`` in column ``day``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")
    )
