"""Live candles held against those of a second source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg

PRICES = ("open", "high", "low", "close")


def _side(candles: DataFrame, name: str, lateness: str, fields: Sequence[str]) -> DataFrame:
    """What the join keeps of a source; null where it does not say when a candle came in."""
    received = F.col("received") if "received" in candles.columns else F.lit(None)
    return candles.withWatermark("timestamp", lateness).select(
        F.col("instrument_key").alias(f"{name}_key"), F.col("timestamp").alias(f"{name}_time"),
        *[F.col(f).cast("double").alias(f"{name}_{f}") for f in fields], received.cast("timestamp").alias(f"{name}_received"))


def _differs(a: Column, b: Column, tolerance: float) -> Column:
    """Beyond the relative tolerance; a value that one source lacks differs."""
    away = F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b))
    return F.when(a.isNull() & b.isNull(), False).otherwise(F.coalesce(away, F.lit(True)))


def _finding(source: str, test: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), F.lit(test).alias("test_name"), status.alias("status"), detail.cast("string").alias("detail"))


def against_second_source(
    live: DataFrame, other: DataFrame, timeframe: str, lateness: str = "10 minutes", price_tolerance: float = 1e-4,
    volume_tolerance: float = 1e-2, max_age_seconds: int = 300,
) -> DataFrame:
    """Findings per candle of two sources: instrument_key, timestamp, source, test_name, status, detail.

    Both frames hold final candles of one timeframe and, if known, when each was
    ``received``. As streams they are joined with a watermark on either side, so state
    holds no more than ``lateness`` of candles that still wait for their partner;
    ``cross_source`` of a candle without one is found when the watermark passes it.

    ``cross_source``: FAIL where a side is missing or fields differ (the detail names
    them). ``freshness``, per source: WARN where a candle came in more than
    ``max_age_seconds`` after its end. ``utc``, per source: FAIL where a start is off
    the UTC grid, or where a candle came in that long before its end, as one stamped
    with a local time ahead of UTC does. Both are SKIP for an unknown arrival on the
    grid. A null key or time finds no partner; repeated candles pair with each.
    """
    fields = (*PRICES, "volume")
    a, b = _side(live, "live", lateness, fields), _side(other, "other", lateness, fields)
    both = a.join(b, (F.col("live_key") == F.col("other_key")) & (F.col("live_time") == F.col("other_time")), "full_outer")

    step = tg.seconds(timeframe) * 1_000_000
    missing = F.when(F.col("live_time").isNull(), "live: missing").when(F.col("other_time").isNull(), "other: missing")
    different = F.concat_ws(",", *[
        F.when(_differs(F.col(f"live_{f}"), F.col(f"other_{f}"), volume_tolerance if f == "volume" else price_tolerance), f) for f in fields])
    detail = F.coalesce(missing, F.when(different != "", different))
    findings = [_finding("both", "cross_source", F.when(detail.isNull(), "PASS").otherwise("FAIL"), detail)]
    for name in ("live", "other"):
        start = F.unix_micros(f"{name}_time")
        age = (F.unix_micros(f"{name}_received") - start - step) / 1e6
        fresh = F.when(age.isNull(), "SKIP").when(age > max_age_seconds, "WARN").otherwise("PASS")
        zone = F.when(F.pmod(start, F.lit(step)) != 0, "FAIL").when(age.isNull(), "SKIP").when(age < -max_age_seconds, "FAIL").otherwise("PASS")
        there = F.col(f"{name}_time").isNotNull()
        findings += [F.when(there, _finding(name, "freshness", fresh, age)), F.when(there, _finding(name, "utc", zone, age))]
    return both.select(
        F.coalesce("live_key", "other_key").alias("instrument_key"), F.coalesce("live_time", "other_time").alias("timestamp"),
        F.explode(F.array_compact(F.array(*findings))).alias("f"),
    ).select("instrument_key", "timestamp", "f.*")


def by_source(findings: DataFrame) -> DataFrame:
    """Stored findings per instrument, source and test: candles, problems (WARN or FAIL) and the worst status."""
    worst = F.when(F.bool_or(F.col("status") == "FAIL"), "FAIL").when(F.bool_or(F.col("status") == "WARN"), "WARN").when(
        F.bool_or(F.col("status") == "PASS"), "PASS").otherwise("SKIP")
    return findings.groupBy("instrument_key", "source", "test_name").agg(
        F.count(F.lit(1)).alias("candles"), F.count_if(F.col("status").isin("FAIL", "WARN")).alias("problems"), worst.alias("status"))
