"""What should exist, what does, and what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import keys as k
from tickloom.operators import selection
from tickloom.operators.instruments import daily, dealt, windowed

TRIPLE = ("day", "instrument_key", "data_type")


def expected_days(instruments: DataFrame, start: str, end: str) -> DataFrame:
    """(day, instrument) pairs of every instrument's life inside the range."""
    return daily(instruments, start, end).select("day", "instrument_key").distinct()


def type_ranges(
    instruments: DataFrame, start: str, end: str, data_types: Sequence[str] | None = None
) -> DataFrame:
    """Ranges of days (``first_day``, ``last_day``) on which an instrument should have a data type.

    Types are read from the definition's list; ``data_types`` narrows them. Equal and
    overlapping windows become one range, so each day of a key and type lies in one.
    """
    typed = instruments.withColumn("data_type", F.explode(F.split("data_types", ","))).withColumn(
        "data_type", F.trim("data_type"))
    if data_types:
        typed = typed.where(F.col("data_type").isin(*data_types))
    windows = windowed(typed, start, end).select("instrument_key", "data_type", "first_day", "last_day").distinct()
    order = Window.partitionBy("instrument_key", "data_type").orderBy("first_day", "last_day")
    before = F.max("last_day").over(order.rowsBetween(Window.unboundedPreceding, -1))
    number = F.sum(F.when(F.col("first_day") <= F.date_add("_before", 1), 0).otherwise(1)).over(order)
    runs = windows.withColumn("_before", before).withColumn("_run", number)
    return runs.groupBy("instrument_key", "data_type", "_run").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).drop("_run")


def expected_types(
    instruments: DataFrame, start: str, end: str, data_types: Sequence[str] | None = None
) -> DataFrame:
    """(day, instrument, data type) triples that should have data: the days of :func:`type_ranges`, each once."""
    ranges = dealt(type_ranges(instruments, start, end, data_types))
    return ranges.select(F.explode(F.sequence("first_day", "last_day")).alias("day"), "instrument_key", "data_type")


def missing_days(expected: DataFrame, available: DataFrame) -> DataFrame:
    found = available.select("day", "instrument_key").distinct()
    return expected.join(found.hint("merge"), ["day", "instrument_key"], "left_anti").withColumns({
        "status": F.lit("missing"), "expected": F.lit(True), "available": F.lit(False)})


def missing_types(expected: DataFrame, available: DataFrame) -> DataFrame:
    return expected.join(available.select(*TRIPLE).distinct().hint("merge"), list(TRIPLE), "left_anti").withColumns({
        "status": F.lit("missing"), "expected": F.lit(True), "available": F.lit(False)})


def available_types(instruments: DataFrame, missing: DataFrame, start: str, end: str, data_types: Sequence[str]) -> DataFrame:
    """Each instrument and day with each of ``data_types``, less what is missing.

    The types are generated per row; nothing is crossed. Spark sizes rows made of
    ranges by the definitions they come from and would send all that is missing to
    the driver, so both sides are named for a merge.
    """
    rows = daily(instruments, start, end).select(
        "day", "instrument_key", "venue", "instrument_type", "base_asset", "quote_asset",
        F.explode(F.array(*[F.lit(t) for t in data_types])).alias("data_type"),
    )
    gone = missing.where(F.col("data_type").isin(*data_types)).select(*TRIPLE).distinct()
    return rows.join(gone.hint("merge"), list(TRIPLE), "left_anti")


def missing_report(expected: DataFrame, missing: DataFrame) -> DataFrame:
    """Missing counts in total and by day, instrument and data type, with coverage.

    Expected and missing rows are tagged and counted together, so coverage
    (available / expected) needs one shuffle and no join.
    """
    tagged = expected.select(*TRIPLE, F.lit(1).alias("e"), F.lit(0).alias("m")).unionByName(
        missing.select(*TRIPLE, F.lit(0).alias("e"), F.lit(1).alias("m")))
    grouped = tagged.groupingSets(
        [[F.col("day")], [F.col("instrument_key")], [F.col("data_type")], []],
        F.col("day"), F.col("instrument_key"), F.col("data_type"),
    ).agg(F.sum("e").alias("expected"), F.sum("m").alias("missing"), F.grouping_id().alias("_id"))
    level = F.when(F.col("_id") == 3, "day").when(F.col("_id") == 5, "instrument").when(
        F.col("_id") == 6, "data_type").otherwise("total")
    return grouped.select(
        level.alias("level"), *TRIPLE, "expected", "missing",
        ((F.col("expected") - F.col("missing")) / F.col("expected") * 100).alias("coverage_pct"))


def known_types(instruments: DataFrame) -> DataFrame:
    return instruments.select(F.explode(F.split("data_types", ",")).alias("data_type")).select(
        F.trim("data_type").alias("data_type")).distinct().orderBy("data_type")


def missing_to_targets(
    missing: DataFrame,
    instruments: DataFrame,
    venues: Sequence[str] | None = None,
    instrument_types: Sequence[str] | None = None,
    data_types: Sequence[str] | None = None,
) -> DataFrame:
    """What to fetch again, with the vendor's names, and why other rows are not.

    ``target_status``: found, venue_filtered, type_filtered, expired (no
    definition, and a YYMMDD part of the key lies before the day) or
    no_definition. An expired key is an option or future.
    """
    rows = missing.where(F.col("data_type").isin(*data_types)) if data_types else missing
    known = instruments.select(
        "instrument_key", "tardis_exchange", "tardis_symbol", "data_types", F.lit(True).alias("_known"))
    joined = rows.join(known, "instrument_key", "left")
    key = F.col("instrument_key")
    today = F.date_format("day", "yyMMdd")
    expired = (key.contains("OPTION") | key.contains("FUTURE")) & F.exists(
        F.split(key, "-"), lambda x: x.rlike(r"^\d{6}$") & (x < today))
    wanted_exchange, wanted_type = F.lit(True), F.lit(True)
    if venues:
        to_exchange = {venue: exchange for exchange, venue in k.EXCHANGE_TO_VENUE.items() if venue != "UPBIT"}
        wanted_exchange = F.col("tardis_exchange").isin(*[to_exchange.get(v, v.lower()) for v in venues])
    if instrument_types:
        wanted_type = F.lit(False)
        for t in instrument_types:
            wanted_type = wanted_type | key.contains(t)
    status = (
        F.when(F.col("_known") & ~wanted_exchange, "venue_filtered")
        .when(F.col("_known") & ~wanted_type, "type_filtered")
        .when(F.col("_known"), "found").when(expired, "expired").otherwise("no_definition")
    )
    return joined.select("day", "instrument_key", "data_type", "tardis_exchange", "tardis_symbol", "data_types",
                         status.alias("target_status"))


def availability_by_day(days: DataFrame, listing: DataFrame) -> DataFrame:
    """For each calendar day: whether anything exists, and the count."""
    counts = listing.groupBy("day").agg(F.count(F.lit(1)).alias("files"))
    return days.join(counts, "day", "left").select(
        "day", F.coalesce("files", F.lit(0)).alias("files"), F.col("files").isNotNull().alias("available"))


def coverage_pct(by_day: DataFrame) -> DataFrame:
    return by_day.agg(
        F.count(F.lit(1)).alias("days"), F.count_if("available").alias("available_days"),
        (F.avg(F.col("available").cast("int")) * 100).alias("coverage_pct"))


# -- groups of instruments on one underlying ------------------------------------------

def underlying_groups(
    instruments: DataFrame, available: DataFrame, data_types: Sequence[str], per: Sequence[str] = ()
) -> DataFrame:
    """Every instrument with its underlying and whether the whole group is complete.

    A group counts only if each of its instruments has each data type. With no
    available data every group fails. Groups are reduced to one flag before the
    join back, so a large group is never collected. ``per`` names columns of both
    sides, such as the day, by which groups are judged apart.
    """
    rows = instruments.select(
        k.underlying(F.col("instrument_type"), F.col("base_asset"), F.col("underlying")).alias("underlying"),
        *per, "instrument_key", "instrument_type",
    ).where(F.col("underlying").isNotNull() & (F.col("underlying") != "")).distinct()
    have = (
        available.where(F.col("data_type").isin(*data_types))
        .groupBy(*per, "instrument_key").agg(F.count_distinct("data_type").alias("_types"))
    )
    complete = F.coalesce(F.col("_types"), F.lit(0)) == len(set(data_types))
    checked = rows.join(have, [*per, "instrument_key"], "left").withColumn("complete", complete).drop("_types")
    groups = checked.groupBy(*per, "underlying").agg(F.bool_and("complete").alias("group_valid"))
    return checked.join(groups, [*per, "underlying"])


def eligible_days(
    instruments: DataFrame, available: DataFrame, start: str, end: str, data_types: Sequence[str],
    instrument_types: Sequence[str] | None = None,
) -> DataFrame:
    """(day, instrument) pairs whose whole group is complete on that day, of the instruments that live on it."""
    groups = underlying_groups(daily(instruments, start, end), available, data_types, per=["day"])
    return eligible(groups, instrument_types).select("day", "instrument_key").distinct()


def eligible(groups: DataFrame, instrument_types: Sequence[str] | None = None) -> DataFrame:
    out = groups.where("group_valid")
    return out.where(F.col("instrument_type").isin(*instrument_types)) if instrument_types else out


def underlying_summary(groups: DataFrame) -> DataFrame:
    """Valid and skipped instruments per underlying and in total."""
    out = groups.rollup("underlying").agg(
        F.count(F.lit(1)).alias("instruments"), F.count_if("group_valid").alias("valid_instruments"),
        F.count_if(~F.col("group_valid")).alias("skipped_instruments"))
    return out.withColumn("validation_rate", F.col("valid_instruments") / F.col("instruments") * 100)


# -- summaries of stored data ---------------------------------------------------------

def tick_summary(ticks: DataFrame) -> DataFrame:
    """Rows per instrument and data type, and the instrument's total."""
    per_type = ticks.groupBy("instrument_key", "data_type").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
    totals = per_type.groupBy("instrument_key").agg(F.sum("rows").alias("total_rows"))
    return per_type.join(totals, "instrument_key")


def candle_summary(candles: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Rows, time span and present feature values per instrument and timeframe."""
    return candles.groupBy("instrument_key", "timeframe").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        *[F.count(c).alias(f"{c}_present") for c in features])


def rows_per_day(frame: DataFrame, time: str = "timestamp", *more: str) -> DataFrame:
    return frame.groupBy(F.to_date(time).alias("day"), *more).agg(F.count(F.lit(1)).alias("rows"))


def volume_by_minute(candles: DataFrame, keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    return candles.groupBy(*keys, F.date_trunc("MINUTE", "timestamp").alias("minute")).agg(
        F.sum("volume").alias("total_volume"), F.avg("price_vwap").alias("avg_vwap"), F.count(F.lit(1)).alias("candles"))


def job_totals(results: DataFrame) -> DataFrame:
    """Totals over a table of job results (``success, records, seconds``)."""
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.try_divide(F.count_if("success") * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("percentage"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"))


def recent(frame: DataFrame, where: Column, n: int, time: str = "timestamp") -> DataFrame:
    """The latest ``n`` rows that satisfy ``where``; of equal times those that come first by key, then by the other columns."""
    ties = [c for c in dict.fromkeys(["instrument_key", *frame.columns]) if c in frame.columns and c != time]
    return frame.where(where).orderBy(F.col(time).desc(), *ties).limit(n)


def signature(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A content signature that ignores row order: count, sum and xor of row hashes."""
    # Each value goes in with its length, so no two rows write alike; 60 bits of the digest fit a LONG.
    def written(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("~"))

    digest = F.sha2(F.concat(*[written(c) for c in columns]), 256)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(number).alias("hash_xor"),
        F.sum(number.cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def latency_stats(ticks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, median, 95th percentile and maximum delay, exact, in milliseconds.

    Delays are whole microseconds; both percentiles are selected by
    :func:`selection.quantiles`, whatever the number of distinct delays. A key whose
    ticks have no delay has its number of ticks only.
    """
    delay = F.unix_micros("local_timestamp") - F.unix_micros("timestamp")
    ms = delay / 1000.0
    totals = ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ticks"), F.avg(ms).alias("mean_ms"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"))
    picked = selection.quantiles(ticks, keys, delay, {"median_ms": 0.5, "p95_ms": 0.95}, scale=1000.0)
    if keys:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"p.{k}"))
        joined = totals.alias("t").join(picked.alias("p"), same, "left").select("t.*", "median_ms", "p95_ms")
    else:
        joined = totals.withColumn("_one", F.lit(1)).join(picked.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    return joined.select(*keys, "ticks", "mean_ms", "median_ms", "p95_ms", "min_ms", "max_ms")
