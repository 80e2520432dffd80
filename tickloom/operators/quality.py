"""Data-quality checks. Each returns a small table of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import numbered, with_previous
from tickloom.schemas import BOOK_LEVELS, SIDES

# Columns each data type must have.
REQUIRED = {
    "trades": ("timestamp", "price", "amount", "side"),
    "book_snapshot_5": ("timestamp", "ask_price_1", "bid_price_1"),
    "derivative_ticker": ("timestamp", "last_price"),
    "liquidations": ("timestamp", "price", "amount", "side"),
    "options_chain": ("timestamp", "strike_price", "type"),
}
# Plausible ranges.
_PRICE, _AMOUNT = (0.001, 1_000_000.0), (0.00000001, 1_000_000.0)
RANGES = {
    "trades": {"price": _PRICE, "amount": _AMOUNT},
    "book_snapshot_5": {
        "bid_price_1": _PRICE, "ask_price_1": _PRICE, "bid_volume_1": _AMOUNT, "ask_volume_1": _AMOUNT},
    "derivative_ticker": {"last_price": _PRICE, "mark_price": _PRICE, "index_price": _PRICE},
}
FIRST_YEAR, LAST_YEAR = 2020, 2030

# A block of ticks with more rows is cut up before it is put into one window.
SPLIT_ROWS = 1_000_000


# -- rows ------------------------------------------------------------------------

def row_errors(data_type: str) -> Column:
    """Array of the rules a tick row breaks; empty when it is valid."""
    positive = lambda c: ~F.coalesce(F.col(c) > 0, F.lit(False))
    rules: list[tuple[Column, str]] = []
    if data_type in ("trades", "liquidations"):
        rules = [(positive("price"), "price"), (positive("amount"), "amount"),
                 (~F.coalesce(F.col("side").isin(*SIDES), F.lit(False)), "side")]
    elif data_type == "book_snapshot_5":
        levels = [f"{s}_{w}_{i}" for i in range(1, BOOK_LEVELS + 1) for s in ("bid", "ask") for w in ("price", "volume")]
        rules = [(positive(c), c) for c in levels]
        rules.append((~F.coalesce(F.col("bid_price_1") < F.col("ask_price_1"), F.lit(False)), "spread"))
    elif data_type == "options_chain":
        rules = [(F.col("timestamp").isNull(), "timestamp"), (F.col("local_timestamp").isNull(), "local_timestamp"),
                 (F.col("expiration").isNull(), "expiration")]
    elif data_type == "derivative_ticker":
        rules = [(F.col("timestamp").isNull(), "timestamp")]
    else:
        raise ValueError(f"unknown data type {data_type!r}")
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in rules]))


def split_valid(ticks: DataFrame, data_type: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their ``errors``."""
    marked = ticks.withColumn("errors", row_errors(data_type))
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0)


# -- columns ---------------------------------------------------------------------

def completeness(ticks: DataFrame, data_type: str) -> DataFrame:
    """Per required column: present, NULL count; a complete-row ratio under 0.95 warns."""
    required = REQUIRED[data_type]
    present = [c for c in required if c in ticks.columns]
    whole = F.lit(True)
    for c in present:
        whole = whole & F.col(c).isNotNull()
    totals = ticks.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("complete_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in present])
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(c in present).alias("present"),
                 (F.col(f"_{c}") if c in present else F.lit(0).cast("long")).alias("nulls")) for c in required])
    ratio = F.try_divide(F.col("complete_rows"), F.col("rows"))
    return totals.select("rows", "complete_rows", ratio.alias("complete_ratio"), F.inline(parts)).withColumn(
        "status", F.when(~F.col("present"), "FAIL").when(
            (F.col("nulls") > 0) | (F.col("complete_ratio") < 0.95), "WARNING").otherwise("PASS"))


def consistency(ticks: DataFrame, keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Repeated timestamps, negative prices and amounts, and unknown sides, per key.

    Repeats are counted through (key, time) groups, whose partial counts are
    combined before the shuffle.
    """
    per_time = ticks.groupBy(*keys, "timestamp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") < 0).alias("p"), F.count_if(F.col("amount") < 0).alias("a"),
        F.count_if(~F.coalesce(F.col("side").isin(*SIDES), F.lit(False))).alias("s"))
    out = per_time.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_timestamps"), F.sum("p").alias("negative_prices"),
        F.sum("a").alias("negative_amounts"), F.sum("s").alias("invalid_sides"))
    bad = (F.col("negative_prices") > 0) | (F.col("negative_amounts") > 0) | (F.col("invalid_sides") > 0)
    return out.withColumn(
        "status", F.when(bad, "FAIL").when(F.col("duplicate_timestamps") > 0, "WARNING").otherwise("PASS"))


def ranges(ticks: DataFrame, data_type: str) -> DataFrame:
    """Out-of-range counts and moments, one row per column with a known range."""
    limits = {c: lim for c, lim in RANGES[data_type].items() if c in ticks.columns}
    measures = []
    for c, (low, high) in limits.items():
        measures += [
            F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"{c}_out"), F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_out").alias("out_of_range"), F.col(f"{c}_min").alias("min_value"),
                 F.col(f"{c}_max").alias("max_value"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
        for c in limits])
    return ticks.agg(*measures).select(F.inline(parts))


def integrity(ticks: DataFrame, data_type: str, columns: Sequence[str]) -> DataFrame:
    """Infinities, negatives and values beyond five deviations, per column.

    Outliers are looked for when there are more than 100 rows and at least ten
    values. The moments are one row, read by the second pass as a scalar subquery.
    """
    moments = ticks.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[x for c in columns for x in (F.count(c).alias(f"_n_{c}"), F.avg(c).alias(f"_m_{c}"), F.stddev_samp(c).alias(f"_s_{c}"))])
    both = ticks.withColumn("_moments", moments.select(F.struct("*")).scalar())
    at = lambda name: F.col("_moments")[name]
    measures = []
    for c in columns:
        far = F.abs(F.col(c) - at(f"_m_{c}")) > 5 * at(f"_s_{c}")
        enough = (at("_rows") > 100) & (at(f"_n_{c}") >= 10)
        measures += [
            F.count_if(F.abs(F.col(c)) == float("inf")).alias(f"{c}_infinite"), F.count_if(F.col(c) < 0).alias(f"{c}_negative"),
            F.count_if(far & enough).alias(f"{c}_outliers")]
    crossed = F.count_if(F.col("bid_price_1") >= F.col("ask_price_1")) if data_type == "book_snapshot_5" else F.count_if(F.lit(False))
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_infinite").alias("infinite"), F.col(f"{c}_negative").alias("negative"),
                 F.col(f"{c}_outliers").alias("outliers")) for c in columns])
    return both.agg(F.count(F.lit(1)).alias("rows"), crossed.alias("crossed_books"), *measures).select(
        "rows", "crossed_books", F.inline(parts))


def castable(raw: DataFrame, numeric: Sequence[str], times: Sequence[str]) -> DataFrame:
    """Text values that do not read as numbers or times, per column."""
    measures = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in numeric]
    measures += [F.count_if(F.col(c).isNotNull() & F.try_to_timestamp(c).isNull()).alias(c) for c in times]
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("unreadable")) for c in (*numeric, *times)])
    return raw.agg(*measures).select(F.inline(parts))


def no_nan(df: DataFrame) -> DataFrame:
    """NaN marks a missing value in files; NULL does so here."""
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema.fields])


# -- time --------------------------------------------------------------------------

def time_bounds(ticks: DataFrame, keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Years outside 2020-2030 and rows not on their partition day."""
    year = F.year("timestamp")
    return ticks.groupBy(*keys).agg(
        F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        F.count_if((year < FIRST_YEAR) | (year > LAST_YEAR)).alias("out_of_bounds"),
        F.count_if(F.to_date("timestamp") != F.col("day")).alias("wrong_day"))


def vendor_labels(raw: DataFrame, exchange: str, symbol: str) -> DataFrame:
    """Whether the exchange and symbol inside a file are the requested ones."""
    out = raw.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.lower("exchange")).alias("exchanges"),
        F.count_distinct(F.lower("symbol")).alias("symbols"), F.min(F.lower("exchange")).alias("exchange"),
        F.min(F.lower("symbol")).alias("symbol"))
    right = (F.col("exchanges") == 1) & (F.col("symbols") == 1) & (F.col("exchange") == exchange.lower()) & (
        F.col("symbol") == symbol.lower())
    return out.withColumn("valid", right)


def intervals(
    series: DataFrame, keys: Sequence[str], time: str = "timestamp", ties: Sequence[str] = (), block_seconds: int = 60,
    split_rows: int | None = SPLIT_ROWS, counted: DataFrame | None = None,
) -> DataFrame:
    """Seconds since the preceding row of the same key; NULL on the first."""
    stepped = with_previous(series, keys, time, [time], ties, block_seconds, split_rows, prefix="previous_", counted=counted)
    return stepped.withColumn(
        "interval_seconds", (F.unix_micros(time) - F.unix_micros(f"previous_{time}")) / 1e6)


def interval_stats(stepped: DataFrame, keys: Sequence[str], expected_seconds: float, max_drift: float = 1.0) -> DataFrame:
    x = F.col("interval_seconds")
    return stepped.groupBy(*keys).agg(
        F.count(x).alias("intervals"), F.avg(x).alias("avg_interval"), F.stddev_pop(x).alias("std_interval"),
        F.min(x).alias("min_interval"), F.max(x).alias("max_interval"),
        F.count_if(F.abs(x - expected_seconds) > max_drift).alias("interval_errors"))


def gaps(stepped: DataFrame, keys: Sequence[str], expected_seconds: float, time: str = "timestamp") -> DataFrame:
    """Intervals longer than 1.5 times the expected one."""
    x = F.col("interval_seconds")
    return stepped.where(x > 1.5 * expected_seconds).select(
        *keys, F.col(f"previous_{time}").alias("gap_start"), F.col(time).alias("gap_end"), x.alias("gap_seconds"),
        (x / expected_seconds).alias("gap_ratio"))


def out_of_order(ticks: DataFrame, keys: Sequence[str] = ("instrument_key",), block_seconds: int = 60) -> DataFrame:
    """Rows whose exchange time is before that of the row received just before."""
    stepped = with_previous(
        ticks, keys, "local_timestamp", ["timestamp"], ["id"], block_seconds, SPLIT_ROWS, prefix="previous_")
    return stepped.where(F.col("timestamp") < F.col("previous_timestamp")).select(
        *keys, "id", "timestamp", "previous_timestamp")


def duplicate_times(series: DataFrame, keys: Sequence[str], time: str = "timestamp") -> DataFrame:
    """Times that occur more than once per key, with the number of extra rows."""
    return series.groupBy(*keys, time).agg((F.count(F.lit(1)) - 1).alias("extra_rows")).where(F.col("extra_rows") > 0)


def _finding(test: str, count: Column) -> Column:
    return F.struct(
        F.lit(test).alias("test_name"), F.when(count > 0, "FAIL").otherwise("PASS").alias("status"), count.alias("problems"))


def stability(
    ticks: DataFrame, expected_seconds: float, max_drift: float = 1.0, keys: Sequence[str] = ("instrument_key",),
    block_seconds: int = 60, arrival: str | None = "local_timestamp",
) -> DataFrame:
    """Four checks per key: duplicates, arrival order, interval drift and gaps."""
    times = ticks.groupBy(*keys, "timestamp").agg((F.count(F.lit(1)) - 1).alias("_extra"))
    # Candle times are few per block; tick times may not be.
    split = SPLIT_ROWS if arrival else None
    stepped = intervals(times, keys, block_seconds=block_seconds, split_rows=split, counted=ticks)
    x = F.col("interval_seconds")
    out = stepped.groupBy(*keys).agg(
        F.sum("_extra").alias("dup"), F.count_if(F.abs(x - expected_seconds) > max_drift).alias("drift"),
        F.count_if(x > 1.5 * expected_seconds).alias("gap"))
    if arrival:
        late = out_of_order(ticks, keys, block_seconds).groupBy(*keys).agg(F.count(F.lit(1)).alias("late"))
        out = out.join(late, list(keys), "left")
    else:
        out = out.withColumn("late", F.lit(0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select(*keys, F.inline(F.array(
        _finding("duplicate_timestamps", zero("dup")), _finding("timestamp_ordering", zero("late")),
        _finding("interval_consistency", zero("drift")), _finding("timestamp_gaps", zero("gap")))))


def zones(raw: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct UTC offsets written in a text time column; more than one fails."""
    offset = F.regexp_extract(column, r"(Z|[+-]\d{2}:?\d{2})$", 1)
    zone = F.when(offset == "", "naive").when(offset.isin("Z", "+00:00", "+0000"), "UTC").otherwise(offset)
    out = raw.groupBy(*keys).agg(F.count_distinct(zone).alias("zones"), F.min(zone).alias("first_zone"))
    return out.withColumn("status", F.when(F.col("zones") == 1, "PASS").otherwise("FAIL"))


def freshness(ticks: DataFrame, now: str, max_age_seconds: float = 300, keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Rows older than the limit at ``now``, and the greatest age."""
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("timestamp")) / 1e6
    stale = age > max_age_seconds
    return ticks.groupBy(*keys).agg(
        F.count_if(stale).alias("stale_count"), F.coalesce(F.max(F.when(stale, age)), F.lit(0.0)).alias("max_age_seconds"),
    ).withColumn("status", F.when(F.col("stale_count") > 0, "WARNING").otherwise("PASS"))


def clock_skew(ticks: DataFrame, max_skew_seconds: float = 0.05, keys: Sequence[str] = ("instrument_key",)) -> DataFrame:
    """Local minus exchange time on each tick."""
    skew = (F.unix_micros("local_timestamp") - F.unix_micros("timestamp")) / 1e6
    return ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.abs(skew)).alias("max_skew_seconds"), F.avg(skew).alias("avg_skew_seconds"),
        F.count_if(F.abs(skew) > max_skew_seconds).alias("skew_errors"),
    ).withColumn("status", F.when(F.col("skew_errors") > 0, "WARNING").otherwise("PASS"))


def paired_clock_skew(local: DataFrame, server: DataFrame, max_skew_seconds: float, keys: Sequence[str]) -> DataFrame:
    """As :func:`clock_skew` for two tables paired by position in time order.

    Positions come from numbering inside short blocks plus block offsets, so a
    long series is not numbered in one task. Unequal counts fail.
    """
    a = numbered(local.select(*keys, "timestamp"), keys, block_seconds=60, split_rows=SPLIT_ROWS).withColumnRenamed("timestamp", "_local")
    b = numbered(server.select(*keys, "timestamp"), keys, block_seconds=60, split_rows=SPLIT_ROWS).withColumnRenamed("timestamp", "_server")
    skew = (F.unix_micros("_local") - F.unix_micros("_server")) / 1e6
    return a.join(b, [*keys, "_rn"], "full_outer").groupBy(*keys).agg(
        F.count("_local").alias("local_count"), F.count("_server").alias("server_count"),
        F.max(F.abs(skew)).alias("max_skew_seconds"), F.avg(skew).alias("avg_skew_seconds"),
        F.count_if(F.abs(skew) > max_skew_seconds).alias("skew_errors"),
    ).withColumn("status", F.when(F.col("local_count") != F.col("server_count"), "FAIL").when(
        F.col("skew_errors") > 0, "WARNING").otherwise("PASS"))


def candle_sanity(candles: DataFrame) -> DataFrame:
    """Candles whose high is below their low, open or close."""
    bad = (F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close"))
    return candles.where(bad)


def day_shape(candles: DataFrame, keys: Sequence[str] = ("instrument_key", "day"), time: str = "candle_time") -> DataFrame:
    """Shifted one-minute days: 1440 candles, first label 00:01, one midnight label."""
    out = candles.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candles"), F.min(time).alias("first_label"), F.max(time).alias("last_label"),
        F.count_if((F.hour(time) == 0) & (F.minute(time) == 0)).alias("midnight_labels"))
    good = (F.col("candles") == 1440) & (F.minute("first_label") == 1) & (F.minute("last_label") == 0) & (
        F.col("midnight_labels") == 1)
    return out.withColumn("valid", good)


def venue_prices(ticks: DataFrame, max_difference: float = 0.1) -> DataFrame:
    """Mean day price per symbol across venues; the spread must stay under 10 %."""
    per_venue = ticks.groupBy("symbol", "day", "venue").agg(F.avg("price").alias("mean_price"))
    out = per_venue.groupBy("symbol", "day").agg(
        F.count(F.lit(1)).alias("venues"), F.min("mean_price").alias("lowest"), F.max("mean_price").alias("highest"))
    spread = F.try_divide(F.col("highest") - F.col("lowest"), F.col("highest"))
    return out.withColumn("difference", spread).withColumn(
        "status", F.when(F.col("venues") < 2, "SKIP").when(F.col("difference") < max_difference, "PASS").otherwise("FAIL"))


# -- report --------------------------------------------------------------------------

def report(findings: DataFrame) -> DataFrame:
    """Counts per status, success rate and overall status of a findings table."""
    s = F.col("status")
    out = findings.agg(
        F.count(F.lit(1)).alias("total_tests"), F.count_if(s == "PASS").alias("passed_tests"),
        F.count_if(s == "FAIL").alias("failed_tests"), F.count_if(s == "WARNING").alias("warning_tests"),
        F.count_if(s == "SKIP").alias("skipped_tests"))
    return out.select(
        "*",
        F.coalesce(F.try_divide(F.col("passed_tests") * 100.0, F.col("total_tests")), F.lit(0.0)).alias("success_rate"),
        F.when(F.col("failed_tests") > 0, "FAIL").when(F.col("warning_tests") > 0, "WARNING")
        .when(F.col("passed_tests") > 0, "PASS").otherwise("SKIP").alias("overall_status"))

