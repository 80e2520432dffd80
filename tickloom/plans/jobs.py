"""Batch jobs composed of the operators. Every job covers all its days at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import book, candles, coverage, features, instruments, quality, reconcile
from tickloom.schemas import BASE_TIMEFRAMES, LIQUIDATION_FEATURES, OPTION_FEATURES, ROLLUP_TIMEFRAMES
from tickloom.session import work_folder
from tickloom.sinks import tables, warehouse
from tickloom.sources import readers


def instrument_job(listing: DataFrame, path: str, start: str, end: str, ranges_path: str | None = None) -> DataFrame:
    """Listings to validated daily definitions; returns counts per skip reason.

    ``ranges_path`` gets the aggregate of the range, made of the stored days.
    """
    defined = instruments.definitions(listing, start, end)
    windows = instruments.windowed(instruments.validate(defined), start, end)
    # Written once: the check, the sample of the range shuffle and the write would each parse the listing again.
    folder = work_folder(listing.sparkSession, "definitions")
    windows.write.parquet(folder)
    tables.write_instrument_windows(listing.sparkSession.read.schema(windows.schema).parquet(folder), path)
    if ranges_path:
        spark = listing.sparkSession
        stored = spark.read.parquet(path).where(tables.days_between(start, end))
        tables.write_instrument_ranges(stored, ranges_path)
    marked = instruments.eligibility(listing, start, end)
    return marked.groupBy("exchange", F.coalesce("skip_reason", F.lit("eligible")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("symbols"))


def ingest_job(raw: DataFrame, data_type: str, path: str, rejected_path: str | None = None) -> None:
    """Typed vendor rows to the tick table; invalid rows go to ``rejected_path``.

    ``raw`` has ``instrument_key`` beside the typed columns. Ticks at one instant
    get their order number here, once, so later candles need no tie-break.
    """
    ticks = readers.as_times(raw)
    good, bad = quality.split_valid(ticks, data_type)
    if "id" in good.columns and "price" in good.columns:
        good = candles.with_sequence(good)
    tables.write_ticks(good, path, data_type)
    if rejected_path:
        bad.write.mode("overwrite").parquet(rejected_path)


def targets_job(spark: SparkSession, missing: DataFrame, definitions: DataFrame, landed: DataFrame, **filters) -> DataFrame:
    """What a missing report says should be read again, of the files that have landed."""
    targets = coverage.missing_to_targets(missing, definitions, **filters).where(F.col("target_status") == "found")
    return targets.join(landed.select("day", "instrument_key", "data_type").distinct(), ["day", "instrument_key", "data_type"], "left_semi")


def _stored_report(spark: SparkSession, path: str, schema: T.StructType, start: str, end: str) -> DataFrame:
    """The rows of a range of days; the schema is given, as a report may have no row."""
    return spark.read.schema(schema).parquet(path).where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def missing_job(
    definitions: DataFrame, available: DataFrame, path: str, start: str, end: str, data_types: Sequence[str] | None = None,
    generated_at: str | None = None,
) -> DataFrame:
    """Write the missing report of every day in the range; returns the summary of the range.

    A run replaces all days of its range, so a day that has become complete loses its rows.
    """
    expected = coverage.expected_types(definitions, start, end, data_types)
    missing = coverage.missing_types(expected, available)
    schema = tables.write_report(missing, path, data_types=data_types or (), generated_at=generated_at, days=(start, end))
    return coverage.missing_report(expected, _stored_report(definitions.sparkSession, path, schema, start, end))


def available_job(
    definitions: DataFrame, missing: DataFrame, path: str, start: str, end: str, data_types: Sequence[str], generated_at: str | None = None
) -> DataFrame:
    """Write the available report of every day in the range; returns the stored rows of the range."""
    rows = coverage.available_types(definitions, missing, start, end, data_types)
    schema = tables.write_report(rows, path, data_types=data_types, generated_at=generated_at, days=(start, end))
    return _stored_report(definitions.sparkSession, path, schema, start, end)


def candle_job(
    spark: SparkSession,
    root: str,
    trades: DataFrame,
    liquidations: DataFrame | None = None,
    ticker: DataFrame | None = None,
    books: DataFrame | None = None,
    eligible: DataFrame | None = None,
    base_timeframes: Sequence[str] = BASE_TIMEFRAMES,
    rollups: Sequence[str] = ROLLUP_TIMEFRAMES,
    days: tuple[str, str] | None = None,
    grid: bool = False,
    chain: DataFrame | None = None,
    underlyings: DataFrame | None = None,
) -> DataFrame:
    """Base candles with features, rollups of the finest one-minute level, book rows.

    ``eligible`` lists the instruments to work on, or (day, instrument) pairs as
    :func:`coverage.eligible_days` gives them; ticks of others are left out before
    any shuffle of theirs. With ``grid`` every interval of a covered day has a candle:
    covered are the pairs of ``eligible``, or the days on which an instrument has a
    tick where that has no day. Empty intervals have NULL prices and zero volume;
    longer candles then open and close with their first and last children that have
    trades. ``chain`` with ``underlyings`` (instrument_key, underlying_index) adds the
    option features of the interval; longer candles keep the last value.

    Ticks of each kind are scanned once for all base timeframes. Base candles are
    written first and read back for the rollups: the stored table cuts the
    lineage, so a lost executor costs a re-read and not the ticks. Book rows of
    longer timeframes come from the finest ones. With ``days``, the range that the
    ticks cover, rollups read these days only and stored rows of the range that are
    no longer made go away, of the timeframes that this run makes; others stay.
    Returns row counts per day and timeframe.
    """
    def in_range(df: DataFrame) -> DataFrame:
        return df.where(F.col("day").between(*[F.lit(d).cast("date") for d in days])) if days else df

    def only(df: DataFrame | None) -> DataFrame | None:
        if df is None or eligible is None:
            return df
        if "day" not in eligible.columns:
            return df.join(eligible.select("instrument_key").distinct(), "instrument_key", "left_semi")
        dated = df.withColumn("_day", F.to_date("timestamp"))
        pairs = eligible.select(F.col("day").alias("_day"), "instrument_key").distinct()
        return dated.join(pairs, ["_day", "instrument_key"], "left_semi").drop("_day")

    def covered() -> DataFrame:
        if eligible is not None and "day" in eligible.columns:
            return in_range(eligible.select("instrument_key", "day"))
        kinds = [only(df).select("instrument_key", F.to_date("timestamp").alias("day")) for df in (trades, liquidations, ticker) if df is not None]
        pairs = kinds[0]
        for kind in kinds[1:]:
            pairs = pairs.unionByName(kind)
        return pairs.distinct()

    if (chain is None) != (underlyings is None):
        raise ValueError("an options chain needs the underlyings of the instruments, and these a chain")
    path = f"{root}/candles"
    base_frame = features.candles_with_features(only(trades), tuple(base_timeframes), only(liquidations), only(ticker))
    if grid:
        base_frame = candles.fill_grids(
            base_frame, base_timeframes, covered(), zero=("volume", "trade_count", "buy_volume_sum", "sell_volume_sum", *LIQUIDATION_FEATURES))
    if chain is not None:
        base_frame = features.with_options(base_frame, chain, underlyings, tuple(base_timeframes))
    tables.write_candles(base_frame, path, days=days, timeframes=base_timeframes)
    if rollups:
        # The columns of this run, whatever older files hold.
        schema = T.StructType([*base_frame.schema.fields, T.StructField("day", T.DateType())])
        base = in_range(spark.read.schema(schema).parquet(path)).where(F.col("timeframe") == base_timeframes[-1]).drop("day")
        full = liquidations is not None and ticker is not None
        if full:
            rolled = features.rollup_features(base, rollups, skip_empty=grid)
        else:
            options = features.last_values(OPTION_FEATURES if chain is not None else ())
            rolled = candles.rollup(base, tuple(rollups), skip_empty=grid, extra=options)
        tables.write_candles(rolled, path, days=days, timeframes=rollups)
    if books is not None:
        finest, *longer = (*base_timeframes, *rollups)
        tables.write_candles(book.book_features(only(books), finest), f"{root}/book", days=days, timeframes=[finest])
        if longer:
            first = in_range(spark.read.parquet(f"{root}/book")).where(F.col("timeframe") == finest).drop("day")
            tables.write_candles(book.rollup_book(first, longer), f"{root}/book", days=days, timeframes=longer)
    return tables.stored_days(spark, path)


def candles_to_warehouse(spark: SparkSession, root: str, table: str, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Load the stored candles into a warehouse table; returns rows per day and timeframe."""
    stored = spark.read.option("mergeSchema", "true").parquet(f"{root}/candles")
    tables.load_warehouse(stored, table, path, mode)
    return coverage.rows_per_day(spark.table(table), "timestamp", "timeframe")


def warehouse_job(
    spark: SparkSession, root: str, warehouse_root: str, report: DataFrame, days: tuple[str, str],
    trades: DataFrame, base_timeframes: Sequence[str] = BASE_TIMEFRAMES, rollups: Sequence[str] = ROLLUP_TIMEFRAMES,
) -> DataFrame:
    """Available report to candles to warehouse tables, for a range of days; returns the totals per timeframe.

    Trades outside the range are not read, and candles are made and loaded of the
    instruments and days only that the report names. Run again, it replaces the range.
    """
    there = report.where((F.col("data_type") == "trades") & tables.days_between(*days)).select("day", "instrument_key").distinct()
    ranged = trades.withColumn("day", F.to_date("timestamp")).where(tables.days_between(*days))
    candle_job(spark, root, ranged.join(there, ["day", "instrument_key"], "left_semi").drop("day"),
               base_timeframes=base_timeframes, rollups=rollups, days=days)
    timeframes = [*base_timeframes, *rollups]
    stored = spark.read.schema(readers.candle_table_schema()).parquet(f"{root}/candles")
    return warehouse.totals(warehouse.load_available(stored, report, warehouse_root, days, timeframes))


def validation_job(first: dict[str, DataFrame], second: dict[str, DataFrame], base: str) -> DataFrame:
    """All reconciliation checks between two sources with several timeframes."""
    columns = ["test_name", "status"]
    longer = [tf for tf in first if tf != base]
    out = reconcile.sweep(first).select(*columns)
    for tf in first:
        rules = reconcile.three_rules(first[tf], second[tf], by_key=False)
        out = out.unionByName(rules.select(F.lit(f"three_rules_{tf}").alias("test_name"), "status"))
    for tf in longer:
        cross = reconcile.cross_source_aggregation(first[base], first[tf], second[base], second[tf], tf)
        out = out.unionByName(cross.select(F.concat_ws("_", "test_name", F.lit(tf)).alias("test_name"), "status"))
    return out
