"""Readers of stored tables and of vendor files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timegrid import bucket_micros
from tickloom.operators import instruments as ins
from tickloom.schemas import BATCH_FEATURES, CANDLE_COLUMNS, HFT_TIMEFRAMES, INDICATORS, MFT_TIMEFRAMES, TICK_SCHEMAS, TIMEFRAMES, WAREHOUSE_TYPES

#: Ranges of time that one scan filters on.
MOST_RANGES = 64
TIME_COLUMNS = ("timestamp", "local_timestamp", "funding_timestamp", "expiration")


# -- ticks ---------------------------------------------------------------------------

def as_times(df: DataFrame) -> DataFrame:
    """Int64 microseconds to timestamps."""
    longs = {f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)}
    return df.withColumns({c: F.timestamp_micros(c) for c in TIME_COLUMNS if c in longs})


def tick_table_schema(data_types: Sequence[str]) -> T.StructType:
    """Columns of the requested data types together, with the partition columns."""
    fields: dict[str, T.StructField] = {"instrument_key": T.StructField("instrument_key", T.StringType())}
    for t in data_types:
        if t not in TICK_SCHEMAS:
            raise ValueError(f"unknown data type {t!r}; known: {sorted(TICK_SCHEMAS)}")
        for f in TICK_SCHEMAS[t].fields:
            kind = T.TimestampType() if f.name in TIME_COLUMNS else f.dataType
            fields.setdefault(f.name, T.StructField(f.name, kind))
    fields["seq"] = T.StructField("seq", T.LongType())
    fields["day"] = T.StructField("day", T.DateType())
    fields["data_type"] = T.StructField("data_type", T.StringType())
    return T.StructType(list(fields.values()))


def read_ticks(
    spark: SparkSession, root: str, start: str, end: str, data_types: Sequence[str] = ("trades",),
    instruments: Sequence[str] | None = None,
) -> DataFrame:
    """Ticks with ``start <= timestamp <= end`` from the tick table.

    One scan for all data types: columns a type lacks read as NULL. Days and
    types prune folders, and the instrument and time filters reach the row
    groups. A row without exchange time is judged by its local time.
    """
    stored = spark.read.schema(tick_table_schema(data_types)).parquet(root)
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    out = stored.where(
        F.col("day").between(F.to_date(low), F.to_date(high)) & F.col("data_type").isin(*data_types)
    ).where(
        F.col("timestamp").between(low, high) | (F.col("timestamp").isNull() & F.col("local_timestamp").between(low, high)))
    return out.where(F.col("instrument_key").isin(*instruments)) if instruments else out


def sorted_ticks(ticks: DataFrame) -> DataFrame:
    """Total time order; rows without exchange time take their local time."""
    return ticks.orderBy(F.coalesce("timestamp", "local_timestamp"), "local_timestamp", *[c for c in ("id",) if c in ticks.columns])


def in_chunks(ticks: DataFrame, rows: int = 10_000) -> Iterator[list[Row]]:
    """Deliver rows to the caller in lists of ``rows``, one partition ahead at a time.

    For display and export on one machine; bulk work stays in DataFrames.
    """
    chunk: list[Row] = []
    for row in ticks.toLocalIterator(prefetchPartitions=True):
        chunk.append(row)
        if len(chunk) == rows:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def map_chunks(ticks: DataFrame, fold: Callable, schema: str) -> DataFrame:
    """Apply ``fold(iterator of Arrow batches)`` inside the tasks that hold the rows.

    The batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    return ticks.mapInArrow(fold, schema)


def around(ticks: DataFrame, times: DataFrame, buffer_minutes: float = 5, bounds: tuple[str, str] | None = None) -> DataFrame:
    """Ticks within ``buffer_minutes`` of each requested time, as ``requested_at``.

    ``times`` has a column ``requested_at`` and may have ``instrument_key``. Each
    time is listed in the two or three buckets its range touches, so the join is
    on equality and either side may be large. ``bounds`` are the least and
    greatest times, which prune days and row groups in the tick scan.
    """
    buffer = int(buffer_minutes * 60_000_000)
    width = max(2 * buffer, 1_000_000)
    keys = [c for c in ("instrument_key",) if c in times.columns]
    at = F.unix_micros("requested_at")
    asked = times.distinct().withColumn(
        "_bucket", F.explode(F.sequence(
            (at - buffer) - F.pmod(at - buffer, F.lit(width)), (at + buffer) - F.pmod(at + buffer, F.lit(width)), F.lit(width))))
    source = ticks
    if bounds:
        low = F.timestamp_micros(F.unix_micros(F.lit(bounds[0]).cast("timestamp")) - buffer)
        high = F.timestamp_micros(F.unix_micros(F.lit(bounds[1]).cast("timestamp")) + buffer)
        source = source.where(F.col("timestamp").between(low, high))
        if "day" in source.columns:
            source = source.where(F.col("day").between(F.to_date(low), F.to_date(high)))
    marked = source.withColumn("_bucket", bucket_micros("timestamp", width))
    gap = F.abs(F.unix_micros("timestamp") - F.unix_micros("requested_at"))
    return marked.join(asked, [*keys, "_bucket"]).where(gap <= buffer).drop("_bucket")


def ticks_for_candles(
    spark: SparkSession, root: str, start: str, end: str, times: Sequence[str] | None = None, buffer_minutes: float = 5,
    data_types: Sequence[str] = ("trades",), instruments: Sequence[str] | None = None,
) -> DataFrame:
    """Ticks around the given candle times, or the whole range without a list.

    The times with their buffer merge into disjoint ranges. The scan gets the days
    these touch, those beyond midnight too, and the ranges themselves as filters on
    time, so days and row groups between them are not read.
    """
    if not times:
        return read_ticks(spark, root, start, end, data_types, instruments)
    ranges = merged_ranges([dt.datetime.fromisoformat(t) for t in times], dt.timedelta(minutes=buffer_minutes))
    first, last = str(ranges[0][0]), str(ranges[-1][1])
    span = read_ticks(spark, root, first, last, data_types, instruments)
    days = sorted({a.date() + dt.timedelta(days=i) for a, b in ranges for i in range((b.date() - a.date()).days + 1)})
    wanted = F.expr(" OR ".join(f"timestamp BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '{high}'" for low, high in ranges))
    asked = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("requested_at"))
    return around(span.where(F.col("day").isin(days) & wanted), asked, buffer_minutes)


def merged_ranges(times: Sequence[dt.datetime], buffer: dt.timedelta, most: int = MOST_RANGES) -> list[tuple[dt.datetime, dt.datetime]]:
    """The ranges within ``buffer`` of the times as disjoint ranges in order.

    Beyond ``most``, those with the narrowest gaps are joined: a filter of bounded
    length that covers every time and some more, for the exact check that follows.
    """
    ranges: list[tuple[dt.datetime, dt.datetime]] = []
    for at in sorted(set(times)):
        low, high = at - buffer, at + buffer
        if ranges and low <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    if len(ranges) > most:
        gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1], reverse=True)
        cuts = [0, *sorted(gaps[: most - 1]), len(ranges)]
        ranges = [(ranges[i][0], ranges[j - 1][1]) for i, j in zip(cuts, cuts[1:])]
    return ranges


# -- candles and features --------------------------------------------------------------

def read_candles(
    spark: SparkSession, root: str, start: str, end: str, timeframes: Sequence[str], instruments: Sequence[str] | None = None
) -> DataFrame:
    """Candles with ``start <= timestamp <= end``; an unknown timeframe raises."""
    unknown = [t for t in timeframes if t not in TIMEFRAMES]
    if unknown:
        raise ValueError(f"unsupported timeframe {unknown[0]!r}; known: {list(TIMEFRAMES)}")
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    out = spark.read.option("mergeSchema", "true").parquet(root).where(
        F.col("day").between(F.to_date(low), F.to_date(high)) & F.col("timeframe").isin(*timeframes)
        & F.col("timestamp").between(low, high))
    return out.where(F.col("instrument_key").isin(*instruments)) if instruments else out


def candle_table_schema() -> T.StructType:
    """All columns a candle table may hold: a read with it opens no footer to find columns, and those not stored are NULL."""
    names = dict.fromkeys(["instrument_key", *CANDLE_COLUMNS, *BATCH_FEATURES])
    fields = [T.StructField(c, T.StringType() if c == "instrument_key" else T._parse_datatype_string(WAREHOUSE_TYPES[c])) for c in names]
    return T.StructType([*fields, T.StructField("day", T.DateType())])


def present_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def _read_features(allowed: Sequence[str], spark, root, start, end, timeframe, instruments) -> DataFrame:
    if timeframe not in allowed:
        raise ValueError(f"unsupported timeframe {timeframe!r}; one of {list(allowed)}")
    frame = read_candles(spark, root, start, end, [timeframe], instruments)
    extra = [c for c in (*BATCH_FEATURES, *INDICATORS) if c not in CANDLE_COLUMNS]
    return present_columns(frame, ["instrument_key", *CANDLE_COLUMNS, *extra])


def read_hft_features(spark, root, start, end, timeframe="1m", instruments=None) -> DataFrame:
    """Candles with features, 15 s and 1 m."""
    return _read_features(HFT_TIMEFRAMES, spark, root, start, end, timeframe, instruments)


def read_mft_features(spark, root, start, end, timeframe="5m", instruments=None) -> DataFrame:
    """Candles with features, 1 m to 24 h."""
    return _read_features(MFT_TIMEFRAMES, spark, root, start, end, timeframe, instruments)


# -- instruments -------------------------------------------------------------------------

def first_present(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first path that can be read."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
    raise FileNotFoundError(f"none of {list(paths)} exists")


def instruments_for_day(spark: SparkSession, roots: Sequence[str], day: str, **filters) -> DataFrame:
    """Definitions valid on a day: daily table, range table, then legacy file."""
    frame = first_present(spark, roots)
    if "day" in frame.columns:
        frame = frame.where(F.col("day") == F.lit(day).cast("date"))
    return ins.select_instruments(ins.available_on(frame, day), **filters)


def missing_instrument_days(days: DataFrame, daily: DataFrame) -> DataFrame:
    """Calendar days without an instrument table."""
    return days.join(daily.select("day").distinct(), "day", "left_anti")


# -- file catalog -----------------------------------------------------------------------------

def file_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` with day, data type, size and time; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{parquet,csv.zst,csv.gz}").load(root)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"),
        F.to_date(F.regexp_extract("path", r"day[=-](\d{4}-\d{2}-\d{2})", 1)).alias("day"),
        F.regexp_extract("path", r"data_type[=-]([^/]+)", 1).alias("data_type"))


def latest_file(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"))


def catalog_totals(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("day", "data_type").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def stored_instruments(ticks: DataFrame, day: str) -> DataFrame:
    """Instruments with any data on a day."""
    return ticks.where(F.col("day") == F.lit(day).cast("date")).select("instrument_key").distinct().orderBy("instrument_key")


# -- vendor files -------------------------------------------------------------------------------

VENDOR_BOOK_NAMES = {
    f"{side}s[{i}].{vendor}": f"{side}_{ours}_{i + 1}"
    for i in range(5) for side in ("ask", "bid") for vendor, ours in (("price", "price"), ("amount", "volume"))
}


def vendor_columns(data_type: str) -> dict[str, str]:
    """Vendor column name to ours."""
    names = {f.name: f.name for f in TICK_SCHEMAS[data_type].fields}
    if data_type == "book_snapshot_5":
        names = {c: c for c in ("timestamp", "local_timestamp")}
        names.update(VENDOR_BOOK_NAMES)
    return names


def typed(raw: DataFrame, data_type: str, keep: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Text columns to the data type's schema; what does not read becomes NULL.

    Quotes are strict: an unreadable number fails the job.
    """
    kinds = {f.name: f.dataType for f in TICK_SCHEMAS[data_type].fields}
    columns = [F.col(c) for c in keep if c in raw.columns]
    for vendor, ours in vendor_columns(data_type).items():
        if vendor in raw.columns:
            text = F.col(f"`{vendor}`")
            value = text.cast(kinds[ours]) if data_type == "quotes" else text.try_cast(kinds[ours])
            if isinstance(kinds[ours], T.DoubleType):
                value = F.nanvl(value, F.lit(None).cast("double"))
        else:
            value = F.lit(None).cast(kinds[ours])
        columns.append(value.alias(ours))
    return raw.select(*columns)


def read_vendor_csv(spark: SparkSession, path: str | list[str], data_type: str) -> DataFrame:
    """Vendor CSV files (plain or gzip) as typed ticks; every field is read as text first."""
    return typed(spark.read.option("header", "true").csv(path), data_type)


# -- reports --------------------------------------------------------------------------------------

REPORT_SCHEMA = T.StructType([
    T.StructField("instrument_key", T.StringType()), T.StructField("data_type", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("expected", T.BooleanType()),
    T.StructField("available", T.BooleanType()), T.StructField("day", T.DateType()),
])


def read_report(spark: SparkSession, root: str, day: str) -> DataFrame:
    """A stored report's day; an absent report reads as an empty table."""
    try:
        return spark.read.parquet(root).where(F.col("day") == F.lit(day).cast("date"))
    except AnalysisException:
        return spark.createDataFrame([], REPORT_SCHEMA)


OHLCV_ALIASES = {"ts": "timestamp", "time": "timestamp", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}


def read_ohlcv(spark: SparkSession, path: str, symbol: str, timeframe: str, source: str) -> DataFrame:
    """A candle file (Parquet or CSV) in the shape used by reconciliation."""
    frame = spark.read.option("header", "true").csv(path) if path.endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    frame = frame.withColumnsRenamed({c: OHLCV_ALIASES[c] for c in frame.columns if c in OHLCV_ALIASES})
    return frame.select(
        F.lit(symbol).alias("symbol"), F.lit(timeframe).alias("timeframe"), F.lit(source).alias("source"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")])
