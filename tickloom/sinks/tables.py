"""Writers of partitioned tables and exports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.keys import symbol_and_exchange
from tickloom.operators import candles as candle_rows
from tickloom.operators import instruments as instrument_rows
from tickloom.schemas import WAREHOUSE_TYPES

# Delta-packed INT64 times, dictionary pages, snappy; see the Parquet options.
PARQUET = {"compression": "snappy", "parquet.writer.version": "v2"}


@contextmanager
def int64_times(spark: SparkSession) -> Iterator[None]:
    """Write times as INT64, whose row-group statistics filters can use."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write(df: DataFrame, path: str, partitions: Sequence[str], mode: str) -> None:
    writer = df.write.mode(mode).options(**PARQUET)
    if mode == "overwrite" and partitions:
        # Only the partitions present in ``df`` are replaced.
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partitions:
        writer = writer.partitionBy(*partitions)
    with int64_times(df.sparkSession):
        writer.parquet(path)


def write_sorted(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], mode: str = "overwrite") -> None:
    """Range-partition by folder and order, sort inside each task, write.

    Ranges include the order columns, so one busy folder is spread over several
    tasks and files, each with a narrow time range.
    """
    arranged = df.repartitionByRange(*partitions, *order).sortWithinPartitions(*partitions, *order)
    _write(arranged, path, partitions, mode)


def files_of(spark: SparkSession, path: str, partitions: Sequence[str], where: Column) -> dict[str, tuple]:
    """The files of the partitions chosen by ``where`` with their values; none where the table is not there yet.

    A listing of folders: no file is opened.
    """
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    if not set(partitions) <= set(listed.columns):  # a table without any file
        return {}
    rows = listed.where(where).select("path", *partitions).collect()
    return {r["path"]: tuple(str(r[c]) for c in partitions) for r in rows}


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table is there and has a file; no file is opened."""
    try:
        return bool(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                    .load(path).select("path").take(1))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str], where: Column) -> None:
    """Write ``df`` in place of all stored partitions chosen by ``where``, those it has no row of too.

    The write replaces the folders that ``df`` has rows for, and only then folders
    that were there before and got no new file are emptied: new rows are visible
    before old ones go. ``where`` is a condition on partition columns; partitions
    outside it are not touched.
    """
    spark = df.sparkSession
    before = files_of(spark, path, partitions, where)
    write_sorted(df.where(where), path, partitions, order)
    after = files_of(spark, path, partitions, where)
    none = spark.createDataFrame([], df.schema).drop(*partitions)
    for values in sorted({after[f] for f in after if f in before}):
        _write(none, "/".join([path, *(f"{c}={v}" for c, v in zip(partitions, values))]), (), "overwrite")


def days_between(start: str, end: str) -> Column:
    return F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def write_ticks(ticks: DataFrame, path: str, data_type: str | None = None, mode: str = "overwrite") -> None:
    """Ticks by day and data type, sorted by instrument and time.

    Priced ticks without their rank among equal times get it here, so that candles
    from the table have one order.
    """
    if "timestamp" not in ticks.columns:
        raise ValueError("ticks need a timestamp column")
    out = ticks.drop("exchange", "symbol")
    if "seq" not in out.columns and {"instrument_key", "local_timestamp", "id", "price"} <= set(out.columns):
        out = candle_rows.with_sequence(out)
    if data_type:
        out = out.withColumn("data_type", F.lit(data_type))
    if "day" not in out.columns:
        out = out.withColumn("day", F.to_date("timestamp"))
    write_sorted(out, path, ["day", "data_type"], ["instrument_key", "timestamp"], mode)


def write_candles(
    candles: DataFrame, path: str, mode: str = "overwrite", days: tuple[str, str] | None = None, timeframes: Sequence[str] | None = None
) -> None:
    """Candles (or book rows) by day and timeframe.

    ``days`` names a range of which no earlier row of ``timeframes`` may stay; other
    timeframes and days are not touched. By default these are the timeframes that the
    candles hold, so a run that may make none has to name them. With both given,
    candles outside are not written.
    """
    out = candles.withColumn("day", F.to_date("timestamp"))
    if days:
        if timeframes is None:
            timeframes = [r[0] for r in out.select("timeframe").distinct().collect()]  # of seven at most
        where = days_between(*days) & F.col("timeframe").isin(*timeframes)
        replace_partitions(out, path, ["day", "timeframe"], ["instrument_key", "timestamp"], where)
        return
    write_sorted(out, path, ["day", "timeframe"], ["instrument_key", "timestamp"], mode)


def write_instruments(daily: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Definitions by day. Rows with errors abort; warnings do not."""
    write_sorted(_without_errors(daily), path, ["day"], ["instrument_key"], mode)


def days_in_order(windows: DataFrame) -> DataFrame:
    """Rows with ``first_day`` and ``last_day`` by day, sorted by day and instrument inside each task.

    Pieces of a few days are range-partitioned by time and instrument, and their days
    generated where they are sorted: no shuffle carries a row once for each of its days.
    """
    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes that become many rows: not to be joined
    arranged = instrument_rows.pieces(windows).repartitionByRange(n, "piece", "instrument_key")
    days = arranged.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).drop("first_day", "last_day", "piece")
    return days.sortWithinPartitions("day", "instrument_key")


def write_instrument_windows(windows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The table of :func:`write_instruments` from definitions with ``first_day`` and ``last_day`` (see ``instruments.windowed``)."""
    _write(days_in_order(_without_errors(windows)), path, ["day"], mode)


def _without_errors(definitions: DataFrame) -> DataFrame:
    if "errors" not in definitions.columns:
        return definitions
    broken = definitions.where(F.size("errors") > 0).select("instrument_key", "errors").limit(5).collect()
    if broken:
        raise ValueError(f"invalid instrument definitions, first: {broken}")
    return definitions.drop("errors", "warnings", "missing_fields")


def write_instrument_ranges(daily: DataFrame, path: str) -> None:
    """The aggregate of daily definitions: ranges of equal days, in one table (see ``instruments.merge_days``)."""
    ranges = instrument_rows.merge_days(daily)
    _write(ranges.repartitionByRange("instrument_key", "first_day").sortWithinPartitions("instrument_key", "first_day"), path, (), "overwrite")


def write_report(
    report: DataFrame, path: str, venues: Sequence[str] = (), instrument_types: Sequence[str] = (), data_types: Sequence[str] = (),
    generated_at: str | None = None, days: tuple[str, str] | None = None,
) -> T.StructType:
    """A coverage report by day, with the filters it was made under; returns its schema.

    With ``days``, a range, a day that has no row any more loses those of earlier runs.
    """
    stamp = F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp()
    text = lambda v: F.lit(",".join(v) if v else "all")
    out = report.withColumns({
        "report_date": F.col("day"), "venues_filter": text(venues), "instrument_types_filter": text(instrument_types),
        "data_types_filter": text(data_types), "generated_at": stamp})
    if days:
        replace_partitions(out, path, ["day"], ["instrument_key"], days_between(*days))
    else:
        write_sorted(out, path, ["day"], ["instrument_key"])
    return out.schema


def warehouse_frame(candles: DataFrame) -> DataFrame:
    """Candles with warehouse labels, cast to the declared column types."""
    symbol, exchange = symbol_and_exchange("instrument_key")
    out = candles.withColumns({
        "instrument_id": F.col("instrument_key"), "symbol": symbol, "exchange": exchange, "date": F.to_date("timestamp"),
        "day_out": F.to_date("timestamp_out")}).drop("instrument_key", "day")
    return out.select(*[
        F.col(c).cast(WAREHOUSE_TYPES.get(c, "date" if c == "day_out" else "string")).alias(c) for c in out.columns])


def load_warehouse(candles: DataFrame, table: str, path: str | None = None, mode: str = "append", buckets: int = 8) -> None:
    """Append or truncate-and-load a table by emission day, clustered on exchange and symbol."""
    writer = (
        warehouse_frame(candles).write.mode(mode).options(**PARQUET).partitionBy("day_out")
        .bucketBy(buckets, "exchange", "symbol").sortBy("exchange", "symbol")
    )
    if path:
        writer = writer.option("path", path)
    with int64_times(candles.sparkSession):
        writer.saveAsTable(table)


def backfill(
    candles: DataFrame, path: str, days: tuple[str, str] | None = None, timeframes: Sequence[str] | None = None
) -> DataFrame:
    """Load a range of days in one job and report what each day holds.

    Writing replaces whole days, so a failed job is simply run again. With ``days``
    the range is replaced: a day of it that has no candle any more loses its old ones.
    """
    write_candles(candles, path, days=days, timeframes=timeframes)
    return stored_days(candles.sparkSession, path)


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("day", "timeframe").agg(F.count(F.lit(1)).alias("rows"))


def expire(spark: SparkSession, path: str, keep_days: int = 30, column: str = "day") -> list[str]:
    """Delete the folders of days older than the newest day less ``keep_days``.

    Whole partitions go, so nothing is rewritten. Returns the days deleted.
    """
    # The distinct partition days of one table: bounded by the calendar.
    days = [r.d for r in spark.read.parquet(path).select(F.col(column).cast("date").alias("d")).distinct().collect()]
    limit = max(days) - timedelta(days=keep_days) if days else None
    old = [d.isoformat() for d in sorted(days) if d < limit]
    jvm = spark.sparkContext._jvm
    for day in old:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return old


def archive_rows(messages: DataFrame) -> DataFrame:
    """Messages with their whole content as JSON text."""
    return messages.select("type", "exchange", "symbol", "timestamp", F.to_json(F.struct(*messages.columns)).alias("payload"))


def archive(messages: DataFrame, path: str) -> None:
    _write(archive_rows(messages), path, ["type", "exchange", "symbol"], "append")


def export(df: DataFrame, path: str, kind: str = "csv") -> None:
    if kind == "csv":
        df.write.mode("overwrite").option("header", "true").csv(path)
    elif kind == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"export kind {kind!r} is not csv or json")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value, found in one aggregation."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])
