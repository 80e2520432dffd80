"""What a tick table holds, from its file listing and the footers of its files.

Footers are read inside tasks, so a table of many files costs no driver memory.
Row counts and time bounds come from row-group statistics. A row group of one
instrument is known from its footer alone; only of those that hold several are
the key and time columns read, one row group at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.keys import part
from tickloom.sources.readers import file_catalog

KEY, TIME = "instrument_key", "timestamp"
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_FOUND = "path string, day date, data_type string, file_bytes bigint, instrument_key string, rows bigint, first_us bigint, last_us bigint"


def _opened(path: str):
    """A Parquet file of any file system that Arrow knows; names are taken as they are written."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pq.ParquetFile("/" + (rest or scheme).lstrip("/"))
    place, _, name = rest.lstrip("/").partition("/")
    store, at = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{place}/")
    return pq.ParquetFile(store.open_input_file(f"{at.rstrip('/')}/{name}"))


def _micros(value) -> int | None:
    if value is None:
        return None
    value = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return (value - _EPOCH) // dt.timedelta(microseconds=1)


def _bounds(group, places: dict[str, int], column: str):
    """(statistics, least, greatest) of a column of a row group; None where the file states none."""
    stats = group.column(places[column]).statistics if column in places else None
    there = stats is not None and stats.has_min_max
    return stats, stats.min if there else None, stats.max if there else None


def _entries(file, by_key: bool) -> Iterator[tuple]:
    """(key, rows, first, last) of each row group, and of each key in it where keys are asked for."""
    import pyarrow as pa

    meta = file.metadata
    places = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        stats, low, high = _bounds(group, places, KEY)
        times, first, last = _bounds(group, places, TIME)
        single = low is not None and low == high and stats.null_count == 0
        timed = times is None or times.has_min_max or times.null_count == group.num_rows
        if timed and (not by_key or single or KEY not in places):
            yield low if by_key and single else None, group.num_rows, _micros(first), _micros(last)
            continue
        rows = file.read_row_group(g, columns=[c for c in ([KEY] if by_key and KEY in places else []) + [TIME] if c in places])
        if TIME in places:
            rows = rows.set_column(rows.schema.get_field_index(TIME), TIME, rows[TIME].cast(pa.timestamp("us", "UTC")).cast(pa.int64()))
        else:
            rows = rows.append_column(TIME, pa.nulls(len(rows), pa.int64()))
        keys = [KEY] if by_key and KEY in places else []
        found = rows.group_by(keys).aggregate([([], "count_all"), (TIME, "min"), (TIME, "max")])
        names = found[KEY].to_pylist() if keys else [None]
        yield from zip(names, *(found[c].to_pylist() for c in ("count_all", f"{TIME}_min", f"{TIME}_max")))


def _found(listing: DataFrame, by_key: bool) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out: list[tuple] = []
            for path, day, data_type, size in zip(*(batch.column(c).to_pylist() for c in ("path", "day", "data_type", "bytes"))):
                with _opened(path) as file:
                    merged: dict = {}
                    for key, rows, first, last in _entries(file, by_key):
                        n, a, b = merged.get(key, (0, None, None))
                        merged[key] = (n + rows, min((v for v in (a, first) if v is not None), default=None),
                                       max((v for v in (b, last) if v is not None), default=None))
                out += [(path, day, data_type, size, key, *entry) for key, entry in merged.items()]
            kinds = [pa.string(), pa.date32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = [field.split()[0] for field in _FOUND.split(", ")]
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    found = listing.select("path", "day", "data_type", "bytes").mapInArrow(run, _FOUND)
    return found.select(
        "path", "day", "data_type", "file_bytes", KEY, "rows",
        F.timestamp_micros("first_us").alias("first_time"), F.timestamp_micros("last_us").alias("last_time"))


def listing(spark: SparkSession, root: str, days: tuple[str, str] | None = None, data_types: Sequence[str] | None = None) -> DataFrame:
    """The Parquet files of a range of days and of some data types; nothing is opened."""
    out = file_catalog(spark, root).where(F.col("path").endswith(".parquet"))
    if days:
        out = out.where(F.col("day").between(*[F.lit(d).cast("date") for d in days]))
    return out.where(F.col("data_type").isin(*data_types)) if data_types else out


def files(spark: SparkSession, root: str, days: tuple[str, str] | None = None, data_types: Sequence[str] | None = None) -> DataFrame:
    """One row per file: day, data type, bytes, rows, first and last time.

    A file without rows is listed with 0 rows. Where a writer left no statistics of
    the time, that column alone is read.
    """
    listed = listing(spark, root, days, data_types)
    found = _found(listed, by_key=False).drop(KEY, "file_bytes", "day", "data_type")
    return listed.join(found, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def contents(
    spark: SparkSession, root: str, days: tuple[str, str] | None = None, data_types: Sequence[str] | None = None,
    instruments: Sequence[str] | None = None,
) -> DataFrame:
    """One row per file and instrument in it: rows, first and last time, the file's path and bytes.

    Rows without a key are listed under a NULL key.
    """
    out = _found(listing(spark, root, days, data_types), by_key=True)
    return out.where(F.col(KEY).isin(*instruments)) if instruments else out


def totals(by_file: DataFrame) -> DataFrame:
    """Files, bytes, rows and time span per day and data type, from :func:`files`."""
    return by_file.groupBy("day", "data_type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def stored(by_instrument: DataFrame) -> DataFrame:
    """What is there per day, instrument and data type, from :func:`contents`."""
    return by_instrument.groupBy("day", KEY, "data_type").agg(
        F.sum("rows").alias("rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.count(F.lit(1)).alias("files"))


def coverage(by_instrument: DataFrame, expected: DataFrame) -> DataFrame:
    """Per day, venue and data type: what is stored against what is expected.

    ``expected`` has day, instrument_key and data_type, repeats count once.
    Coverage is the part of the expected instruments that has rows; where nothing
    is expected it is NULL. Stored instruments that nobody expected count as
    ``unexpected``; rows without a key stand under a NULL venue.
    """
    both = stored(by_instrument).withColumn("_s", F.lit(1)).join(
        expected.select("day", KEY, "data_type").distinct().withColumn("_e", F.lit(1)), ["day", KEY, "data_type"], "full_outer")
    found, wanted = F.col("rows") > 0, F.col("_e").isNotNull()
    out = both.groupBy("day", part(KEY, 1).alias("venue"), "data_type").agg(
        F.count_if(wanted).alias("expected"), F.count_if(wanted & found).alias("found"), F.count_if(found & ~wanted).alias("unexpected"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))
    return out.withColumn("coverage_pct", F.try_divide(F.col("found") * 100.0, F.col("expected")))
