"""Long ordered series without one task per series.

A busy instrument can own a large share of all rows, so nothing here puts a
whole series into one window partition. Two exact methods are used:

* :func:`with_previous` - the preceding row, by windows inside short time
  buckets plus the last row of the bucket before;
* :func:`chunked` - fixed-size pieces of a numbered series, each with a copy of
  the rows just before it, for windows with a bounded reach.

Both join a frame with one row per block of the same frame. That row keeps all
columns, so both sides need the same shuffle and Spark runs it once: what lies
below (a scan of ticks, say) is not read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.timegrid import bucket_micros
from tickloom.session import work_folder

#: Rows of a range of busy blocks, once there are more than the session's shuffle partitions take.
RANGE_ROWS = 2_000_000


def time_blocks(
    df: DataFrame, keys: Sequence[str], time: str, block_seconds: int, split_rows: int | None = None, ties: Sequence[str] = (),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``_block``, the start (microseconds) of the time block of each row, and with ``split_rows`` the ``_piece`` of it.

    With ``split_rows``, a (key, block) holding more rows is cut by rank into pieces of
    that many rows at most, so that no burst becomes one task, be it in one instant:
    the rows of all busy blocks are range-partitioned in their order (time, then
    ``ties``), counted inside each partition and written to the shared work folder,
    which fixes their pieces. A range holds many pieces: the number of tasks does not
    follow ``split_rows``. Pieces follow the order. Without busy blocks, which one
    aggregation finds out at once, nothing is written. It counts the rows of
    ``counted``, if given: a frame that ``df`` was made of and that costs less to read.

    Rows without key or time have no place in a series; :func:`unplaced` counts them.
    """
    width = block_seconds * 1_000_000
    # Stated here, the filter is the same below every use of the blocks; left to the
    # optimizer it would differ, and with it the shuffles that could be shared.
    marked = df.withColumn("_block", bucket_micros(time, width)).where(F.col("_block").isNotNull())
    for key in keys:
        marked = marked.where(F.col(key).isNotNull())
    if split_rows is None:
        return marked
    whole = marked.withColumn("_piece", F.lit(0).cast("long"))  # of a block that is not cut
    seen = marked if counted is None else counted.select(*keys, bucket_micros(time, width).alias("_block"))
    busy = seen.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows)
    rows = busy.agg(F.sum("_n")).first()[0]
    if rows is None:
        return whole
    spark, order = df.sparkSession, [*keys, "_block", time, *ties]
    listed = f"{(folder := work_folder(spark, 'bursts'))}/blocks"
    busy.drop("_n").write.parquet(listed)
    blocks = spark.read.parquet(listed)
    hot = marked.join(blocks, [*keys, "_block"], "left_semi")
    # A row that no tie tells apart still falls into some range: equal rows may be cut anywhere.
    ranges = min(-(-rows // split_rows), max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // RANGE_ROWS))
    dealt = hot.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order, "_row")
    # In a sorted partition these numbers count its rows, from a start of the partition's own.
    cut = dealt.sortWithinPartitions(*order, "_row").withColumn("_piece", 1 + F.floor(F.monotonically_increasing_id() / split_rows)).drop("_row")
    cut.write.parquet(f"{folder}/rows")
    calm = whole.join(blocks, [*keys, "_block"], "left_anti")
    return calm.unionByName(spark.read.schema(cut.schema).parquet(f"{folder}/rows"))


def _place(split_rows: int | None) -> list[str]:
    """Columns that place a piece in its key's series."""
    return ["_block"] if split_rows is None else ["_block", "_piece"]


def unplaced(df: DataFrame, keys: Sequence[str], time: str = "timestamp") -> DataFrame:
    """Rows that no ordered operator sees, per key: those without time, and those without one of the keys."""
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    out = df.groupBy(*keys).agg(F.count_if(F.col(time).isNull() & ~keyless).alias("without_time"), F.count_if(keyless).alias("without_key"))
    return out.where((F.col("without_time") > 0) | (F.col("without_key") > 0))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    ties: Sequence[str] = (),
    block_seconds: int = 60,
    split_rows: int | None = None,
    prefix: str = "prev_",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``prefix + value``: each value on the preceding row of the same key.

    Rows are ordered by ``time`` and then ``ties``. The window partition is one
    piece of a (key, block); its first row takes the last row of the nearest earlier
    piece, found among one row per piece.
    """
    order, place = [time, *ties], _place(split_rows)
    piece = [*keys, *place]
    marked = time_blocks(df, keys, time, block_seconds, split_rows, ties, counted)
    inside = Window.partitionBy(*piece).orderBy(*order)
    packed = F.struct(*[F.col(v) for v in values])
    ranked = marked.withColumns({"_place": F.row_number().over(inside), "_inside": F.lag(packed).over(inside)})

    whole = F.struct(*ranked.columns)
    lasts = ranked.groupBy(*piece).agg(F.max_by(whole, F.col("_place")).alias("_last"))
    over_blocks = Window.partitionBy(*keys).orderBy(*place)
    lasts = lasts.select(*piece, F.lag("_last").over(over_blocks).alias("_before"))
    joined = ranked.join(lasts, piece)
    return joined.select(*df.columns, *[
        F.when(F.col("_place") == 1, F.col("_before")[v]).otherwise(F.col("_inside")[v]).alias(prefix + v) for v in values])


def numbered(
    df: DataFrame, keys: Sequence[str], time: str = "timestamp", block_seconds: int = 86400, split_rows: int | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add ``_rn``, the 1-based position of each row in its key's series.

    Positions come from row numbers inside a block plus the number of rows in
    earlier blocks. A day's block suits candles, whose number per day is fixed;
    ticks need short blocks and ``split_rows``.
    """
    place = _place(split_rows)
    piece = [*keys, *place]
    marked = time_blocks(df, keys, time, block_seconds, split_rows, ties)
    inside = Window.partitionBy(*piece).orderBy(time, *ties)
    ranked = marked.withColumn("_place", F.row_number().over(inside))

    whole = F.struct(*ranked.columns)
    counts = ranked.groupBy(*piece).agg(F.max_by(whole, F.col("_place")).alias("_last"))
    before = Window.partitionBy(*keys).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *piece, F.coalesce(F.sum(F.col("_last")["_place"]).over(before), F.lit(0)).alias("_offset"))
    return (
        ranked.join(offsets, piece)
        .withColumn("_rn", F.col("_offset") + F.col("_place"))
        .drop(*place, "_offset", "_place")
    )


def chunked(df: DataFrame, size: int, halo: int) -> DataFrame:
    """Cut a :func:`numbered` series into chunks of ``size`` rows.

    Adds ``_chunk`` and ``_own``. Each chunk also holds copies (``_own`` false)
    of the ``halo`` rows before it, so a window with reach ``halo`` over the
    chunk gives the same result as over the whole series. Drop the copies
    afterwards.
    """
    own = F.floor((F.col("_rn") - 1) / size)
    last = F.floor((F.col("_rn") - 1 + halo) / size)
    return (
        df.withColumn("_home", own)
        .withColumn("_chunk", F.explode(F.sequence(own, last)))
        .withColumn("_own", F.col("_home") == F.col("_chunk"))
        .drop("_home")
    )


def running_position(size: int, halo: int) -> Column:
    """Position inside a chunk, counted from the first copied row."""
    return F.col("_rn") - 1 - (F.col("_chunk") * size - halo)
