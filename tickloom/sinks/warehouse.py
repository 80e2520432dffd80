"""Warehouse tables: one per timeframe, loaded by ranges of days, with a schema that grows.

A table is a folder of days below the warehouse's root. Its declared schema lies
beside it; readers use that, so no file is opened to find columns: files from before
a column was added give NULL, and files from before a type was relaxed are widened
by the Parquet reader. A load replaces the days of its range and reads no others.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import timegrid as tg
from tickloom.functions.keys import symbol_and_exchange
from tickloom.schemas import TIMEFRAMES, WAREHOUSE_TYPES
from tickloom.sinks import tables

PREFIX = "candles_"
# What a column's type may become without a rewrite of its files.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"),
    "float": ("double",),
}


def table_schema(spark: SparkSession, root: str, table: str) -> T.StructType | None:
    """The declared schema of a table, None where there is no such table."""
    try:
        rows = spark.read.parquet(f"{root}/_schemas/{table}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(rows[0].schema))


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Columns of both, in the old order; a type that one side has wider becomes the wider one, else it is an error."""
    fields = {f.name: T.StructField(f.name, f.dataType) for f in old or ()}
    for f in new:
        known = fields.get(f.name)
        if known is None:
            fields[f.name] = T.StructField(f.name, f.dataType)
            continue
        was, now = known.dataType.simpleString(), f.dataType.simpleString()
        if now in WIDER.get(was, ()):
            fields[f.name] = T.StructField(f.name, f.dataType)
        elif now != was and was not in WIDER.get(now, ()):
            raise ValueError(f"column {f.name}: {now} does not fit the table's {was}")
    return T.StructType(list(fields.values()))


def table_rows(candles: DataFrame) -> DataFrame:
    """Candles with warehouse labels; known columns have their declared types, others keep their own."""
    symbol, exchange = symbol_and_exchange("instrument_key")
    out = candles.withColumns({
        "instrument_id": F.col("instrument_key"), "symbol": symbol, "exchange": exchange, "date": F.to_date("timestamp"),
        "day": F.to_date("timestamp")}).drop("instrument_key")
    return out.select(*[F.col(c).cast(WAREHOUSE_TYPES[c]).alias(c) if c in WAREHOUSE_TYPES else F.col(c) for c in out.columns])


def load(
    candles: DataFrame, root: str, days: tuple[str, str], timeframes: Sequence[str] = tuple(TIMEFRAMES), prefix: str = PREFIX
) -> DataFrame:
    """Load a range of days into the tables of ``timeframes`` and report each day of each.

    Stored days of the range are replaced, those without candles too; other days stay
    as they are. New columns are added, types are relaxed (see :data:`WIDER`);
    columns the candles lack become NULL. Returns day, timeframe, rows and status
    (``loaded`` or ``empty``) of every day in the range.
    """
    spark = candles.sparkSession
    ranged = table_rows(candles).where(tables.days_between(*days))
    for tf in timeframes:
        rows, table = ranged.where(F.col("timeframe") == tf), f"{prefix}{tf}"
        schema = merged_schema(table_schema(spark, root, table), rows.schema)
        # The schema comes first: readers between the two steps see NULL in a new column.
        named = spark.createDataFrame([(schema.json(),)], "schema string")
        named.coalesce(1).write.mode("overwrite").parquet(f"{root}/_schemas/{table}")
        whole = rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        tables.replace_partitions(
            whole, f"{root}/{table}", ["day"], ["exchange", "symbol", "timestamp"], tables.days_between(*days))
    return day_status(spark, root, days, timeframes, prefix)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = table_schema(spark, root, table)
    if schema is None:
        raise FileNotFoundError(f"no table {table} in {root}")
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def day_status(
    spark: SparkSession, root: str, days: tuple[str, str], timeframes: Sequence[str] = tuple(TIMEFRAMES), prefix: str = PREFIX
) -> DataFrame:
    """Rows and status of each day of a range, per timeframe; a day without rows is ``empty``."""
    out = None
    for tf in timeframes:
        rows = read_table(spark, root, f"{prefix}{tf}").where(tables.days_between(*days)).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))
        one = tg.calendar(spark, *days).join(rows, "day", "left").select(
            "day", F.lit(tf).alias("timeframe"), F.coalesce("rows", F.lit(0)).alias("rows"),
            F.when(F.col("rows") > 0, "loaded").otherwise("empty").alias("status"))
        out = one if out is None else out.unionByName(one)
    return out


def totals(status: DataFrame) -> DataFrame:
    """Rows, days loaded and days empty per timeframe."""
    return status.groupBy("timeframe").agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("status") == "loaded").alias("days_loaded"),
        F.count_if(F.col("status") == "empty").alias("days_empty"))


def load_available(
    candles: DataFrame, report: DataFrame, root: str, days: tuple[str, str], timeframes: Sequence[str] = tuple(TIMEFRAMES),
    data_type: str = "trades", prefix: str = PREFIX,
) -> DataFrame:
    """From an available report to the warehouse: candles of the instruments and days whose ``data_type`` is available.

    ``candles`` is the stored table with its ``day`` and ``timeframe`` folders, of
    which only those of the range and timeframes are read.
    """
    there = report.where((F.col("data_type") == data_type) & tables.days_between(*days)).select("day", "instrument_key").distinct()
    chosen = candles.where(tables.days_between(*days) & F.col("timeframe").isin(*timeframes)).join(there, ["day", "instrument_key"], "left_semi")
    return load(chosen, root, days, timeframes, prefix)
