"""Landed vendor files to the tick table.

Files lie in ``landing/data_type=…/day=…/source=<exchange>/name=<symbol>/``. Each
is checked against its folder, bad rows and files go to a quarantine with their
reasons, and what a target has in the table is replaced as a whole. A target whose
landed rows are the stored ones already is left alone, so a job may be run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import candles, coverage, quality
from tickloom.schemas import TICK_SCHEMAS
from tickloom.session import work_folder
from tickloom.sinks import tables
from tickloom.sources import readers

TARGET = ("day", "instrument_key", "data_type")
_PLACE = ("day", "source", "name")
_UNREADABLE = "_unreadable"
_STATUS = "day date, instrument_key string, data_type string, landed bigint, rejected bigint, stored_before bigint, status string"


def read_landed(spark: SparkSession, landing: str, data_type: str) -> DataFrame | None:
    """The rows of the landed files of a data type as text, with their folder and file; None where there is none.

    Columns are those of the vendor's header, day, source and name those of the
    folders. A line with too few or too many fields keeps its text.
    """
    root = f"{landing}/data_type={data_type}"
    try:
        # One line of one file: finding the columns of the whole folder would list each of its files anew.
        first = spark.read.text(root).where(F.trim("value") != "").select("value").head()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if first is None:
        return None
    header = spark.read.option("header", "true").csv(spark.sparkContext.parallelize([first.value], 1)).columns
    text = [T.StructField(c, T.StringType()) for c in header if c not in _PLACE]
    place = [T.StructField("day", T.DateType()), T.StructField("source", T.StringType()), T.StructField("name", T.StringType())]
    schema = T.StructType([*text, T.StructField(_UNREADABLE, T.StringType()), *place])
    rows = spark.read.schema(schema).option("header", "true").option("columnNameOfCorruptRecord", _UNREADABLE).csv(root)
    return rows.withColumn("file", F.col("_metadata.file_path"))


def _row_errors(data_type: str) -> Column:
    """The rules of the data type, and those of the place: readable, with a time, on its folder's day."""
    rules = [] if data_type == "quotes" else [quality.row_errors(data_type)]
    more = F.array(
        F.when(F.col(_UNREADABLE).isNotNull(), "unreadable"), F.when(F.col("timestamp").isNull(), "timestamp"),
        F.when(F.to_date("timestamp") != F.col("day"), "day"))
    return F.array_distinct(F.concat(F.array_compact(more), *rules))


def wrong_labels(rows: DataFrame) -> DataFrame:
    """Files of which a readable row names another exchange or symbol than the folder, with ``label_errors``.

    Letter case does not count; a row without a label counts as wrong.
    """
    def differs(label: str, folder: str) -> Column:
        same = F.lower(label) == F.lower(folder)
        return F.count_if(F.col(_UNREADABLE).isNull() & ~F.coalesce(same, F.lit(False))) > 0

    out = rows.groupBy("file").agg(F.array_compact(F.array(
        F.when(differs("exchange", "source"), "file_exchange"), F.when(differs("symbol", "name"), "file_symbol"))).alias("label_errors"))
    return out.where(F.size("label_errors") > 0)


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows once written: what made them is not run again, and Spark knows their size."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _checked(landed: DataFrame, data_type: str, wanted: DataFrame, days: Sequence[date]) -> DataFrame:
    """Typed rows of the wanted files with ``errors``, written once: the text is parsed one time only."""
    for label in ("exchange", "symbol"):
        if label not in landed.columns:
            landed = landed.withColumn(label, F.lit(None).cast("string"))
    # The wanted days prune folders whatever join Spark picks.
    ours = landed.where(F.col("day").isin(*days)).join(wanted, list(_PLACE))
    keep = ("instrument_key", "exchange", "symbol", "file", _UNREADABLE, *_PLACE)
    typed = readers.as_times(readers.typed(ours, data_type, keep=keep)).withColumn("errors", _row_errors(data_type))
    rows = _written(typed, "landed")
    out = rows.join(_written(wrong_labels(rows), "landed-labels"), "file", "left")
    return out.withColumn("errors", F.concat("errors", F.coalesce("label_errors", F.array().cast("array<string>")))).drop("label_errors").withColumn(
        "data_type", F.lit(data_type))


def _contents(columns: Sequence[str], n: str, digest: str, of: Column) -> list[Column]:
    """Count and digest of those of a target's rows that ``of`` holds for, whatever their order; NULL where there is none."""
    number = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    return [F.nullif(F.count_if(of), F.lit(0).cast("long")).alias(n), F.sum(F.when(of, number)).alias(digest)]


def replace_targets(rows: DataFrame, targets: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write ``rows`` in place of what the table holds of ``targets``; other rows of the same folders stay.

    Only folders (day, data type) that a target names are read and written. They are
    put together in the shared work folder first: the write reads nothing that it
    replaces.
    """
    spark = rows.sparkSession
    folders = targets.select("day", "data_type").distinct().collect()  # bounded by days of the calendar and data types
    if not folders:
        return
    by_type: dict[str, list] = {}
    for folder in folders:
        by_type.setdefault(folder.data_type, []).append(folder.day)
    touched = reduce(Column.__or__, [(F.col("data_type") == t) & F.col("day").isin(days) for t, days in sorted(by_type.items())])
    whole = rows
    held = sorted(tables.files_of(spark, path, ["day", "data_type"], touched))
    if held:
        stored = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*held)
        others = stored.join(targets.select(*TARGET).distinct(), list(TARGET), "left_anti")
        whole = others.unionByName(rows, allowMissingColumns=True)
    staged = work_folder(spark, "replace")
    whole.write.parquet(staged)
    tables.replace_partitions(spark.read.schema(whole.schema).parquet(staged), path, ["day", "data_type"], list(order), touched)


def ingest_landed(
    spark: SparkSession, landing: str, path: str, wanted: DataFrame, quarantine: str | None = None
) -> DataFrame:
    """Load the landed files of the wanted targets; returns one row per target with its status.

    ``wanted`` has day, instrument_key, data_type, source and name (see
    :func:`vendor_places`); NULLs in these name no file. Status: ``added``,
    ``replaced`` (the table held other rows), ``unchanged`` (it holds these),
    ``quarantined`` (no valid row landed, what is stored stays) or ``not_landed``.
    Rejected rows go to ``quarantine`` with all their reasons, in place of earlier
    ones of the same target.
    """
    # Asked for many times below; a missing report is read from whole tables.
    wanted = _written(wanted.select(*TARGET, "source", "name").distinct(), "wanted")
    base = wanted.select(*TARGET).distinct()
    reports = []
    for (data_type,) in wanted.select("data_type").distinct().where("data_type IS NOT NULL").collect():  # of the known types
        if data_type not in TICK_SCHEMAS:
            raise ValueError(f"unknown data type {data_type!r}; known: {sorted(TICK_SCHEMAS)}")
        places = wanted.where(F.col("data_type") == data_type).dropna().drop("data_type")
        days = [r.day for r in places.select("day").distinct().collect()]  # bounded by the calendar
        landed = read_landed(spark, landing, data_type) if days else None
        if landed is None:
            continue
        rows = _checked(landed, data_type, places, days)
        columns = [f.name for f in TICK_SCHEMAS[data_type].fields]
        valid = F.size("errors") == 0
        good = rows.where(valid).select("instrument_key", *columns, "day", "data_type")
        if {"id", "price", "local_timestamp"} <= set(columns):
            good = candles.with_sequence(good)
        report = rows.groupBy(*TARGET).agg(
            F.count(F.lit(1)).alias("landed"), F.count_if(~valid).alias("rejected"), *_contents(columns, "_new", "_new_digest", valid))
        if tables.has_files(spark, path):
            stored = spark.read.schema(good.schema).parquet(path).where((F.col("data_type") == data_type) & F.col("day").isin(*days))
            mine = stored.join(base, list(TARGET), "left_semi").groupBy(*TARGET).agg(*_contents(columns, "_old", "_old_digest", F.lit(True)))
            report = report.join(mine, list(TARGET), "left")
        else:
            report = report.withColumns({"_old": F.lit(None).cast("long"), "_old_digest": F.lit(None).cast("decimal(38,0)")})
        same = (F.col("_new") == F.col("_old")) & (F.col("_new_digest") == F.col("_old_digest"))
        status = F.when(F.col("_new").isNull(), "quarantined").when(F.col("_old").isNull(), "added").when(same, "unchanged").otherwise("replaced")
        report = report.select(*TARGET, "landed", "rejected", F.coalesce("_old", F.lit(0)).alias("stored_before"), status.alias("status"))
        # Written before the table changes, as it says how the table was.
        folder = work_folder(spark, "ingest-report")
        report.write.parquet(folder)
        report = spark.read.schema(_STATUS).parquet(folder)
        reports.append(report)
        changed = report.where(F.col("status").isin("added", "replaced"))
        replace_targets(good.join(changed.select(*TARGET), list(TARGET), "left_semi").select(*good.columns), changed, path, ["instrument_key", "timestamp"])
        if quarantine:
            bad = rows.where(~valid)
            replace_targets(bad.select(*[c for c in bad.columns if c not in ("day", "data_type")], "day", "data_type"),
                            report, f"{quarantine}/{data_type}", ["instrument_key", "file", "timestamp"])
    known = reduce(DataFrame.unionByName, reports) if reports else spark.createDataFrame([], _STATUS)
    return base.join(known, list(TARGET), "left").select(
        *TARGET, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("landed", "rejected", "stored_before")],
        F.coalesce("status", F.lit("not_landed")).alias("status"))


def vendor_places(targets: DataFrame) -> DataFrame:
    """Targets of :func:`coverage.missing_to_targets` with the folders that their files land in."""
    return targets.select(*TARGET, F.col("tardis_exchange").alias("source"), F.col("tardis_symbol").alias("name"))


def reingest_job(
    spark: SparkSession, missing: DataFrame, definitions: DataFrame, landing: str, path: str, quarantine: str | None = None, **filters
) -> DataFrame:
    """Load what a missing report lists and nothing else; returns one row per listed target with its status.

    Targets that the filters or the definitions leave out carry the reason of
    :func:`coverage.missing_to_targets` as their status.
    """
    targets = _written(coverage.missing_to_targets(missing, definitions, **filters), "targets")
    found = targets.where(F.col("target_status") == "found")
    done = ingest_landed(spark, landing, path, vendor_places(found), quarantine)
    none = F.lit(0).cast("long")
    left_out = targets.where(F.col("target_status") != "found").select(
        *TARGET, none.alias("landed"), none.alias("rejected"), none.alias("stored_before"), F.col("target_status").alias("status")).distinct()
    return done.unionByName(left_out)
