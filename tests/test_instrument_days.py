"""Days of definitions: what their shuffles carry does not grow with the number of days."""

import datetime as dt

from pyspark.sql import functions as F

from tickloom.operators import instruments as ins
from tickloom.plans import jobs
from tickloom.session import work_folder
from tickloom.sinks import tables
from tickloom.sources import adapters


def shuffled_rows(frame):
    """Rows that the exchanges of a plan wrote when it ran."""
    frame.collect()
    total, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind == "ShuffleQueryStageExec":
            nodes.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
    return total


def defined(spark, n=3, first="2024-01-02", last="2024-07-20"):
    return spark.range(n).select(
        F.concat(F.lit("A:SPOT_PAIR:K"), F.col("id").cast("string")).alias("instrument_key"),
        F.lit(f"{first}T00:00:00Z").alias("available_from_datetime"), F.lit(f"{last}T08:00:00Z").alias("available_to_datetime"))


def test_days_are_merged_before_the_shuffle(spark):
    daily = ins.daily(defined(spark), "2024-01-01", "2024-12-31")
    merged = ins.merge_days(daily)
    assert shuffled_rows(merged) < 60 < daily.count() / 9
    assert {(str(r.first_day), str(r.last_day)) for r in merged.collect()} == {("2024-01-02", "2024-07-20")}


def test_merged_days_at_the_ends_of_blocks(spark):
    """Runs of every kind around the blocks of 64 days, days before 1970, repeated rows and a day that is missing."""
    days = {"a": [*range(-70, 5), 7, *range(60, 200)], "b": [-1, 0, 63, 64, 65, 127, 129], "c": [63], "d": [None, *range(0, 64)]}
    at = lambda d: None if d is None else dt.date(1970, 1, 1) + dt.timedelta(d)
    rows = [(k, at(d)) for k, ds in days.items() for d in ds for _ in range(2)]
    got = {tuple(r) for r in ins.merge_days(spark.createDataFrame(rows, "k string, day date")).select("k", "first_day", "last_day").collect()}
    runs = [("a", -70, 4), ("a", 7, 7), ("a", 60, 199), ("b", -1, 0), ("b", 63, 65), ("b", 127, 127), ("b", 129, 129), ("c", 63, 63),
            ("d", None, None), ("d", 0, 63)]
    assert got == {(k, at(a), at(b)) for k, a, b in runs}


def test_days_are_generated_behind_the_shuffle(spark):
    windows = ins.windowed(defined(spark), "2024-01-05", "2024-12-31")
    days = tables.days_in_order(windows)
    daily = ins.daily(defined(spark), "2024-01-05", "2024-12-31")
    assert shuffled_rows(days) < daily.count() / 6
    assert sorted(map(tuple, days.select(*daily.columns).collect())) == sorted(map(tuple, daily.collect()))
    path, old = work_folder(spark, "test-windows"), work_folder(spark, "test-daily")
    tables.write_instrument_windows(windows, path)
    tables.write_instruments(daily, old)
    new, before = (spark.read.parquet(p).select(*daily.columns) for p in (path, old))
    assert new.exceptAll(before).isEmpty() and before.exceptAll(new).isEmpty()


def test_listing_is_parsed_for_the_table_and_for_the_counts_only(spark, sf):
    listing = adapters.vendor_symbols(spark, sf)
    rows, schema = listing.collect(), listing.schema
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    counted = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(seen), schema, verifySchema=False)
    jobs.instrument_job(counted, work_folder(spark, "test-job"), "2024-03-01", "2024-06-30").collect()
    assert read.value <= 2 * len(rows)
