"""Coverage of definitions with overlapping windows, and the plans of its joins."""

import datetime as dt

from tickloom.operators import coverage


def _definitions(spark, *windows):
    rows = [("V:SPOT_PAIR:A-B", "V", "SPOT_PAIR", "A", "B", "trades, liquidations", f"{a}T00:00:00Z", f"{b}T08:00:00Z") for a, b in windows]
    return spark.createDataFrame(
        rows, "instrument_key string, venue string, instrument_type string, base_asset string, quote_asset string, data_types string, "
        "available_from_datetime string, available_to_datetime string")


def test_overlapping_windows_give_each_day_once(spark):
    """A window inside another, one that touches it, one apart, one outside the range, one repeated."""
    windows = [("2024-01-01", "2024-01-10"), ("2024-01-03", "2024-01-04"), ("2024-01-11", "2024-01-12"), ("2024-01-20", "2024-01-21"),
               ("2023-01-01", "2023-01-02"), ("2024-01-20", "2024-01-21")]
    defined = _definitions(spark, *windows)
    days = [dt.date(2024, 1, d) for d in [*range(2, 13), 20]]
    ranges = coverage.type_ranges(defined, "2024-01-02", "2024-01-20", ["trades"])
    assert sorted((r.first_day.day, r.last_day.day) for r in ranges.collect()) == [(2, 12), (20, 20)]
    got = [(r.day, r.data_type) for r in coverage.expected_types(defined, "2024-01-02", "2024-01-20").collect()]
    assert sorted(got) == sorted((d, t) for d in days for t in ("trades", "liquidations"))


def test_missing_days_are_not_broadcast(spark):
    """Spark takes rows made of ranges for as small as the definitions, and would gather what is missing in the driver."""
    defined = _definitions(spark, ("2024-01-01", "2024-12-31"))
    available = spark.createDataFrame([(dt.date(2024, 1, 5), "V:SPOT_PAIR:A-B", "trades")], "day date, instrument_key string, data_type string")
    missing = coverage.missing_types(coverage.expected_types(defined, "2024-01-01", "2024-12-31"), available)
    found = coverage.available_types(defined, missing, "2024-01-01", "2024-12-31", ["trades"])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.day for r in found.collect()] == [dt.date(2024, 1, 5)]
