"""Quality and reconciliation findings on hand-made series."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_candles import FIVE, START, minute_candles, ticks
from tickloom.operators import quality, reconcile

KEY = ["instrument_key"]


def parent(spark, values, shift=0, tf=300):
    return minute_candles(spark, [values], step=tf).withColumn(
        "timestamp", F.col("timestamp") + F.make_interval(secs=F.lit(shift)))


def test_ohlc_preserved(spark):
    good = reconcile.preserved(minute_candles(spark, FIVE), parent(spark, (100.0, 109.0, 95.0, 104.0, 6000.0)), "5m")
    assert good.count() == 4 and reconcile.errors(good).count() == 0


def test_wrong_parent_fails(spark):
    bad = reconcile.preserved(minute_candles(spark, FIVE), parent(spark, (200.0, 300.0, 50.0, 250.0, 10000.0)), "5m")
    assert reconcile.errors(bad).count() == 4
    assert reconcile.verdict(bad, "t").first().status == "FAIL"


@pytest.mark.parametrize("shift,found", [(1, 4), (2, 0), (-1, 4)])
def test_parent_found_within_a_second(spark, shift, found):
    p = parent(spark, (100.0, 109.0, 95.0, 104.0, 6000.0), shift)
    assert reconcile.preserved(minute_candles(spark, FIVE), p, "5m").count() == found


def test_no_common_candles_fails(spark):
    far = parent(spark, (1.0, 1.0, 1.0, 1.0, 1.0), 86400)
    assert reconcile.aggregation_consistency(minute_candles(spark, FIVE), far, "5m").first().status == "FAIL"


def test_volume_tolerance(spark):
    close, off = parent(spark, (100.0, 109.0, 95.0, 104.0, 6050.0)), parent(spark, (100.0, 109.0, 95.0, 104.0, 6100.0))
    for p, n in ((close, 0), (off, 1)):
        assert reconcile.errors(reconcile.preserved(minute_candles(spark, FIVE), p, "5m", fields=("volume",))).count() == n


def test_off_grid(spark):
    assert reconcile.off_grid(parent(spark, FIVE[0], 30), "5m").first().offset_seconds == 30.0


@pytest.mark.parametrize("price,volume,status", [(1.0, 1.0, "PASS"), (1.0, 1.5, "WARNING"), (1.01, 1.0, "FAIL"), (1.01, 1.5, "FAIL")])
def test_three_rules(spark, price, volume, status):
    a = minute_candles(spark, FIVE)
    b = a.withColumns({"high": F.col("high") * price, "volume": F.col("volume") * volume})
    assert reconcile.three_rules(a, b).first().status == status


def test_repeated_candle_counts_once(spark):
    a = minute_candles(spark, FIVE)
    assert reconcile.three_rules(a, a.unionByName(a)).first().aligned_candles == 5


def test_overlap(spark):
    a = minute_candles(spark, FIVE)
    row = reconcile.timestamp_overlap(a, a.limit(3)).first()
    assert (row.overlap_ratio, row.status, row.max_timestamp_diff) == (0.6, "FAIL", 0.0)


def findings(spark, offsets, expected=60):
    t = ticks(spark, [(s, 1.0, 1.0) for s in offsets])
    return {r.test_name: r.status for r in quality.stability(t, expected).collect()}


def test_steady_times_pass(spark):
    assert set(findings(spark, [0, 60, 120, 180]).values()) == {"PASS"}


def test_duplicate_gap_and_order(spark):
    assert findings(spark, [0, 60, 60, 120])["duplicate_timestamps"] == "FAIL"
    assert findings(spark, [0, 60, 65, 120])["interval_consistency"] == "FAIL"
    assert findings(spark, [0, 60, 240])["timestamp_gaps"] == "FAIL"
    late = ticks(spark, [(0, 1.0, 1.0), (120, 1.0, 1.0), (60, 1.0, 1.0)]).withColumn(
        "local_timestamp", F.lit(START).cast("timestamp") + F.make_interval(secs=F.col("id").cast("int")))
    assert {r.test_name: r.status for r in quality.stability(late, 60).collect()}["timestamp_ordering"] == "FAIL"


def test_clock_skew(spark):
    t = ticks(spark, [(0, 1.0, 1.0)])
    assert quality.clock_skew(t).first().status == "PASS"
    behind = t.withColumn("local_timestamp", F.col("timestamp") - F.expr("INTERVAL 2 SECONDS"))
    assert quality.clock_skew(behind).first().status == "WARNING"


def test_unequal_counts_fail(spark):
    t = ticks(spark, [(0, 1.0, 1.0), (1, 1.0, 1.0)])
    assert quality.paired_clock_skew(t, t.limit(1), 1.0, KEY).first().status == "FAIL"


def test_zones(spark):
    mixed = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00+02:00",)], "t string")
    assert quality.zones(mixed, "t").first().status == "FAIL"
    one = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00+00:00",)], "t string")
    assert quality.zones(one, "t").first().status == "PASS"


def test_freshness(spark):
    t = ticks(spark, [(0, 1.0, 1.0)])
    assert quality.freshness(t, "2024-01-15 12:04:59").first().status == "PASS"
    assert quality.freshness(t, "2024-01-15 12:05:01").first().max_age_seconds == 301.0


def test_day_shape(spark):
    day = START.date()
    labels = [dt.datetime.combine(day, dt.time()) + dt.timedelta(minutes=m) for m in range(1, 1441)]
    frame = spark.createDataFrame([("k", day, t) for t in labels], "instrument_key string, day date, candle_time timestamp")
    assert quality.day_shape(frame).first().valid
    assert not quality.day_shape(frame.where(F.minute("candle_time") != 7)).first().valid


def test_row_rules(spark):
    t = ticks(spark, [(0, -1.0, 0.0, "up")])
    assert t.select(quality.row_errors("trades").alias("e")).first().e == ["price", "amount", "side"]
    with pytest.raises(ValueError):
        quality.row_errors("unknown")


def test_report_ladder(spark):
    def overall(*statuses):
        return quality.report(spark.createDataFrame([(s,) for s in statuses], "status string")).first().overall_status

    assert overall("PASS", "FAIL", "WARNING") == "FAIL" and overall("PASS", "WARNING") == "WARNING"
    assert overall("PASS", "SKIP") == "PASS" and overall("SKIP") == "SKIP"


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert quality.no_nan(frame).agg(F.sum("x")).first()[0] == 1.0


def test_missing_and_zero_values_are_errors(spark):
    candles = minute_candles(spark, FIVE)
    lacking = candles.withColumn("open", F.lit(None).cast("double"))
    assert {r.field for r in reconcile.errors(reconcile.compare(candles, lacking, KEY)).collect()} == {"open"}
    assert reconcile.errors(reconcile.compare(lacking, lacking, KEY)).count() == 0
    still = candles.withColumn("volume", F.lit(0.0))
    found = reconcile.errors(reconcile.compare(still, candles, KEY)).collect()
    assert len(found) == 5 and {r.field for r in found} == {"volume"}
    assert reconcile.errors(reconcile.compare(still, still, KEY)).count() == 0


def test_sources_without_common_times_fail_per_key(spark):
    candles = minute_candles(spark, FIVE)
    later = candles.withColumn("timestamp", F.col("timestamp") + F.make_interval(days=F.lit(1)))
    row = reconcile.three_rules(candles, later, KEY, by_key=True).first()
    assert (row.status, row.aligned_candles) == ("FAIL", 0)
