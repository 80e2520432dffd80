"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tickloom.operators import book, candles, coverage, features, indicators, quality, reconcile
from tickloom.session import local_session, work_folder
from tickloom.sinks import tables
from tickloom.sources import adapters as ad
from tickloom.sources import readers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    trades, dense = ad.trades(spark, SF_DIR), ad.dense_trades(spark, SF_DIR)
    keys = [f"BINANCE:SPOT_PAIR:U{i}-USDT" for i in range(8)]

    # Stored tables, written once: scans and rollups start from these.
    root = work_folder(spark, "bench")
    tables.write_ticks(candles.with_sequence(trades), f"{root}/ticks", "trades")
    tables.write_candles(features.candles_with_features(trades, "1m", ad.liquidations(spark, SF_DIR), ad.derivative_ticker(spark, SF_DIR)),
                         f"{root}/candles")
    stored = readers.read_ticks(spark, f"{root}/ticks", "2024-01-01", "2024-02-01")
    minutes = spark.read.parquet(f"{root}/candles").drop("day")
    n_ticks = stored.count()

    times = [f"2024-01-{d:02d} {h:02d}:00:00" for d in range(2, 30, 3) for h in (3, 15)]
    hourly = candles.ohlcv(stored, "1h").select("instrument_key", "timestamp", *reconcile.FIELDS)
    other = hourly.withColumn("close", F.when(F.hour("timestamp") % 7 == 0, F.col("close") * 1.0002).otherwise(F.col("close")))
    instruments, available = ad.instruments(spark, SF_DIR), ad.available_ticks(spark, SF_DIR)
    expected = coverage.expected_types(instruments, "1995-01-01", "2001-12-31")

    work = {
        "a1_full_scan": lambda: stored,
        "a2_time_range_scan": lambda: readers.read_ticks(spark, f"{root}/ticks", "2024-01-10", "2024-01-13", instruments=keys[:4]),
        "a4_sparse_ticks": lambda: readers.ticks_for_candles(spark, f"{root}/ticks", "2024-01-01", "2024-01-31", times),
        "e1_candles_1m": lambda: candles.ohlcv(stored, "1m"),
        "e1_candles_dense_24h": lambda: candles.ohlcv(dense, "24h"),
        "e4_candles_with_features_15m": lambda: features.candles_with_features(
            trades, "15m", ad.liquidations(spark, SF_DIR), ad.derivative_ticker(spark, SF_DIR)),
        "e9_rollup_1m_to_all": lambda: candles.rollup_all(minutes),
        "e11_feature_rollup": lambda: features.rollup_features(minutes),
        "f16_indicators_1m": lambda: indicators.indicators(minutes, "1m"),
        "i17_book_features_1m": lambda: book.book_features(ad.book_snapshots(spark, SF_DIR), "1m"),
        "e8_options_features": lambda: features.options_features(ad.options_chain(spark, SF_DIR), "24h"),
        "d2_missing_by_type": lambda: coverage.missing_types(expected, available),
        "d13_underlying_groups": lambda: coverage.underlying_groups(instruments, available, ["trades", "book_snapshot_5"]),
        "j9_stability": lambda: quality.stability(trades, 900, block_seconds=3600),
        "j17_three_rules": lambda: reconcile.three_rules(hourly, other),
    }
    seconds = {}
    for name, build in work.items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")), "rows_per_second": {"a1_full_scan": round(n_ticks / seconds["a1_full_scan"])},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
