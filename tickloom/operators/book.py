"""Order-book snapshot features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import timegrid as tg
from tickloom.operators.candles import KEYS, Timeframes, interval_frame
from tickloom.schemas import BOOK_LEVELS

LEVELS = range(1, BOOK_LEVELS + 1)


def _total(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


RAW = tuple(f"{s}_{w}_{i}" for i in LEVELS for s in ("bid", "ask") for w in ("price", "volume"))


def first_snapshot(books: DataFrame, timeframe: Timeframes, keys: Sequence[str] = KEYS) -> DataFrame:
    """The first snapshot of each interval, which is the one nearest its start."""
    order = F.struct(*[c for c in ("timestamp", "local_timestamp", "id") if c in books.columns])
    row = F.struct(F.col("timestamp").alias("snapshot_timestamp"), *RAW)
    frame = interval_frame(books, timeframe, keys, [F.min_by(row, order).alias("s")])
    name = F.lit(timeframe).alias("timeframe") if isinstance(timeframe, str) else F.col("timeframe")
    return frame.select(*keys, name, "timestamp", "s.*")


def rollup_book(rows: DataFrame, timeframes: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Book rows of longer timeframes: the first child's snapshot is the parent's."""
    row = F.struct("snapshot_timestamp", *RAW)
    present = rows.where(F.col("snapshot_timestamp").isNotNull())
    frame = interval_frame(present, tuple(timeframes), keys, [F.min_by(row, F.col("snapshot_timestamp")).alias("s")])
    return emitted(derived(frame.select(*keys, "timeframe", "timestamp", "s.*")))


def emitted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("timestamp_out", tg.emission_time(F.col("snapshot_timestamp"), F.col("timestamp")))


def derived(books: DataFrame) -> DataFrame:
    """Spread, imbalance, distance and shape columns from the level columns.

    All of it is one projection. A total is NULL when a level's volume is.
    """
    bid, ask = F.col("bid_price_1"), F.col("ask_price_1")
    out = books.withColumns({
        "mid_price": (bid + ask) / 2,
        "spread_abs": ask - bid,
        "bid_ask_ratio": F.try_divide(bid, ask),
        "total_bid_volume": _total([F.col(f"bid_volume_{i}") for i in LEVELS]),
        "total_ask_volume": _total([F.col(f"ask_volume_{i}") for i in LEVELS]),
        "bid_levels_filled": _total([F.col(f"bid_price_{i}").isNotNull().cast("int") for i in LEVELS]),
        "ask_levels_filled": _total([F.col(f"ask_price_{i}").isNotNull().cast("int") for i in LEVELS]),
    })
    mid = F.col("mid_price")
    both = F.col("total_bid_volume") + F.col("total_ask_volume")
    more: dict[str, Column] = {
        "spread_bps": F.try_divide(F.col("spread_abs"), mid) * 10000,
        "volume_imbalance": F.when(both > 0, (F.col("total_bid_volume") - F.col("total_ask_volume")) / both),
        "book_imbalance": (F.col("bid_levels_filled") - F.col("ask_levels_filled")) / F.lit(float(BOOK_LEVELS)),
    }
    for side in ("bid", "ask"):
        total = F.col(f"total_{side}_volume")
        for i in LEVELS:
            more[f"{side}_distance_{i}"] = F.try_divide(F.col(f"{side}_price_{i}") - mid, mid) * 10000
            more[f"{side}_volume_ratio_{i}"] = F.when(total > 0, F.col(f"{side}_volume_{i}") / total)
        value = _total([F.col(f"{side}_price_{i}") * F.col(f"{side}_volume_{i}") for i in LEVELS])
        more[f"{side}_vwap"] = F.when(total > 0, value / total)
    return out.withColumns(more).withColumn("vwap_spread", F.col("ask_vwap") - F.col("bid_vwap"))


def book_features(
    books: DataFrame, timeframe: str, keys: Sequence[str] = KEYS, days: DataFrame | None = None
) -> DataFrame:
    """Snapshot and derived features per interval; with ``days``, empty intervals too."""
    frame = first_snapshot(books, timeframe, keys)
    if days is not None:
        grid = tg.day_grid(days.select(*keys, "day"), timeframe).drop("day")
        frame = (
            grid.join(frame.drop("timeframe"), [*keys, "timestamp"], "left")
            .withColumn("timeframe", F.lit(timeframe))
        )
    return emitted(derived(frame))
