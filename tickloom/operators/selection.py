"""Exact quantiles by selection: no list of values, no buffer that grows with a group.

Values are whole numbers. Equal ones are counted first (in each task, before the
shuffle). Counts are summed per range of ``2**bits`` neighbouring values; running
sums over a key's ranges tell which ranges hold the wanted ranks, and only in those
running sums over values pick them. All steps are hash aggregations and windows with
running sums, which hold one row at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 12


def quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, wanted: Mapping[str, float], bits: int = RANGE_BITS, scale: float = 1.0
) -> DataFrame:
    """Per key one column per entry of ``wanted`` (name to share, 0 to 1), interpolated between neighbours, divided by ``scale``.

    NULL values are left out; a key without a value has no row. Keys may be NULL.
    """
    counts = df.select(*keys, value.cast("long").alias("_v")).where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_range", F.shiftright("_v", bits))
    return quantiles_of_counts(counts, keys, wanted, scale)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], wanted: Mapping[str, float], scale: float = 1.0) -> DataFrame:
    """As :func:`quantiles`, of values ``_v`` counted in ``_n`` and dealt to ranges ``_range`` that follow their order."""
    # NULL keys meet in joins by a text that tells them from every value.
    named = {f"_k{i}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for i, k in enumerate(keys)}
    counts = counts.withColumns(named)
    on = [*named, "_range"]
    ranges = counts.groupBy(*on).agg(F.sum("_n").alias("_all"))
    series = Window.partitionBy(*named) if named else Window.partitionBy(F.lit(0))
    running = series.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.select("*", F.sum("_all").over(running).alias("_to"), F.sum("_all").over(series).alias("_total"))
    at = {name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in wanted.items()}  # place of a quantile, from 0
    ranks = {name: (F.floor(p), F.ceil(p)) for name, p in at.items()}

    def holds(rank: Column, to: str, n: str) -> Column:
        return (rank < F.col(to)) & (rank >= F.col(to) - F.col(n))

    needed = F.lit(False)
    for low, high in ranks.values():
        needed = needed | holds(low, "_to", "_all") | holds(high, "_to", "_all")
    chosen = ranges.where(needed).withColumn("_base", F.col("_to") - F.col("_all")).drop("_to", "_all")
    inside = Window.partitionBy(*on).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.join(chosen, on).withColumn("_to", F.col("_base") + F.sum("_n").over(inside))
    picked = []
    for i, (name, (low, high)) in enumerate(ranks.items()):
        picked += [F.max(F.when(holds(low, "_to", "_n"), F.col("_v"))).alias(f"_low{i}"),
                   F.max(F.when(holds(high, "_to", "_n"), F.col("_v"))).alias(f"_high{i}"),
                   F.max(at[name] - F.floor(at[name])).alias(f"_part{i}")]
    out = rows.groupBy(*named, *keys).agg(*picked)
    return out.select(*keys, *[
        ((1 - F.col(f"_part{i}")) * (F.col(f"_low{i}") / scale) + F.col(f"_part{i}") * (F.col(f"_high{i}") / scale)).alias(name)
        for i, name in enumerate(wanted)])
