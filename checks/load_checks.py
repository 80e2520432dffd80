"""The catalog of stored ticks, loading of landed files, and the whole candle job."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.candle_checks import options_ctes
from checks.common import Checks, r, rounded
from checks.storage_checks import _tick_table
from tickloom.functions.keys import part
from tickloom.operators import coverage
from tickloom.plans import ingest, jobs
from tickloom.session import work_folder
from tickloom.sinks import tables
from tickloom.sources import adapters as ad
from tickloom.sources import catalog, readers

CHECKS = Checks()
check = CHECKS.add

_TICKS = fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER, """
t AS (SELECT day, instrument_key, 'trades' AS data_type, "timestamp" FROM trades UNION ALL SELECT day, instrument_key, 'liquidations', "timestamp" FROM liquidations
  UNION ALL SELECT day, instrument_key, 'derivative_ticker', "timestamp" FROM ticker)""")


# -- catalog ------------------------------------------------------------------------

@check("a11_catalog_contents", _TICKS + """
SELECT day, instrument_key, data_type, count(*) AS "rows", min("timestamp") AS first_time, max("timestamp") AS last_time FROM t GROUP BY ALL""")
def _contents(spark, sf):
    return catalog.stored(catalog.contents(spark, _tick_table(spark, sf))).drop("files")


@check("a13_catalog_by_footers", _TICKS + """
SELECT day, data_type, count(*) AS "rows", min("timestamp") AS first_time, max("timestamp") AS last_time, TRUE AS has_bytes FROM t GROUP BY ALL""")
def _footers(spark, sf):
    totals = catalog.totals(catalog.files(spark, _tick_table(spark, sf)))
    return totals.select("day", "data_type", "rows", "first_time", "last_time", (F.col("bytes") >= F.col("files")).alias("has_bytes"))


@check("a13_catalog_coverage", _TICKS.rstrip() + """,
k AS (SELECT DISTINCT instrument_key FROM t),
e AS (SELECT k.instrument_key, CAST(d AS DATE) AS day, dt AS data_type FROM k, (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS d),
  (SELECT unnest(['trades', 'liquidations']) AS dt)),
s AS (SELECT day, instrument_key, data_type, count(*) AS n, min("timestamp") AS a, max("timestamp") AS b FROM t GROUP BY ALL),
j AS (SELECT coalesce(e.day, s.day) AS day, coalesce(e.instrument_key, s.instrument_key) AS instrument_key, coalesce(e.data_type, s.data_type) AS data_type,
    e.day IS NOT NULL AS wanted, s.day IS NOT NULL AS found, n, a, b
  FROM e FULL JOIN s ON s.day = e.day AND s.instrument_key = e.instrument_key AND s.data_type = e.data_type)
SELECT day, split_part(instrument_key, ':', 1) AS venue, data_type, count(*) FILTER (WHERE wanted) AS expected, count(*) FILTER (WHERE wanted AND found) AS found,
  count(*) FILTER (WHERE found AND NOT wanted) AS unexpected, CAST(coalesce(sum(n), 0) AS BIGINT) AS "rows", min(a) AS first_time, max(b) AS last_time,
  round(CASE WHEN count(*) FILTER (WHERE wanted) > 0 THEN count(*) FILTER (WHERE wanted AND found) * 100.0 / count(*) FILTER (WHERE wanted) END, 6) AS coverage_pct
FROM j GROUP BY 1, 2, 3""")
def _coverage(spark, sf):
    """Two of the three stored types are expected, on days that reach beyond the stored ones."""
    keys = ad.trades(spark, sf).select("instrument_key").distinct()
    days = F.explode(F.sequence(F.lit("2024-01-05").cast("date"), F.lit("2024-02-03").cast("date")))
    expected = keys.select("instrument_key", days.alias("day")).select(
        "*", F.explode(F.array(F.lit("trades"), F.lit("liquidations"))).alias("data_type"))
    return rounded(catalog.coverage(catalog.contents(spark, _tick_table(spark, sf)), expected))


# -- landed files ----------------------------------------------------------------------

def _definitions(trades):
    return trades.select(
        "instrument_key", F.lower(part("instrument_key", 1)).alias("tardis_exchange"), part("instrument_key", 3).alias("tardis_symbol"),
        F.lit("trades").alias("data_types")).distinct()


def _land(trades, landing, wrong_price):
    """Vendor files per day and instrument; U3 comes under another exchange's label, some prices are no numbers."""
    name = part("instrument_key", 3)
    trades.select(
        F.when(name == "U3-USDT", "bybit").otherwise("BINANCE").alias("exchange"), F.lower(name).alias("symbol"),
        F.unix_micros("timestamp").alias("timestamp"), F.unix_micros("local_timestamp").alias("local_timestamp"), "id", "side",
        F.when(wrong_price, "n/a").otherwise(F.col("price").cast("string")).alias("price"), "amount",
        F.lit("trades").alias("data_type"), "day", F.lit("binance").alias("source"), name.alias("name"),
    ).hint("rebalance", "day", "name").write.partitionBy("data_type", "day", "source", "name").option("header", "true").option("compression", "gzip").csv(landing)


def _reingest(spark, sf):
    """Stored are two days of three; the rest is missing, landed, and loaded twice."""
    trades, root, landing = ad.trades(spark, sf), work_folder(spark, "p3"), f"{work_folder(spark, 'p3-landing')}/files"
    tables.write_ticks(trades.where(F.dayofmonth("day") % 3 != 0), root, "trades")
    _land(trades, landing, F.col("amount") == 5.0)
    expected = trades.select("day", "instrument_key", F.lit("trades").alias("data_type")).distinct()
    missing = coverage.missing_types(expected, catalog.stored(catalog.contents(spark, root)))
    definitions = _definitions(trades)
    first = ingest.reingest_job(spark, missing, definitions, landing, root, root + "-quarantine")
    folder = work_folder(spark, "p3-report")
    first.write.parquet(f"{folder}/first")
    targets = spark.read.parquet(f"{folder}/first")
    second = ingest.reingest_job(spark, targets.select("day", "instrument_key", "data_type"), definitions, landing, root, root + "-quarantine")
    second.write.parquet(f"{folder}/second")
    return root, targets, spark.read.parquet(f"{folder}/second")


_LANDED = fx.with_(fx.TRADES, """
m AS (SELECT *, instrument_key LIKE '%:U3-USDT' OR NOT price > 0 OR amount = 5.0 AS bad FROM trades WHERE extract(day FROM day) % 3 = 0)""")


@check("p3_reingest_job", _LANDED + """
SELECT id, day, instrument_key, "timestamp", round(price, 6) AS price, round(amount, 6) AS amount, side FROM trades WHERE extract(day FROM day) % 3 <> 0
UNION ALL SELECT id, day, instrument_key, "timestamp", round(price, 6), round(amount, 6), side FROM m WHERE NOT bad""")
def _reingested(spark, sf):
    root, _, _ = _reingest(spark, sf)
    return rounded(readers.read_ticks(spark, root, "1990-01-01", "2050-01-01").select("id", "day", "instrument_key", "timestamp", "price", "amount", "side"))


@check("p3_reingest_status", _LANDED.rstrip() + """,
s AS (SELECT day, instrument_key, 'trades' AS data_type, count(*) AS landed, count(*) FILTER (WHERE bad) AS rejected FROM m GROUP BY ALL)
SELECT *, 1 AS run, 0 AS stored_before, CASE WHEN landed = rejected THEN 'quarantined' ELSE 'added' END AS status FROM s
UNION ALL SELECT *, 2, landed - rejected, CASE WHEN landed = rejected THEN 'quarantined' ELSE 'unchanged' END FROM s""")
def _statuses(spark, sf):
    _, first, second = _reingest(spark, sf)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


@check("p2_quarantined_rows", _LANDED + """
SELECT day, instrument_key, id, CASE WHEN instrument_key LIKE '%:U3-USDT' THEN concat_ws(',', CASE WHEN NOT price > 0 OR amount = 5.0 THEN 'price' END, 'file_exchange')
  ELSE 'price' END AS reasons FROM m WHERE bad""")
def _quarantined(spark, sf):
    root, _, _ = _reingest(spark, sf)
    return spark.read.parquet(f"{root}-quarantine/trades").select("day", "instrument_key", "id", F.concat_ws(",", "errors").alias("reasons"))


# -- whole candle job ----------------------------------------------------------------------

_NUMBER = "CAST(substr(split_part(instrument_key, ':', 3), 2, 1) AS INTEGER)"
_ELIGIBLE_DAYS = f"""
k AS (SELECT DISTINCT instrument_key, {_NUMBER} AS n FROM trades),
life AS (SELECT instrument_key, n, 'G' || (n % 3) AS u, CAST(d AS DATE) AS day FROM k,
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS d)),
a AS (SELECT DISTINCT instrument_key, day FROM trades WHERE extract(day FROM day) % 7 <> {_NUMBER}),
elig AS (SELECT instrument_key, n, day FROM (SELECT life.*, a.day IS NOT NULL AS there FROM life LEFT JOIN a ON a.instrument_key = life.instrument_key AND a.day = life.day)
  QUALIFY bool_and(there) OVER (PARTITION BY u, day)),
s AS (SELECT t.* FROM trades t JOIN elig e ON e.instrument_key = t.instrument_key AND e.day = t.day)"""
_MOVED = """
moved AS (SELECT underlying_index, TIMESTAMP '2024-01-01' + to_days(CAST(extract(day FROM "timestamp") - 1 AS INTEGER)) + to_hours(CAST(strike_price / 10 AS INTEGER) % 24) AS "timestamp",
  local_timestamp, id, type, strike_price, TIMESTAMP '2024-03-01' + to_days(CAST(date_diff('day', "timestamp", expiration) AS INTEGER)) AS expiration, delta, mark_iv FROM chain)"""


def _eligible_days(spark, sf):
    trades = ad.trades(spark, sf)
    number = F.substring(part("instrument_key", 3), 2, 1).cast("int")
    definitions = trades.select("instrument_key").distinct().select(
        "instrument_key", F.lit("SPOT_PAIR").alias("instrument_type"), F.concat(F.lit("G"), number % 3).alias("base_asset"), F.lit("").alias("underlying"),
        F.lit("2024-01-03T00:00:00Z").alias("available_from_datetime"), F.lit("2024-02-28T00:00:00Z").alias("available_to_datetime"))
    available = trades.where(F.dayofmonth("day") % 7 != number).select("day", "instrument_key", F.lit("trades").alias("data_type")).distinct()
    return coverage.eligible_days(definitions, available, "2024-01-01", "2024-01-20", ["trades"])


@check("d13_eligible_days", fx.with_(fx.TRADES, _ELIGIBLE_DAYS) + "SELECT day, instrument_key FROM elig")
def _eligible(spark, sf):
    return _eligible_days(spark, sf)


_JOB = ", ".join(f'round(c."{c}", 6) AS "{c}"' for c in ("open", "high", "low", "close")) + """,
  round(coalesce(c.volume, 0), 6) AS volume, CAST(coalesce(c.trade_count, 0) AS BIGINT) AS trade_count"""


def _job_level(tf, n, source):
    return f"""
SELECT '{tf}' AS timeframe, g.instrument_key, g."timestamp", {_JOB}, o.skew AS skew_25d_put_call_ratio, o.atm AS atm_mark_iv
FROM (SELECT instrument_key, n, CAST(day AS TIMESTAMP) + to_seconds(CAST(i * {n} AS BIGINT)) AS "timestamp" FROM elig, (SELECT unnest(generate_series(0, {86400 // n - 1})) AS i)) g
LEFT JOIN {source} c ON c.instrument_key = g.instrument_key AND c."timestamp" = g."timestamp"
LEFT JOIN o{n} o ON o.underlying_index = 'A' || (g.n % 5) || '-USD' AND o."timestamp" = g."timestamp" """


@check("p7_whole_candle_job", fx.with_(fx.TRADES, _ELIGIBLE_DAYS, fx.OPTIONS, _MOVED, *options_ctes(900, "moved"), """
o900 AS (SELECT underlying_index, "timestamp", round(CASE WHEN call_iv <> 0 THEN put_iv / call_iv END, 6) AS skew, round(atm_mark_iv, 6) AS atm FROM g)""", """
o14400 AS (SELECT underlying_index, time_bucket(INTERVAL 4 HOURS, o."timestamp", TIMESTAMP '1970-01-01') AS "timestamp",
  arg_max(skew, o."timestamp") FILTER (WHERE skew IS NOT NULL) AS skew, arg_max(atm, o."timestamp") FILTER (WHERE atm IS NOT NULL) AS atm FROM o900 o GROUP BY ALL)""",
    fx.candles(900, "c1", "s"), fx.candles(14400, "c2", "s")) + _job_level("15m", 900, "c1") + " UNION ALL " + _job_level("4h", 14400, "c2"))
def _whole_job(spark, sf):
    """Days whose whole group is there, every interval, option features of the underlying; all values compared."""
    root = work_folder(spark, "p7w")
    chain = ad.options_chain(spark, sf)
    hours = F.make_dt_interval(days=F.dayofmonth("timestamp") - 1, hours=(F.col("strike_price") / 10).cast("int") % 24)
    ahead = F.date_diff("expiration", "timestamp")
    moved = chain.withColumns({
        "expiration": F.date_add(F.lit("2024-03-01").cast("date"), ahead).cast("timestamp"),
        "timestamp": F.lit("2024-01-01").cast("timestamp") + hours})
    trades = ad.trades(spark, sf)
    number = F.substring(part("instrument_key", 3), 2, 1).cast("int")
    underlyings = trades.select("instrument_key").distinct().select(
        "instrument_key", F.concat(F.lit("A"), number % 5, F.lit("-USD")).alias("underlying_index"))
    jobs.candle_job(spark, root, trades, eligible=_eligible_days(spark, sf), base_timeframes=["15m"], rollups=["4h"],
                    days=("2024-01-01", "2024-01-20"), grid=True, chain=moved, underlyings=underlyings)
    return rounded(spark.read.parquet(f"{root}/candles").select(
        "timeframe", "instrument_key", "timestamp", "open", "high", "low", "close", "volume", "trade_count", "skew_25d_put_call_ratio", "atm_mark_iv"))
