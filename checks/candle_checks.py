"""Candles, features, book rows and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.common import CANDLE_SQL, Checks, r, rounded
from tickloom.functions import timegrid as tg
from tickloom.operators import book, candles, features, indicators
from tickloom.operators.series import with_previous
from tickloom.schemas import INDICATORS
from tickloom.sources import adapters as ad

CHECKS = Checks()
check = CHECKS.add


def _candle_query(timeframe, source=ad.trades):
    def run(spark, sf):
        return rounded(candles.ohlcv(source(spark, sf), timeframe).drop("timeframe"))
    return run


for tf in ("15s", "1m", "5m", "1h", "4h", "24h"):
    check(f"e1_ohlcv_{tf}", fx.with_(fx.TRADES, fx.candles(tg.seconds(tf))) + f"SELECT {CANDLE_SQL} FROM candles")(
        _candle_query(tf))

check("e1_ohlcv_dense_24h",
      fx.with_(fx.DENSE_TRADES, fx.candles(86400, source="dense")) + f"SELECT {CANDLE_SQL} FROM candles")(
    _candle_query("24h", ad.dense_trades))


@check("e1_ohlcv_sequenced_24h",
       fx.with_(fx.DENSE_TRADES, fx.candles(86400, source="dense")) + f"SELECT {CANDLE_SQL} FROM candles")
def _sequenced(spark, sf):
    ticks = candles.with_sequence(ad.dense_trades(spark, sf))
    return rounded(candles.ohlcv(ticks, "24h").drop("timeframe"))


_GRID = """,
grid AS (
  SELECT d.instrument_key, CAST(d.day AS TIMESTAMP) + to_seconds(CAST(g.i * {n} AS BIGINT)) AS "timestamp"
  FROM (SELECT DISTINCT instrument_key, CAST("timestamp" AS DATE) AS day FROM candles) d,
       (SELECT unnest(range(0, {last})) AS i) g
)"""


def _grid_sql(n: int) -> str:
    return _GRID.format(n=n, last=86400 // n)


def _filled_sql(n: int) -> str:
    return fx.with_(fx.TRADES, fx.candles(n)) .rstrip() + _grid_sql(n) + """
SELECT g.instrument_key, g."timestamp", coalesce(c.timestamp_out, g."timestamp" + INTERVAL 200 MILLISECONDS) AS timestamp_out,
  round(c."open", 6) AS "open", round(c.high, 6) AS high, round(c.low, 6) AS low, round(c."close", 6) AS "close",
  round(coalesce(c.volume, 0), 6) AS volume, round(c.vwap, 6) AS vwap, CAST(coalesce(c.trade_count, 0) AS BIGINT) AS trade_count
FROM grid g LEFT JOIN candles c ON g.instrument_key = c.instrument_key AND g."timestamp" = c."timestamp" """


@check("d8_grid_15m", _filled_sql(900))
def _grid_15m(spark, sf):
    return rounded(candles.fill_grid(candles.ohlcv(ad.trades(spark, sf), "15m"), "15m").drop("timeframe"))


@check("i5_day_boundaries_1m", fx.with_(fx.TRADES) + """
SELECT d.day, CAST(d.day AS TIMESTAMP) + to_minutes(CAST(g.i AS BIGINT)) AS "timestamp"
FROM (SELECT DISTINCT day FROM trades) d, (SELECT unnest(range(0, 1440)) AS i) g""")
def _boundaries(spark, sf):
    return tg.day_grid(ad.trades(spark, sf).select("day").distinct(), "1m")


@check("e2_emission_time_1m", fx.with_(fx.TRADES, fx.candles(60)) +
       'SELECT instrument_key, "timestamp", timestamp_out FROM candles')
def _emission(spark, sf):
    return candles.ohlcv(ad.trades(spark, sf), "1m").select("instrument_key", "timestamp", "timestamp_out")


@check("e3_candle_shape_1h", fx.with_(fx.TRADES, fx.candles(3600)) + """
SELECT instrument_key, "timestamp",
  round(CAST(epoch_us(timestamp_out) - epoch_us("timestamp") AS DOUBLE) / 1000.0, 6) AS latency_ms,
  round("close" - "open", 6) AS price_change,
  round(CASE WHEN "open" = 0 THEN 0.0 ELSE ("close" - "open") / "open" * 100 END, 6) AS price_change_pct,
  ("close" >= "open") AS is_green
FROM candles""")
def _shape(spark, sf):
    return rounded(candles.describe(candles.ohlcv(ad.trades(spark, sf), "1h")).select(
        "instrument_key", "timestamp", "latency_ms", "price_change", "price_change_pct", "is_green"))


# -- rollups ---------------------------------------------------------------

_ROLL_SELECT = """
  SELECT instrument_key, time_bucket(INTERVAL {n} SECONDS, "timestamp", TIMESTAMP '1970-01-01') AS "timestamp",
    max(timestamp_out) + INTERVAL 200 MILLISECONDS AS timestamp_out,
    arg_min_null("open", "timestamp") AS "open", max(high) AS high, min(low) AS low,
    arg_max_null("close", "timestamp") AS "close", sum(volume) AS volume,
    CASE WHEN sum(volume) > 0 THEN sum(vwap * volume) / sum(volume) END AS vwap,
    CAST(sum(trade_count) AS BIGINT) AS trade_count
  FROM candles GROUP BY ALL"""
_ROLL = ",\nrolled AS (" + _ROLL_SELECT + ")\n"


@check("e9_rollup_1m_to_1h", fx.with_(fx.TRADES, fx.candles(60)).rstrip() + _ROLL.format(n=3600) +
       f"SELECT {CANDLE_SQL} FROM rolled")
def _rollup(spark, sf):
    return rounded(candles.rollup(candles.ohlcv(ad.trades(spark, sf), "1m"), "1h").drop("timeframe"))


@check("e9_rollup_all", fx.with_(fx.TRADES, fx.candles(60)).rstrip() + ",\nrolled AS (" + "\nUNION ALL\n".join(
    f"SELECT '{tf}' AS timeframe, * FROM ({_ROLL_SELECT.format(n=tg.seconds(tf))})"
    for tf in ("5m", "15m", "1h", "4h", "24h")) + f")\nSELECT timeframe, {CANDLE_SQL} FROM rolled")
def _rollup_all(spark, sf):
    return rounded(candles.rollup_all(candles.ohlcv(ad.trades(spark, sf), "1m")))


_EMPTY_ROLL = """,
filled AS (
  SELECT g.instrument_key, g."timestamp", c."open", c.high, c.low, c."close", coalesce(c.volume, 0) AS volume,
    c.vwap, coalesce(c.trade_count, 0) AS trade_count
  FROM grid g LEFT JOIN candles c ON g.instrument_key = c.instrument_key AND g."timestamp" = c."timestamp")
"""


@check("e9_rollup_with_empty_children", fx.with_(fx.TRADES, fx.candles(900)).rstrip() + _grid_sql(900) + _EMPTY_ROLL + """
SELECT instrument_key, time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS "timestamp",
  arg_min_null("open", "timestamp") AS "open", max(high) AS high, min(low) AS low,
  arg_max_null("close", "timestamp") AS "close", round(sum(volume), 6) AS volume,
  round(CASE WHEN sum(volume) > 0 THEN sum(vwap * volume) / sum(volume) END, 6) AS vwap,
  CAST(sum(trade_count) AS BIGINT) AS trade_count
FROM filled GROUP BY ALL""")
def _rollup_empty(spark, sf):
    base = candles.fill_grid(candles.ohlcv(ad.trades(spark, sf), "15m"), "15m")
    return rounded(candles.rollup(base, "1h").drop("timeframe", "timestamp_out"))


@check("e10_rollup_emission_1h", fx.with_(fx.TRADES, fx.candles(60)).rstrip() + _ROLL.format(n=3600) +
       'SELECT instrument_key, "timestamp", timestamp_out FROM rolled')
def _rollup_emission(spark, sf):
    return candles.rollup(candles.ohlcv(ad.trades(spark, sf), "1m"), "1h").select(
        "instrument_key", "timestamp", "timestamp_out")


@check("e12_shifted_candles_1m", fx.with_(fx.TRADES) + """
SELECT instrument_key, CAST(rt AS DATE) AS day,
  time_bucket(INTERVAL 1 MINUTE, rt + INTERVAL 60 SECONDS, TIMESTAMP '1970-01-01') AS candle_time,
  arg_min_null(price, row(rt, "timestamp", id)) AS "open", max(price) AS high, min(price) AS low,
  arg_max_null(price, row(rt, "timestamp", id)) AS "close", round(sum(amount), 6) AS volume, count(*) AS trade_count
FROM (SELECT *, local_timestamp + INTERVAL 200 MILLISECONDS AS rt FROM trades) GROUP BY ALL""")
def _shifted(spark, sf):
    return rounded(candles.shifted(ad.trades(spark, sf)))


# -- features --------------------------------------------------------------

_BUCKET = "time_bucket(INTERVAL {n} SECONDS, \"timestamp\", TIMESTAMP '1970-01-01')"
_DELAY = 'CAST(epoch_us(local_timestamp) - epoch_us("timestamp") AS DOUBLE) / 1000.0'


def _trade_features_cte(n: int) -> str:
    return f"""
tf AS (
  SELECT instrument_key, {_BUCKET.format(n=n)} AS b, count(*) AS trade_count,
    sum(CASE WHEN side = 'buy' THEN amount ELSE 0 END) AS buy_volume_sum,
    sum(CASE WHEN side = 'sell' THEN amount ELSE 0 END) AS sell_volume_sum,
    avg(amount) AS size_avg, sum(price * amount) / sum(amount) AS price_vwap,
    median({_DELAY}) AS delay_median, max({_DELAY}) AS delay_max, min({_DELAY}) AS delay_min, avg({_DELAY}) AS delay_mean
  FROM trades GROUP BY ALL
)"""


_TF_COLUMNS = r("buy_volume_sum", "sell_volume_sum", "size_avg", "price_vwap",
                "delay_median", "delay_max", "delay_min", "delay_mean")


@check("e4_trade_features_1h", fx.with_(fx.TRADES, _trade_features_cte(3600)) +
       f'SELECT instrument_key, b AS "timestamp", trade_count, {_TF_COLUMNS} FROM tf')
def _trade_features(spark, sf):
    return rounded(features.trade_features(ad.trades(spark, sf), "1h"))


@check("e5_liquidation_features_1h", fx.with_(fx.EVENTS, fx.LIQUIDATIONS) + f"""
SELECT instrument_key, {_BUCKET.format(n=3600)} AS "timestamp", count(*) AS liquidation_count,
  round(sum(CASE WHEN side = 'buy' THEN amount ELSE 0 END), 6) AS liquidation_buy_volume,
  round(sum(CASE WHEN side = 'sell' THEN amount ELSE 0 END), 6) AS liquidation_sell_volume
FROM liquidations GROUP BY ALL""")
def _liquidation_features(spark, sf):
    return rounded(features.liquidation_features(ad.liquidations(spark, sf), "1h"))


def _derivative_cte(n: int) -> str:
    o = 'row("timestamp", local_timestamp, id)'
    cols = ", ".join(
        f"arg_max({c}, {o}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("funding_rate", "index_price", "mark_price", "open_interest", "predicted_funding_rate"))
    return f"""
dv AS (SELECT instrument_key, {_BUCKET.format(n=n)} AS b, {cols} FROM ticker GROUP BY ALL)"""


_DV_COLUMNS = r("funding_rate", "index_price", "mark_price", "open_interest", "predicted_funding_rate", digits=9)


@check("e6_derivative_features_4h", fx.with_(fx.EVENTS, fx.TICKER, _derivative_cte(14400)) +
       f'SELECT instrument_key, b AS "timestamp", {_DV_COLUMNS} FROM dv')
def _derivative_features(spark, sf):
    return rounded(features.derivative_features(ad.derivative_ticker(spark, sf), "4h"), 9)


@check("d10_carry_forward_15m", fx.with_(fx.EVENTS, fx.TICKER, _derivative_cte(900)) + """
SELECT instrument_key, b AS "timestamp",
  last_value(predicted_funding_rate IGNORE NULLS) OVER w AS predicted_funding_rate,
  last_value(open_interest IGNORE NULLS) OVER w AS open_interest
FROM dv WINDOW w AS (PARTITION BY instrument_key, CAST(b AS DATE) ORDER BY b
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _carry(spark, sf):
    frame = features.derivative_features(ad.derivative_ticker(spark, sf), "15m").select(
        "instrument_key", "timestamp", "predicted_funding_rate", "open_interest")
    return features.carry_forward(frame, ["predicted_funding_rate", "open_interest"])


def _full_feature_sql(n: int, select: str) -> str:
    return fx.with_(fx.TRADES, fx.LIQUIDATIONS, fx.TICKER, fx.candles(n), _trade_features_cte(n), _derivative_cte(n),
                    f"""
lq AS (SELECT instrument_key, {_BUCKET.format(n=n)} AS b, count(*) AS n,
         sum(CASE WHEN side = 'buy' THEN amount ELSE 0 END) AS buy, sum(CASE WHEN side = 'sell' THEN amount ELSE 0 END) AS sell
       FROM liquidations GROUP BY ALL)""", """
j AS (
  SELECT c.*, tf.* EXCLUDE (instrument_key, b, trade_count), dv.* EXCLUDE (instrument_key, b),
    CAST(coalesce(lq.n, 0) AS BIGINT) AS liquidation_count, coalesce(lq.buy, 0) AS liquidation_buy_volume,
    coalesce(lq.sell, 0) AS liquidation_sell_volume
  FROM candles c JOIN tf ON tf.instrument_key = c.instrument_key AND tf.b = c."timestamp"
  LEFT JOIN lq ON lq.instrument_key = c.instrument_key AND lq.b = c."timestamp"
  LEFT JOIN dv ON dv.instrument_key = c.instrument_key AND dv.b = c."timestamp"
)""", """
f AS (
  SELECT *, CASE WHEN oi_change > 0 THEN liquidation_buy_volume + liquidation_sell_volume END AS liquidation_with_rising_oi,
    CASE WHEN oi_change < 0 THEN liquidation_buy_volume + liquidation_sell_volume END AS liquidation_with_falling_oi
  FROM (SELECT *, open_interest - lag(open_interest) OVER (PARTITION BY instrument_key ORDER BY "timestamp") AS oi_change
        FROM j)
)""") + select


_OI = r("oi_change", "liquidation_with_rising_oi", "liquidation_with_falling_oi")
_LIQ = "liquidation_count, " + r("liquidation_buy_volume", "liquidation_sell_volume")


@check("e7_oi_features_1h", _full_feature_sql(3600, f'SELECT instrument_key, "timestamp", {_OI} FROM f'))
def _oi(spark, sf):
    frame = features.candles_with_features(
        ad.trades(spark, sf), "1h", ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf))
    return rounded(frame.select("instrument_key", "timestamp", "oi_change", "liquidation_with_rising_oi",
                                "liquidation_with_falling_oi"))


@check("e4_e7_candles_with_features_15m", _full_feature_sql(
    900, f"SELECT '15m' AS timeframe, {CANDLE_SQL}, {_TF_COLUMNS}, {_LIQ}, {r('funding_rate', 'index_price', 'mark_price', 'open_interest', 'predicted_funding_rate')}, {_OI} FROM f"))
def _all_features(spark, sf):
    return rounded(features.candles_with_features(
        ad.trades(spark, sf), "15m", ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf)))


@check("f21_oi_change_1h", fx.with_(fx.EVENTS, fx.TICKER, _derivative_cte(3600)) + """
SELECT instrument_key, b AS "timestamp",
  round(open_interest - lag(open_interest) OVER (PARTITION BY instrument_key ORDER BY b), 6) AS oi_change FROM dv""")
def _oi_change(spark, sf):
    frame = features.derivative_features(ad.derivative_ticker(spark, sf), "1h")
    stepped = with_previous(frame, ["instrument_key"], "timestamp", ["open_interest"], block_seconds=86400)
    return rounded(stepped.select("instrument_key", "timestamp", (
        F.col("open_interest") - F.col("prev_open_interest")).alias("oi_change")))


def options_ctes(seconds: int, source: str = "chain") -> tuple[str, ...]:
    return (f"""
latest AS (
  SELECT underlying_index, time_bucket(INTERVAL {seconds} SECONDS, "timestamp", TIMESTAMP '1970-01-01') AS b, type, strike_price, expiration,
    arg_max_null(delta, row("timestamp", local_timestamp, id)) AS delta,
    arg_max_null(mark_iv, row("timestamp", local_timestamp, id)) AS mark_iv
  FROM {source} GROUP BY ALL HAVING expiration >= b
)""", """
near AS (SELECT * FROM latest QUALIFY expiration = min(expiration) OVER (PARTITION BY underlying_index, b))""", """
g AS (
  SELECT underlying_index, b AS "timestamp", expiration,
    arg_min(mark_iv, row(round(abs(abs(delta) - 0.25), 9), strike_price, type)) FILTER (WHERE type = 'put') AS put_iv,
    arg_min(mark_iv, row(round(abs(abs(delta) - 0.25), 9), strike_price, type)) FILTER (WHERE type = 'call') AS call_iv,
    arg_min(mark_iv, row(round(abs(abs(delta) - 0.5), 9), strike_price, type)) AS atm_mark_iv
  FROM near GROUP BY ALL
)""")


@check("e8_options_features_24h", fx.with_(fx.OPTIONS, *options_ctes(86400)) + """
SELECT underlying_index, "timestamp", expiration, round(CASE WHEN call_iv <> 0 THEN put_iv / call_iv END, 6) AS skew_25d_put_call_ratio,
  round(atm_mark_iv, 6) AS atm_mark_iv FROM g""")
def _options(spark, sf):
    return rounded(features.options_features(ad.options_chain(spark, sf), "24h"))


_FEATURE_ROLL = """
fr AS (
  SELECT instrument_key, time_bucket(INTERVAL 4 HOURS, "timestamp", TIMESTAMP '1970-01-01') AS "timestamp",
    sum(buy_volume_sum) AS buy_volume_sum, sum(sell_volume_sum) AS sell_volume_sum,
    CAST(sum(liquidation_count) AS BIGINT) AS liquidation_count, sum(liquidation_buy_volume) AS liquidation_buy_volume,
    sum(liquidation_sell_volume) AS liquidation_sell_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count,
    sum(size_avg * trade_count) / sum(trade_count) AS size_avg, sum(price_vwap * volume) / sum(volume) AS price_vwap,
    median(delay_median) AS delay_median, {dmax}(delay_max) AS delay_max, {dmin}(delay_min) AS delay_min,
    median(delay_mean) AS delay_mean,
    arg_max(funding_rate, "timestamp") FILTER (WHERE funding_rate IS NOT NULL) AS funding_rate,
    arg_max(open_interest, "timestamp") FILTER (WHERE open_interest IS NOT NULL) AS open_interest,
    arg_max(predicted_funding_rate, "timestamp") FILTER (WHERE predicted_funding_rate IS NOT NULL) AS predicted_funding_rate
  FROM f GROUP BY ALL
)"""


def _feature_roll(spec):
    names = ["instrument_key", "timestamp", "buy_volume_sum", "sell_volume_sum", "liquidation_count", "liquidation_buy_volume",
             "liquidation_sell_volume", "trade_count", "size_avg", "price_vwap", "delay_median", "delay_max", "delay_min",
             "delay_mean", "funding_rate", "open_interest", "predicted_funding_rate"]

    def run(spark, sf):
        base = features.candles_with_features(
            ad.trades(spark, sf), "15m", ad.liquidations(spark, sf), ad.derivative_ticker(spark, sf))
        return rounded(features.rollup_features(base, ["4h"], spec_delays=spec).select(*names))

    text = _full_feature_sql(900, "").rstrip() + "," + _FEATURE_ROLL.format(
        dmax="max" if spec else "median", dmin="min" if spec else "median")
    doubles = [n for n in names if n not in ("instrument_key", "timestamp", "liquidation_count", "trade_count")]
    return run, text + f' SELECT instrument_key, "timestamp", liquidation_count, trade_count, {r(*doubles)} FROM fr'


CHECKS["e11_feature_rollup_4h"] = _feature_roll(False)
CHECKS["e11_feature_rollup_spec_4h"] = _feature_roll(True)


# -- book ------------------------------------------------------------------

def _first_book(n: int) -> str:
    return f"""
fb AS (
  SELECT instrument_key, {_BUCKET.format(n=n)} AS b, arg_min_null(books, row("timestamp", local_timestamp, id)) AS s
  FROM books GROUP BY instrument_key, b
)"""


def _level(c: str) -> str:
    return f"s.{c}"


def _sum_levels(expr: str) -> str:
    return "(" + " + ".join(expr.format(i=i) for i in range(1, 6)) + ")"


def _book_sql(n: int) -> str:
    raw = ", ".join(f"s.{side}_{w}_{i} AS {side}_{w}_{i}" for i in range(1, 6) for side in ("bid", "ask") for w in ("price", "volume"))
    base = fx.with_(fx.EVENTS, fx.BOOKS, _first_book(n), f"""
lv AS (SELECT instrument_key, b AS "timestamp", s."timestamp" AS snapshot_timestamp, {raw} FROM fb)""", f"""
t AS (SELECT *, (bid_price_1 + ask_price_1) / 2 AS mid, {_sum_levels('bid_volume_{i}')} AS tb, {_sum_levels('ask_volume_{i}')} AS ta,
        {_sum_levels('CASE WHEN bid_price_{i} IS NOT NULL THEN 1 ELSE 0 END')} AS nb,
        {_sum_levels('CASE WHEN ask_price_{i} IS NOT NULL THEN 1 ELSE 0 END')} AS na FROM lv)""", f"""
v AS (SELECT *, CASE WHEN tb > 0 THEN {_sum_levels('bid_price_{i} * bid_volume_{i}')} / tb END AS bv,
        CASE WHEN ta > 0 THEN {_sum_levels('ask_price_{i} * ask_volume_{i}')} / ta END AS av FROM t)""")
    items = [
        'instrument_key', '"timestamp"', "snapshot_timestamp", "snapshot_timestamp + INTERVAL 200 MILLISECONDS AS timestamp_out",
        "CAST(nb AS INTEGER) AS bid_levels_filled", "CAST(na AS INTEGER) AS ask_levels_filled",
        "round(mid, 6) AS mid_price", "round(ask_price_1 - bid_price_1, 6) AS spread_abs",
        "round(CASE WHEN mid <> 0 THEN (ask_price_1 - bid_price_1) / mid END * 10000, 6) AS spread_bps",
        "round(CASE WHEN ask_price_1 <> 0 THEN bid_price_1 / ask_price_1 END, 6) AS bid_ask_ratio",
        "round(tb, 6) AS total_bid_volume", "round(ta, 6) AS total_ask_volume",
        "round(CASE WHEN tb + ta > 0 THEN (tb - ta) / (tb + ta) END, 6) AS volume_imbalance",
        "round(bv, 6) AS bid_vwap", "round(av, 6) AS ask_vwap", "round(av - bv, 6) AS vwap_spread",
        "round((nb - na) / 5.0, 6) AS book_imbalance",
    ]
    for i in range(1, 6):
        for side, total in (("bid", "tb"), ("ask", "ta")):
            items += [
                f"round({side}_price_{i}, 6) AS {side}_price_{i}", f"round({side}_volume_{i}, 6) AS {side}_volume_{i}",
                f"round(CASE WHEN mid <> 0 THEN ({side}_price_{i} - mid) / mid END * 10000, 6) AS {side}_distance_{i}",
                f"round(CASE WHEN {total} > 0 THEN {side}_volume_{i} / {total} END, 6) AS {side}_volume_ratio_{i}"]
    return base + "SELECT " + ", ".join(items) + " FROM v"


@check("i17_book_features_15m", _book_sql(900))
def _book(spark, sf):
    return rounded(book.book_features(ad.book_snapshots(spark, sf), "15m").drop("timeframe"))


@check("d9_first_snapshot_1h", fx.with_(fx.EVENTS, fx.BOOKS, _first_book(3600)) + """
SELECT instrument_key, b AS "timestamp", s."timestamp" AS snapshot_timestamp, round(s.bid_price_1, 6) AS bid_price_1,
  round(s.ask_volume_5, 6) AS ask_volume_5 FROM fb""")
def _first_snapshot(spark, sf):
    return rounded(book.first_snapshot(ad.book_snapshots(spark, sf), "1h").select(
        "instrument_key", "timestamp", "snapshot_timestamp", "bid_price_1", "ask_volume_5"))


@check("i18_book_emission_grid_15m", fx.with_(fx.EVENTS, fx.BOOKS, _first_book(900), """
g AS (
  SELECT d.instrument_key, CAST(d.day AS TIMESTAMP) + to_minutes(CAST(x.i * 15 AS BIGINT)) AS b
  FROM (SELECT DISTINCT instrument_key, day FROM books) d, (SELECT unnest(range(0, 96)) AS i) x)""") + """
SELECT g.instrument_key, g.b AS "timestamp",
  coalesce(fb.s."timestamp", g.b) + INTERVAL 200 MILLISECONDS AS timestamp_out,
  CAST(CASE WHEN fb.s.bid_price_5 IS NOT NULL THEN 5 WHEN fb.s IS NULL THEN 0 ELSE 4 END AS INTEGER) AS bid_levels_filled
FROM g LEFT JOIN fb ON g.instrument_key = fb.instrument_key AND g.b = fb.b""")
def _book_grid(spark, sf):
    books = ad.book_snapshots(spark, sf)
    days = books.select("instrument_key", "day").distinct()
    return book.book_features(books, "15m", days=days).select(
        "instrument_key", "timestamp", "timestamp_out", "bid_levels_filled")


@check("i17_book_rollup_4h", _book_sql(14400))
def _book_rollup(spark, sf):
    base = book.book_features(ad.book_snapshots(spark, sf), "15m")
    return rounded(book.rollup_book(base, ["4h"]).drop("timeframe"))


@check("e1_ohlcv_one_pass", fx.with_(fx.TRADES, *[fx.candles(n, f"c{n}") for n in (15, 60, 86400)]) + " UNION ALL ".join(
    f"SELECT '{tf}' AS timeframe, {CANDLE_SQL} FROM c{n}" for tf, n in (("15s", 15), ("1m", 60), ("24h", 86400))))
def _one_pass(spark, sf):
    return rounded(candles.ohlcv(candles.with_sequence(ad.trades(spark, sf)), ("15s", "1m", "24h")))


# -- indicators ------------------------------------------------------------

def _ema_cte(name: str, column: str, k: int) -> str:
    a = 2.0 / (k + 1)
    return f"""
{name} AS (
  SELECT instrument_key, rn, {column} AS e FROM s WHERE rn = {k}
  UNION ALL
  SELECT s.instrument_key, s.rn, {a!r} * s.{column} + {1 - a!r} * p.e
  FROM {name} p JOIN s ON s.instrument_key = p.instrument_key AND s.rn = p.rn + 1
)"""


def _since(k: int, expr: str) -> str:
    return f"CASE WHEN rn >= {k} THEN {expr} END"


def _indicator_ctes(n: int) -> str:
    return fx.with_(fx.TRADES, fx.candles(n), """
s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY "timestamp") AS rn FROM candles)""",
                    _ema_cte("ema5", "close", 5), _ema_cte("ema10", "close", 10), _ema_cte("ema20", "close", 20),
                    _ema_cte("vema5", "volume", 5), """
l AS (
  SELECT s.*, ema5.e AS ema_5, ema10.e AS ema_10, ema20.e AS ema_20, vema5.e AS volume_ema_5,
    lag("close", 1) OVER w AS p1, lag("close", 2) OVER w AS p2, lag("close", 3) OVER w AS p3, lag("close", 4) OVER w AS p4,
    lag("close", 5) OVER w AS p5, lag(volume) OVER w AS v1
  FROM s LEFT JOIN ema5 ON ema5.instrument_key = s.instrument_key AND ema5.rn = s.rn
  LEFT JOIN ema10 ON ema10.instrument_key = s.instrument_key AND ema10.rn = s.rn
  LEFT JOIN ema20 ON ema20.instrument_key = s.instrument_key AND ema20.rn = s.rn
  LEFT JOIN vema5 ON vema5.instrument_key = s.instrument_key AND vema5.rn = s.rn
  WINDOW w AS (PARTITION BY s.instrument_key ORDER BY s.rn)
)""", f"""
m AS (
  SELECT *, {_since(5, 'avg("close") OVER w5')} AS sma_5, {_since(10, 'avg("close") OVER w10')} AS sma_10,
    {_since(20, 'avg("close") OVER w20')} AS sma_20, {_since(5, 'avg(volume) OVER w5')} AS volume_sma_5,
    {_since(5, 'stddev_pop("close") OVER w5')} AS price_volatility_5,
    {_since(10, 'stddev_pop("close") OVER w10')} AS price_volatility_10,
    {_since(6, 'avg(greatest("close" - p1, 0)) OVER w5')} AS g, {_since(6, 'avg(greatest(p1 - "close", 0)) OVER w5')} AS d
  FROM l
  WINDOW w5 AS (PARTITION BY instrument_key ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w10 AS (PARTITION BY instrument_key ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY instrument_key ORDER BY rn ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
)""", f"""
ind AS (
  SELECT instrument_key, "timestamp", "close" AS c, sma_5, sma_10, sma_20, ema_5, ema_10, ema_20,
    {_since(5, '(5 * "close" + 4 * p1 + 3 * p2 + 2 * p3 + p4) / 15.0')} AS wma_5,
    {_since(4, 'CASE WHEN p3 <> 0 THEN ("close" - p3) / p3 END')} AS price_momentum_3,
    {_since(6, 'CASE WHEN p5 <> 0 THEN ("close" - p5) / p5 END')} AS price_momentum_5,
    {_since(3, '"close" - p1')} AS price_velocity, {_since(4, '("close" - p1) - (p1 - p2)')} AS price_acceleration,
    volume_sma_5, volume_ema_5, CASE WHEN volume_sma_5 > 0 THEN volume / volume_sma_5 END AS volume_ratio,
    CASE WHEN vwap > 0 THEN ("close" - vwap) / vwap END AS vwap_deviation, price_volatility_5, price_volatility_10,
    CASE WHEN "close" > 0 THEN (high - low) / "close" END AS high_low_ratio,
    {_since(2, 'CASE WHEN "close" > 0 AND p1 > 0 THEN ln("close" / p1) END')} AS close_to_close_return,
    trade_count / {n}.0 AS trade_intensity, volume / trade_count AS avg_trade_size,
    {_since(2, 'CASE WHEN volume - v1 > 1e-9 * volume THEN abs("close" - p1) / (volume - v1) END')} AS price_impact,
    high - low AS bid_ask_spread_proxy,
    CASE WHEN d = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / d) END AS rsi_5,
    CASE WHEN sma_20 <> 0 AND price_volatility_10 <> 0
      THEN ("close" - (sma_20 - 2 * price_volatility_10)) / (4 * price_volatility_10) END AS bollinger_position,
    ema_5 - ema_10 AS macd_signal
  FROM m
)""")


def _indicator_sql(n: int, columns=INDICATORS) -> str:
    return _indicator_ctes(n) + f'SELECT instrument_key, "timestamp", {r(*columns)} FROM ind'


def _indicator_query(tf, columns=INDICATORS):
    def run(spark, sf):
        frame = indicators.indicators(candles.ohlcv(ad.trades(spark, sf), tf), tf)
        return rounded(frame.select("instrument_key", "timestamp", *columns))
    return run


CHECKS["f16_indicators_1h"] = (_indicator_query("1h"), _indicator_sql(3600))
CHECKS["f16_indicators_1m"] = (_indicator_query("1m"), _indicator_sql(60))
for _name, _columns in {
    "f1_sma": ("sma_5", "sma_10", "sma_20"),
    "f2_ema": ("ema_5", "ema_10", "ema_20"),
    "f3_wma": ("wma_5",),
    "f4_momentum": ("price_momentum_3", "price_momentum_5"),
    "f5_velocity": ("price_velocity", "price_acceleration"),
    "f6_volume_averages": ("volume_sma_5", "volume_ema_5", "volume_ratio"),
    "f7_vwap_deviation": ("vwap_deviation",),
    "f8_volatility": ("price_volatility_5", "price_volatility_10"),
    "f9_range_and_return": ("high_low_ratio", "close_to_close_return"),
    "f10_intensity": ("trade_intensity", "avg_trade_size"),
    "f11_price_impact": ("price_impact",),
    "f12_spread_proxy": ("bid_ask_spread_proxy",),
    "f13_rsi": ("rsi_5",),
    "f14_bollinger": ("bollinger_position",),
    "f15_macd": ("macd_signal",),
}.items():
    CHECKS[f"{_name}_4h"] = (_indicator_query("4h", _columns), _indicator_sql(14400, _columns))


@check("f17_latest_candles", fx.with_(fx.TRADES, fx.candles(3600)) + f"""
SELECT {CANDLE_SQL} FROM candles QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY "timestamp" DESC) <= 100""")
def _latest(spark, sf):
    frame = candles.ohlcv(ad.trades(spark, sf), "1h")
    return rounded(indicators.latest(frame, 100, ["instrument_key"]).drop("timeframe"))


@check("f17_feature_summary", _indicator_ctes(14400) + """
SELECT instrument_key, '4h' AS timeframe, count(*) AS "rows", min("timestamp") AS first_time, max("timestamp") AS last_time, """
       + ", ".join(f"count({c}) AS {c}" for c in INDICATORS) + " FROM ind GROUP BY instrument_key")
def _feature_summary(spark, sf):
    return indicators.feature_summary(indicators.indicators(candles.ohlcv(ad.trades(spark, sf), "4h"), "4h"))
