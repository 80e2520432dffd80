"""Rules that the SQL of registered queries states, on rows that the small test tables do not hold."""

import duckdb

import __spark_entry__ as entry


def _rows(name, events):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS {events}")
    found = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    return [dict(zip(columns, row)) for row in found.fetchall()]


def test_whole_day_is_valid():
    """j21_day_shape: a day with a candle a minute has the shape, one with a minute less has not."""
    minutes = """SELECT n AS event_id, TIMESTAMP '2024-01-01' + to_minutes(n) AS ts, 0 AS user_id, 'view' AS event_type, 1.0 AS "value", '{"k": 0}' AS props
                 FROM range(2879) r(n)"""
    assert sorted((r["day"].day, r["valid"]) for r in _rows("j21_day_shape", minutes)) == [(1, True), (2, False)]


def test_rejected_ticks_make_no_candle():
    """p2_ingest_job: a tick without a price is rejected at ingest."""
    ticks = """SELECT n AS event_id, TIMESTAMP '2024-01-01' + to_minutes(n) AS ts, 0 AS user_id, 'view' AS event_type, CAST(n AS DOUBLE) AS "value", '{"k": 0}' AS props
               FROM range(3) r(n)"""
    assert [(r["low"], r["trade_count"]) for r in _rows("p2_ingest_job", ticks)] == [(1.0, 2)]
