"""Data-quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tickloom.operators import quality as q
from tickloom.schemas import OHLCV
from tickloom.workload import fixtures as fx
from tickloom.workload.fixtures import RUN_DATE
from tickloom.workload.registry import query

FIRST, LAST = date(1995, 1, 1), date(2001, 12, 31)


@query("validate_directory", "SELECT * FROM directory WHERE etf IN ('Y', 'N')")
def validate_directory(spark, sf):
    return q.validate_directory(fx.directory(spark, sf))


@query(
    "validate_prices",
    """SELECT a.symbol, CAST(coalesce(v.valid_rows, 0) AS bigint) AS valid_rows,
              CASE WHEN v.symbol IS NULL OR bad_price OR bad_volume OR bad_order THEN false ELSE true END AS is_valid,
              CASE WHEN v.symbol IS NULL THEN 'no data' WHEN bad_price THEN 'invalid price'
                   WHEN bad_volume THEN 'invalid volume' WHEN bad_order THEN 'dates not ascending' END AS reason
       FROM (SELECT DISTINCT symbol FROM dirty_prices) AS a LEFT JOIN (
         SELECT symbol, count(*) AS valid_rows, bool_or(least(open, high, low, close) <= 0) AS bad_price,
                bool_or(volume < 0) AS bad_volume, bool_or(coalesce(before > dt, false)) AS bad_order
         FROM (SELECT *, lag(dt) OVER (PARTITION BY symbol ORDER BY seq) AS before FROM dirty_prices
               WHERE symbol IS NOT NULL AND dt IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
                 AND close IS NOT NULL AND volume IS NOT NULL) AS t
         GROUP BY symbol) AS v ON a.symbol = v.symbol""",
)
def validate_prices(spark, sf):
    return q.validate_prices(fx.dirty_prices(spark, sf), "dt", "seq")


@query(
    "data_complete",
    """SELECT symbol, CAST(count(*) FILTER (WHERE here) AS bigint) AS rows_on_day,
              CAST(count(*) FILTER (WHERE here AND broken) AS bigint) AS null_rows,
              count(*) FILTER (WHERE here) > 0 AND count(*) FILTER (WHERE here AND broken) = 0 AS is_complete
       FROM (SELECT upper(symbol) AS symbol, dt = DATE '2000-12-15' AS here,
                    open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL AS broken
             FROM incoming) AS t GROUP BY symbol""",
)
def data_complete(spark, sf):
    bars = fx.incoming(spark, sf).select(F.upper("symbol").alias("symbol"), F.col("dt").alias("trade_date"), *OHLCV)
    return q.completeness(bars, F.lit(date(2000, 12, 15)))


CALENDAR_SQL = """SELECT CAST(d AS date) AS trade_date
                  FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) AS r(d)
                  WHERE isodow(d) < 6 AND CAST(d AS date) NOT IN (SELECT holiday FROM holidays)"""


@query("trading_calendar", CALENDAR_SQL)
def trading_calendar(spark, sf):
    return q.trading_calendar(spark, FIRST, LAST, fx.holidays(spark, sf))


@query(
    "is_trading_day",
    """SELECT t.trade_date, c.trade_date IS NOT NULL AS is_open
       FROM (SELECT DISTINCT trade_date FROM bars) AS t
       LEFT JOIN calendar AS c ON t.trade_date = c.trade_date""",
    calendar=CALENDAR_SQL,
)
def is_trading_day(spark, sf):
    return q.is_trading_day(fx.bars(spark, sf).select("trade_date"), trading_calendar(spark, sf))


@query(
    "staleness_gate",
    """SELECT CAST(date_diff('day', max(trade_date), DATE '2001-01-02') AS int) AS days_since,
              date_diff('day', max(trade_date), DATE '2001-01-02') >= 3 AS is_due FROM stored_prices""",
)
def staleness_gate(spark, sf):
    committed = fx.stored_prices(spark, sf).select(F.col("trade_date").cast("timestamp").alias("committed_at"))
    return q.staleness_gate(committed, RUN_DATE)


@query(
    "integrity_report",
    """SELECT 'repeated key symbol, trade_date' AS check_name, CAST(count(*) AS bigint) AS violations
       FROM (SELECT symbol, trade_date FROM rows_checked GROUP BY ALL HAVING count(*) > 1) AS k
       UNION ALL SELECT 'null in trade_date', count(*) FILTER (WHERE trade_date IS NULL) FROM rows_checked
       UNION ALL SELECT 'null in close', count(*) FILTER (WHERE close IS NULL) FROM rows_checked
       UNION ALL SELECT 'orphan symbol', count(*) FROM rows_checked
                 WHERE symbol NOT IN (SELECT symbol FROM symbols)
       UNION ALL SELECT 'orphan trade_date', count(*) FROM rows_checked
                 WHERE trade_date NOT IN (SELECT trade_date FROM trading_days)""",
    rows_checked="SELECT upper(symbol) AS symbol, dt AS trade_date, open, high, low, close, volume FROM incoming",
)
def integrity_report(spark, sf):
    rows = fx.incoming(spark, sf).select(F.upper("symbol").alias("symbol"), F.col("dt").alias("trade_date"), *OHLCV)
    references = {"symbol": fx.symbols(spark, sf), "trade_date": fx.trading_days(spark, sf)}
    return q.integrity_report(rows, ["symbol", "trade_date"], ["trade_date", "close"], references)


@query(
    "missing_intervals",
    """SELECT symbol, min(trade_date) AS first_day, max(trade_date) AS last_day, CAST(count(*) AS bigint) AS days
       FROM (SELECT *, day_no - row_number() OVER (PARTITION BY symbol ORDER BY day_no) AS island
             FROM (SELECT s.symbol, d.trade_date, d.day_no
                   FROM (SELECT symbol FROM directory) AS s
                   CROSS JOIN (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS day_no FROM calendar) AS d
                   WHERE NOT EXISTS (SELECT 1 FROM stored_prices AS b
                                     WHERE b.symbol = s.symbol AND b.trade_date = d.trade_date)) AS m) AS i
       GROUP BY symbol, island""",
    calendar=CALENDAR_SQL,
)
def missing_intervals(spark, sf):
    listed = fx.directory(spark, sf).select("symbol")
    return q.missing_intervals(fx.stored_prices(spark, sf), trading_calendar(spark, sf), listed)
