"""Dimensions, facts, upserts and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import dimensions as d
from tickloom.operators import quality
from tickloom.operators.relational import batch_metadata, directory_projection, union_all
from tickloom.schemas import PRICE_COLUMNS
from tickloom.workload import fixtures as fx
from tickloom.workload.fixtures import RUN_DATE
from tickloom.workload.registry import query
from tickloom.workload.relational import PRICES, clean_incoming, listing


@query("dim_trading_days", "SELECT date_id, trade_date FROM all_days")
def dim_trading_days(spark, sf):
    stored = fx.trading_days(spark, sf)
    return union_all(stored, d.new_trading_days(fx.bars(spark, sf), stored))


@query("dim_symbols", "SELECT symbol_id, symbol, is_etf FROM all_symbols")
def dim_symbols(spark, sf):
    stored = fx.symbols(spark, sf)
    return union_all(stored, d.new_symbols(listing(spark, sf), stored))


def _keyed_bars(spark, sf):
    return d.fact_keys(fx.bars(spark, sf), dim_symbols(spark, sf), dim_trading_days(spark, sf))


FACT_SQL = """SELECT s.symbol_id, t.date_id, b.open, b.high, b.low, b.close, b.volume
              FROM bars AS b JOIN all_symbols AS s ON b.symbol = s.symbol
              JOIN all_days AS t ON b.trade_date = t.trade_date WHERE s.is_etf = {etf}"""


@query("fact_stock_prices", FACT_SQL.format(etf="false"))
def fact_stock_prices(spark, sf):
    return d.fact_rows(_keyed_bars(spark, sf), etf=False)


@query("fact_etf_prices", FACT_SQL.format(etf="true"))
def fact_etf_prices(spark, sf):
    return d.fact_rows(_keyed_bars(spark, sf), etf=True)


def relisted(spark, sf):
    """The directory twice: later rows of every third symbol carry a new name."""
    first = fx.directory(spark, sf).withColumn("arrival", F.lit(1))
    again = first.where(F.col("symbol").endswith("3")).select(
        "symbol",
        F.concat("security_name", F.lit(" new")).alias("security_name"),
        "market_category",
        "etf",
        "test_issue",
        "round_lot_size",
        F.lit(2).alias("arrival"),
    )
    return union_all(first, again)


@query(
    "metadata_replace",
    """SELECT symbol, CASE WHEN symbol LIKE '%3' THEN concat(security_name, ' new')
                           ELSE security_name END AS security_name,
              market_category, etf = 'Y' AS is_etf, round_lot_size
       FROM directory WHERE test_issue = 'N'""",
)
def metadata_replace(spark, sf):
    return d.replace_metadata(directory_projection(relisted(spark, sf), "arrival"), "arrival")


@query(
    "metadata_add_new",
    """SELECT symbol, CASE WHEN symbol LIKE '%3' THEN 'kept' ELSE security_name END AS security_name,
              market_category, etf = 'Y' AS is_etf, round_lot_size
       FROM directory WHERE test_issue = 'N'""",
)
def metadata_add_new(spark, sf):
    all_listed = directory_projection(fx.directory(spark, sf))
    ends_in_3 = all_listed.where(F.col("symbol").endswith("3"))
    return d.add_new_metadata(all_listed, ends_in_3.withColumn("security_name", F.lit("kept")))


@query(
    "advance_last_update",
    """SELECT m.symbol, m.sector,
              CASE WHEN c.symbol IS NULL THEN m.last_update
                   WHEN m.last_update IS NULL OR (c.here > 0 AND c.broken = 0) THEN DATE '2001-01-02'
                   ELSE m.last_update END AS last_update
       FROM metadata AS m LEFT JOIN (
         SELECT i.symbol, count(*) FILTER (WHERE i.dt = k.last_update) AS here,
                count(*) FILTER (WHERE i.dt = k.last_update AND i.volume IS NULL) AS broken
         FROM (SELECT upper(symbol) AS symbol, dt, volume FROM incoming) AS i
         LEFT JOIN metadata AS k ON i.symbol = k.symbol GROUP BY i.symbol) AS c ON m.symbol = c.symbol""",
)
def advance_last_update(spark, sf):
    metadata = fx.metadata(spark, sf)
    bars = fx.incoming(spark, sf).withColumn("symbol", F.upper("symbol")).withColumnRenamed("dt", "trade_date")
    checked = quality.completeness(
        bars, F.col("last_update"), metadata.select("symbol", "last_update")
    )
    return d.advance_last_update(metadata, checked, RUN_DATE)


@query(
    "merge_last_update",
    """SELECT symbol, max(last_update) AS last_update
       FROM (SELECT symbol, last_update FROM metadata UNION ALL
             SELECT DISTINCT upper(symbol), DATE '2001-01-02' FROM incoming UNION ALL
             SELECT symbol, max(trade_date) FROM stored_prices GROUP BY symbol) AS u
       GROUP BY symbol""",
)
def merge_last_update(spark, sf):
    metadata = fx.metadata(spark, sf)
    from_batch = batch_metadata(fx.incoming(spark, sf), metadata, RUN_DATE)
    stored = fx.stored_prices(spark, sf).groupBy("symbol").agg(F.max("trade_date").alias("last_update"))
    batches = [b.select("symbol", "last_update") for b in (from_batch, stored)]
    return d.merge_last_update(metadata.select("symbol", "last_update"), *batches)


@query(
    "merge_keep_existing",
    f"""SELECT {PRICES} FROM stored_prices UNION ALL
        SELECT symbol, trade_date, open, high, low, close + 1, volume FROM unique_incoming AS u
        WHERE NOT EXISTS (SELECT 1 FROM stored_prices AS s
                          WHERE s.symbol = u.symbol AND s.trade_date = u.trade_date)""",
)
def merge_keep_existing(spark, sf):
    new = d.dedupe_bars(clean_incoming(spark, sf)).withColumn("close", F.col("close") + 1)
    return d.keep_existing(fx.stored_prices(spark, sf), new)


@query("dedupe_batch", f"SELECT {PRICES} FROM unique_incoming")
def dedupe_batch(spark, sf):
    return d.dedupe_bars(clean_incoming(spark, sf)).select(*PRICE_COLUMNS)
