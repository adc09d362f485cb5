"""The fixtures of ``FIXTURES.md`` in DuckDB SQL."""

D = "date_diff('day', DATE '1995-01-01', trade_date)"

FIXTURES: dict[str, str] = {
    "bars": """
        SELECT concat('SUP', CAST(l_suppkey AS varchar)) AS symbol,
               CAST(l_shipdate AS date) AS trade_date,
               arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS open,
               max(l_extendedprice * (1 + l_tax)) AS high,
               min(l_extendedprice * (1 - l_discount)) AS low,
               arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS close,
               CAST(sum(l_quantity) AS bigint) AS volume
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS date)""",
    "directory": """
        SELECT concat('SUP', CAST(s_suppkey AS varchar)) AS symbol, s_name AS security_name,
               CASE s_nationkey % 3 WHEN 0 THEN 'Q' WHEN 1 THEN 'G' ELSE 'S' END AS market_category,
               CASE WHEN s_suppkey % 17 = 16 THEN ' ' WHEN s_suppkey % 5 = 0 THEN 'Y' ELSE 'N' END AS etf,
               CASE WHEN s_suppkey % 11 = 10 THEN 'Y' ELSE 'N' END AS test_issue,
               100 AS round_lot_size
        FROM supplier""",
    "metadata": """
        SELECT concat('SUP', CAST(s_suppkey AS varchar)) AS symbol,
               CASE WHEN s_suppkey % 13 = 12 THEN NULL
                    WHEN s_suppkey % 3 = 0 THEN DATE '2001-01-01'
                    ELSE DATE '2001-01-02' END AS last_update,
               CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE r_name END AS sector
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey
        WHERE s_suppkey % 4 <> 3""",
    "sector_lookup": """
        SELECT concat('SUP', CAST(s_suppkey AS varchar)) AS symbol,
               CASE WHEN s_suppkey % 2 = 0 THEN r_name WHEN s_suppkey % 6 = 1 THEN '' ELSE NULL END AS sector
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "stored_prices": "SELECT * FROM bars WHERE trade_date < DATE '2000-01-01'",
    "incoming": """
        SELECT lower(symbol) AS symbol, trade_date AS dt,
               CASE WHEN volume % 10 = 0 THEN NULL ELSE open END AS open,
               CASE WHEN volume % 10 = 0 THEN NULL ELSE high END AS high,
               CASE WHEN volume % 10 = 0 THEN NULL ELSE low END AS low,
               CASE WHEN volume % 10 = 0 THEN NULL ELSE close END AS close,
               CASE WHEN volume % 10 = 0 THEN NULL ELSE volume END AS volume
        FROM bars WHERE trade_date >= DATE '1999-07-01'
        UNION ALL
        SELECT lower(symbol), trade_date, open, high, low, close, volume
        FROM bars WHERE trade_date >= DATE '2000-12-01' AND trade_date < DATE '2001-01-01'
        UNION ALL
        SELECT lower(symbol), CAST(NULL AS date), open, high, low, close, volume
        FROM bars WHERE trade_date = DATE '2000-06-01'""",
    "dirty_prices": f"""
        SELECT CASE WHEN volume % 13 <> 0 THEN symbol END AS symbol, trade_date AS dt,
               CASE WHEN volume % 7 = 0 THEN NULL ELSE open END AS open, high, low,
               CASE WHEN symbol LIKE '%3' THEN -close ELSE close END AS close,
               CASE WHEN symbol LIKE '%6' THEN -1 ELSE volume END AS volume,
               row_number() OVER (PARTITION BY symbol
                 ORDER BY CASE WHEN symbol LIKE '%9' THEN -{D} ELSE {D} END) AS seq
        FROM bars""",
    "patchy_bars": """
        SELECT symbol, trade_date, open, high, low, CASE WHEN volume % 23 <> 0 THEN close END AS close,
               CASE WHEN volume % 19 <> 0 THEN volume END AS volume FROM bars""",
    "whole_bars": "SELECT * FROM patchy_bars WHERE close IS NOT NULL",
    "trading_days": """
        SELECT CAST(row_number() OVER (ORDER BY trade_date) AS int) AS date_id, trade_date
        FROM (SELECT DISTINCT trade_date FROM stored_prices) AS t""",
    "symbols": """
        SELECT CAST(row_number() OVER (ORDER BY symbol) AS int) AS symbol_id, symbol, etf = 'Y' AS is_etf
        FROM directory WHERE test_issue = 'N' AND symbol IN (SELECT symbol FROM metadata)""",
    "holidays": """
        SELECT DISTINCT CAST(o_orderdate AS date) AS holiday FROM orders
        WHERE extract(month FROM o_orderdate) = 12 AND extract(day FROM o_orderdate) IN (24, 25)""",
    # Results several queries build on.
    "clean_incoming": """
        SELECT upper(symbol) AS symbol, dt AS trade_date, open, high, low, close, volume
        FROM incoming
        WHERE dt IS NOT NULL AND NOT (open IS NULL AND high IS NULL AND low IS NULL
              AND close IS NULL AND volume IS NULL)""",
    "listing": """
        SELECT symbol, etf = 'Y' AS is_etf,
               CASE WHEN etf = 'Y' THEN 'etf_prices' ELSE 'stock_prices' END AS target
        FROM directory WHERE test_issue = 'N' AND etf IN ('Y', 'N')""",
    "due": """
        SELECT l.symbol FROM listing AS l
        WHERE NOT l.is_etf
          AND (EXISTS (SELECT 1 FROM metadata AS m
                       WHERE m.symbol = l.symbol AND m.last_update < DATE '2001-01-02')
               OR NOT EXISTS (SELECT 1 FROM metadata AS m WHERE m.symbol = l.symbol))""",
    "fetched": """
        SELECT i.* FROM incoming AS i JOIN due AS d ON upper(i.symbol) = d.symbol
        LEFT JOIN metadata AS m ON m.symbol = d.symbol
        WHERE m.last_update IS NULL OR i.dt > m.last_update""",
    "ingest_batch": """
        SELECT DISTINCT upper(symbol) AS symbol, dt AS trade_date, open, high, low, close, volume
        FROM fetched
        WHERE dt IS NOT NULL AND NOT (open IS NULL AND high IS NULL AND low IS NULL
              AND close IS NULL AND volume IS NULL)""",
    "ingested": """
        SELECT b.* FROM ingest_batch AS b
        WHERE NOT EXISTS (SELECT 1 FROM stored_prices AS s
                          WHERE s.symbol = b.symbol AND s.trade_date = b.trade_date)""",
    "unique_incoming": "SELECT DISTINCT * FROM clean_incoming",
    "all_days": """
        SELECT date_id, trade_date FROM trading_days
        UNION ALL
        SELECT CAST((SELECT max(date_id) FROM trading_days)
                    + row_number() OVER (ORDER BY trade_date) AS int), trade_date
        FROM (SELECT DISTINCT trade_date FROM bars
              WHERE trade_date NOT IN (SELECT trade_date FROM trading_days)) AS t""",
    "all_symbols": """
        SELECT symbol_id, symbol, is_etf FROM symbols
        UNION ALL
        SELECT CAST((SELECT max(symbol_id) FROM symbols)
                    + row_number() OVER (ORDER BY symbol) AS int), symbol, is_etf
        FROM listing WHERE symbol NOT IN (SELECT symbol FROM symbols)""",
}
