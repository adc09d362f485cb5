"""Fetching, enrichment and the whole jobs, batch and streaming."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators import enrich
from tickloom.operators.positions import with_position
from tickloom.operators.relational import (
    distinct_symbols,
    missing_sector,
    union_all,
)
from tickloom.plans import ingest as job
from tickloom.plans.backfill import backfill_to_fixpoint
from tickloom.plans.flat import FlatStore
from tickloom.plans.flat import flat_load as load_flat
from tickloom.plans.star import STAR_TABLES, Star, load_star
from tickloom.sources import provider
from tickloom.sources import tables as t
from tickloom.storage import fresh_path
from tickloom.streaming.ingest import ingest_stream as stream
from tickloom.streaming.stateful import ingest_stream_stateful as stateful_stream
from tickloom.workload import fixtures as fx
from tickloom.workload.dimensions import relisted
from tickloom.workload.fixtures import RUN_DATE
from tickloom.workload.registry import query
from tickloom.workload.relational import PRICES, clean_incoming, listing
from tickloom.workload.tables import COMMITTED_AT, LATER, counts, new_namespace


def filled_store(spark, sf) -> job.Store:
    """A price store holding the stored prices and the metadata."""
    store = job.Store(spark, new_namespace(spark)).create()
    t.append(t.by_month(fx.stored_prices(spark, sf)), store.prices)
    t.append(fx.metadata(spark, sf), store.metadata)
    return store


@query("landing_fetch", "SELECT symbol, dt, open, high, low, close, volume FROM fetched")
def landing_fetch(spark, sf):
    requested = job.requested_symbols(fx.directory(spark, sf), fx.metadata(spark, sf), RUN_DATE)
    return enrich.landing_fetch(requested, fx.incoming(spark, sf), RUN_DATE)


@query(
    "batched_map",
    """SELECT symbol, CASE WHEN bad THEN NULL ELSE digits END AS digits, batch_id,
              CASE WHEN bad THEN 'failed' ELSE 'ok' END AS status,
              CAST(CASE WHEN bad THEN 3 ELSE 1 END AS int) AS attempts,
              CASE WHEN bad THEN 'ConnectionError: provider refused the batch' END AS error
       FROM (SELECT symbol, digits, batch_id, bool_or(symbol = 'SUP77') OVER (PARTITION BY batch_id) AS bad
             FROM (SELECT symbol, CAST(length(symbol) - 3 AS bigint) AS digits,
                          CAST(floor((row_number() OVER (ORDER BY symbol) - 1) / 50) AS int) AS batch_id
                   FROM (SELECT DISTINCT symbol FROM bars) AS s) AS b) AS f""",
)
def batched_map(spark, sf):
    def fetch(asked):
        if (asked["symbol"] == "SUP77").any():
            raise ConnectionError("provider refused the batch")
        return asked.assign(digits=asked["symbol"].str.len() - 3)

    result = StructType.fromDDL("symbol string, digits bigint")
    return enrich.batched_map(distinct_symbols(fx.bars(spark, sf)), fetch, result)


@query(
    "enrich_sector",
    """SELECT m.symbol, l.sector FROM (SELECT symbol FROM metadata WHERE sector IS NULL OR sector = '') AS m
       LEFT JOIN sector_lookup AS l ON m.symbol = l.symbol""",
)
def enrich_sector(spark, sf):
    return enrich.enrich_sector(missing_sector(fx.metadata(spark, sf)), fx.sector_lookup(spark, sf))


@query(
    "fetch_source",
    """SELECT i.symbol, i.dt, i.open, i.high, i.low, i.close, i.volume, CAST(w.no AS int) AS request_no, 'ok' AS status,
              CAST(CASE WHEN w.no = 1 THEN 2 ELSE 1 END AS int) AS attempts,
              CASE WHEN w.no = 1 THEN 'ConnectionError: provider refused' END AS error
       FROM (SELECT upper(symbol) AS symbol, dt, open, high, low, close, volume FROM incoming WHERE dt IS NOT NULL) AS i
       JOIN wanted AS w ON w.symbol = i.symbol
       WHERE w.no <> 0 AND i.dt > w.last_update AND i.dt >= DATE '2000-06-01'
       UNION ALL SELECT symbol, NULL, NULL, NULL, NULL, NULL, NULL, 0, 'failed', 3, 'ConnectionError: provider refused' FROM wanted WHERE no = 0""",
    wanted="""SELECT symbol, last_update, floor((row_number() OVER (ORDER BY symbol) - 1) / 5) AS no
              FROM (SELECT symbol, coalesce(last_update - CAST(200 AS int), DATE '1990-01-01') AS last_update FROM metadata) AS m""",
)
def fetch_source(spark, sf):
    """Landed files read as a provider: the first request fails for good, the second once."""
    landed, plans = fresh_path(spark, "landed"), fresh_path(spark, "plans")
    rows = fx.incoming(spark, sf).where("dt IS NOT NULL")
    by_symbol = rows.withColumn("symbol", F.upper("symbol")).repartition("symbol")
    provider.write_by_symbol(by_symbol.sortWithinPartitions("symbol"), landed)
    held_since = F.coalesce(F.date_sub("last_update", 200), F.lit(date(1990, 1, 1)))
    wanted = fx.metadata(spark, sf).select("symbol", held_since.alias("after"))
    numbered = with_position(wanted, "symbol").withColumn("request_no", F.floor((F.col("position") - 1) / 5))
    # Symbols with different days get partitions of their own within a request number.
    requests = numbered.groupBy("request_no", "after").agg(F.sort_array(F.collect_list("symbol")).alias("symbols"))
    provider.write_plan(requests, plans, "2001-01-02")
    answer = provider.landed_files(landed)

    def fetch(request):
        if request.request_no == 0 or (request.request_no == 1 and request.attempt == 1):
            raise ConnectionError("provider refused")
        return answer(request)

    provider.register(spark, "landed_provider", fetch)
    fetched = spark.read.format("landed_provider").option("requests", plans).load()
    return fetched.where((F.col("dt") >= F.lit(date(2000, 6, 1))) | (F.col("status") == "failed"))


INGESTED_SQL = f"SELECT {PRICES} FROM stored_prices UNION ALL SELECT {PRICES} FROM ingested"


@query("ingest_incremental", INGESTED_SQL)
def ingest_incremental(spark, sf):
    store = filled_store(spark, sf)
    job.ingest(store, fx.directory(spark, sf), fx.incoming(spark, sf), RUN_DATE, COMMITTED_AT)
    return t.prices(spark, store.prices)


@query(
    "ingest_metadata",
    """SELECT symbol, max(last_update) AS last_update, max(CASE WHEN sector <> '' THEN sector END) AS sector
       FROM (SELECT * FROM metadata UNION ALL
             SELECT DISTINCT symbol, DATE '2001-01-02', CAST(NULL AS varchar) FROM ingest_batch) AS u
       GROUP BY symbol""",
)
def ingest_metadata(spark, sf):
    store = filled_store(spark, sf)
    job.ingest(store, fx.directory(spark, sf), fx.incoming(spark, sf), RUN_DATE, COMMITTED_AT)
    return spark.table(store.metadata)


@query(
    "ingest_rerun_is_noop",
    """SELECT CAST((SELECT count(*) FROM ingested) AS bigint) AS first_run, CAST(0 AS bigint) AS second_run,
              CAST((SELECT count(*) FROM stored_prices) + (SELECT count(*) FROM ingested) AS bigint) AS row_count""",
)
def ingest_rerun_is_noop(spark, sf):
    store = filled_store(spark, sf)
    directory, landing = fx.directory(spark, sf), fx.incoming(spark, sf)
    first = job.ingest(store, directory, landing, RUN_DATE, COMMITTED_AT)
    second = job.ingest(store, directory, landing, RUN_DATE, LATER)
    return spark.table(store.prices).agg(
        F.lit(first).cast("bigint").alias("first_run"),
        F.lit(second).cast("bigint").alias("second_run"),
        F.count(F.lit(1)).alias("row_count"),
    )


@query("ingest_stream", INGESTED_SQL)
def ingest_stream(spark, sf):
    """Two runs: all files are consumed by the first, half of the symbols are listed for the second.

    Emptier copies of the last month arrive in files of their own, so the choice
    among differing copies is made across files.
    """
    store = filled_store(spark, sf)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    raw = fx.incoming(spark, sf)
    poorer = raw.where("dt >= DATE'2000-12-01' AND close IS NOT NULL").withColumn("volume", F.lit(None).cast("bigint"))
    poorer.write.parquet(landing)
    raw.repartition("symbol", "dt").write.mode("append").parquet(landing)
    directory = fx.directory(spark, sf)
    first = directory.where(F.substring("symbol", 4, 20).cast("int") % 2 == 0)
    for listed in (first, directory):
        stream(store, listed, landing, raw.schema, checkpoint, RUN_DATE, COMMITTED_AT, files_per_batch=3)
    return t.prices(spark, store.prices)


@query("ingest_stream_stateful", INGESTED_SQL)
def ingest_stream_stateful(spark, sf):
    """Three runs: half of the symbols are listed, then all, some of whose rows land late, then nothing is new."""
    store = filled_store(spark, sf)
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    raw, directory = fx.incoming(spark, sf), fx.directory(spark, sf)
    even = F.substring("symbol", 4, 20).cast("int") % 2 == 0
    early = even | F.coalesce(F.month("dt") < 10, F.lit(True))
    raw.where(early).write.parquet(landing)
    half = directory.where(even)
    stateful_stream(store, half, landing, raw.schema, checkpoint, RUN_DATE, COMMITTED_AT, files_per_batch=3)
    raw.where(~early).write.mode("append").parquet(landing)
    for committed_at in (LATER, LATER):
        stateful_stream(store, directory, landing, raw.schema, checkpoint, RUN_DATE, committed_at)
    return t.prices(spark, store.prices)


@query(
    "upsert_prices",
    f"""SELECT {PRICES} FROM stored_prices AS s
        WHERE NOT EXISTS (SELECT 1 FROM unique_incoming AS u
                          WHERE s.symbol = u.symbol AND s.trade_date = u.trade_date)
        UNION ALL SELECT symbol, trade_date, open, high, low, close + 1, volume FROM unique_incoming""",
)
def upsert_prices(spark, sf):
    store = filled_store(spark, sf)
    # Greater copies arrive first and are corrected by the last ones.
    last = clean_incoming(spark, sf).withColumn("close", F.col("close") + 1)
    early = last.withColumns({"close": F.col("close") + 100, "arrival": F.lit(1)})
    job.upsert_prices(store, union_all(early, last.withColumn("arrival", F.lit(2))), COMMITTED_AT)
    return t.prices(spark, store.prices)


@query(
    "sector_backfill_fixpoint",
    """SELECT m.symbol, m.last_update,
              CASE WHEN m.sector <> '' THEN m.sector ELSE coalesce(nullif(l.sector, ''), m.sector) END AS sector
       FROM metadata AS m LEFT JOIN sector_lookup AS l ON m.symbol = l.symbol""",
)
def sector_backfill_fixpoint(spark, sf):
    table, calls = fx.sector_lookup(spark, sf), []

    def lookup(symbols):
        """Half of the sectors on the first call, all of them from the second on."""
        calls.append(1)
        key = F.substring("symbol", 4, 20).cast("int")
        return enrich.enrich_sector(symbols, table.where(key % 4 < 2 * len(calls)))

    return backfill_to_fixpoint(fx.metadata(spark, sf), lookup)


@query(
    "star_load",
    """SELECT 'trading_days' AS table_name, CAST(count(DISTINCT trade_date) AS bigint) AS row_count FROM loaded
       UNION ALL SELECT 'symbols', count(*) FROM listing
       UNION ALL SELECT 'stock_prices', count(*) FROM loaded WHERE NOT is_etf
       UNION ALL SELECT 'etf_prices', count(*) FROM loaded WHERE is_etf
       UNION ALL SELECT 'metadata', count(*) FROM directory WHERE test_issue = 'N'""",
    loaded="SELECT b.*, l.is_etf FROM bars AS b JOIN listing AS l ON b.symbol = l.symbol",
)
def star_load(spark, sf):
    star = Star(spark, new_namespace(spark)).create()
    directory, bars = fx.directory(spark, sf), fx.bars(spark, sf)
    cut = datetime(2000, 7, 1).date()
    # Overlapping loads: the second repeats a year and every listing, the last half a year, and adds the rest.
    load_star(star, directory, bars.where(F.col("trade_date") < F.lit(cut)))
    repeated = union_all(directory, directory.withColumn("round_lot_size", F.lit(1)))
    load_star(star, repeated, bars.where(F.col("trade_date") < F.lit(date(1996, 1, 1))))
    load_star(star, relisted(spark, sf), bars.where(F.col("trade_date") >= F.lit(fx.STORED_BEFORE)))
    return union_all(*counts(spark, [star.name(table) for table in STAR_TABLES]))


@query(
    "flat_load",
    """SELECT u.symbol, max(u.last_update) AS last_update, CAST(any_value(c.bars) AS bigint) AS bars
       FROM (SELECT symbol, last_update FROM metadata WHERE last_update IS NOT NULL
             UNION ALL SELECT DISTINCT symbol, DATE '2001-01-02' FROM flat_batch) AS u
       LEFT JOIN (SELECT symbol, count(*) AS bars FROM (
                    SELECT symbol, trade_date FROM stored_prices
                    UNION SELECT symbol, trade_date FROM flat_batch) AS p GROUP BY symbol) AS c
         ON c.symbol = u.symbol
       GROUP BY u.symbol""",
    flat_batch="""SELECT DISTINCT upper(i.symbol) AS symbol, i.dt AS trade_date
                  FROM incoming AS i JOIN listing AS l ON upper(i.symbol) = l.symbol
                  LEFT JOIN metadata AS m ON m.symbol = l.symbol
                  WHERE i.dt IS NOT NULL AND NOT (i.open IS NULL AND i.high IS NULL AND i.low IS NULL
                        AND i.close IS NULL AND i.volume IS NULL)
                    AND (m.last_update IS NULL OR (m.last_update < DATE '2001-01-02' AND i.dt > m.last_update))""",
)
def flat_load(spark, sf):
    store = FlatStore(spark, new_namespace(spark)).create()
    t.append(t.by_month(fx.stored_prices(spark, sf)), store.prices)
    dated = fx.metadata(spark, sf).where("last_update IS NOT NULL").select("symbol", "last_update")
    t.append(dated, store.last_update)
    listed = listing(spark, sf).select("symbol")
    key = F.substring("symbol", 4, 20).cast("int")
    load_flat(store, [listed.where(key % 2 == i) for i in (0, 1)], fx.incoming(spark, sf), RUN_DATE)
    held = spark.table(store.prices).groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"))
    return spark.table(store.last_update).join(held, "symbol", "left")
