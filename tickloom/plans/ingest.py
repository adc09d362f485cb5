"""Incremental, idempotent ingestion of daily bars."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.dimensions import dedupe_bars, merge_metadata, upsert
from tickloom.operators.enrich import landing_fetch
from tickloom.operators.relational import (
    batch_metadata,
    clean_rows,
    listing_universe,
    new_bars,
    normalize_prices,
    stale_or_unseen,
    symbols_with_metadata,
)
from tickloom.schemas import PRICE_KEY, schema_for
from tickloom.sources import ledger
from tickloom.sources import tables as t
from tickloom.storage import Scratch, fresh_path, remove_folder


@dataclass(frozen=True)
class Store:
    """The tables of one price store, all in one namespace."""

    spark: SparkSession
    namespace: str

    @property
    def prices(self) -> str:
        return f"{self.namespace}.stock_prices"

    @property
    def metadata(self) -> str:
        return f"{self.namespace}.metadata"

    @property
    def landed(self) -> str:
        return f"{self.namespace}.landed"

    @property
    def ledger(self) -> str:
        return f"{self.namespace}.load_ledger"

    def create(self, location: str | None = None) -> Store:
        t.create_namespace(self.spark, self.namespace, location)
        t.create_price_table(self.spark, self.prices, schema_for("stock_prices"))
        t.create_table(self.spark, self.metadata, schema_for("metadata"), comment="Symbol metadata")
        ledger.create_ledger(self.spark, self.ledger)
        return self


class Upserted(NamedTuple):
    """Rows written, and rows of the batch left out for want of a symbol or a date."""

    written: int
    rejected: int


def requested_symbols(directory: DataFrame, metadata: DataFrame, run_date: date) -> DataFrame:
    """Listed stocks due for an update, with their last update."""
    stocks = listing_universe(directory).where("not is_etf").select("symbol")
    due = stale_or_unseen(stocks, metadata, run_date)
    return symbols_with_metadata(due, metadata.select("symbol", "last_update"))


def batch_bars(landing: DataFrame, requested: DataFrame, run_date: date, day: str) -> DataFrame:
    """The clean bars of a landed batch that the requested symbols need, one per key."""
    fetched = landing_fetch(requested, landing, run_date, day)
    return dedupe_bars(normalize_prices(clean_rows(fetched, day), day))


def append_new(store: Store, batch: DataFrame, committed_at: datetime) -> int:
    """Append the bars of a batch that are not stored; note the write in the ledger.

    Only the months of the batch are read from the store. A batch that was
    committed before adds nothing.
    """
    spark = store.spark
    stored = t.prices_in_months(spark, store.prices, t.months_in(batch))
    path = fresh_path(spark, "new-bars")
    new_bars(batch, stored).write.parquet(path)
    fresh = spark.read.schema(batch.schema).parquet(path)
    if fresh.isEmpty():
        remove_folder(spark, path)
        return 0
    intent = ledger.begin(spark, store.ledger, "append", "stock_prices", path, committed_at)
    added = t.append(t.by_month(fresh), store.prices)
    _close(store, intent, "append", "stock_prices", added, committed_at)
    remove_folder(spark, path)
    return added


def _close(store: Store, intent: str, operation: str, table: str, rows: int, committed_at: datetime) -> None:
    ledger.record(store.spark, store.ledger, operation, table, rows, committed_at)
    ledger.end(store.spark, store.ledger, intent)


def finish_interrupted(store: Store) -> None:
    """Bring writes of interrupted runs to their end, so that each is in the ledger once.

    The rows an append or upsert was to write are still in its folder; what is
    not stored yet is written now. A replacement was committed if the table
    lies in the intent's folder, else it is given up and made anew by the run.
    """
    spark = store.spark
    for row in ledger.open_intents(spark, store.ledger):
        noted = spark.table(store.ledger).where(
            (F.col("committed_at") == F.lit(row.committed_at))
            & (F.col("operation") == row.operation)
            & (F.col("table_name") == row.table_name)
        )
        if row.operation == "replace":
            if t.location_of(spark, store.metadata) != row.path:
                remove_folder(spark, row.path)
                ledger.end(spark, store.ledger, row.intent_id)
                continue
            rows = spark.table(store.metadata).count()
        elif not noted.isEmpty():
            rows = 0
        else:
            batch = spark.read.schema(schema_for("stock_prices")).parquet(row.path)
            if row.operation == "append":
                stored = t.prices_in_months(spark, store.prices, t.months_in(batch))
                # Written before the append, which changes the table it is computed from.
                with Scratch(spark) as scratch:
                    t.append(t.by_month(scratch.stage(new_bars(batch, stored), "missing-bars")), store.prices)
                rows = batch.count()
            else:
                rows = _overwrite(store, batch)
        if noted.isEmpty():
            ledger.record(spark, store.ledger, row.operation, row.table_name, rows, row.committed_at)
        ledger.end(spark, store.ledger, row.intent_id)
        if row.operation != "replace":
            remove_folder(spark, row.path)


def ingest(
    store: Store,
    directory: DataFrame,
    landing: DataFrame,
    run_date: date,
    committed_at: datetime,
    day: str = "dt",
) -> int:
    """Load what is new and note which symbols were updated. Returns the bars added.

    Prices are committed before the metadata. A run that stops at any point is
    repeated without harm: open intents are ended first, stored bars are not
    appended again, and intermediate rows are deleted at the end.
    """
    finish_interrupted(store)
    with Scratch(store.spark) as scratch:
        metadata = scratch.stage(store.spark.table(store.metadata), "metadata")
        requested = requested_symbols(directory, metadata, run_date)
        batch = scratch.stage(batch_bars(landing, requested, run_date, day), "batch")
        added = append_new(store, batch, committed_at)
        advance_metadata(store, batch_metadata(batch, metadata, run_date), committed_at)
    return added


def advance_metadata(store: Store, batch: DataFrame, committed_at: datetime) -> None:
    """Merge a batch into the metadata; nothing is written or noted if that changes nothing."""
    spark = store.spark
    with Scratch(spark) as scratch:
        merged = scratch.stage(merge_metadata(spark.table(store.metadata), batch), "merged")
        if merged.exceptAll(spark.table(store.metadata).select(*merged.columns)).isEmpty():
            return
        location = t.next_version(spark, store.metadata)
        intent = ledger.begin(spark, store.ledger, "replace", "metadata", location, committed_at)
        rows = t.replace_table(merged, store.metadata, location)
        _close(store, intent, "replace", "metadata", rows, committed_at)


def upsert_prices(store: Store, changes: DataFrame, committed_at: datetime) -> Upserted:
    """Insert or replace bars by (symbol, trade_date).

    Only the months that occur in the changes are read and rewritten, each
    once. Of repeated keys the row that arrived last counts, if the changes
    have a column ``arrival``.
    """
    spark = store.spark
    finish_interrupted(store)
    keyed = F.col("symbol").isNotNull() & F.col("trade_date").isNotNull()
    rejected = changes.where(~keyed).count()
    path = fresh_path(spark, "changes")
    dedupe_bars(changes.where(keyed)).write.parquet(path)
    batch = spark.read.schema(schema_for("stock_prices")).parquet(path)
    written = 0
    if not batch.isEmpty():
        intent = ledger.begin(spark, store.ledger, "overwrite", "stock_prices", path, committed_at)
        written = _overwrite(store, batch)
        _close(store, intent, "overwrite", "stock_prices", written, committed_at)
    remove_folder(spark, path)
    return Upserted(written, rejected)


def _overwrite(store: Store, batch: DataFrame) -> int:
    current = t.prices_in_months(store.spark, store.prices, t.months_in(batch))
    return t.overwrite_partitions(t.by_month(upsert(current, batch, PRICE_KEY)), store.prices)
