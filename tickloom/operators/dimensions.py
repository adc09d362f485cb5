"""Dimensions with surrogate keys, fact loads, upserts and merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import is_blank
from tickloom.operators.positions import with_position
from tickloom.operators.relational import latest_per_symbol, union_all
from tickloom.schemas import OHLCV, PRICE_COLUMNS, PRICE_KEY

STAR_KEY = ["symbol_id", "date_id"]


def absent_keys(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys that the dimension does not hold."""
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(dimension.select(key), key, "left_anti")


def extend_dimension(new_rows: DataFrame, dimension: DataFrame, key: str, id_column: str) -> DataFrame:
    """``new_rows`` with ids that continue those of the dimension, in key order.

    ``new_rows`` has one row per key not in the dimension. Ids do not depend on
    how the data is partitioned, so a repeated load gives the same ones.
    """
    placed = with_position(new_rows, key, name="_place")
    highest = dimension.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    new_id = (highest + F.col("_place")).cast("int").alias(id_column)
    return placed.select(new_id, *new_rows.columns)


def new_trading_days(rows: DataFrame, trading_days: DataFrame) -> DataFrame:
    absent = absent_keys(rows, trading_days, "trade_date")
    return extend_dimension(absent, trading_days, "trade_date", "date_id")


def new_symbols(listing: DataFrame, symbols: DataFrame) -> DataFrame:
    """New rows of the symbol dimension from (symbol, is_etf) rows."""
    absent = absent_keys(listing, symbols, "symbol")
    flags = listing.groupBy("symbol").agg(F.max("is_etf").alias("is_etf"))
    return extend_dimension(absent.join(flags, "symbol"), symbols, "symbol", "symbol_id")


def fact_keys(bars: DataFrame, symbols: DataFrame, trading_days: DataFrame) -> DataFrame:
    """Bars with both surrogate keys in place of symbol and date; NULL if unknown.

    No side is broadcast by hint: Spark chooses the joins from the sizes and
    splits hot symbols.
    """
    days = trading_days.select("date_id", "trade_date")
    return (
        bars.join(days, "trade_date", "left")
        .join(symbols.select("symbol_id", "symbol", "is_etf"), "symbol", "left")
        .select(*STAR_KEY, "is_etf", *OHLCV)
    )


def fact_rows(keyed: DataFrame, etf: bool) -> DataFrame:
    """The rows of one fact table: ETF bars or all others whose keys are known."""
    known = F.col("symbol_id").isNotNull() & F.col("date_id").isNotNull()
    return keyed.where(known & (F.col("is_etf") == etf)).select(*STAR_KEY, *OHLCV)


def dedupe(rows: DataFrame, key: Sequence[str], *preferred: str) -> DataFrame:
    """One row per key, the greatest by the ``preferred`` columns.

    Copies are reduced before the shuffle, so any number of them is cheap. The
    order covers all columns, so the choice does not depend on arrival.
    """
    others = [c for c in rows.columns if c not in key]
    order = [*preferred, *[c for c in others if c not in preferred]]
    best = rows.groupBy(*key).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in others]).select(*rows.columns)


def dedupe_bars(bars: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One bar per (symbol, trade_date).

    Of differing copies the one that arrived last, where the rows have a column
    ``arrival``; without one, or among equal arrivals, the fullest, then greatest.
    """
    present = sum((F.col(c).isNotNull().cast("int") for c in OHLCV), F.lit(0))
    order = ([arrival] if arrival in bars.columns else []) + ["_present", "close"]
    rows = bars.select(*PRICE_COLUMNS, *order[:-2]).withColumn("_present", present)
    return dedupe(rows, PRICE_KEY, *order).select(*PRICE_COLUMNS)


def upsert(stored: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows, replaced or joined by ``changes``, which hold one row per key.

    Only keys of the stored rows meet the changes, so a small batch is
    broadcast by Spark and the stored rows are not shuffled.
    """
    kept = stored.join(changes.select(*key), list(key), "left_anti")
    return kept.select(*stored.columns).unionByName(changes.select(*stored.columns))


def keep_existing(existing: DataFrame, new: DataFrame, key: Sequence[str] = PRICE_KEY) -> DataFrame:
    """Existing rows plus the new rows whose key they lack."""
    added = new.join(existing.select(*key), list(key), "left_anti")
    return existing.unionByName(added.select(*existing.columns))


def replace_metadata(listing: DataFrame, arrival: str) -> DataFrame:
    """One row per symbol: the one that arrived last, of equal arrivals the greatest."""
    others = [c for c in listing.columns if c not in ("symbol", arrival)]
    order = [arrival] if arrival in listing.columns else []
    last = listing.groupBy("symbol").agg(F.max(F.struct(*order, *others)).alias("_last"))
    return last.select("symbol", *[F.col(f"_last.{c}").alias(c) for c in others])


def add_new_metadata(listing: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata plus the listed symbols it does not hold yet."""
    added = listing.join(metadata.select("symbol"), "symbol", "left_anti")
    return metadata.unionByName(added)


def advance_last_update(metadata: DataFrame, completeness: DataFrame, run_date: date) -> DataFrame:
    """The run date for symbols whose bars on their last update day are complete.

    A symbol without a date has nothing to check and advances too, as long as
    the batch brought it bars. ``completeness`` has symbol and is_complete.
    """
    checked = completeness.select("symbol", "is_complete")
    advances = F.col("is_complete").isNotNull() & (
        F.col("last_update").isNull() | F.col("is_complete")
    )
    return metadata.join(checked, "symbol", "left").select(
        "symbol",
        F.when(advances, F.lit(run_date)).otherwise(F.col("last_update")).alias("last_update"),
        "sector",
    )


def merge_last_update(last_update: DataFrame, *batches: DataFrame) -> DataFrame:
    """One row per symbol with the latest date of the table and all batches."""
    everything = union_all(last_update, *batches).select("symbol", "last_update")
    return everything.groupBy("symbol").agg(F.max("last_update").alias("last_update"))


def merge_metadata(metadata: DataFrame, batch: DataFrame) -> DataFrame:
    """Latest date and latest known sector per symbol; no known sector is lost."""
    kept = F.when(~is_blank("sector"), F.col("sector"))
    return latest_per_symbol(union_all(metadata, batch).withColumn("sector", kept))
