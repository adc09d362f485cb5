"""Projections, filters, joins, aggregates and batching."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import clean_symbol, is_blank, request_period
from tickloom.operators.positions import with_position, with_position_in, with_running_sum
from tickloom.schemas import OHLCV, PRICE_COLUMNS, PRICE_KEY

# -- projections and filters -------------------------------------------------


def normalize_prices(raw: DataFrame, day: str = "Date") -> DataFrame:
    """Provider rows as price bars: clean symbol, declared names and order, then ``arrival`` if there."""
    return raw.select(
        clean_symbol("symbol").alias("symbol"), F.col(day).alias("trade_date"), *[F.col(c).alias(c) for c in OHLCV],
        *[c for c in ("arrival",) if c in raw.columns],
    )


def clean_rows(raw: DataFrame, day: str = "trade_date") -> DataFrame:
    """Drop rows with no price and no volume at all, and rows with no date."""
    return raw.dropna("all", subset=OHLCV).dropna(subset=[day])


def for_symbols(bars: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return bars.where(F.col("symbol").isin(list(symbols)))


def since(bars: DataFrame, first_day: date) -> DataFrame:
    return bars.where(F.col("trade_date") >= F.lit(first_day))


def close_series(bars: DataFrame, symbols: Sequence[str], first_day: date) -> DataFrame:
    """Closing prices of some symbols from a day on, sorted for a chart."""
    chosen = since(for_symbols(bars, symbols), first_day)
    return chosen.select(*PRICE_KEY, "close").orderBy(*PRICE_KEY)


def listing_universe(directory: DataFrame) -> DataFrame:
    """Tradable listings with the fact table their bars belong to."""
    return directory.where((F.col("test_issue") == "N") & F.col("etf").isin("Y", "N")).select(
        "symbol",
        (F.col("etf") == "Y").alias("is_etf"),
        F.when(F.col("etf") == "Y", "etf_prices").otherwise("stock_prices").alias("target"),
    )


def directory_projection(directory: DataFrame, *more: str) -> DataFrame:
    """The directory columns kept as symbol metadata, of listings that are no tests."""
    return directory.where(F.col("test_issue") == "N").select(
        "symbol",
        "security_name",
        "market_category",
        (F.col("etf") == "Y").alias("is_etf"),
        "round_lot_size",
        *more,
    )


def stale_or_unseen(listing: DataFrame, metadata: DataFrame, run_date: date) -> DataFrame:
    """Listed symbols that are known and outdated, or not known at all.

    A known symbol without a date is in neither part.
    """
    outdated = metadata.where(F.col("last_update") < F.lit(run_date)).select("symbol")
    known = metadata.select("symbol")
    return listing.join(outdated, "symbol", "left_semi").unionByName(
        listing.join(known, "symbol", "left_anti")
    )


def missing_sector(metadata: DataFrame) -> DataFrame:
    return metadata.where(is_blank("sector"))


def with_sector(metadata: DataFrame) -> DataFrame:
    return metadata.where(~is_blank("sector"))


def lookup_last_update(requests: DataFrame, metadata: DataFrame) -> DataFrame:
    """The last update of each requested symbol, trimmed; NULL if there is none."""
    wanted = requests.select(F.trim("symbol").alias("symbol"))
    known = metadata.select(F.col("symbol").alias("_known"), "last_update")
    return wanted.join(known, F.col("symbol").eqNullSafe(F.col("_known")), "left").select(
        "symbol", "last_update"
    )


def incremental_rows(bars: DataFrame, metadata: DataFrame) -> DataFrame:
    """Bars later than their symbol's last update; all bars of an unknown symbol."""
    known = metadata.select("symbol", "last_update")
    newer = F.col("last_update").isNull() | (F.col("trade_date") > F.col("last_update"))
    return bars.join(known, "symbol", "left").where(newer).drop("last_update")


# -- joins -------------------------------------------------------------------


def symbols_with_metadata(requested: DataFrame, metadata: DataFrame) -> DataFrame:
    return requested.join(metadata, "symbol", "left")


def new_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars whose (symbol, trade_date) is not stored yet; repeats in the input stay."""
    return bars.join(stored.select(*PRICE_KEY), PRICE_KEY, "left_anti")


def split_known(batch: DataFrame, known: DataFrame, key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """The rows whose key is known and the rows whose key is new."""
    keys = known.select(key)
    return batch.join(keys, key, "left_semi"), batch.join(keys, key, "left_anti")


def backfill_sector(metadata: DataFrame, found: DataFrame) -> DataFrame:
    """Metadata with the sector that was found, where one was."""
    new = found.where(~is_blank("sector")).select("symbol", F.col("sector").alias("_new"))
    sector = F.coalesce("_new", "sector").alias("sector")
    return metadata.join(new, "symbol", "left").select("symbol", "last_update", sector)


def attach(rows: DataFrame, attributes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per-symbol attributes joined to rows; NULL for an unknown symbol."""
    return rows.join(attributes.select("symbol", *columns), "symbol", "left")


# -- aggregates --------------------------------------------------------------


def price_stats(bars: DataFrame, *more: Column) -> DataFrame:
    """Statistics of the close per symbol, and whatever else is wanted of the same pass."""
    return bars.groupBy("symbol").agg(
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
        F.avg("close").alias("avg_close"),
        F.count("close").alias("close_count"),
        *more,
    )


def latest_per_symbol(metadata: DataFrame) -> DataFrame:
    """One row per symbol: its latest date and the latest sector that is not blank."""
    dated = F.struct(F.col("last_update"), F.col("sector"))
    return metadata.groupBy("symbol").agg(
        F.max("last_update").alias("last_update"),
        F.max(F.when(~is_blank("sector"), dated))["sector"].alias("sector"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with NULLs and how many, from one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count").where("null_count > 0")


def next_id(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("next_id"))


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select(clean_symbol("symbol").alias("symbol")).distinct()


def missing_remaining(metadata: DataFrame) -> DataFrame:
    return metadata.agg(F.count_if(is_blank("sector")).alias("missing_count"))


def batch_metadata(raw: DataFrame, metadata: DataFrame, run_date: date) -> DataFrame:
    """Metadata of the symbols in a batch: the run date and the sector known so far."""
    seen = distinct_symbols(raw)
    return (
        seen.join(metadata.select("symbol", "sector"), "symbol", "left")
        .withColumn("last_update", F.lit(run_date))
        .select("symbol", "last_update", "sector")
    )


# -- requests and batches ----------------------------------------------------


def request_plan(symbols: DataFrame, run_date: date, size: int = 50) -> DataFrame:
    """Requests of at most ``size`` symbols that share a period.

    ``symbols`` has symbol and last_update. Symbols that are up to date need no
    request. A period may be shared by any number of symbols: they are numbered
    by a distributed sort and only single requests are collected.
    """
    due = symbols.select("symbol", request_period(run_date, "last_update").alias("period")).where(
        F.col("period").isNotNull()
    )
    numbered = with_position_in(due, ["period"], "symbol")
    request = F.floor((F.col("position") - 1) / size).cast("int")
    return (
        numbered.groupBy("period", request.alias("request_no"))
        .agg(
            F.count(F.lit(1)).alias("symbol_count"),
            F.sort_array(F.collect_list("symbol")).alias("symbols"),
        )
    )


def batch_assignment(symbols: DataFrame, size: int = 100) -> DataFrame:
    """Every symbol with its batch number, counted from 0 in symbol order."""
    placed = with_position(symbols.select("symbol"), "symbol")
    return placed.select(
        "symbol", F.floor((F.col("position") - 1) / size).cast("int").alias("batch_id")
    )


def balanced_batches(symbols: DataFrame, bound: int, weight: str = "days") -> DataFrame:
    """Every symbol with a batch, cut in symbol order where the running weight crosses a multiple of ``bound``.

    ``symbols`` has symbol and a weight, for instance the days it is behind, so
    batches are of about equal work whatever a symbol needs. A batch weighs less
    than ``bound`` plus its last symbol, and one symbol is never split. Symbols
    of weight 0 or NULL go with the next one.
    """
    if bound < 1:
        raise ValueError("a batch needs a bound of at least 1")
    summed = with_running_sum(symbols.select("symbol", weight), weight, "symbol")
    start = F.col("running") - F.coalesce(F.col(weight), F.lit(0))
    return summed.select("symbol", weight, F.floor(start / bound).cast("int").alias("batch_id"))


# -- order and samples -------------------------------------------------------


def first_rows(bars: DataFrame, count: int = 5) -> DataFrame:
    """The first bars of every symbol. Each task keeps ``count`` rows a symbol before the shuffle."""
    by_date = Window.partitionBy("symbol").orderBy("trade_date")
    place = F.row_number().over(by_date).alias("place")
    return bars.select(*PRICE_COLUMNS, place).where(F.col("place") <= count)


# -- set operations ----------------------------------------------------------


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows, columns matched by name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def union_distinct(*parts: DataFrame) -> DataFrame:
    return union_all(*parts).distinct()
