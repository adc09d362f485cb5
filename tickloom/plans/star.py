"""Load of the star schema: two dimensions, two fact tables, listing metadata."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.dimensions import (
    STAR_KEY,
    dedupe_bars,
    fact_keys,
    fact_rows,
    new_symbols,
    new_trading_days,
    replace_metadata,
    upsert,
)
from tickloom.operators.relational import directory_projection, listing_universe
from tickloom.schemas import schema_for
from tickloom.sources import tables as t
from tickloom.storage import Scratch

STAR_TABLES = ["trading_days", "symbols", "stock_prices", "etf_prices", "metadata"]


@dataclass(frozen=True)
class Star:
    spark: SparkSession
    namespace: str

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def create(self, location: str | None = None) -> Star:
        t.create_namespace(self.spark, self.namespace, location)
        for table in ("trading_days", "symbols"):
            t.create_table(self.spark, self.name(table), schema_for(table))
        for table in ("stock_prices", "etf_prices"):
            fact = t.with_month(schema_for(f"{table}_star"))
            t.create_table(self.spark, self.name(table), fact, partitioned_by=[t.MONTH])
        t.create_table(self.spark, self.name("metadata"), schema_for("symbol_listing"))
        return self


class Loaded(NamedTuple):
    """Bars of listed symbols that were loaded, bars without a symbol or a date, and bars of symbols not listed."""

    facts: int
    rejected: int
    unlisted: int


def load_star(star: Star, directory: DataFrame, bars: DataFrame) -> Loaded:
    """Add what is new to the dimensions, then insert or replace the facts.

    ``directory`` and ``bars`` may carry an ``arrival`` column; the last row of a
    key wins. A symbol listed more than once is one row of the metadata. Bars
    without a symbol or a date belong to no key; they and the bars of symbols
    that are not listed are left out and counted in what is returned, with the
    distinct bars loaded. Intermediate rows are deleted at the end.
    """
    with Scratch(star.spark) as scratch:
        return _load(star, directory, bars, scratch)


def _load(star: Star, directory: DataFrame, bars: DataFrame, scratch: Scratch) -> Loaded:
    listing = listing_universe(directory)
    keyed = F.col("symbol").isNotNull() & F.col("trade_date").isNotNull()
    seen = Observation()
    # Counted while the batch is written, without another pass over the bars.
    counted = bars.withColumn("_keyed", keyed).join(
        listing.select("symbol", F.lit(True).alias("_listed")).distinct(), "symbol", "left"
    ).withColumn("_listed", F.coalesce("_listed", F.lit(False))).observe(
        seen,
        F.count_if(~F.col("_keyed")).alias("rejected"),
        F.count_if(F.col("_keyed") & ~F.col("_listed")).alias("unlisted"),
    )
    batch = scratch.stage(dedupe_bars(counted.where("_keyed AND _listed").drop("_keyed", "_listed")), "star-bars")
    facts = batch.count()
    t.append(new_trading_days(batch, star.table("trading_days")), star.name("trading_days"))
    t.append(new_symbols(listing.select("symbol", "is_etf"), star.table("symbols")), star.name("symbols"))
    days = star.table("trading_days")
    keyed = scratch.stage(fact_keys(batch, star.table("symbols"), days), "star-facts")
    for table, etf in (("stock_prices", False), ("etf_prices", True)):
        _upsert_facts(star, table, fact_rows(keyed, etf), days)
    arrival = ["arrival"] if "arrival" in directory.columns else []
    known = replace_metadata(directory_projection(directory, *arrival), "arrival")
    t.replace_table(known, star.name("metadata"))
    return Loaded(facts, seen.get["rejected"], seen.get["unlisted"])


def _upsert_facts(star: Star, table: str, rows: DataFrame, days: DataFrame) -> None:
    """Rewrite the months the new facts fall into, once; all others stay untouched."""
    changes = rows.join(days.select("date_id", t.month_of().alias(t.MONTH)), "date_id")
    months = sorted(r[t.MONTH] for r in changes.select(t.MONTH).distinct().collect())
    if not months:
        return
    current = star.table(table).where(F.col(t.MONTH).isin(months))
    merged = upsert(current, changes, STAR_KEY)
    t.overwrite_partitions(merged.repartitionByRange(t.MONTH, *STAR_KEY), star.name(table))
