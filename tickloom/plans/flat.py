"""Flat load: bars in batches of symbols, last updates merged once at the end."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.dimensions import dedupe_bars, merge_last_update
from tickloom.operators.enrich import landing_fetch
from tickloom.operators.relational import (
    clean_rows,
    new_bars,
    normalize_prices,
    split_known,
    symbols_with_metadata,
    union_all,
)
from tickloom.schemas import schema_for
from tickloom.sources import tables as t
from tickloom.storage import Scratch


@dataclass(frozen=True)
class FlatStore:
    """A price table and the table of last updates."""

    spark: SparkSession
    namespace: str

    @property
    def prices(self) -> str:
        return f"{self.namespace}.stock_prices"

    @property
    def last_update(self) -> str:
        return f"{self.namespace}.last_update"

    def create(self, location: str | None = None) -> FlatStore:
        t.create_namespace(self.spark, self.namespace, location)
        t.create_price_table(self.spark, self.prices, schema_for("stock_prices"))
        t.create_table(self.spark, self.last_update, schema_for("last_update"), comment="Last updates")
        return self


def flat_load(
    store: FlatStore, batches: Iterable[DataFrame], landing: DataFrame, run_date: date, day: str = "dt"
) -> dict[str, int]:
    """Load every batch of symbols, then write the last updates once.

    Each batch is looked up in the last updates, fetched, reduced to bars not
    stored yet and appended; its symbols are split into known and new ones. An
    interrupted load is repeated: stored bars are not appended again and the
    last updates have not moved. Returns bars added and symbols known and new.
    """
    counts = {"bars": 0, "known": 0, "new": 0}
    with Scratch(store.spark) as scratch:
        before = scratch.stage(store.spark.table(store.last_update), "last-update")
        touched = []
        for symbols in batches:
            requested = symbols_with_metadata(symbols.select("symbol"), before)
            fetched = landing_fetch(requested, landing, run_date, day)
            bars = scratch.stage(dedupe_bars(normalize_prices(clean_rows(fetched, day), day)), "batch")
            stored = t.prices_in_months(store.spark, store.prices, t.months_in(bars))
            fresh = scratch.stage(new_bars(bars, stored), "new-bars")
            counts["bars"] += t.append(t.by_month(fresh), store.prices)
            seen = bars.select("symbol").distinct().withColumn("last_update", F.lit(run_date))
            known, new = (scratch.stage(part, "touched") for part in split_known(seen, before))
            counts["known"] += known.count()
            counts["new"] += new.count()
            touched += [known, new]
        if touched:
            merged = scratch.stage(merge_last_update(before, union_all(*touched)), "merged")
            t.replace_table(merged, store.last_update)
    return counts
