"""The indicator table kept beside the prices and brought up to date by years.

Next to the indicators lies a table of states: for every symbol and year the
number of usable bars so far, the last of them, and the smoothing states. A
refresh takes up the states from before the first changed year, reads the bars
from that year on, and replaces the years it has computed in both tables. What
lies before is not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions import indicators as ind
from tickloom.functions.scan import carry_of
from tickloom.functions.series import ERA, is_complete, last_of
from tickloom.schemas import OHLCV
from tickloom.sources import tables as t
from tickloom.storage import Scratch

YEAR = "year"
MANY_ROWS = 5_000_000  # so many indicators are written by the tasks that compute them
_BAR = "struct<trade_date: date, open: double, high: double, low: double, close: double, volume: bigint>"


@dataclass(frozen=True)
class IndicatorStore:
    """The tables of one indicator store."""

    spark: SparkSession
    namespace: str

    @property
    def table(self) -> str:
        return f"{self.namespace}.indicators"

    @property
    def states(self) -> str:
        return f"{self.namespace}.indicator_states"

    def create(self, location: str | None = None) -> IndicatorStore:
        t.create_namespace(self.spark, self.namespace, location)
        kinds = {"Date": "date", "Volume": "bigint"}
        columns = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in ind.INDICATOR_COLUMNS)
        table = StructType.fromDDL(f"symbol string, {columns}, {YEAR} int")
        t.create_table(self.spark, self.table, table, [YEAR], "Technical indicators")
        t.create_table(self.spark, self.states, _state_schema(), [YEAR], "States of the indicators at the ends of years")
        return self

    def indicators(self) -> DataFrame:
        """The stored indicator table, without its partition column."""
        return self.spark.table(self.table).drop(YEAR)


def _state_schema() -> StructType:
    carry = carry_of(ind.table_smoothers())
    return StructType.fromDDL(f"symbol string, n int, tail array<{_BAR}>, carry {carry}, {YEAR} int")


def refresh(store: IndicatorStore, prices: str, first_changed: date | None = None) -> int:
    """Compute the indicators of every bar of the price table from the year of ``first_changed`` on.

    Without a day all bars are computed. Returns the rows written. New symbols,
    late and corrected bars are taken in if ``first_changed`` is the earliest
    day that changed; a year that has lost all of its bars keeps its rows. The
    years before are neither read nor written. Indicators are written before
    the states, and both by years, so an interrupted run is repeated with the
    same result.
    """
    spark = store.spark
    with Scratch(spark) as scratch:
        if first_changed is None:
            bars, prior = t.prices(spark, prices), spark.table(store.states).limit(0)
        else:
            bars = t.prices_from(spark, prices, date(first_changed.year, 1, 1))
            prior = _states_before(store, first_changed.year)
        year = F.year("trade_date")
        found = bars.where(is_complete([])).agg(F.min(year).alias("first"), F.max(year).alias("last"), F.count("*").alias("bars")).first()
        if not found.bars:
            return 0
        # The states are read while their table is written to below.
        prior = scratch.stage(prior.drop(YEAR), "prior-states")
        rows = ind.indicator_rows(bars, prior, keep_states=True).withColumn(YEAR, year)
        # Computed twice, whole for the one table and in part for the other: rows kept or dealt anew
        # between would be several times as large as the bars.
        written = t.overwrite_partitions(_laid(ind.named_table(rows, YEAR), found.bars), store.table)
        states = year_states(rows, prior, found.first, found.last)
        t.overwrite_partitions(states.repartitionByRange(YEAR, "symbol"), store.states)
    return written


def _laid(table: DataFrame, rows: int) -> DataFrame:
    """The indicators in the order of their folders, many of them where they were computed.

    These are not moved: a file for each task and year, sorted by symbol. Few are
    dealt by ranges, as they would lie in as many files.
    """
    order = [YEAR, "symbol", "Date"]
    return table.repartitionByRange(*order) if rows < MANY_ROWS else table.sortWithinPartitions(*order)


def _states_before(store: IndicatorStore, year: int) -> DataFrame:
    """The states at the end of the last stored year before ``year``: one folder is read."""
    states = store.spark.table(store.states).where(F.col(YEAR) < year)
    last = states.agg(F.max(YEAR)).first()[0]
    return states.where(F.col(YEAR) == last) if last is not None else states.limit(0)


def year_states(rows: DataFrame, prior: DataFrame, first: int, last: int) -> DataFrame:
    """(symbol, n, tail, carry, year): the states of every symbol at the end of each year from first to last.

    ``rows`` are ``indicator_rows`` with their states and year, ``prior``
    the states before them. A symbol without bars in a year carries its state
    on. A symbol gives one row a year, and its arrays hold a few bars of each.
    """
    lookback = ind.TABLE_LOOKBACK
    bar = F.struct("trade_date", *OHLCV)
    # A year lies in one era, so its last bars are gathered where the bars of the era lie.
    ends = rows.where("in_tail").groupBy(*ERA, YEAR).agg(
        F.max_by(F.struct("n", "carry"), "trade_date").alias("state"),
        last_of(F.sort_array(F.collect_list(bar)), lookback).alias("tail"),
    )
    by_symbol = ends.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct(YEAR, "state", "tail"))).alias("ends"))
    before = prior.select("symbol", F.struct("n", "carry").alias("_state"), F.col("tail").alias("_tail"))
    joined = by_symbol.join(before, "symbol", "full")
    passed = F.filter(F.coalesce("ends", F.array()), lambda e: e[YEAR] <= F.col(YEAR))
    at = joined.withColumn(YEAR, F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("_passed", passed)
    state = F.coalesce(F.try_element_at("_passed", F.lit(-1))["state"], F.col("_state"))
    bars = F.concat(F.coalesce("_tail", F.array()), F.flatten(F.transform("_passed", lambda e: e["tail"])))
    return at.where(state.isNotNull()).select(
        "symbol", state["n"].alias("n"), last_of(bars, lookback).alias("tail"), state["carry"].alias("carry"), YEAR
    )
