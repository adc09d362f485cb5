"""A first look at stored bars: counts, gaps, statistics, latest indicators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.indicators import signals
from tickloom.operators.relational import for_symbols, price_stats, since

LATEST = ["rsi_14", "macd_hist", "is_overbought", "is_oversold", "is_rising"]


def explore(bars: DataFrame, symbols: Sequence[str], first_day: date) -> DataFrame:
    """One row per chosen symbol.

    Counts and price statistics cover its whole history, the indicators the
    bars from ``first_day`` on; they are those of its latest bar.
    """
    chosen = for_symbols(bars, symbols)
    summary = price_stats(
        chosen,
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("volume").isNull() | F.col("close").isNull()).alias("null_rows"),
        F.min("trade_date").alias("first_day"),
        F.max("trade_date").alias("last_day"),
    )
    latest = (
        signals(since(chosen, first_day))
        .groupBy("symbol")
        .agg(*[F.max_by(c, "trade_date").alias(c) for c in LATEST])
    )
    return summary.join(latest, "symbol", "left")
