"""Fetching bars and sectors: joins with landed data, and a hook for callers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.scalars import clean_symbol, days_behind
from tickloom.operators.relational import batch_assignment

# Attempts per batch and symbols per call.
MAX_ATTEMPTS = 3
CALL_SIZE = 50


def landing_fetch(requested: DataFrame, landing: DataFrame, run_date: date, day: str = "dt") -> DataFrame:
    """Landed rows the requested symbols still need.

    ``requested`` has symbol and last_update. A symbol without a date needs its
    whole history, one that is up to date nothing, any other its later rows.
    """
    last = F.col("last_update")
    wanted = requested.where(last.isNull() | (days_behind(run_date, last) > 0)).select(
        F.col("symbol").alias("_wanted"), "last_update"
    )
    later = last.isNull() | (F.col(day) > last)
    return (
        landing.join(wanted, clean_symbol("symbol") == F.col("_wanted"))
        .where(later)
        .select(*landing.columns)
    )


def batched_map(
    symbols: DataFrame,
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    result: StructType,
    size: int = CALL_SIZE,
    attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Call ``fetch`` once per batch of at most ``size`` symbols, in the tasks.

    ``fetch`` gets a frame with a symbol column and returns rows of ``result``,
    whose first column is the symbol. A batch that still raises after
    ``attempts`` calls gives one row per symbol with NULL results. ``status``,
    ``attempts`` and ``error`` (the last one's type and text, NULL if there was
    none) say how each batch went, so no failure is silent. ``fetch``
    may be called again if an executor is lost.
    """
    names = [f.name for f in result]
    schema = StructType(
        result.fields + StructType.fromDDL("batch_id int, status string, attempts int, error string").fields
    )

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        asked = batch[["symbol"]].sort_values("symbol").reset_index(drop=True)
        status, made, out, error = "failed", 0, None, None
        while out is None and made < attempts:
            made += 1
            try:
                out = fetch(asked.copy())[names]
                status = "ok"
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
        if out is None:
            out = asked.rename(columns={"symbol": names[0]}).reindex(columns=names)
        return out.assign(batch_id=batch["batch_id"].iloc[0], status=status, attempts=made, error=error)

    return batch_assignment(symbols, size).groupBy("batch_id").applyInPandas(run, schema)


def enrich_sector(symbols: DataFrame, lookup: DataFrame) -> DataFrame:
    """The sector of each symbol from a reference table; NULL if it has none."""
    return symbols.select("symbol").join(lookup.select("symbol", "sector"), "symbol", "left")
