"""Filling in missing sectors until a round finds nothing more."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.relational import backfill_sector, missing_sector, with_sector
from tickloom.storage import fresh_path, remove_folder


def backfill_to_fixpoint(
    metadata: DataFrame, lookup: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Metadata after repeated rounds of looking up the symbols without a sector.

    ``lookup`` maps symbols to (symbol, sector) and may find more on a later
    call. A round that finds nothing is the last one. Only symbols that were
    asked for count as found, so every round fills at least one and the loop
    ends. Every round is written to the shared folder, so plans do not grow and
    a lost executor costs one round; of all rounds only the last one's metadata
    stays there, for the caller to read.
    """
    spark, kept = metadata.sparkSession, None

    def stored(rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    while True:
        symbols = missing_sector(metadata).select("symbol").distinct()
        answers = with_sector(lookup(symbols)).join(symbols, "symbol", "left_semi")
        sectors, filled = fresh_path(spark, "sectors"), fresh_path(spark, "metadata")
        found = stored(answers.groupBy("symbol").agg(F.max("sector").alias("sector")), sectors)
        done = found.isEmpty()
        if not done:
            metadata = stored(backfill_sector(metadata, found), filled)
            if kept:
                remove_folder(spark, kept)
            kept = filled
        remove_folder(spark, sectors)
        if done:
            return metadata
