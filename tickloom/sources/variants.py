"""Records of unknown shape, as VARIANT values unfolded by path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_variant(records: DataFrame, column: str = "record", name: str = "record") -> DataFrame:
    """JSON texts parsed once; a text that is no JSON gives NULL."""
    return records.withColumn(name, F.try_parse_json(column))


def variant_to_long(
    grid: DataFrame, fields: Mapping[str, str], record: str = "record", day: str = "trade_date"
) -> DataFrame:
    """One row per (ticker, day) from records that map tickers to their fields.

    ``record`` is a VARIANT object; its keys are the tickers, whatever they are,
    and ``fields`` maps the wanted fields to types. A field a ticker lacks, or
    whose value does not fit the type, is NULL; other fields are passed over. A
    ticker without any of the fields has no row, nor has a record that is NULL
    or no object. No list of tickers is needed or collected.
    """
    kept = grid.select(F.col(day).alias("_day"), F.col(record).alias("_record"))
    # schema_of_variant tells objects from arrays, which unfold too.
    objects = kept.where(F.schema_of_variant("_record").startswith("OBJECT"))
    unfolded = objects.lateralJoin(grid.sparkSession.tvf.variant_explode(F.col("_record").outer()))
    values = [F.try_variant_get("value", f'$["{name}"]', kind).alias(name) for name, kind in fields.items()]
    return unfolded.select(F.col("key").alias("symbol"), F.col("_day").alias(day), *values).dropna("all", subset=list(fields))
