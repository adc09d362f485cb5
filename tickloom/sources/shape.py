"""From what providers send to the declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def wide_to_long(
    grid: DataFrame,
    tickers: Sequence[str],
    fields: Sequence[str],
    day: str = "trade_date",
    separator: str = "_",
    names: str | None = None,
) -> DataFrame:
    """One row per (ticker, day) from a grid with a column per (ticker, field).

    Tickers with no column in the grid are skipped, a missing field is NULL and
    rows with no value at all are dropped. Each grid row unfolds in place.

    Many grids of one width may lie in one frame: their columns then have the
    names of slots, ``tickers`` lists the slots, and the column ``names`` maps
    those of its row to tickers. A slot that has no ticker there is skipped.
    """
    types = {f.name: f.dataType for f in grid.schema}

    def type_of(field: str) -> str:
        for t in tickers:
            if t + separator + field in types:
                return types[t + separator + field].simpleString()
        return "double"

    def cell(ticker: str, field: str) -> Column:
        name = ticker + separator + field
        value = F.col(f"`{name}`") if name in types else F.lit(None)
        return value.cast(type_of(field)).alias(field)

    present = [t for t in tickers if any(t + separator + f in types for f in fields)]
    if not present:
        columns = [F.lit(None).cast("double").alias(f) for f in fields]
        return grid.select(F.lit("").alias("symbol"), day, *columns).limit(0)
    rows = F.array(
        *[F.struct(F.lit(t).alias("symbol"), *[cell(t, f) for f in fields]) for t in present]
    )
    if names is None:
        unfolded = grid.select(day, F.inline(rows)).dropna("all", subset=list(fields))
    else:
        slots = grid.select(day, names, F.inline(rows)).dropna("all", subset=list(fields))
        unfolded = slots.withColumn("symbol", F.try_element_at(names, "symbol")).dropna(subset=["symbol"])
    return unfolded.select("symbol", day, *fields)


def enforce_schema(records: DataFrame, schema: StructType, report: str = "cast_errors") -> DataFrame:
    """Columns of ``schema`` cast from ``records``, plus what could not be cast.

    A value that does not fit becomes NULL and its column is named in
    ``report``; so is a NULL in a column declared NOT NULL. A declared column
    the records lack is an error.
    """
    missing = [f.name for f in schema if f.name not in records.columns]
    if missing:
        raise ValueError(f"records lack the columns {missing}")
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    failed = [
        F.when(
            typed[f.name].isNull() & (F.col(f.name).isNotNull() | F.lit(not f.nullable)),
            F.lit(f.name),
        )
        for f in schema
    ]
    return records.select(
        *[c.alias(name) for name, c in typed.items()],
        F.concat_ws(",", *failed).alias(report),
    )


def flatten_names(df: DataFrame) -> DataFrame:
    """``('Close', 'X')`` becomes ``Close``; plain names stay. Two equal results are an error."""
    renames = {c: c.split(",")[0].strip("()'\" ") for c in df.columns}
    if len(set(renames.values())) != len(renames):
        raise ValueError(f"flattened names collide: {sorted(renames.values())}")
    return df.withColumnsRenamed(renames)
