"""Scalar expressions shared by the operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import OHLC


def is_blank(column: str | Column) -> Column:
    """NULL or the empty string."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (c == "")


def is_missing(column: str) -> Column:
    """NULL, or NaN in a price column."""
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if column in OHLC else missing


def clean_symbol(column: str | Column) -> Column:
    return F.upper(F.trim(column))


def days_behind(run_date: date, last_update: str | Column) -> Column:
    return F.datediff(F.lit(run_date), last_update)


def request_period(run_date: date, last_update: str | Column) -> Column:
    """``max`` for a symbol never loaded, ``<days>d`` for a stale one, else NULL."""
    last = F.col(last_update) if isinstance(last_update, str) else last_update
    days = days_behind(run_date, last)
    return F.when(last.isNull(), "max").when(days > 0, F.concat(days.cast("string"), F.lit("d")))


def batches_needed(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size))


def first_present(*columns: str | Column) -> Column:
    """The first value that is neither NULL nor empty."""
    cs = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.coalesce(*[F.when(~is_blank(c), c) for c in cs])


def to_day(column: str | Column) -> Column:
    """A date from a date, a timestamp or ISO text; text that is neither gives NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.to_date(c.try_cast("timestamp_ntz"))
