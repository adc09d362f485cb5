"""Checks on listings, bars, keys and the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import is_missing
from tickloom.operators.positions import with_position
from tickloom.schemas import OHLC, OHLCV

# Columns a symbol directory must have, and its ETF marks.
DIRECTORY_COLUMNS = ["symbol", "security_name", "market_category", "etf", "round_lot_size"]
ETF_MARKS = ["Y", "N"]

# Reasons for which a symbol's bars are rejected, first one wins.
BAD_PRICE = "invalid price"
BAD_VOLUME = "invalid volume"
BAD_ORDER = "dates not ascending"
NO_ROWS = "no data"

ARRIVALS_PER_BLOCK = 100_000


def validate_directory(directory: DataFrame) -> DataFrame:
    """Rows with a valid ETF mark. A missing column or no rows at all is an error."""
    missing = [c for c in DIRECTORY_COLUMNS if c not in directory.columns]
    if missing:
        raise ValueError(f"directory lacks the columns {missing}")
    if directory.isEmpty():
        raise ValueError("directory is empty")
    return directory.where(F.col("etf").isin(ETF_MARKS))


def validate_prices(rows: DataFrame, day: str = "trade_date", arrival: str = "seq") -> DataFrame:
    """Per symbol: rows left after dropping incomplete ones, and why it is rejected.

    Rows without a symbol are judged together, as the symbol NULL without data.
    ``arrival`` numbers a symbol's rows as they came. The order check compares
    neighbours inside blocks of arrivals and then the borders of the blocks, so
    a symbol of any size is spread over tasks.
    """
    block = F.floor(F.col(arrival) / ARRIVALS_PER_BLOCK).alias("_block")
    usable = reduce(and_, [~is_missing(c) for c in ("symbol", day, *OHLCV)])
    before = Window.unboundedPreceding, -1
    in_block = Window.partitionBy("symbol", "_block").orderBy(arrival).rowsBetween(*before)
    judged = (
        rows.select(
            "symbol", F.when(usable, F.col(day)).alias("_day"), arrival, block,
            # Flags instead of the prices: all that the window and the shuffle carry.
            (usable & (F.least(*OHLC) <= 0)).alias("_price"), (usable & (F.col("volume") < 0)).alias("_volume"),
        )
        .withColumn("_seen", F.last("_day", ignorenulls=True).over(in_block))
        .withColumn("_arrived", F.when(F.col("_day").isNotNull(), F.col(arrival)))
        .groupBy("symbol", "_block")
        .agg(
            F.count("_day").alias("rows_here"),
            F.bool_or(F.coalesce("_price", F.lit(False))).alias("bad_price"),
            F.bool_or(F.coalesce("_volume", F.lit(False))).alias("bad_volume"),
            _any_usable(F.col("_seen") > F.col("_day")).alias("falls"),
            F.min_by("_day", "_arrived").alias("first_day"),
            F.max_by("_day", "_arrived").alias("last_day"),
        )
    )
    by_block = Window.partitionBy("symbol").orderBy("_block").rowsBetween(*before)
    last_seen = F.last("last_day", ignorenulls=True).over(by_block)
    verdict = (
        judged.withColumn("_border", F.coalesce(last_seen > F.col("first_day"), F.lit(False)))
        .groupBy("symbol")
        .agg(
            F.sum("rows_here").alias("valid_rows"),
            F.bool_or("bad_price").alias("bad_price"),
            F.bool_or("bad_volume").alias("bad_volume"),
            F.bool_or(F.col("falls") | F.col("_border")).alias("bad_order"),
        )
    )
    reason = (
        F.when(F.col("valid_rows") == 0, NO_ROWS)
        .when(F.col("bad_price"), BAD_PRICE)
        .when(F.col("bad_volume"), BAD_VOLUME)
        .when(F.col("bad_order"), BAD_ORDER)
    )
    return verdict.select(
        "symbol", "valid_rows", reason.isNull().alias("is_valid"), reason.alias("reason")
    )


def _any_usable(condition: Column) -> Column:
    return F.bool_or(F.col("_day").isNotNull() & F.coalesce(condition, F.lit(False)))


def completeness(
    bars: DataFrame, on_day: Column, days: DataFrame | None = None, symbols: DataFrame | None = None
) -> DataFrame:
    """Per symbol: whether it has bars on ``on_day`` and none of them has a NULL or NaN.

    ``on_day`` is a literal day, or a column of ``days`` (symbol, ...), for
    instance the last update of each symbol. Only bars of that day are counted,
    so a literal day reaches the scan. The result has the rows of ``symbols``,
    by default all symbols of the bars, of which only that column is read.
    """
    rows = bars if days is None else bars.join(days, "symbol", "left")
    has_null = reduce(or_, [is_missing(c) for c in OHLCV])
    on_it = (
        rows.where(F.col("trade_date") == on_day)
        .groupBy(F.col("symbol").alias("_symbol"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.count_if(has_null).alias("_nulls"))
    )
    known = (bars if symbols is None else symbols).select("symbol").distinct()
    return (
        known.join(on_it, F.col("symbol").eqNullSafe(F.col("_symbol")), "left")
        .select(
            "symbol",
            F.coalesce("_rows", F.lit(0)).alias("rows_on_day"),
            F.coalesce("_nulls", F.lit(0)).alias("null_rows"),
        )
        .withColumn("is_complete", (F.col("rows_on_day") > 0) & (F.col("null_rows") == 0))
    )


def trading_calendar(spark: SparkSession, first: date, last: date, holidays: DataFrame) -> DataFrame:
    """Weekdays from ``first`` to ``last`` that are not in ``holidays``."""
    span = F.sequence(F.lit(first), F.lit(last)).alias("days")
    days = spark.range(1).select(F.explode(span).alias("trade_date"))
    # weekday() counts Monday as 0.
    return days.where(F.weekday("trade_date") < 5).join(
        holidays.select(F.col("holiday").alias("trade_date")), "trade_date", "left_anti"
    )


def is_trading_day(days: DataFrame, calendar: DataFrame, day: str = "trade_date") -> DataFrame:
    """Every distinct day with whether the market is open on it."""
    open_days = calendar.select(F.col("trade_date").alias(day), F.lit(True).alias("_open"))
    return (
        days.select(day)
        .distinct()
        .join(open_days, day, "left")
        .select(day, F.coalesce("_open", F.lit(False)).alias("is_open"))
    )


def staleness_gate(ledger: DataFrame, run_date: date, wait_days: int = 3) -> DataFrame:
    """Days since the last committed write, 1 if there was none, and whether to run."""
    days = F.coalesce(F.datediff(F.lit(run_date), F.max(F.to_date("committed_at"))), F.lit(1))
    return ledger.agg(days.alias("days_since")).withColumn("is_due", F.col("days_since") >= wait_days)


def integrity_report(
    rows: DataFrame,
    key: Sequence[str],
    required: Sequence[str],
    references: dict[str, DataFrame],
) -> DataFrame:
    """Violations per check: repeated keys, NULLs in required columns, orphans.

    ``references`` maps a column to the frame whose same-named column it must
    occur in. The rows are read once: repeats, NULLs and orphans all come from
    one grouping by the key and the references.
    """
    beside = [c for c in references if c not in key]
    counted = rows.groupBy(*key, *beside).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in required],
    )
    for column, parent in references.items():
        known = parent.select(column).where(F.col(column).isNotNull()).distinct()
        counted = counted.join(known.withColumn(f"_in_{column}", F.lit(True)), column, "left")
    orphans = [
        F.sum(F.when(F.col(c).isNotNull() & F.col(f"_in_{c}").isNull(), F.col("_n")).otherwise(0)).alias(f"_orphan_{c}")
        for c in references
    ]
    nulls = [F.sum(f"_null_{c}").alias(f"_null_{c}") for c in required]
    per_key = counted.groupBy(*key).agg(F.sum("_n").alias("_n"), *nulls, *orphans)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    totals = per_key.agg(
        F.count_if(F.col("_n") > 1).alias(f"repeated key {', '.join(key)}"),
        *[total(f"_null_{c}").alias(f"null in {c}") for c in required],
        *[total(f"_orphan_{c}").alias(f"orphan {c}") for c in references],
    )
    checks = [F.col(f"`{c}`") for c in totals.columns]
    return totals.unpivot([], checks, "check_name", "violations")


def missing_intervals(bars: DataFrame, calendar: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """(symbol, first_day, last_day, days): the runs of trading days of ``calendar`` without a bar.

    Trading days are numbered, bars take the number of their day, and a jump in
    a symbol's numbers is a gap; what lies before its first and after its last
    bar counts too. Symbols times days are never made: a symbol has as many
    rows as bars. Symbols of ``symbols`` (by default those of the bars) without
    any bar lack the whole calendar. Bars on other days fill nothing.
    """
    days = with_position(calendar.select("trade_date").distinct(), "trade_date", name="day_no")
    known = (bars if symbols is None else symbols).select("symbol").where("symbol IS NOT NULL").distinct()
    numbered = bars.select("symbol", "trade_date").join(days, "trade_date").select("symbol", "day_no").distinct()
    # The end of the calendar as one more row of every symbol, so that the last gap is one like the others.
    end = days.agg((F.coalesce(F.max("day_no"), F.lit(0)) + 1).alias("day_no"))
    held = numbered.join(known, "symbol", "left_semi").unionByName(known.join(F.broadcast(end)))  # one number
    # One bar a day: a symbol has at most as many rows as the calendar has days.
    before = F.coalesce(F.lag("day_no").over(Window.partitionBy("symbol").orderBy("day_no")), F.lit(0))
    gaps = held.select("symbol", (before + 1).alias("first_no"), (F.col("day_no") - 1).alias("last_no")).where("last_no >= first_no")
    first, last = (days.select(F.col("day_no").alias(f"{e}_no"), F.col("trade_date").alias(f"{e}_day")) for e in ("first", "last"))
    return gaps.join(first, "first_no").join(last, "last_no").select(
        "symbol", "first_day", "last_day", (F.col("last_no") - F.col("first_no") + 1).alias("days")
    )
