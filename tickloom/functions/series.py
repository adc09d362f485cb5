"""Per-symbol series laid out so that no task ever holds a whole series.

A series is cut into *eras* (whole decades) and each era is its own window
partition: with one bar a day that is at most 3,660 rows, however long the
history and however large the symbol's share of the table. What an era needs
from earlier ones is small and is computed apart:

* its *context*: the last ``lookback`` bars before it, for frames that reach back;
* the number of bars before it, for positions counted from the first bar.

Eras are dealt over at least ``PARTITIONS`` tasks. Bars compress well, so tasks
merged by the size of their files would sort millions of them at once.

Bars that lack a needed price are *unusable*: they keep their rows, but in a
window partition of their own, so that no frame meets them. The bars are read
once and shuffled once, on (symbol, era).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import is_missing

ERA_YEARS = 10
BLOCK_MONTHS = 2  # divides a year, so a block never spans two eras
PARTITIONS = 192  # tasks that the eras are dealt over, or the session's shuffle partitions if they are more

ERA = ["symbol", "era"]


def in_era() -> Window:
    """All usable rows of one (symbol, era), by date. ``block`` rises with the date."""
    return Window.partitionBy(*ERA, "usable").orderBy("block", "trade_date")


def in_block() -> Window:
    """One two-month stretch of a series; needs the same sort as ``in_era``."""
    return Window.partitionBy(*ERA, "usable", "block").orderBy("trade_date")


def _era() -> Column:
    return F.floor(F.year("trade_date") / ERA_YEARS).cast("int")


def _block() -> Column:
    month = F.year("trade_date") * 12 + F.month("trade_date") - 1
    return F.floor(month / BLOCK_MONTHS).cast("int")


def _dealt(keyed: DataFrame) -> DataFrame:
    """By symbol and era, over a number of tasks that adaptive execution keeps; without it the session's number holds."""
    conf = keyed.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") != "true":
        return keyed.repartition(*ERA)
    return keyed.repartition(max(PARTITIONS, int(conf.get("spark.sql.shuffle.partitions"))), *ERA)


def is_complete(columns: Sequence[str]) -> Column:
    """A symbol, a date, and neither NULL nor NaN in ``columns``."""
    return reduce(and_, [~is_missing(c) for c in ("symbol", "trade_date", *columns)])


def in_order(
    bars: DataFrame, values: Sequence[str], lookback: int = 0, needed: Sequence[str] | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Bars ready for windows: symbol, era, usable, block, trade_date, values, n, is_context.

    ``n`` counts a symbol's usable bars from 1. Rows with ``is_context`` belong
    to an earlier era; they serve the frames of this one and must be dropped
    after. A bar with a NULL or NaN in ``needed`` (all ``values``, unless fewer
    are named) is not usable: it enters no frame and no count and its ``n`` is
    NULL. Rows without a symbol or a date are left out; (symbol, trade_date) is
    unique.

    ``state`` (symbol, n, tail) continues series: the number of usable bars
    before the first of ``bars``, and the last of them.
    """
    needed = list(values) if needed is None else list(needed)
    keyed = bars.select("symbol", "trade_date", *values).where(is_complete([]))
    dealt = _dealt(keyed.withColumn("era", F.coalesce(_era(), F.lit(0))))
    # Judged after the bars are dealt: what reads ``usable`` then reads the same shuffle as the bars.
    placed = dealt.withColumns({"usable": is_complete(needed), "block": _block()})
    if not lookback and set(values) <= set(needed) and state is None:
        return _numbered(placed, values)
    lookback = max(1, lookback)
    bar = F.struct("trade_date", *values)
    # Only an era's last bars are ever held in an array. Unusable ones are left out inside the
    # aggregates: a filter would reach the scan and part this plan from the one it shares a shuffle with.
    ends = placed.withColumns({
        "_place": F.row_number().over(in_era()),
        "_first": F.first("trade_date").over(in_era()),
        "_ahead": F.lead("trade_date", lookback).over(in_era()),
    }).where(F.col("_ahead").isNull())
    eras = ends.groupBy(*ERA).agg(
        F.coalesce(F.max(F.when(F.col("usable"), F.col("_place"))), F.lit(0)).alias("bars_here"),
        F.min(F.when(F.col("usable"), F.col("_first"))).alias("first_day"),
        F.sort_array(F.collect_list(F.when(F.col("usable"), bar))).alias("tail"),
    )
    tails = F.flatten(F.collect_list("tail").over(_history()))
    starts = eras.select(*ERA, "first_day", _bars_before().alias("bars_before"), tails.alias("context"))
    if state is not None:
        kept = F.transform("tail", lambda b: F.struct(b["trade_date"].alias("trade_date"), *[b[v].alias(v) for v in values]))
        earlier = state.select("symbol", F.col("n").alias("_n"), kept.alias("_tail"))
        starts = starts.join(earlier, "symbol", "left").select(
            *ERA, "first_day",
            (F.col("bars_before") + F.coalesce("_n", F.lit(0))).alias("bars_before"),
            F.concat(F.coalesce("_tail", F.array().cast(eras.schema["tail"].dataType)), "context").alias("context"),
        )
    starts = starts.withColumn("context", last_of(F.col("context"), lookback))
    own = F.array(bar)
    opens = F.col("usable") & (F.col("trade_date") == F.col("first_day"))
    rows = F.when(opens, F.concat("context", own)).otherwise(own)
    return (
        placed.join(_hashed(starts), ERA)
        .select(
            *ERA,
            "usable",
            "first_day",
            (F.col("bars_before") - F.size("context")).alias("bars_before"),
            F.explode(rows).alias("bar"),
        )
        .select(*ERA, "usable", "first_day", "bars_before", "bar.*")
        .withColumn("block", _block())
        .select(
            *ERA,
            "usable",
            "block",
            "trade_date",
            *values,
            F.when(F.col("usable"), F.col("bars_before") + F.row_number().over(in_era())).cast("int").alias("n"),
            (F.col("usable") & (F.col("trade_date") < F.col("first_day"))).alias("is_context"),
        )
    )


def _numbered(placed: DataFrame, values: Sequence[str]) -> DataFrame:
    """``in_order`` without context: the bars of earlier eras are counted, none is carried over or sorted for it."""
    eras = placed.groupBy(*ERA).agg(F.count_if("usable").alias("bars_here"))
    starts = eras.select(*ERA, _bars_before().alias("bars_before"))
    return placed.join(_hashed(starts), ERA).select(
        *ERA,
        "usable",
        "block",
        "trade_date",
        *values,
        F.when(F.col("usable"), F.col("bars_before") + F.row_number().over(in_era())).cast("int").alias("n"),
        F.lit(False).alias("is_context"),
    )


def _history() -> Window:
    return Window.partitionBy("symbol").orderBy("era").rowsBetween(Window.unboundedPreceding, -1)


def _bars_before() -> Column:
    return F.coalesce(F.sum("bars_here").over(_history()), F.lit(0))


def _hashed(starts: DataFrame) -> DataFrame:
    """One row an era, so hashed in each task; left to its estimates Spark may sort the bars for the join or broadcast them."""
    return starts.hint("shuffle_hash")


def last_of(array: Column, k: int) -> Column:
    """The last ``k`` items of an array, or all of a shorter one."""
    return F.slice(array, F.greatest(F.size(array) - k + 1, F.lit(1)), k)
