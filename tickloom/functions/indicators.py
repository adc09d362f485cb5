"""Technical indicators over daily bars, all symbols at once.

Definitions: simple and exponential moving averages with a mean seed, Bollinger
bands with the population deviation, MACD after Appel, the slow stochastic
after Lane, average true range and relative strength after Wilder. Every
indicator is computed over a symbol's full history and is NULL while its
look-back is not yet filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scan import Smoother, ema, smooth, wilder
from tickloom.functions.series import ERA, in_era, in_order
from tickloom.schemas import OHLCV

# The indicator table's column names and order.
INDICATOR_COLUMNS = [
    "Date", "Open", "High", "Low", "Close", "Volume", "SMA_20", "EMA_20", "BB_upper",
    "BB_middle", "BB_lower", "MACD", "MACD_signal", "MACD_hist", "STOCH_k", "STOCH_d", "ATR", "RSI_14",
]

# Look-backs of the indicator table.
SMA_LENGTH = 20
SMA_LONG_LENGTH = 50
EMA_LENGTH = 20
BAND_LENGTH, BAND_WIDTH = 20, 2.0
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
STOCH_K, STOCH_D, STOCH_SMOOTH = 14, 3, 3
WILDER_LENGTH = 14

KEY = ["symbol", "trade_date"]
_READ = ["high", "low", "close"]


def _over_last(aggregate, column: str, length: int) -> Column:
    """An aggregate of a price over the last ``length`` bars, NULL before there are as many."""
    frame = in_era().rowsBetween(-(length - 1), 0)
    return F.when(F.col("n") >= length, aggregate(column).over(frame))


def _mean_of_last(column: str, length: int) -> Column:
    """The mean of a derived column, NULL unless all of its last ``length`` values exist."""
    frame = in_era().rowsBetween(-(length - 1), 0)
    return F.when(F.count(column).over(frame) == length, F.avg(column).over(frame))


def _previous(column: str) -> Column:
    return F.lag(column).over(in_era())


def _own(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.where(~F.col("is_context")).select(*KEY, *columns)


# -- columns ---------------------------------------------------------------


def sma_column(length: int) -> Column:
    return _over_last(F.avg, "close", length)


def _with_bands(rows: DataFrame, length: int = BAND_LENGTH, width: float = BAND_WIDTH, middle: str | None = None) -> DataFrame:
    """Bollinger bands; ``middle`` is a column that holds the average already.

    Each frame is run once: a window expression that is written several times is computed as often.
    """
    found = {"bb_middle": F.col(middle) if middle else sma_column(length)}
    return (
        rows.withColumns({**found, "_spread": _over_last(F.stddev_pop, "close", length) * width})
        .withColumns({"bb_upper": F.col("bb_middle") + F.col("_spread"), "bb_lower": F.col("bb_middle") - F.col("_spread")})
        .drop("_spread")
    )


def _with_stochastic(rows: DataFrame, k: int, d: int, smooth_k: int) -> DataFrame:
    low = _over_last(F.min, "low", k)
    high = _over_last(F.max, "high", k)
    return (
        rows.withColumns({"_low": low, "_high": high})
        .withColumn(
            "_raw_k",
            100 * (F.col("close") - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)),
        )
        .withColumn("stoch_k", _mean_of_last("_raw_k", smooth_k))
        .withColumn("stoch_d", _mean_of_last("stoch_k", d))
        .drop("_low", "_high", "_raw_k")
    )


def _with_moves(rows: DataFrame) -> DataFrame:
    """True range, gain and loss against the close before; NULL on the first bar."""
    with_previous = rows.withColumn("_before", _previous("close"))
    change = F.col("close") - F.col("_before")
    moves = {"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0))}
    if {"high", "low"} <= set(rows.columns):
        # greatest() skips NULLs, so the first bar must be left out explicitly.
        reach = F.greatest(
            F.col("high") - F.col("low"),
            F.abs(F.col("high") - F.col("_before")),
            F.abs(F.col("low") - F.col("_before")),
        )
        moves["_true_range"] = F.when(F.col("_before").isNotNull(), reach)
    # greatest(NULL, 0) is 0: the first bar adds nothing, and its weight is 0 too.
    return with_previous.withColumns(moves).drop("_before")


def _macd_smoothers(fast: int, slow: int, signal: int) -> list:
    quick = ema("_fast", F.col("close"), fast)
    lazy = ema("_slow", F.col("close"), slow)
    line = ema("macd_signal", {quick: 1.0, lazy: -1.0}, signal, first=lazy.defined_from)
    return [quick, lazy, line]


def _macd_columns() -> dict[str, Column]:
    line = F.col("_fast") - F.col("_slow")
    return {"macd": line, "macd_hist": line - F.col("macd_signal")}


def _rsi_smoothers(length: int) -> list:
    return [
        wilder("_up", F.col("_gain"), length, first=2),
        wilder("_down", F.col("_loss"), length, first=2),
    ]


def _rsi_column() -> Column:
    up, down = F.col("_up"), F.col("_down")
    return 100 * up / F.nullif(up + down, F.lit(0.0))


# -- tables ----------------------------------------------------------------


def sma(bars: DataFrame, *lengths: int) -> DataFrame:
    rows = in_order(bars, ["close"], max(lengths) - 1)
    columns = {f"sma_{length}": sma_column(length) for length in lengths}
    return _own(rows.withColumns(columns), "close", *columns)


def exponential_average(bars: DataFrame, length: int = EMA_LENGTH) -> DataFrame:
    rows = in_order(bars, ["close"])
    name = f"ema_{length}"
    return smooth(rows, [ema(name, F.col("close"), length)]).select(*KEY, "close", name)


def bollinger(bars: DataFrame, length: int = BAND_LENGTH, width: float = BAND_WIDTH) -> DataFrame:
    rows = _with_bands(in_order(bars, ["close"], length - 1), length, width)
    return _own(rows, "close", "bb_upper", "bb_middle", "bb_lower")


def macd(
    bars: DataFrame, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL
) -> DataFrame:
    rows = smooth(in_order(bars, ["close"]), _macd_smoothers(fast, slow, signal))
    return rows.withColumns(_macd_columns()).select(*KEY, "close", "macd", "macd_signal", "macd_hist")


def stochastic(
    bars: DataFrame, k: int = STOCH_K, d: int = STOCH_D, smooth_k: int = STOCH_SMOOTH
) -> DataFrame:
    rows = in_order(bars, ["high", "low", "close"], k + d + smooth_k - 3)
    return _own(_with_stochastic(rows, k, d, smooth_k), "close", "stoch_k", "stoch_d")


def average_true_range(bars: DataFrame, length: int = WILDER_LENGTH) -> DataFrame:
    rows = _with_moves(in_order(bars, ["high", "low", "close"], 1))
    return smooth(rows, [wilder("atr", F.col("_true_range"), length, first=2)]).select(*KEY, "close", "atr")


def relative_strength(bars: DataFrame, length: int = WILDER_LENGTH) -> DataFrame:
    rows = _with_moves(in_order(bars, ["close"], 1))
    name = f"rsi_{length}"
    return smooth(rows, _rsi_smoothers(length)).withColumn(name, _rsi_column()).select(*KEY, "close", name)


TABLE_LOOKBACK = max(SMA_LENGTH, BAND_LENGTH, STOCH_K + STOCH_D + STOCH_SMOOTH - 2) - 1
def table_smoothers() -> list[Smoother]:
    return [
        ema("ema_20", F.col("close"), EMA_LENGTH),
        wilder("atr", F.col("_true_range"), WILDER_LENGTH, first=2),
        *_rsi_smoothers(WILDER_LENGTH),
        *_macd_smoothers(MACD_FAST, MACD_SLOW, MACD_SIGNAL),
    ]


def indicator_rows(bars: DataFrame, state: DataFrame | None = None, keep_states: bool = False) -> DataFrame:
    """The columns of ``indicator_table`` under their own names, with ``usable`` and ``n``.

    ``state`` (symbol, n, tail, carry) continues series whose earlier bars are
    not in ``bars``; ``keep_states`` adds ``carry``, the smoothing states after
    each bar, and ``in_tail``, which is true for the last usable bars of a year,
    as many as the indicators look back on, and NULL or false for others.
    """
    rows = in_order(bars, OHLCV, TABLE_LOOKBACK, _READ, state)
    if keep_states:
        # Marked here, where the bars lie in order, so that the others need not be moved or sorted to find these.
        ahead = F.lead(F.year("trade_date"), TABLE_LOOKBACK).over(in_era())
        last = F.coalesce(F.col("_ahead") != F.year("trade_date"), F.lit(True))
        rows = rows.withColumn("_ahead", ahead).withColumn("in_tail", F.when(F.col("usable"), last)).drop("_ahead")
    rows = rows.withColumn("sma_20", sma_column(SMA_LENGTH))
    rows = _with_bands(rows, middle="sma_20" if SMA_LENGTH == BAND_LENGTH else None)
    rows = _with_moves(_with_stochastic(rows, STOCH_K, STOCH_D, STOCH_SMOOTH))
    table = smooth(rows, table_smoothers(), state, keep_states)
    return table.withColumns({**_macd_columns(), "rsi_14": _rsi_column()})


def named_table(rows: DataFrame, *more: str) -> DataFrame:
    """Symbol, the indicator table's columns and any ``more``, from ``indicator_rows``."""
    named = {"Date": "trade_date"}
    return rows.select("symbol", *[F.col(named.get(c, c.lower())).alias(c) for c in INDICATOR_COLUMNS], *more)


def indicator_table(bars: DataFrame) -> DataFrame:
    """Symbol plus the 18 indicator columns, a row for every bar, from one shuffle of the bars.

    Indicators read high, low and close. A bar without one of these enters none
    of them and has NULL indicators; a missing open or volume does not matter.
    """
    return named_table(indicator_rows(bars))


def rolling_extremes(bars: DataFrame, length: int) -> DataFrame:
    """The lowest low and the highest high of the last ``length`` bars, NULL before there are as many.

    Constant work a row, however long the frame: bars are cut into blocks of
    ``length``, and a frame is the end of one block and the start of the next.
    So its extreme is that of two running ones, from the block's end backwards
    and from its start onwards. A sliding frame would hold ``length`` bars at
    every row.
    """
    rows = in_order(bars, ["high", "low"], length - 1)
    rows = rows.withColumn("_place", F.row_number().over(in_era()) - 1)
    rows = rows.withColumn("_part", F.floor(F.col("_place") / length))
    block = Window.partitionBy(*ERA, "usable", "_part")
    running = {"low": F.min, "high": F.max}
    ends = {"_back": block.orderBy(F.desc("_place")), "_on": block.orderBy("_place")}
    for way, order in ends.items():
        frame = order.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumns({f"{way}_{c}": f(c).over(frame) for c, f in running.items()})
    combined = {"low": F.least, "high": F.greatest}
    # The order of in_era(), in the terms of the running extremes: the rows are not sorted once more.
    in_place = Window.partitionBy(*ERA, "usable").orderBy("_part", "_place")
    opened = {c: F.lag(f"_back_{c}", length - 1).over(in_place) if length > 1 else F.col(f"_back_{c}") for c in running}
    columns = {f"{c}_{length}": F.when(F.col("n") >= length, f(opened[c], F.col(f"_on_{c}"))) for c, f in combined.items()}
    return _own(rows.withColumns(columns), "low", "high", *columns)


def signals(bars: DataFrame, overbought: float = 70.0, oversold: float = 30.0) -> DataFrame:
    """RSI thresholds and the sign of the MACD histogram as flags, a row for every bar; NULL in, NULL out."""
    rows = _with_moves(in_order(bars, ["close"], 1))
    smoothers = [
        *_rsi_smoothers(WILDER_LENGTH),
        *_macd_smoothers(MACD_FAST, MACD_SLOW, MACD_SIGNAL),
    ]
    table = smooth(rows, smoothers).withColumns({**_macd_columns(), "rsi_14": _rsi_column()})
    return table.select(
        *KEY,
        "rsi_14",
        "macd_hist",
        (F.col("rsi_14") > overbought).alias("is_overbought"),
        (F.col("rsi_14") < oversold).alias("is_oversold"),
        (F.col("macd_hist") > 0).alias("is_rising"),
    )


def numbered_series(bars: DataFrame) -> DataFrame:
    """Every dated bar with its place in the symbol's series, counted from 1.

    A bar counts whether or not it has prices. Rows are sorted within partitions.
    """
    rows = in_order(bars, ["close"], needed=[]).where(~F.col("is_context"))
    return rows.select(*KEY, "close", F.col("n").alias("bar_number")).sortWithinPartitions(*KEY)
