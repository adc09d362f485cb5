"""Ordered per-symbol analytics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.plans.explore import explore
from tickloom.plans.indicator_store import IndicatorStore, refresh
from tickloom.sources import tables as t
from tickloom.workload import fixtures as fx
from tickloom.workload.registry import query
from tickloom.workload.relational import CHOSEN, CHOSEN_SQL, FIRST_DAY
from tickloom.workload.tables import new_namespace, price_table


def rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Four decimals, by the arithmetic DuckDB's ``round`` uses, so that ties agree."""
    return df.withColumns({c: F.round(F.col(c) * 10_000) / 10_000 for c in columns})


def _frame(length: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW)"


def full(aggregate: str, column: str, length: int) -> str:
    """A row-frame aggregate, NULL unless the frame holds ``length`` values."""
    over = _frame(length)
    return f"CASE WHEN count({column}) {over} = {length} THEN {aggregate}({column}) {over} END"


BY_DATE = "OVER (PARTITION BY symbol ORDER BY trade_date)"


def series_ctes(source: str = "bars") -> dict[str, str]:
    """Bars numbered per symbol, with the true range, gain and loss of each."""
    return {
        "numbered": f"""
            SELECT *, row_number() {BY_DATE} AS n, lag(close) {BY_DATE} AS before FROM {source}""",
        "moves": """
            SELECT symbol, trade_date, n, close,
                   CASE WHEN before IS NOT NULL
                        THEN greatest(high - low, abs(high - before), abs(low - before)) END AS true_range,
                   greatest(close - before, 0.0) AS gain, greatest(before - close, 0.0) AS loss
            FROM numbered""",
    }


def mean_cte(name: str, source: str, column: str, length: int, gain: float, first: int = 1) -> dict[str, str]:
    """Seeded recursive mean: y(n) for every n from ``first + length - 1``."""
    last = first + length - 1
    return {
        name: f"""
            SELECT symbol, CAST({last} AS bigint) AS n, avg({column}) AS y FROM {source}
            WHERE n BETWEEN {first} AND {last} GROUP BY symbol HAVING count({column}) = {length}
            UNION ALL
            SELECT s.symbol, s.n, CAST({gain!r} AS double) * s.{column} + CAST({1 - gain!r} AS double) * e.y
            FROM {name} AS e JOIN {source} AS s ON s.symbol = e.symbol AND s.n = e.n + 1"""
    }


def macd_ctes() -> dict[str, str]:
    return {
        **mean_cte("fast", "numbered", "close", 12, 2 / 13),
        **mean_cte("slow", "numbered", "close", 26, 2 / 27),
        "line": """
            SELECT f.symbol, f.n, f.y - s.y AS macd FROM fast AS f
            JOIN slow AS s ON f.symbol = s.symbol AND f.n = s.n""",
        **mean_cte("signal", "line", "macd", 9, 2 / 10, first=26),
    }


def rsi_ctes() -> dict[str, str]:
    return {
        **mean_cte("up", "moves", "gain", 14, 1 / 14, first=2),
        **mean_cte("down", "moves", "loss", 14, 1 / 14, first=2),
    }


def joined(base: str, *means: str) -> str:
    return base + "".join(
        f" LEFT JOIN {m} ON {m}.symbol = b.symbol AND {m}.n = b.n" for m in means
    )


RSI = "100 * up.y / nullif(up.y + down.y, 0.0)"
HISTOGRAM = "line.macd - signal.y"

STOCH_CTES = {
    "extremes": f"""
        SELECT symbol, trade_date, n, close, {full('min', 'low', 14)} AS low14,
               {full('max', 'high', 14)} AS high14 FROM numbered""",
    "raw_k": """
        SELECT symbol, trade_date, n, close,
               100 * (close - low14) / nullif(high14 - low14, 0.0) AS raw_k FROM extremes""",
    "slow_k": f"SELECT symbol, trade_date, n, close, {full('avg', 'raw_k', 3)} AS stoch_k FROM raw_k",
    "stoch": f"SELECT symbol, trade_date, n, close, stoch_k, {full('avg', 'stoch_k', 3)} AS stoch_d FROM slow_k",
}


@query(
    "ind_sma",
    f"""SELECT symbol, trade_date, close, round({full('avg', 'close', 20)}, 4) AS sma_20,
               round({full('avg', 'close', 50)}, 4) AS sma_50 FROM bars""",
)
def ind_sma(spark, sf):
    return rounded(ind.sma(fx.bars(spark, sf), 20, 50), ["sma_20", "sma_50"])


@query(
    "ind_ema",
    joined(
        """SELECT p.symbol, p.trade_date, p.close, round(e.y, 4) AS ema_20 FROM patchy_bars AS p
           LEFT JOIN numbered AS b ON p.symbol = b.symbol AND p.trade_date = b.trade_date""",
        "e",
    ),
    **series_ctes("whole_bars"),
    **mean_cte("e", "numbered", "close", 20, 2 / 21),
)
def ind_ema(spark, sf):
    return rounded(ind.exponential_average(fx.patchy_bars(spark, sf)), ["ema_20"])


BAND_MIDDLE = full("avg", "close", 20)
BAND_SPREAD = f"2 * {full('stddev_pop', 'close', 20)}".replace("2 * CASE", "2 * (CASE") + ")"


@query(
    "ind_bbands",
    f"""SELECT symbol, trade_date, close, round(middle + spread, 4) AS bb_upper,
               round(middle, 4) AS bb_middle, round(middle - spread, 4) AS bb_lower
        FROM (SELECT *, {BAND_MIDDLE} AS middle, {BAND_SPREAD} AS spread FROM bars) AS t""",
)
def ind_bbands(spark, sf):
    return rounded(ind.bollinger(fx.bars(spark, sf)), ["bb_upper", "bb_middle", "bb_lower"])


@query(
    "ind_macd",
    joined(
        f"""SELECT b.symbol, b.trade_date, b.close, round(line.macd, 4) AS macd,
                   round(signal.y, 4) AS macd_signal, round({HISTOGRAM}, 4) AS macd_hist
            FROM numbered AS b""",
        "line",
        "signal",
    ),
    **series_ctes(),
    **macd_ctes(),
)
def ind_macd(spark, sf):
    return rounded(ind.macd(fx.bars(spark, sf)), ["macd", "macd_signal", "macd_hist"])


@query(
    "ind_stoch",
    """SELECT symbol, trade_date, close, round(stoch_k, 4) AS stoch_k, round(stoch_d, 4) AS stoch_d
       FROM stoch""",
    **series_ctes(),
    **STOCH_CTES,
)
def ind_stoch(spark, sf):
    return rounded(ind.stochastic(fx.bars(spark, sf)), ["stoch_k", "stoch_d"])


@query(
    "ind_atr",
    joined("SELECT b.symbol, b.trade_date, b.close, round(e.y, 4) AS atr FROM moves AS b", "e"),
    **series_ctes(),
    **mean_cte("e", "moves", "true_range", 14, 1 / 14, first=2),
)
def ind_atr(spark, sf):
    return rounded(ind.average_true_range(fx.bars(spark, sf)), ["atr"])


@query(
    "ind_rsi",
    joined(
        f"SELECT b.symbol, b.trade_date, b.close, round({RSI}, 4) AS rsi_14 FROM moves AS b", "up", "down"
    ),
    **series_ctes(),
    **rsi_ctes(),
)
def ind_rsi(spark, sf):
    return rounded(ind.relative_strength(fx.bars(spark, sf)), ["rsi_14"])


@query(
    "rolling_extremes",
    f"""SELECT p.symbol, p.trade_date, p.low, p.high, w.low_250, w.high_250 FROM holed AS p LEFT JOIN (
          SELECT symbol, trade_date, {full('min', 'low', 250)} AS low_250, {full('max', 'high', 250)} AS high_250
          FROM holed WHERE high IS NOT NULL) AS w ON p.symbol = w.symbol AND p.trade_date = w.trade_date""",
    holed="SELECT symbol, trade_date, low, CASE WHEN volume % 23 <> 0 THEN high END AS high FROM bars",
)
def rolling_extremes(spark, sf):
    holed = fx.bars(spark, sf).withColumn("high", F.when(F.col("volume") % 23 != 0, F.col("high")))
    return ind.rolling_extremes(holed, 250)


BUNDLE_SQL = joined(
    f"""SELECT p.symbol, p.trade_date AS "Date", p.open AS "Open", p.high AS "High", p.low AS "Low",
               p.close AS "Close", p.volume AS "Volume", round(f.sma, 4) AS "SMA_20",
               round(ema.y, 4) AS "EMA_20", round(f.sma + f.spread, 4) AS "BB_upper",
               round(f.sma, 4) AS "BB_middle", round(f.sma - f.spread, 4) AS "BB_lower",
               round(line.macd, 4) AS "MACD", round(signal.y, 4) AS "MACD_signal",
               round({HISTOGRAM}, 4) AS "MACD_hist", round(stoch.stoch_k, 4) AS "STOCH_k",
               round(stoch.stoch_d, 4) AS "STOCH_d", round(atr.y, 4) AS "ATR",
               round({RSI}, 4) AS "RSI_14"
        FROM patchy_bars AS p
        LEFT JOIN numbered AS b ON p.symbol = b.symbol AND p.trade_date = b.trade_date
        LEFT JOIN frames AS f ON f.symbol = b.symbol AND f.n = b.n""",
    "ema",
    "line",
    "signal",
    "stoch",
    "atr",
    "up",
    "down",
)
BUNDLE_CTES = {
    **series_ctes("whole_bars"),
    "frames": f"SELECT symbol, n, {BAND_MIDDLE} AS sma, {BAND_SPREAD} AS spread FROM numbered",
    **mean_cte("ema", "numbered", "close", 20, 2 / 21),
    **macd_ctes(),
    **STOCH_CTES,
    **mean_cte("atr", "moves", "true_range", 14, 1 / 14, first=2),
    **rsi_ctes(),
}


@query("indicator_bundle", BUNDLE_SQL, **BUNDLE_CTES)
def indicator_bundle(spark, sf):
    return rounded(ind.indicator_table(fx.patchy_bars(spark, sf)), ind.INDICATOR_COLUMNS[6:])


@query("indicator_increment", BUNDLE_SQL, **BUNDLE_CTES)
def indicator_increment(spark, sf):
    """The stored table after history, one more year, and late bars of an earlier one."""
    bars = fx.patchy_bars(spark, sf)
    late = (F.year("trade_date") == fx.STORED_BEFORE.year - 1) & F.col("symbol").endswith("3")
    recent = F.col("trade_date") >= F.lit(fx.STORED_BEFORE)
    prices = price_table(spark, bars.where(~recent & ~late))
    store = IndicatorStore(spark, new_namespace(spark)).create()
    refresh(store, prices)
    for batch, first in ((recent, fx.STORED_BEFORE), (late, date(fx.STORED_BEFORE.year - 1, 1, 1))):
        t.append(t.by_month(bars.where(batch)), prices)
        refresh(store, prices, first)
    return rounded(store.indicators(), ind.INDICATOR_COLUMNS[6:])


SIGNALS = f"""round({RSI}, 4) AS rsi_14, round({HISTOGRAM}, 4) AS macd_hist, {RSI} > 70 AS is_overbought,
              {RSI} < 30 AS is_oversold, {HISTOGRAM} > 0 AS is_rising"""


@query(
    "indicator_signals",
    joined(
        f"""SELECT p.symbol, p.trade_date, {SIGNALS} FROM patchy_bars AS p
            LEFT JOIN numbered AS b ON p.symbol = b.symbol AND p.trade_date = b.trade_date""",
        "line", "signal", "up", "down",
    ),
    **series_ctes("whole_bars"),
    **macd_ctes(),
    **rsi_ctes(),
)
def indicator_signals(spark, sf):
    return rounded(ind.signals(fx.patchy_bars(spark, sf)), ["rsi_14", "macd_hist"])


@query(
    "explore_summary",
    """SELECT c.symbol, c.row_count, c.null_rows, c.first_day, c.last_day, c.min_close, c.max_close,
              c.avg_close, c.close_count, l.rsi_14, l.macd_hist, l.is_overbought, l.is_oversold, l.is_rising
       FROM counts AS c LEFT JOIN latest AS l ON c.symbol = l.symbol""",
    chosen=f"SELECT * FROM patchy_bars WHERE symbol IN {CHOSEN_SQL}",
    recent="SELECT * FROM chosen WHERE trade_date >= DATE '1998-01-01' AND close IS NOT NULL",
    **series_ctes("recent"),
    **macd_ctes(),
    **rsi_ctes(),
    counts="""SELECT symbol, CAST(count(*) AS bigint) AS row_count,
                     CAST(count(*) FILTER (WHERE volume IS NULL OR close IS NULL) AS bigint) AS null_rows,
                     min(trade_date) AS first_day, max(trade_date) AS last_day, min(close) AS min_close,
                     max(close) AS max_close, round(avg(close), 4) AS avg_close,
                     CAST(count(close) AS bigint) AS close_count FROM chosen GROUP BY symbol""",
    latest=joined(
        f"""SELECT z.symbol, {SIGNALS} FROM (SELECT symbol, max(trade_date) AS trade_date FROM chosen GROUP BY symbol) AS z
            LEFT JOIN numbered AS b ON z.symbol = b.symbol AND z.trade_date = b.trade_date""",
        "line", "signal", "up", "down",
    ),
)
def explore_summary(spark, sf):
    summary = explore(fx.patchy_bars(spark, sf), CHOSEN, FIRST_DAY)
    return rounded(summary, ["avg_close", "rsi_14", "macd_hist"])
