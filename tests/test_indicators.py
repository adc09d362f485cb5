from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.functions.scan import ema, smooth, wilder
from tickloom.functions.series import in_order

SCHEMA = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"


def make_bars(spark, series: dict[str, list[tuple[date, float]]]):
    rows = [
        (symbol, day, close, close * 1.05, close * 0.97, close, 10)
        for symbol, points in series.items()
        for day, close in points
    ]
    return spark.createDataFrame(rows, SCHEMA)


def daily(first: date, closes, step: int = 1):
    return [(first + timedelta(days=i * step), float(c)) for i, c in enumerate(closes)]


def seeded_mean(x: pd.Series, length: int, gain: float) -> pd.Series:
    """The definition, one value after the other."""
    values = x.to_numpy(float)
    known = np.flatnonzero(~np.isnan(values))
    y = np.full(len(values), np.nan)
    if len(known) < length:
        return pd.Series(y)
    at = known[length - 1]
    y[at] = values[known[:length]].mean()
    for i in known[length:]:
        y[i] = gain * values[i] + (1 - gain) * y[at]
        at = i
    return pd.Series(y)


def expected(pdf: pd.DataFrame) -> pd.DataFrame:
    c, h, lo = pdf.Close, pdf.High, pdf.Low
    out = pd.DataFrame()
    out["SMA_20"] = c.rolling(20).mean()
    out["EMA_20"] = seeded_mean(c, 20, 2 / 21)
    spread = 2 * c.rolling(20).std(ddof=0)
    out["BB_upper"], out["BB_middle"], out["BB_lower"] = out.SMA_20 + spread, out.SMA_20, out.SMA_20 - spread
    out["MACD"] = seeded_mean(c, 12, 2 / 13) - seeded_mean(c, 26, 2 / 27)
    out["MACD_signal"] = seeded_mean(out.MACD, 9, 0.2)
    out["MACD_hist"] = out.MACD - out.MACD_signal
    low, high = lo.rolling(14).min(), h.rolling(14).max()
    raw = 100 * (c - low) / (high - low).replace(0.0, np.nan)
    out["STOCH_k"] = raw.rolling(3).mean()
    out["STOCH_d"] = out.STOCH_k.rolling(3).mean()
    before = c.shift()
    reach = pd.concat([h - lo, (h - before).abs(), (lo - before).abs()], axis=1).max(axis=1)
    out["ATR"] = seeded_mean(reach.where(before.notna()), 14, 1 / 14)
    up = seeded_mean((c - before).clip(lower=0), 14, 1 / 14)
    down = seeded_mean((before - c).clip(lower=0), 14, 1 / 14)
    out["RSI_14"] = 100 * up / (up + down).replace(0.0, np.nan)
    return out


def test_indicator_table_equals_the_definitions(spark):
    rng = np.random.default_rng(7)

    def walk(n):
        return 100 + np.abs(np.cumsum(rng.normal(0, 3, n)))

    series = {
        "LONG": daily(date(1988, 11, 3), walk(900), step=9),  # four decades
        "EDGE": daily(date(1999, 12, 1), walk(120)),  # context reaches over a decade's end
        "SPARSE": daily(date(1975, 1, 1), walk(60), step=400),  # few bars in each decade
        "FLAT": daily(date(2000, 1, 1), [50.0] * 60),
        "SHORT": daily(date(2001, 1, 1), walk(10)),
        "ONE": daily(date(2001, 1, 1), [5.0]),
    }
    table = ind.indicator_table(make_bars(spark, series))
    assert table.columns == ["symbol", *ind.INDICATOR_COLUMNS]
    got = table.toPandas().sort_values(["symbol", "Date"])
    assert len(got) == sum(len(points) for points in series.values())
    for symbol, pdf in got.groupby("symbol"):
        pdf = pdf.reset_index(drop=True)
        want = expected(pdf)
        for column in want:
            np.testing.assert_allclose(
                pdf[column].to_numpy(float), want[column].to_numpy(float), rtol=1e-9, atol=1e-8,
                err_msg=f"{symbol} {column}",
            )


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.floats(0.01, 1e5), min_size=0, max_size=150), min_size=1, max_size=6
    ),
    st.integers(2, 30),
    st.sampled_from([1, 7, 40]),
)
def test_scan_equals_the_recursion(spark, closes, length, step):
    series = {f"S{i}": daily(date(1989, 6, 1), c, step) for i, c in enumerate(closes)}
    rows = in_order(make_bars(spark, series), ["close"])
    out = smooth(rows, [ema("e", F.col("close"), length), wilder("w", F.col("close"), length)])
    got = out.toPandas()
    for i, c in enumerate(closes):
        mine = got[got.symbol == f"S{i}"].sort_values("trade_date")
        for name, gain in (("e", 2 / (length + 1)), ("w", 1 / length)):
            want = seeded_mean(pd.Series(c, dtype=float), length, gain)
            np.testing.assert_allclose(mine[name].to_numpy(float), want.to_numpy(), rtol=1e-9)


def test_one_symbol_with_a_third_of_all_bars_is_split(spark):
    hot = daily(date(1900, 1, 1), range(1, 3001), step=10)
    cold = {f"C{i}": daily(date(2000, 1, 1), range(1, 61)) for i in range(100)}
    rows = in_order(make_bars(spark, {"HOT": hot, **cold}), ["close"], 4)
    groups = rows.where("not is_context").groupBy("symbol", "era").count().toPandas()
    assert groups[groups.symbol == "HOT"]["count"].max() <= 366
    assert groups["count"].sum() == 3000 + 100 * 60
    numbers = rows.where("not is_context and symbol = 'HOT'").orderBy("trade_date").toPandas()
    assert numbers.n.tolist() == list(range(1, 3001))


def test_context_rows_come_from_all_earlier_decades(spark):
    points = daily(date(1958, 1, 1), range(1, 9), step=3650)
    rows = in_order(make_bars(spark, {"S": points}), ["close"], 3).toPandas()
    last = rows[rows.era == rows.era.max()]
    own = int((~last.is_context).sum())
    assert last.is_context.sum() == 3
    assert sorted(last.close) == [float(v) for v in range(8 - own - 2, 9)]


def test_rows_with_missing_values_enter_no_average_but_stay(spark):
    bars = make_bars(spark, {"S": daily(date(2000, 1, 1), range(1, 31))})
    day = F.dayofmonth("trade_date")
    price = F.when(day == 6, F.lit(float("nan"))).when(day != 5, F.col("close"))
    got = ind.sma(bars.withColumn("close", price), 20).toPandas()
    assert len(got) == 30
    assert got.sma_20.notna().sum() == 9


def test_no_bars(spark):
    assert ind.indicator_table(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signals_are_null_until_defined(spark):
    bars = make_bars(spark, {"UP": daily(date(2000, 1, 1), range(1, 41))})
    got = ind.signals(bars).orderBy("trade_date").toPandas()
    assert got.is_overbought.isna().sum() == 14
    assert got.is_overbought.iloc[14] and not got.is_oversold.iloc[14]
    assert got.is_rising.isna().sum() == 33


def test_smoothers_need_a_gain_below_one(spark):
    rows = in_order(make_bars(spark, {"S": daily(date(2000, 1, 1), [1.0])}), ["close"])
    with pytest.raises(ValueError):
        smooth(rows, [ema("e", F.col("close"), 1)])


def test_bars_are_shuffled_once(spark):
    bars = make_bars(spark, {"S": daily(date(2000, 1, 1), range(50))})
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan, average, series = (
            table(bars)._jdf.queryExecution().executedPlan().toString()
            for table in (ind.indicator_table, ind.exponential_average, ind.numbered_series)
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    moved = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(moved) == 3
    assert sum("ReusedExchange" not in line for line in moved) == 1
    for other in (average, series):
        shuffled = [line for line in other.splitlines() if "REPARTITION_BY_COL" in line]
        assert sum("ReusedExchange" not in line for line in shuffled) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bars_with_missing_prices_are_kept(spark):
    days = [date(2000, 1, 1) + timedelta(days=i) for i in range(40)]
    bars = [("A", d, 1.0, 2.0, 1.0, float(i % 7 + 1) if i != 30 else None, 5 if i != 25 else None) for i, d in enumerate(days)]
    bars.append((None, days[0], 1.0, 1.0, 1.0, 1.0, 1))
    df = spark.createDataFrame(bars, "symbol string, trade_date date, open double, high double, low double, close double, volume bigint")
    table = {r.Date: r for r in ind.indicator_table(df).collect()}
    ema = {r.trade_date: r.ema_20 for r in ind.exponential_average(df).collect()}
    assert len(table) == 40 and table[days[30]].EMA_20 is None and table[days[25]].Volume is None
    assert {d: r.EMA_20 for d, r in table.items()} == pytest.approx(ema)
    series = ind.numbered_series(df).collect()
    assert [r.bar_number for r in sorted(series, key=lambda r: r.trade_date)] == list(range(1, 41))
