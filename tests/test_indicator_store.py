"""The stored indicator table against the whole computation."""

from __future__ import annotations

import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_indicators import daily, make_bars

from tickloom.functions import indicators as ind
from tickloom.plans import indicator_store
from tickloom.plans.indicator_store import IndicatorStore, refresh
from tickloom.sources import tables as t
from tickloom.workload.tables import new_namespace, price_table


def _scans(df) -> list[str]:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?:FileScan|Scan) parquet", plan.split("Initial Plan")[0])


def _bars(spark):
    rng = np.random.default_rng(3)

    def walk(n):
        return 100 + np.abs(np.cumsum(rng.normal(0, 3, n)))

    bars = make_bars(spark, {
        "OLD": daily(date(1996, 1, 2), walk(700), step=3),
        "GAP": daily(date(1996, 5, 2), walk(60), step=2) + daily(date(2000, 2, 1), walk(90), step=4),
        "NEW": daily(date(2000, 12, 20), walk(60)),
        "RARE": daily(date(1990, 1, 1), walk(50), step=90),
        "ONE": daily(date(2001, 1, 5), [5.0]),
    })
    # Some bars lack a price, among them the last ones of a year.
    odd = (F.dayofyear("trade_date") % 11 == 0) | ((F.month("trade_date") == 12) & (F.dayofmonth("trade_date") > 28))
    return bars.withColumn("close", F.when(~odd, F.col("close")))


@pytest.fixture(scope="module")
def prices(spark):
    return price_table(spark, _bars(spark))


def _same(got, want):
    got, want = (df.toPandas().sort_values(["symbol", "Date"]).reset_index(drop=True) for df in (got, want))
    assert len(got) == len(want) and list(got.symbol) == list(want.symbol) and list(got.Date) == list(want.Date)
    for column in ind.INDICATOR_COLUMNS[1:]:
        np.testing.assert_allclose(
            got[column].to_numpy(float), want[column].to_numpy(float), rtol=1e-9, atol=1e-8, err_msg=column
        )


@pytest.mark.parametrize("cuts", [[date(2000, 1, 1)], [date(1997, 3, 5), date(1999, 6, 1), date(2001, 1, 1)]])
def test_resumed_equals_the_whole_computation(spark, cuts):
    bars = _bars(spark).cache()
    prices = price_table(spark, bars.where(F.col("trade_date") < F.lit(cuts[0])))
    store = IndicatorStore(spark, new_namespace(spark)).create()
    refresh(store, prices)
    for first, end in zip(cuts, [*cuts[1:], date(2100, 1, 1)]):
        t.append(t.by_month(bars.where((F.col("trade_date") >= F.lit(first)) & (F.col("trade_date") < F.lit(end)))), prices)
        refresh(store, prices, first)
    _same(store.indicators(), ind.indicator_table(bars))
    # Once more from the middle: nothing changes.
    refresh(store, prices, date(1998, 7, 1))
    _same(store.indicators(), ind.indicator_table(bars))


def test_late_and_corrected_bars_are_taken_in(spark):
    bars = _bars(spark).cache()
    late = (F.col("symbol") == "OLD") & (F.year("trade_date") == 1998)
    prices = price_table(spark, bars.where(~late))
    store = IndicatorStore(spark, new_namespace(spark)).create()
    refresh(store, prices)
    t.append(t.by_month(bars.where(late)), prices)
    refresh(store, prices, date(1998, 1, 1))
    _same(store.indicators(), ind.indicator_table(bars))


def test_only_new_months_and_one_folder_of_states_are_read(spark, prices, monkeypatch):
    store = IndicatorStore(spark, new_namespace(spark)).create()
    whole = refresh(store, prices)
    seen = {}
    taken = ind.indicator_rows

    def watched(bars, state, keep_states):
        bars.collect(), state.collect()
        seen["bars"] = bars._jdf.queryExecution().executedPlan().toString()
        return taken(bars, state, keep_states)

    monkeypatch.setattr(indicator_store.ind, "indicator_rows", watched)
    part = refresh(store, prices, date(2001, 1, 2))
    assert 0 < part < whole / 5
    assert re.search(r"PartitionFilters: \[isnotnull\(trade_month#\d+\), \(trade_month#\d+ >= 200101\)\]", seen["bars"])
    folders = store.spark.table(store.states).where("year < 2001").select(F.max("year")).first()[0]
    states = indicator_store._states_before(store, 2001)
    assert folders == 2000 and {f.split("year=")[1][:4] for f in states.inputFiles()} >= {"2000"}
    assert "PartitionFilters" in states._jdf.queryExecution().executedPlan().toString()
    assert {r.symbol for r in states.collect()} == {"OLD", "GAP", "NEW", "RARE"}


def test_no_bars_no_rows(spark):
    store = IndicatorStore(spark, new_namespace(spark)).create()
    assert refresh(store, price_table(spark)) == 0 and refresh(store, price_table(spark), date(2000, 1, 1)) == 0
    assert store.indicators().collect() == []


@pytest.mark.parametrize(
    "compute",
    [ind.sma, ind.exponential_average, ind.bollinger, ind.macd, ind.stochastic, ind.average_true_range,
     ind.relative_strength, ind.indicator_table, ind.signals, ind.numbered_series],
)
def test_stored_bars_are_scanned_once(spark, prices, compute):
    arguments = [20, 50] if compute is ind.sma else []
    assert len(_scans(compute(t.prices(spark, prices), *arguments))) == 1


def test_signals_have_a_row_for_every_bar_and_explore_reads_the_last(spark):
    from tickloom.plans.explore import explore

    bars = make_bars(spark, {"A": daily(date(2000, 1, 1), range(1, 61))})
    last = bars.withColumn("close", F.when(F.col("trade_date") < F.lit(date(2000, 2, 29)), F.col("close")))
    got = {r.trade_date: r for r in ind.signals(last).collect()}
    assert len(got) == 60 and got[date(2000, 2, 28)].rsi_14 is not None
    assert got[date(2000, 2, 29)].rsi_14 is None and got[date(2000, 2, 29)].is_rising is None
    summary = explore(last, ["A"], date(2000, 1, 1)).first()
    assert summary.last_day == date(2000, 2, 29) and summary.rsi_14 is None


def test_many_indicators_are_neither_staged_nor_dealt_anew(spark, monkeypatch):
    staged, laid = [], []
    stage, lay = indicator_store.Scratch.stage, indicator_store._laid
    monkeypatch.setattr(indicator_store, "MANY_ROWS", 1)
    monkeypatch.setattr(indicator_store.Scratch, "stage", lambda self, df, label: staged.append(label) or stage(self, df, label))
    monkeypatch.setattr(indicator_store, "_laid", lambda *a: laid.append(lay(*a)) or laid[-1])
    bars = _bars(spark).cache()
    recent = F.col("trade_date") >= F.lit(date(1999, 1, 1))
    prices = price_table(spark, bars.where(~recent))
    store = IndicatorStore(spark, new_namespace(spark)).create()
    refresh(store, prices)
    t.append(t.by_month(bars.where(recent)), prices)
    refresh(store, prices, date(1999, 1, 1))
    _same(store.indicators(), ind.indicator_table(bars))
    assert set(staged) == {"prior-states"} and len(laid) == 2
    assert all("rangepartitioning" not in d._jdf.queryExecution().executedPlan().toString() for d in laid)
    assert {len(r.tail) for r in spark.table(store.states).collect()} <= set(range(1, ind.TABLE_LOOKBACK + 1))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    seen = []

    class Watched:
        sparkSession = spark

        def __init__(self, df):
            self.write, self.schema = self, df.schema
            self.df = df

        def parquet(self, path):
            seen.append(spark.conf.get(name))
            self.df.write.parquet(path)

    with indicator_store.Scratch(spark) as scratch:
        assert scratch.stage(Watched(spark.range(9).repartition(3)), "rows").count() == 9
    assert seen == ["true"] and spark.conf.get(name) == before
