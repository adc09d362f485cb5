"""Plans and layouts whose size must not grow with the number of symbols."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from test_indicators import daily, make_bars
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.sources import buckets, shape
from tickloom.storage import fresh_path
from tickloom.workload import QUERIES

LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def tables(spark):
    """120 suppliers with a few line items each, one of them listed twice and one not at all."""
    folder = fresh_path(spark, "tables")
    keys = [*range(119), 7]
    spark.createDataFrame([(k, f"S{k}", k % 25, 0.0) for k in keys], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    days = [datetime(1999, 12, 20) + timedelta(days=9 * i) for i in range(6)]
    items = [
        (10 * k + i, 1, k, i % 2, float(k % 5 + 1), 100.0 + k + i, 0.01 * i, 0.02, "N", "O", day)
        for k in range(120) for i, day in enumerate(days) if (k + i) % 3
    ]
    spark.createDataFrame(items + items[:40], LINEITEM).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_grids_of_all_blocks_come_from_one_scan(spark, tables):
    got = QUERIES["wide_to_long"].run(spark, tables)
    assert plan_of(got).count("lineitem") <= 1 and plan_of(got).count("Aggregate") <= 5
    items = spark.read.parquet(f"{tables}/lineitem.parquet").where("l_suppkey < 119")
    keys = items.select(F.concat(F.lit("SUP"), "l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("trade_date")).distinct()
    assert {(r.symbol, r.trade_date) for r in got.collect()} == {tuple(r) for r in keys.collect()}
    assert got.count() == keys.count() and got.where("close IS NULL OR volume IS NULL").count() == 0


def test_a_row_names_the_tickers_of_its_slots(spark):
    grids = spark.createDataFrame(
        [(1, {"0": "A", "1": "B"}, 1.0, 2.0, 5), (1, {"0": "C"}, 3.0, 9.0, None), (2, {"0": "A"}, None, None, None)],
        "d int, names map<string, string>, 0_close double, 1_close double, 1_volume int",
    )
    got = shape.wide_to_long(grids, ["NONE", "0", "1"], ["close", "volume"], day="d", names="names")
    assert sorted(map(tuple, got.collect())) == [("A", 1, 1.0, None), ("B", 1, 2.0, 5), ("C", 1, 3.0, None)]


def sorts_of(spark, df) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    return sum("Sort [symbol" in line and "usable" in line for line in lines)


def test_buckets_grow_with_the_bars():
    assert [buckets.buckets_for(n) for n in (0, 1, 8_000_000, 8_000_001, 140_000_000)] == [8, 8, 8, 9, 140]


def test_running_extremes_are_sorted_once_each_way(spark):
    bars = make_bars(spark, {"S": daily(date(2000, 1, 1), range(1, 60))})
    # To number the bars, to find the starts, and for the extremes from either end of a block.
    assert sorts_of(spark, ind.rolling_extremes(bars, 30)) == 4


def test_every_frame_is_run_once(spark):
    bars = make_bars(spark, {"S": daily(date(2000, 1, 1), range(1, 60))})
    for table in (ind.bollinger, ind.indicator_table):
        plan = plan_of(table(bars))
        frames = {line.split("Window [")[1] for line in plan.splitlines() if "Window [" in line and "stddev_pop(" in line}
        # Several readers of the same rows repeat a window, so windows are told apart, not counted.
        assert frames and all(f.count("stddev_pop(") == 1 and f.count("avg(close") <= 1 for f in frames)


def test_eras_are_dealt_over_tasks_of_few_bars(spark):
    bars = make_bars(spark, {f"S{i}": daily(date(2000, 1, 1), range(1, 40)) for i in range(30)})
    for table in (ind.sma(bars, 20, 50), ind.macd(bars)):
        # Neither merged by the size of their files nor broadcast because the bars compress well.
        assert table.rdd.getNumPartitions() >= 192
        plan = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        moved = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
        assert "BuildLeft" not in plan and sum("ReusedExchange" not in line for line in moved) == 1


def test_bars_without_look_back_carry_no_context(spark):
    bars = make_bars(spark, {"S": daily(date(1999, 12, 1), range(1, 60)), "T": daily(date(1999, 12, 30), [3.0, float("nan"), 5.0, 10.0])})
    got = ind.macd(bars, 2, 3, 2)
    # One sort for the states at the ends of blocks and one for the rows.
    assert sorts_of(spark, got) == 2 and "explode(CASE" not in plan_of(got)
    line = {r.trade_date.day: r.macd for r in got.where("symbol = 'T'").collect()}
    assert line == {30: None, 31: None, 1: None, 2: pytest.approx(2.0)}
    assert got.where("symbol = 'S'").count() == 59
