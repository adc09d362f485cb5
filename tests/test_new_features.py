"""Batches of equal work, gaps, long frames, variants, digests, buckets and the provider source."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_indicators import daily, make_bars

from tickloom.functions import indicators as ind
from tickloom.operators import digest
from tickloom.operators.positions import with_running_sum
from tickloom.operators.quality import missing_intervals
from tickloom.operators.relational import balanced_batches
from tickloom.schemas import schema_for
from tickloom.sources import buckets, files, provider
from tickloom.sources.variants import as_variant, variant_to_long
from tickloom.storage import fresh_path
from tickloom.workload.tables import new_namespace

DAY = date(2000, 1, 3)


def test_running_sum_and_batches_of_equal_work(spark):
    rng = random.Random(1)
    rows = [(f"S{i:04}", rng.choice([0, 1, 5, 400, None])) for i in range(700)]
    df = spark.createDataFrame(rows, "symbol string, days long").repartition(7)
    total, want = 0, {}
    for symbol, days in rows:
        want[symbol] = (total + (days or 0), total // 1000)
        total += days or 0
    assert {r.symbol: r.running for r in with_running_sum(df, "days", "symbol").collect()} == {k: v for k, (v, _) in want.items()}
    got = balanced_batches(df, 1000).collect()
    assert {r.symbol: r.batch_id for r in got} == {k: b for k, (_, b) in want.items()}
    weights = pd.DataFrame([r.asDict() for r in got]).groupby("batch_id").days.sum()
    assert weights.max() < 1000 + 400
    assert balanced_batches(df.limit(0), 10).collect() == []
    with pytest.raises(ValueError):
        balanced_batches(df, 0)


def test_missing_intervals(spark):
    calendar = spark.createDataFrame([(DAY + timedelta(days=i),) for i in range(10)], "trade_date date")
    held = {"FULL": range(10), "HOLES": [0, 1, 4, 9], "LATE": [5], "OFF": [2, 40], None: [1]}
    rows = [(s, DAY + timedelta(days=i)) for s, days in held.items() for i in days] + [("LATE", DAY + timedelta(days=5))]
    bars = spark.createDataFrame(rows, "symbol string, trade_date date")
    listed = spark.createDataFrame([("FULL",), ("HOLES",), ("LATE",), ("NONE",), ("OFF",)], "symbol string")
    got = {(r.symbol, (r.first_day - DAY).days, (r.last_day - DAY).days, r.days) for r in missing_intervals(bars, calendar, listed).collect()}
    assert got == {
        ("HOLES", 2, 3, 2), ("HOLES", 5, 8, 4), ("LATE", 0, 4, 5), ("LATE", 6, 9, 4), ("NONE", 0, 9, 10),
        ("OFF", 0, 1, 2), ("OFF", 3, 9, 7),
    }
    assert missing_intervals(bars, calendar.limit(0)).collect() == []
    assert missing_intervals(bars.limit(0), calendar).collect() == []


@pytest.mark.parametrize("length", [1, 2, 30])
def test_rolling_extremes(spark, length):
    rng = random.Random(length)
    series = {
        "LONG": daily(date(1988, 11, 3), [rng.uniform(1, 9) for _ in range(600)], step=9),
        "SPARSE": daily(date(1975, 1, 1), [rng.uniform(1, 9) for _ in range(60)], step=400),
        "SHORT": daily(date(2001, 1, 1), [3.0]),
    }
    bars = make_bars(spark, series).withColumn("low", F.when(F.dayofmonth("trade_date") != 7, F.col("low")))
    got = ind.rolling_extremes(bars, length).toPandas().sort_values(["symbol", "trade_date"])
    assert len(got) == bars.count()
    for symbol, pdf in got.groupby("symbol"):
        usable = pdf[pdf.low.notna()]
        low, high = usable.low.rolling(length).min(), usable.high.rolling(length).max()
        pd.testing.assert_series_equal(pdf[f"low_{length}"].reindex(usable.index), low, check_names=False)
        pd.testing.assert_series_equal(pdf[f"high_{length}"].reindex(usable.index), high, check_names=False)
        assert pdf.loc[pdf.low.isna(), f"high_{length}"].isna().all()


def test_variants_unfold_by_path(spark):
    texts = [
        '{"A": {"close": 1.5, "volume": 3}, "B b": {"close": null, "volume": 7, "more": [1]}}',
        '{"A": {"close": "text", "volume": 9}, "C": {"other": 1}, "D": 5}',
        "[1, 2]", "no json", None, "{}",
    ]
    grid = as_variant(spark.createDataFrame([(DAY, x) for x in texts], "trade_date date, record string"))
    got = {tuple(r) for r in variant_to_long(grid, {"close": "double", "volume": "bigint"}).collect()}
    assert got == {("A", DAY, 1.5, 3), ("B b", DAY, None, 7), ("A", DAY, None, 9)}


def test_digests_find_what_differs(spark):
    rows = [(i, f"t{i % 7}", None if i % 5 == 0 else i * 0.5) for i in range(1000)] + [(5, "t", None)] * 2
    df = spark.createDataFrame(rows, "k long, t string, `x.y` double")
    part = F.floor(F.col("k") / 100)
    same = digest.verified(df, df.repartition(7).select("`x.y`", "t", "k"), part).collect()
    assert len(same) == 10 and all(r.is_equal for r in same)
    halves = [digest.table_digest(df.where(c), part) for c in ("k % 2 = 0", "k % 2 = 1")]
    assert all(r.is_equal for r in digest.compared(digest.merged_digests(*halves), digest.table_digest(df, part)).collect())
    nulled = df.withColumn("t", F.when(F.col("k") != 321, F.col("t")))
    moved = df.where("k <> 777").unionByName(df.where("k = 778"))
    gone = df.where("k < 900")
    for changed, want in ((nulled, {3}), (moved, {7}), (gone, {9}), (df.dropDuplicates(), {0})):
        assert {r.part for r in digest.verified(df, changed, part).collect() if not r.is_equal} == want
    # A NULL in another column is another row.
    a = spark.createDataFrame([(1, None, 1.0)], "k long, t string, x double")
    b = spark.createDataFrame([(1, "1.0", None)], "k long, t string, x double")
    assert not digest.verified(a, b, F.lit(0)).first().is_equal


def test_bucketed_bars_do_not_move(spark):
    bars = make_bars(spark, {f"S{i}": daily(date(2000, 1, 3), range(1, 60)) for i in range(20)})
    name = f"{new_namespace(spark)}.bucketed"
    buckets.create_bucketed(spark, name, 4)
    assert buckets.append_bucketed(bars.where("trade_date < DATE'2000-02-10'"), name) == 20 * 38
    batch = bars.where("trade_date >= DATE'2000-01-25'").select(*[f.name for f in schema_for("stock_prices")])
    new = buckets.new_bars_bucketed(batch, name)
    assert new.count() == new.distinct().count() == 20 * 21
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = buckets.new_bars_bucketed(batch, name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    # The only exchange is the batch's; the stored side is read in its buckets.
    assert "Bucketed: true" in plan and sum("Exchange" in line for line in plan.splitlines()) == 1
    assert plan.index("Exchange") < plan.index("Bucketed: true")
    assert buckets.bars_of(spark, name, "S3").count() == 38
    with pytest.raises(ValueError, match="not bucketed"):
        buckets.buckets_of(spark, _plain(spark))


def _plain(spark):
    name = f"{new_namespace(spark)}.plain"
    spark.sql(f"CREATE TABLE {name} (symbol string) USING parquet")
    return name


def test_provider_filters_retries_and_stream_offsets(spark):
    plans, log, out = fresh_path(spark, "plans"), fresh_path(spark, "log"), fresh_path(spark, "out")
    plan = spark.createDataFrame([(0, ["A", "B"], None), (1, ["C"], DAY)], "request_no int, symbols array<string>, after date")
    provider.write_plan(plan, plans, "p1")

    def fetch(request):
        import os

        os.makedirs(log, exist_ok=True)
        said = f"{request.request_no} {','.join(request.symbols)} {request.after} {request.first} {request.last}"
        with open(f"{log}/{request.request_no}-{request.attempt}", "w") as f:
            f.write(said)
        if "B" in request.symbols or (request.symbols == ("C",) and request.attempt < 3):
            raise TimeoutError("slow")
        return pa.table({"symbol": list(request.symbols), "dt": [DAY] * len(request.symbols), "close": [1.0] * len(request.symbols)})

    provider.register(spark, "test_provider", fetch)
    source = spark.read.format("test_provider").option("requests", plans)
    got = {(r.symbol, r.dt, r.close, r.status, r.attempts, r.error) for r in source.load().collect()}
    assert got == {
        ("A", None, None, "failed", 3, "TimeoutError: slow"), ("B", None, None, "failed", 3, "TimeoutError: slow"),
        ("C", DAY, 1.0, "ok", 3, "TimeoutError: slow"),
    }
    chosen = source.load().where((F.col("symbol") == "A") & (F.col("dt") >= F.lit(DAY)) & (F.col("dt") < F.lit(date(2000, 2, 1))))
    assert [(r.symbol, r.status, r.attempts) for r in chosen.collect()] == [("A", "ok", 1)]
    assert open(f"{log}/0-1").read() == "0 A None 2000-01-03 2000-02-01"
    assert source.load().where("symbol = 'Z'").collect() == []

    def run():
        stream = spark.readStream.format("test_provider").option("requests", plans).option("attempts", "3").load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state").trigger(availableNow=True).start()
        query.awaitTermination(60)
        return spark.read.parquet(out).count()

    assert run() == 3
    assert run() == 3  # nothing new
    provider.write_plan(plan.where("request_no = 1"), plans, "p2")
    assert run() == 4


def test_many_requests_share_the_tasks_of_a_scan():
    asked = [provider.Request(i, ("A",), None) for i in range(1000)]
    dealt = provider._dealt(asked)
    assert len(dealt) == provider.MAX_TASKS
    assert sorted(r.request_no for part in dealt for r in part.requests) == list(range(1000))
    assert [len(part.requests) for part in provider._dealt(asked[:3])] == [1, 1, 1]


def test_folders_by_symbol_hold_every_row(spark):
    names = F.expr("CASE WHEN id < 45000 THEN 'HOT' WHEN id % 5 < 4 THEN concat('S', id % 5) END")
    rows = spark.range(50_000).select(
        names.alias("symbol"), F.when(F.col("id") % 9 > 0, F.date_add(F.lit(DAY), F.col("id").cast("int") % 700)).alias("dt"),
        F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("close"),
    ).repartition(3, "symbol").sortWithinPartitions("symbol")
    folder = fresh_path(spark, "landed")
    provider.write_by_symbol(rows, folder)
    back = spark.read.parquet(folder).select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    hot = provider.landed_files(folder)(provider.Request(0, ("HOT", "NONE"), DAY))
    assert hot.num_rows == rows.where((F.col("symbol") == "HOT") & (F.col("dt") > F.lit(DAY))).count()
    # One file a symbol and task, whether its rows fill many batches or few.
    assert len(back.inputFiles()) == 6


def test_csv_files_by_symbol_keep_names(spark):
    root = fresh_path(spark, "tree")
    days = spark.createDataFrame([(DAY, 2.0, 3.0, 1e20, None, 7)], "Date date, Close double, High double, Low double, Open double, Volume long")
    names = spark.createDataFrame([(n,) for n in ("BRK B", "A^A", "C+%20", "É/x")], "symbol string")
    provider.write_by_symbol(names.crossJoin(days).coalesce(1).sortWithinPartitions("symbol"), f"{root}/etfs", "csv")
    got = sorted((r.kind, r.symbol, r.trade_date, r.open, r.close, r.low, r.volume) for r in files.price_csv_tree(spark, root).collect())
    assert got == sorted(("etfs", s, DAY, None, 2.0, 1e20, 7) for s in ("A^A", "BRK B", "C+%20", "É/x"))
