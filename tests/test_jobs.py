from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators.enrich import enrich_sector
from tickloom.plans import ingest as job
from tickloom.plans.backfill import backfill_to_fixpoint
from tickloom.plans.flat import FlatStore, flat_load
from tickloom.plans.star import STAR_TABLES, Star, load_star
from tickloom.schemas import schema_for
from tickloom.sources import tables as t
from tickloom.storage import fresh_path
from tickloom.streaming.ingest import ingest_stream
from tickloom.workload.tables import new_namespace

RUN, AT = date(2001, 1, 2), datetime(2001, 1, 2, 18)
LANDING = "symbol string, dt date, open double, high double, low double, close double, volume bigint"
META = schema_for("metadata")


def landed(symbol, day, close=1.0):
    return (symbol, day, close, close, close, close, 1)


@pytest.fixture
def directory(spark):
    marks = [("A", "N", "N"), ("B", "N", "N"), ("C", "N", "N"), ("E", "Y", "N"), ("T", "N", "Y")]
    return spark.createDataFrame(
        [(s, s, "Q", etf, test, 100) for s, etf, test in marks], schema_for("directory")
    )


@pytest.fixture
def store(spark):
    store = job.Store(spark, new_namespace(spark)).create()
    t.append(t.by_month(spark.createDataFrame([landed("A", date(2000, 12, 29))], schema_for("stock_prices"))), store.prices)
    known = [("A", date(2000, 12, 29), "Tech"), ("C", None, None)]
    t.append(spark.createDataFrame(known, META), store.metadata)
    return store


def landing(spark):
    rows = [
        landed("a", date(2000, 12, 29), 9.0),  # stored before
        landed("a", RUN, 2.0),
        landed("a", RUN, 2.0),  # copy
        landed("b", date(1999, 1, 4)),
        ("b", RUN, None, None, None, None, None),
        landed("c", RUN),  # known without a date: not requested
        landed("e", RUN),  # an ETF
        landed("t", RUN),  # a test issue
    ]
    return spark.createDataFrame(rows, LANDING)


WANT = [("A", date(2000, 12, 29), 1.0), ("A", RUN, 2.0), ("B", date(1999, 1, 4), 1.0)]


def stored(store):
    return sorted((r.symbol, r.trade_date, r.close) for r in t.prices(store.spark, store.prices).collect())


def test_ingest_adds_once_and_moves_the_metadata(spark, directory, store):
    assert job.ingest(store, directory, landing(spark), RUN, AT) == 2
    assert stored(store) == WANT
    known = {r.symbol: (r.last_update, r.sector) for r in spark.table(store.metadata).collect()}
    assert known == {"A": (RUN, "Tech"), "B": (RUN, None), "C": (None, None)}
    assert job.ingest(store, directory, landing(spark), RUN, AT) == 0
    assert stored(store) == WANT
    book = spark.table(store.ledger).orderBy("snapshot_id").collect()
    assert [(r.operation, r.table_name, r.added_rows) for r in book] == [
        ("append", "stock_prices", 2), ("replace", "metadata", 3)]


def test_a_run_that_stopped_before_the_metadata_is_repeated(spark, directory, store, monkeypatch):
    monkeypatch.setattr(job, "advance_metadata", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        job.ingest(store, directory, landing(spark), RUN, AT)
    monkeypatch.undo()
    assert job.ingest(store, directory, landing(spark), RUN, AT) == 0
    assert stored(store) == WANT


def test_stream_equals_batch_and_takes_each_file_once(spark, directory, store):
    path, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    rows = landing(spark)
    for part in ("symbol = 'a'", "symbol <> 'a'"):
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    run = (store, directory, path, rows.schema, checkpoint, RUN, AT, 1)
    ingest_stream(*run)
    assert stored(store) == WANT
    book = spark.table(store.ledger).count()
    assert ingest_stream(*run) == 0
    assert stored(store) == WANT and spark.table(store.ledger).count() == book
    dates = {r.symbol: r.last_update for r in spark.table(store.metadata).collect()}
    assert dates == {"A": RUN, "B": RUN, "C": None}


def test_upsert_counts_rows(spark, store):
    changes = spark.createDataFrame(
        [landed("A", date(2000, 12, 29), 5.0), landed("A", date(2000, 12, 29), 5.0), landed("Z", RUN)],
        schema_for("stock_prices"))
    assert job.upsert_prices(store, changes, AT) == (2, 0)
    assert stored(store) == [("A", date(2000, 12, 29), 5.0), ("Z", RUN, 1.0)]
    assert job.upsert_prices(store, changes.where("false"), AT) == (0, 0)


def test_backfill_stops_when_a_round_finds_nothing(spark):
    meta = spark.createDataFrame([("A", None, None), ("B", None, ""), ("C", None, "Tech")], META)
    calls = []

    def flaky(symbols):
        calls.append(1)
        known = [("A", "Energy")] if len(calls) == 1 else [("B", "Health")] if len(calls) == 2 else []
        return enrich_sector(symbols, spark.createDataFrame(known, "symbol string, sector string"))

    got = {r.symbol: r.sector for r in backfill_to_fixpoint(meta, flaky).collect()}
    assert got == {"A": "Energy", "B": "Health", "C": "Tech"} and len(calls) == 3


def test_star_load_is_repeatable(spark, directory):
    star = Star(spark, new_namespace(spark)).create()
    bars = spark.createDataFrame([landed(s, d) for s in "AET" for d in (date(1999, 1, 4), RUN)], schema_for("stock_prices"))
    for _ in range(2):
        load_star(star, directory, bars)
        sizes = {name: star.table(name).count() for name in STAR_TABLES}
        assert sizes == {"trading_days": 2, "symbols": 4, "stock_prices": 2, "etf_prices": 2, "metadata": 4}
    ids = [r.symbol_id for r in star.table("symbols").orderBy("symbol").collect()]
    assert ids == [1, 2, 3, 4]


BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"


def test_upsert_takes_the_last_arrival_and_rewrites_one_month(spark, store):
    more = [landed("A", date(2000, 11, d)) for d in (1, 2)] + [landed("B", date(2000, 12, 1))]
    t.append(t.by_month(spark.createDataFrame(more, schema_for("stock_prices"))), store.prices)
    before = {f for f in spark.table(store.prices).inputFiles()}
    rows = [(*landed("A", date(2000, 11, 1), 9.0), 1), (*landed("A", date(2000, 11, 1), 5.0), 2)]
    rows += [(*landed(None, RUN), 1), (*landed("A", None), 1)]
    changes = spark.createDataFrame(rows, BARS + ", arrival int")
    assert job.upsert_prices(store, changes, AT) == (2, 2)
    assert ("A", date(2000, 11, 1), 5.0) in stored(store) and len(stored(store)) == 4
    after = {f for f in spark.table(store.prices).inputFiles()}
    assert before - after and all("trade_month=200011" in f for f in before ^ after)


STEPS = ["append", "record", "end", "replace_table"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_interrupted_anywhere_and_repeated_the_ledger_is_full(spark, directory, store, monkeypatch, step, late):
    """Each step fails once, just before or just after its work."""
    owner = job.t if step in ("append", "replace_table") else job.ledger
    work, calls = getattr(owner, step), []

    def failing(*args, **more):
        if calls:
            return work(*args, **more)
        calls.append(1)
        if late:
            work(*args, **more)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(RuntimeError):
        job.ingest(store, directory, landing(spark), RUN, AT)
    job.ingest(store, directory, landing(spark), RUN, AT)
    assert stored(store) == WANT
    book = sorted((r.operation, r.table_name, r.added_rows) for r in spark.table(store.ledger).collect())
    assert book == [("append", "stock_prices", 2), ("replace", "metadata", 3)]
    assert job.ledger.open_intents(spark, store.ledger) == []


def test_padded_symbols_are_one_symbol(spark, directory, store):
    rows = spark.createDataFrame([landed(" a ", RUN, 2.0), landed("B", RUN)], LANDING)
    job.ingest(store, directory, rows, RUN, AT)
    assert {s for s, _, _ in stored(store)} == {"A", "B"}
    assert {r.symbol for r in spark.table(store.metadata).collect()} == {"A", "B", "C"}


def test_stream_keeps_files_for_later_listings(spark, directory, store):
    path, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    rows = landing(spark)
    rows.write.parquet(path)
    run = (path, rows.schema, checkpoint, RUN, AT)
    ingest_stream(store, directory.where("symbol = 'A'"), *run)
    assert {s for s, _, _ in stored(store)} == {"A"}
    ingest_stream(store, directory, *run)
    assert stored(store) == WANT


def test_jobs_leave_no_intermediate_rows(spark, directory, store):
    from tickloom.storage import shared_root

    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def names():
        labels = ("batch-", "new-bars-", "merged-", "changes-", "missing-bars-")
        return {n for n in (f.getPath().getName() for f in files.listStatus(folder)) if n.startswith(labels)}

    before = names()
    job.ingest(store, directory, landing(spark), RUN, AT)
    job.upsert_prices(store, spark.createDataFrame([landed("A", RUN, 7.0)], schema_for("stock_prices")), AT)
    assert names() - before == set()


def test_flat_load_moves_last_updates_once(spark):
    store = FlatStore(spark, new_namespace(spark)).create()
    t.append(spark.createDataFrame([("A", date(2000, 12, 29))], schema_for("last_update")), store.last_update)
    batches = [spark.createDataFrame([(s,)], "symbol string") for s in "AB"]
    assert flat_load(store, batches, landing(spark), RUN) == {"bars": 2, "known": 1, "new": 1}
    assert stored(store) == [("A", RUN, 2.0), ("B", date(1999, 1, 4), 1.0)]
    assert {tuple(r) for r in spark.table(store.last_update).collect()} == {("A", RUN), ("B", RUN)}
    assert flat_load(store, batches, landing(spark), RUN)["bars"] == 0


def test_backfill_needs_as_many_rounds_as_there_are(spark):
    meta = spark.createDataFrame([(f"S{i}", None, None) for i in range(4)], META)

    def one(symbols):
        first = sorted(r.symbol for r in symbols.collect())[:1]
        return spark.createDataFrame([(s, "x") for s in first] + [("OTHER", "y")], "symbol string, sector string")

    assert {r.sector for r in backfill_to_fixpoint(meta, one).collect()} == {"x"}


def test_star_load_reports_what_it_leaves_out(spark, directory):
    star = Star(spark, new_namespace(spark)).create()
    rows = [landed("A", RUN), landed("A", RUN), landed("T", RUN), landed("NEW", RUN), landed(None, RUN), landed("A", None), landed(None, None)]
    bars = spark.createDataFrame(rows, BARS)
    # T is a test issue and NEW is unknown: neither is listed.
    assert load_star(star, directory, bars) == (1, 3, 2)
    assert load_star(star, directory, bars.limit(0)) == (0, 0, 0)
    assert star.table("stock_prices").count() == 1


def _folders(spark, *labels):
    from tickloom.storage import shared_root

    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {n for n in (f.getPath().getName() for f in files.listStatus(folder)) if n.startswith(labels)}


def test_backfill_keeps_the_result_only(spark):
    meta = spark.createDataFrame([(f"S{i}", None, None) for i in range(3)], META)
    before = _folders(spark, "sectors-", "metadata-")
    rounds = []

    def lookup(symbols):
        rounds.append(1)
        return symbols.where(F.col("symbol") == f"S{len(rounds) - 1}").withColumn("sector", F.lit("x"))

    filled = backfill_to_fixpoint(meta, lookup)
    assert {r.sector for r in filled.collect()} == {"x"} and len(rounds) == 4
    assert len(_folders(spark, "sectors-", "metadata-") - before) == 1


def test_an_interrupted_append_leaves_no_folder(spark, directory, store, monkeypatch):
    before = _folders(spark, "batch-", "new-bars-", "missing-bars-")
    work, calls = job.t.append, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return work(*args)

    with monkeypatch.context() as m:
        m.setattr(job.t, "append", failing)
        with pytest.raises(RuntimeError):
            job.ingest(store, directory, landing(spark), RUN, AT)
        job.ingest(store, directory, landing(spark), RUN, AT)
    assert stored(store) == WANT and _folders(spark, "batch-", "new-bars-", "missing-bars-") == before
