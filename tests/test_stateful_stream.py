"""The stateful stream: held rows, requests by run, restarts."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from test_jobs import AT, LANDING, RUN, WANT, directory, landed, landing, store, stored  # noqa: F401  fixtures

from tickloom.storage import fresh_path
from tickloom.streaming import stateful
from tickloom.streaming.stateful import ingest_stream_stateful

NEXT, NEXT_AT = date(2001, 1, 3), datetime(2001, 1, 3, 18)


def _places(spark):
    return fresh_path(spark, "landing"), fresh_path(spark, "stream")


def test_equals_the_batch_job_and_a_restart_repeats_nothing(spark, directory, store):
    path, checkpoint = _places(spark)
    rows = landing(spark)
    rows.coalesce(1).write.parquet(path)
    run = (path, rows.schema, checkpoint, RUN, AT)
    ingest_stream_stateful(store, directory.where("symbol = 'A'"), *run)
    assert {s for s, _, _ in stored(store)} == {"A"}
    # B is listed after its file was consumed; the file is gone, only the state has its rows.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in files.listStatus(folder):
        files.delete(f.getPath(), True)
    assert ingest_stream_stateful(store, directory, path, rows.schema, checkpoint, RUN, NEXT_AT) == 1
    assert stored(store) == WANT
    book = spark.table(store.ledger).count()
    assert ingest_stream_stateful(store, directory, path, rows.schema, checkpoint, RUN, NEXT_AT) == 0
    assert stored(store) == WANT and spark.table(store.ledger).count() == book
    assert spark.table(f"{store.namespace}.released").isEmpty()


def test_rows_of_an_up_to_date_symbol_wait_for_the_next_request(spark, directory, store):
    path, checkpoint = _places(spark)
    first = spark.createDataFrame([landed("a", RUN, 2.0)], LANDING)
    first.write.parquet(path)
    ingest_stream_stateful(store, directory, path, first.schema, checkpoint, RUN, AT)
    later = [landed("a", RUN, 5.0), landed("A ", NEXT, 3.0), (None, NEXT, 1.0, 1.0, 1.0, 1.0, 1), ("a", None, 1.0, 1.0, 1.0, 1.0, 1)]
    spark.createDataFrame(later, LANDING).write.mode("append").parquet(path)
    # A has been updated to this day: nothing is asked for.
    assert ingest_stream_stateful(store, directory, path, first.schema, checkpoint, RUN, datetime(2001, 1, 2, 19)) == 0
    assert ingest_stream_stateful(store, directory, path, first.schema, checkpoint, NEXT, NEXT_AT) == 1
    assert stored(store) == [("A", date(2000, 12, 29), 1.0), ("A", RUN, 2.0), ("A", NEXT, 3.0)]


def test_a_run_that_stopped_before_storing_is_repeated(spark, directory, store, monkeypatch):
    path, checkpoint = _places(spark)
    rows = landing(spark)
    rows.repartition(3).write.parquet(path)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(stateful, "append_new", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest_stream_stateful(store, directory, path, rows.schema, checkpoint, RUN, AT, files_per_batch=1)
    # The files are consumed, but the queue still has what they released.
    assert ingest_stream_stateful(store, directory, path, rows.schema, checkpoint, RUN, NEXT_AT) == 2
    assert stored(store) == WANT


def test_values_come_back_as_they_landed(spark, directory, store):
    path, checkpoint = _places(spark)
    big = 2**53 + 1
    odd = [("b", RUN, None, float("nan"), 1e-300, 0.1, big), ("b", NEXT, 1.0, None, -0.0, 2.5, None)]
    rows = spark.createDataFrame(odd, LANDING)
    rows.write.parquet(path)
    requested = spark.createDataFrame([("B", None)], "symbol string, last_update date")
    stateful.release(store, requested, path, rows.schema, checkpoint, "run", RUN)
    got = {r.dt: r for r in spark.table(f"{store.namespace}.released").collect()}
    assert got[RUN].volume == big and got[RUN].open is None and got[RUN].high != got[RUN].high and got[RUN].low == 1e-300
    assert got[NEXT].high is None and got[NEXT].volume is None


def test_held_rows_expire(spark, directory, store):
    path, checkpoint = _places(spark)
    rows = spark.createDataFrame([landed("b", RUN)], LANDING)
    rows.write.parquet(path)
    hold = {"hold_for": timedelta(days=5)}
    args = (path, rows.schema, checkpoint)
    ingest_stream_stateful(store, directory.where("symbol = 'A'"), *args, RUN, AT, **hold)
    spark.createDataFrame([landed("b", date(2001, 1, 6))], LANDING).write.mode("append").parquet(path)
    later = date(2001, 1, 8)
    assert ingest_stream_stateful(store, directory, *args, later, datetime(2001, 1, 8, 18), **hold) == 1
    assert ("B", date(2001, 1, 6), 1.0) in stored(store) and ("B", RUN, 1.0) not in stored(store)


class _State:
    """A value or a list of the state store that counts the calls."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self, *_):
        self.calls += 1
        return iter(self.rows) if self.listed else (self.rows[0] if self.rows else None)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, list(rows)

    def update(self, row):
        self.put([row])

    def appendValue(self, row):
        self.put([*self.rows, row])

    def clear(self):
        self.put([])

    def getValueState(self, *_):
        self.listed = False
        return self

    def getListState(self, *_):
        self.listed = True
        return self


def test_a_bucket_of_symbols_takes_a_few_calls_to_the_state():
    value, held = _State(), _State()

    def event(*row):
        named = zip(("key", "request", "last_update", "day", "payload"), row)
        return json.dumps({k: v for k, v in named if v is not None})

    class Handle:
        getValueState, getListState = value.getValueState, held.getListState

    def batch(run, *rows):
        hold = stateful.HoldUntilRequested(run, RUN)
        hold.init(Handle)
        return sorted(p for r in hold.handleInputRows((0,), iter([(0, event(*row)) for row in rows]), None) for p in r.payload.split("\n"))

    names = [f"S{i:04}" for i in range(2000)]
    rows = [(s, None, None, day, f"{s}-{day}") for s in names for day in (1, 2, None)]
    asked = [(s, "first", 1 if s < "S0500" else None, None, None) for s in names[:1000]]
    want = sorted([f"{s}-2" for s in names[:500]] + [f"{s}-{d}" for s in names[500:1000] for d in (1, 2, None)])
    # Requests lie among the rows; of symbols that are not asked for all rows are held.
    assert batch("first", *rows[:3000], *asked, *rows[3000:]) == want
    assert batch("first", *rows[:3]) == ["S0000-2"] and batch("second", *rows[:3]) == []
    late = [(s, "second", 1, None, None) for s in (names[0], names[1000], names[1999], "NONE")]
    assert batch("second", *late) == ["S0000-2", "S1000-2", "S1999-2"]
    assert batch("second", *late) == []
    rest = batch("third", *[(s, "third", None, None, None) for s in names])
    assert rest == sorted(f"{s}-{d}" for s in names[1001:1999] for d in (1, 2, None))
    assert held.rows == [] and value.calls + held.calls < 30
