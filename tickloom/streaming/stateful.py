"""Ingestion as a stateful stream: no landed row is read twice.

The stream takes in landing files and, before them, the requests of every run
(symbol, last update). Its state, kept by Spark's state store for buckets of
symbols, is the last request of each symbol and the landed rows that nobody has
asked for yet. A run releases
what its requests ask for, held rows and new ones, into a queue table; the batch
part of the run stores the queue and empties it.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.functions.scalars import clean_symbol
from tickloom.operators.dimensions import dedupe_bars
from tickloom.operators.relational import batch_metadata, clean_rows, normalize_prices
from tickloom.plans.ingest import Store, advance_metadata, append_new, finish_interrupted, requested_symbols
from tickloom.sources import tables as t
from tickloom.storage import Scratch

PART = "released_by"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHUNK = 10_000  # landed rows of a bucket that a task holds at once
BUCKETS = 4096  # of symbols, each a key of the state; a checkpoint is bound to their number
_EVENT = "key string, request string, last_update date, day date, payload string"

# Tasks get the processor by value, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class HoldUntilRequested(StatefulProcessor):
    """For each symbol of a bucket: rows pass if the current run asks for them, else they are held.

    A request is an event with the run's name and the symbol's last update. Only
    later rows are asked for, all of them if there is no last update. Rows up to
    the last update are dropped once the symbol is requested: no later request
    can ask for them. Rows held since before ``hold_from`` have expired; they go
    when their symbol next has an event.

    Every call to the state is a message to the JVM, and every row in it is
    converted by itself. So a bucket's requests are one value, and the rows that
    a micro-batch holds are one entry of a list, as are those that pass: text
    with a line for each payload, as JSON has no line breaks.
    """

    def __init__(self, run: str, run_date: date, hold_from: date | None = None):
        self.run, self.run_date, self.hold_from = run, run_date, hold_from

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.requests = handle.getValueState("requests", "by_symbol string")
        self.held = handle.getListState("held", "held_on date, by_symbol string")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known = self.requests.get()
        requests = json.loads(known[0]) if known is not None else {}
        seen, asked, landed, n = set(), set(), {}, 0
        for _, text in rows:
            event = json.loads(text)
            symbol = event["key"]
            seen.add(symbol)
            if "request" in event:
                requests[symbol] = [event["request"], event.get("last_update")]
                asked.add(symbol)
            else:
                landed.setdefault(symbol, []).append([event.get("day"), event["payload"]])
                n += 1
            if n == _CHUNK:
                yield from self._passed(landed, requests)
                landed, n = {}, 0
        if asked:
            self.requests.update((json.dumps(requests),))
        yield from self._passed(landed, requests)
        yield from self._sifted(seen, asked, requests)

    def _passed(self, landed: dict[str, list], requests: dict[str, list]) -> Iterator[Row]:
        """The landed rows that are asked for; others are held."""
        wanted = [symbol for symbol in landed if self._is_wanted(symbol, requests)]
        passed = [p for symbol in wanted for p in self._later(landed.pop(symbol), requests[symbol][1])]
        if landed:
            self.held.appendValue((self.run_date, json.dumps(landed)))
        if passed:
            yield Row(payload="\n".join(passed))

    def _sifted(self, seen: set[str], asked: set[str], requests: dict[str, list]) -> Iterator[Row]:
        """The held rows that are asked for now. They go, as do the expired ones of symbols that had an event."""
        wanted = {symbol for symbol in asked if self._is_wanted(symbol, requests)}
        if not wanted and self.hold_from is None:
            return
        kept, changed = [], False
        for held_on, text in self.held.get():
            by_symbol = json.loads(text)
            gone = seen if self.hold_from is not None and held_on < self.hold_from else ()
            passed, rest = [], {}
            for symbol, rows in by_symbol.items():
                if symbol in gone:
                    continue
                if symbol in wanted:
                    passed += self._later(rows, requests[symbol][1])
                else:
                    rest[symbol] = rows
            if len(rest) < len(by_symbol):
                changed = True
                text = json.dumps(rest)
            if rest:
                kept.append((held_on, text))
            if passed:
                yield Row(payload="\n".join(passed))
        if changed:
            self.held.put(kept) if kept else self.held.clear()

    def _is_wanted(self, symbol: str, requests: dict[str, list]) -> bool:
        return symbol in requests and requests[symbol][0] == self.run

    @staticmethod
    def _later(rows: list[list], last: int | None) -> list[str]:
        return [payload for day, payload in rows if last is None or (day is not None and day > last)]

    def close(self) -> None:
        pass


def _queue(store: Store) -> str:
    return f"{store.namespace}.released"


def release(
    store: Store, requested: DataFrame, landing_path: str, landing_schema: StructType, checkpoint: str, run: str,
    run_date: date, day: str = "dt", files_per_batch: int | None = None, hold_for: timedelta | None = None,
) -> None:
    """Run the stream over all new files and put what ``requested`` asks for into the queue.

    Each micro-batch is one partition of the queue, so a repeated one replaces
    itself. ``run`` names the requests: rows that land in a later run pass only
    if that run asks for them. Time is the run date, never the clock.
    """
    spark = store.spark
    schema = StructType([*landing_schema.fields, StructField(PART, StringType())])
    t.create_table(spark, _queue(store), schema, partitioned_by=[PART], comment="Rows released by the stream")
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    requests = f"{checkpoint.rstrip('/')}-requests"
    # A repeated run asks once more for the same; the name of the run tells requests apart.
    requested.select(
        F.col("symbol").alias("key"), F.lit(run).alias("request"), F.col("last_update").cast("date").alias("last_update"),
        F.lit(None).cast("date").alias("day"), F.lit(None).cast("string").alias("payload"),
    ).write.mode("append").parquet(requests)

    reader = spark.readStream.schema(landing_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landed = reader.parquet(landing_path).select(
        clean_symbol("symbol").alias("key"), F.lit(None).cast("string").alias("request"),
        F.lit(None).cast("date").alias("last_update"), F.col(day).cast("date").alias("day"),
        # As text, so that NULL and NaN come back as they were.
        F.to_json(F.struct(*landing_schema.names)).alias("payload"),
    )
    events = landed.unionByName(spark.readStream.schema(_EVENT).parquet(requests))
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")
    # Days as numbers: the processor only compares them. One column, as each of a row costs a conversion.
    numbers = [F.unix_date(c).alias(c) for c in ("last_update", "day")]
    event = F.to_json(F.struct("key", "request", *numbers, "payload"), {"ignoreNullFields": "true"})
    passed = (
        events.where(F.col("key").isNotNull())
        .select(bucket.alias("bucket"), event.alias("event"))
        .groupBy("bucket")
        .transformWithState(
            HoldUntilRequested(run, run_date, run_date - hold_for if hold_for is not None else None), "payload string", "Append", "None"
        )
        .select(F.explode(F.split("payload", "\n")).alias("payload"))
        .select(F.from_json("payload", landing_schema).alias("row"))
        .select("row.*")
    )

    def take(rows: DataFrame, batch_id: int) -> None:
        # A stream runs in a session of its own: only there are its writes seen at once.
        t.overwrite_partitions(rows.withColumn(PART, F.lit(f"{stream_id}-{batch_id}")), _queue(store))

    with _state_store(spark):
        query = passed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    spark.catalog.refreshTable(_queue(store))


class _state_store:
    """The state store that this kind of state needs, for the time of a stream."""

    def __init__(self, spark: SparkSession):
        self.conf, self.name = spark.conf, "spark.sql.streaming.stateStore.providerClass"

    def __enter__(self) -> None:
        self.before = self.conf.get(self.name)
        self.conf.set(self.name, PROVIDER)

    def __exit__(self, *_) -> None:
        self.conf.set(self.name, self.before)


def ingest_stream_stateful(
    store: Store,
    directory: DataFrame,
    landing_path: str,
    landing_schema: StructType,
    checkpoint: str,
    run_date: date,
    committed_at: datetime,
    day: str = "dt",
    files_per_batch: int | None = None,
    hold_for: timedelta | None = None,
) -> int:
    """One run: release what is requested now, then store it. Returns the bars added.

    A landed row is read once, by the stream; a symbol listed later gets its
    rows from the state. The queue is emptied when its bars and the metadata
    are committed, so an interrupted run is repeated without loss, and what it
    had stored already is not added again.
    """
    spark = store.spark
    finish_interrupted(store)
    with Scratch(spark) as scratch:
        metadata = scratch.stage(spark.table(store.metadata), "metadata")
        requested = requested_symbols(directory, metadata, run_date)
        run = committed_at.isoformat()
        release(store, requested, landing_path, landing_schema, checkpoint, run, run_date, day, files_per_batch, hold_for)
        queued = spark.table(_queue(store))
        # As many as micro-batches ran since the queue was emptied.
        parts = [r[PART] for r in queued.select(PART).distinct().collect()]
        rows = queued.where(F.col(PART).isin(parts)).drop(PART)
        batch = scratch.stage(dedupe_bars(normalize_prices(clean_rows(rows, day), day)), "batch")
        added = append_new(store, batch, committed_at)
        advance_metadata(store, batch_metadata(batch, metadata, run_date), committed_at)
        for part in parts:
            spark.sql(f"ALTER TABLE {_queue(store)} DROP IF EXISTS PARTITION ({PART} = '{part}')")
    return added
