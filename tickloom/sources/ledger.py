"""A table with one row per committed write, and the intents that make it complete.

A job notes what it is about to write as an open intent, writes, records the
write in the ledger and closes the intent. A run that finds an open intent of
an interrupted one can tell whether its write was committed, and records it.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import schema_for
from tickloom.sources.tables import create_table

_SCHEMA = schema_for("load_ledger")


_INTENTS = schema_for("load_intents")


def create_ledger(spark: SparkSession, name: str) -> None:
    create_table(spark, name, _SCHEMA, comment="Committed writes")
    create_table(spark, intents_of(name), _INTENTS, comment="Writes begun and ended")


def intents_of(ledger: str) -> str:
    return ledger + "_intents"


def begin(
    spark: SparkSession, ledger: str, operation: str, table_name: str, path: str, committed_at: datetime
) -> str:
    """Note a write before it is made. ``path`` holds the rows it adds, or will hold all of them."""
    intent = uuid.uuid4().hex
    _note(spark, ledger, (intent, "open", operation, table_name, path, committed_at))
    return intent


def end(spark: SparkSession, ledger: str, intent: str) -> None:
    _note(spark, ledger, (intent, "closed", None, None, None, None))


def open_intents(spark: SparkSession, ledger: str) -> list[Row]:
    """Intents not closed, oldest first: those of interrupted runs, so only a few."""
    intents = spark.table(intents_of(ledger))
    closed = intents.where("state = 'closed'").select("intent_id")
    rows = intents.where("state = 'open'").join(closed, "intent_id", "left_anti")
    return rows.orderBy("committed_at", "intent_id").collect()


def _note(spark: SparkSession, ledger: str, row: tuple) -> None:
    spark.createDataFrame([row], _INTENTS).write.insertInto(intents_of(ledger))


def record(
    spark: SparkSession,
    ledger: str,
    operation: str,
    table_name: str,
    added_rows: int,
    committed_at: datetime,
) -> None:
    """Note a write after it has been committed; the time is the caller's."""
    last = spark.table(ledger).agg(F.coalesce(F.max("snapshot_id"), F.lit(0)).alias("id")).first().id
    row = [(last + 1, committed_at, operation, table_name, added_rows)]
    spark.createDataFrame(row, _SCHEMA).write.insertInto(ledger)


def current_snapshot(ledger: DataFrame) -> DataFrame:
    """The latest write per table, by commit time and then by id."""
    latest = F.max_by("snapshot_id", F.struct("committed_at", "snapshot_id"))
    return ledger.groupBy("table_name").agg(
        latest.alias("current_snapshot_id"),
        F.max("committed_at").alias("committed_at"),
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("added_rows").alias("added_rows"),
    )
