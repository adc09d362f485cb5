"""What several operators of this package share."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.storage import fresh_path

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *labels: str) -> list[str]:
    """A name for each label that no column of ``df`` has, whatever the caller's columns are called."""
    taken = {c.lower() for c in df.columns}
    names = []
    for label in labels:
        while label.lower() in taken:
            label = f"{label}_"
        taken.add(label.lower())
        names.append(label)
    return names


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)


def with_fields(schema: T.StructType, **new: str) -> T.StructType:
    """``schema`` without fields named like a new one, then the new ones (name = type)."""
    kept = [f for f in schema.fields if f.name not in new]
    return T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in new.items()])


def extended(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with new columns after its own; a new name replaces a column so named."""
    names = [n for n in batch.schema.names if n not in new]
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*columns, *new.values()], names=[*names, *new])


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterable[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that a task's Python objects stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def travels(module: str) -> None:
    """Send functions of ``module`` to tasks by value, so that workers need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of ``value``, whose classes travel with it; tasks read it with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(handle: Broadcast) -> Any:
    return pickle.loads(handle.value)


travels(__name__)
