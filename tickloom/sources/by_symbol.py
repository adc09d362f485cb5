"""Parquet in folders by symbol, on a file system that driver and executors mount.

Such a folder has a file a symbol and append. Spark's writer costs several processes for each of them
there (Hadoop sets the rights of a file, and of its checksums, by a process), and its committer moves
them one after the other on the driver. Here tasks write the files and, when all are there, move them.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.storage import Scratch, remove_folder

# Tasks get the functions by value, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_GROUP = 1 << 26  # bytes of a symbol's rows that a task holds
LISTED = 10_000  # files named in one batch
ESCAPED = r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"  # what Spark escapes in the name of a partition


def _folder(symbol: str | None) -> str:
    name = re.sub(ESCAPED, lambda c: f"%{ord(c[0]):02X}", symbol or "") or "__HIVE_DEFAULT_PARTITION__"
    return f"symbol={name}"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, pa.RecordBatch]]:
    """Rows that follow each other with one symbol, without it."""
    for batch in batches:
        runs = pc.run_end_encode(batch.column("symbol"))
        own, start = batch.drop_columns(["symbol"]), 0
        for end, symbol in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
            yield symbol, own.slice(start, end - start)
            start = end


def _write(path: str, parts: Iterator[tuple[str | None, pa.RecordBatch]]) -> None:
    out, held, size = None, [], 0
    for _, part in parts:
        out = out or pq.ParquetWriter(path, part.schema)
        held.append(part)
        size += part.nbytes
        if size >= ROW_GROUP:
            out.write_table(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        out.write_table(pa.Table.from_batches(held))
    out.close()


def _move(source: str, target: str) -> None:
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        os.replace(source, target)
    except FileNotFoundError:
        if not os.path.exists(target):
            raise


def _listed(files: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*files)], names=["source", "target"])


def append(rows: DataFrame, root: str) -> int:
    """Append rows, sorted by symbol within their partitions, to folders ``symbol=NAME``. Returns how many files.

    The files are written to a folder that readers skip. Spark commits the list of them, which has
    those of one attempt of each task, and what it lists is then moved by tasks; one that is repeated
    passes over what is in place. An append that fails takes back what it moved.
    """
    spark, this = rows.sparkSession, uuid.uuid4().hex
    staged = f"{root}/_append-{this}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt = f"{task.partitionId():05d}-{task.taskAttemptId()}"
        os.makedirs(f"{staged}/{attempt}", exist_ok=True)
        listed, made = [], 0
        for symbol, parts in groupby(_runs(batches), key=lambda run: run[0]):
            name = f"part-{attempt}-{made}-{this}.snappy.parquet"
            _write(f"{staged}/{attempt}/{name}", parts)
            listed.append((f"{attempt}/{name}", f"{_folder(symbol)}/{name}"))
            made += 1
            if len(listed) == LISTED:
                yield _listed(listed)
                listed = []
        if listed:
            yield _listed(listed)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, target in zip(batch.column("source").to_pylist(), batch.column("target").to_pylist()):
                _move(f"{staged}/{source}", f"{root}/{target}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    def take_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for target in batch.column("target").to_pylist():
                if os.path.exists(f"{root}/{target}"):
                    os.remove(f"{root}/{target}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    def over(files: DataFrame, run) -> int:
        return files.mapInArrow(run, "files long").agg(F.sum("files")).first()[0] or 0

    os.makedirs(root, exist_ok=True)
    with Scratch(spark) as scratch:
        scratch.paths.append(staged)
        files = scratch.stage(rows.mapInArrow(write, "source string, target string"), "appended")
        try:
            moved = over(files, move)
        except BaseException:
            remove_folder(spark, staged)  # first, so that no task still running moves another one
            over(files, take_back)
            raise
    open(f"{root}/_SUCCESS", "w").close()
    return moved
