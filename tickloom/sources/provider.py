"""A provider of bars as a Spark data source.

Requests (a few symbols and the day from which on they are wanted) are planned
as a table and become the partitions of the scan: each is fetched by one task,
retried there, and reported row by row if it keeps failing. Of a plan of more
than ``MAX_TASKS`` requests a task fetches several, one after the other. Filters on symbol
and day reach the provider. As a stream the source fetches every plan once; its
offset is the name of the last plan.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from tickloom.operators.enrich import MAX_ATTEMPTS

# Tasks get the source by value, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BARS = "symbol string, dt date, open double, high double, low double, close double, volume bigint"
MAX_TASKS = 256  # a task costs more than a small request
REPORT = "request_no int, status string, attempts int, error string"
_ARROW = pa.schema([
    ("symbol", pa.string()), ("dt", pa.date32()), *[(c, pa.float64()) for c in ("open", "high", "low", "close")],
    ("volume", pa.int64()), ("request_no", pa.int32()), ("status", pa.string()), ("attempts", pa.int32()), ("error", pa.string()),
])


@dataclass
class Request(InputPartition):
    """What one task asks a provider for: rows of ``symbols`` after ``after``, from ``first`` to ``last``.

    None is no bound. ``attempt`` counts from 1.
    """

    request_no: int
    symbols: tuple[str, ...]
    after: date | None
    first: date | None = None
    last: date | None = None
    attempt: int = 1


@dataclass
class Requests(InputPartition):
    """What one task fetches."""

    requests: tuple[Request, ...]


Fetch = Callable[[Request], pa.Table]


def _dealt(requests: Sequence[Request]) -> list[Requests]:
    n = min(len(requests), MAX_TASKS)
    return [Requests(tuple(requests[i::n])) for i in range(n)]


def write_plan(requests: DataFrame, folder: str, name: str) -> None:
    """Store requests (request_no, symbols, after) as the plan ``name``; later plans need greater names."""
    requests.select(
        F.col("request_no").cast("int").alias("request_no"), "symbols", F.col("after").cast("date").alias("after")
    ).write.mode("overwrite").parquet(f"{folder}/{name}")


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


def _plans(folder: str) -> list[str]:
    files, at = _files(folder)
    found = files.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory)


def _requests(folder: str, plans: Iterable[str]) -> list[Request]:
    """As many as there are requests: a plan has one row for each, not one for each symbol."""
    files, at = _files(folder)
    rows = [
        row for plan in plans for row in pads.dataset(f"{at}/{plan}", filesystem=files, format="parquet").to_table().to_pylist()
    ]
    return [Request(r["request_no"], tuple(r["symbols"]), r["after"]) for r in rows]


def _rows(fetch: Fetch, request: Request, attempts: int) -> Iterator[pa.RecordBatch]:
    error, table, made = None, None, 0
    while table is None and made < attempts:
        made += 1
        try:
            table = fetch(replace(request, attempt=made))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
    names = _ARROW.names[:7]
    status = "failed" if table is None else "ok"
    if table is None:
        table = pa.table({"symbol": list(request.symbols)})
    n = table.num_rows
    columns = [table[c].cast(_ARROW.field(c).type) if c in table.column_names else pa.nulls(n, _ARROW.field(c).type) for c in names]
    said = [request.request_no, status, made, error]
    columns += [pa.array([x] * n, _ARROW.field(c).type) for c, x in zip(_ARROW.names[7:], said)]
    yield from pa.table(columns, schema=_ARROW).to_batches(max_chunksize=10_000)


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, options: dict[str, str]):
        self.fetch, self.folder = fetch, options["requests"]
        self.attempts = int(options.get("attempts", MAX_ATTEMPTS))
        self.symbols: set[str] | None = None
        self.first: date | None = None
        self.last: date | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("symbol",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.symbols = wanted if self.symbols is None else self.symbols & wanted
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("dt",):
                self.first = max(filter(None, (self.first, f.value)))
                if isinstance(f, GreaterThan):
                    yield f  # the day itself is fetched and left to Spark
            elif isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("dt",):
                self.last = min(filter(None, (self.last, f.value)))
                if isinstance(f, LessThan):
                    yield f
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        found = []
        for r in _requests(self.folder, _plans(self.folder)):
            symbols = r.symbols if self.symbols is None else tuple(s for s in r.symbols if s in self.symbols)
            if symbols:
                found.append(replace(r, symbols=symbols, first=self.first, last=self.last))
        return _dealt(found) or [Requests(())]

    def read(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        for request in partition.requests:
            yield from _rows(self.fetch, request, self.attempts)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, fetch: Fetch, options: dict[str, str]):
        self.fetch, self.folder = fetch, options["requests"]
        self.attempts = int(options.get("attempts", MAX_ATTEMPTS))

    def initialOffset(self) -> dict:
        return {"plan": ""}

    def latestOffset(self) -> dict:
        return {"plan": max(_plans(self.folder), default="")}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _dealt(_requests(self.folder, [p for p in _plans(self.folder) if start["plan"] < p <= end["plan"]]))

    def read(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        for request in partition.requests:
            yield from _rows(self.fetch, request, self.attempts)


def register(spark: SparkSession, name: str, fetch: Fetch) -> None:
    """Make ``spark.read.format(name)`` and ``readStream`` fetch through ``fetch``.

    Option ``requests`` names the folder of plans, ``attempts`` the calls for a
    request. A request that fails every time gives one row a symbol with NULL
    values; ``status``, ``attempts`` and ``error`` say how each request went.
    """

    class Provider(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"{BARS}, {REPORT}"

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(fetch, self.options)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _StreamReader(fetch, self.options)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Provider)


def write_by_symbol(rows: DataFrame, folder: str, ending: str = "parquet") -> None:
    """Write rows as a provider lands them: Parquet in folders ``symbol=NAME``, or CSV files ``symbol=NAME.csv``.

    Rows come sorted by symbol within their partitions; for CSV, whose names are escaped, all rows of a
    symbol lie in one. A task writes the files of its symbols itself and a repeated one replaces them:
    Spark's committer moves every file and sets the rights of each by a process of its own, which is
    not made for a file a symbol.
    """

    def opened(symbol: str | None, schema: pa.Schema) -> tuple[pa.NativeFile, pq.ParquetWriter | pacsv.CSVWriter]:
        files, at = _files(folder)
        label = "__HIVE_DEFAULT_PARTITION__" if symbol is None else symbol
        if ending == "csv":
            out = files.open_output_stream(f"{at}/symbol={quote(label, safe='')}.csv")
            return out, pacsv.CSVWriter(out, schema)
        files.create_dir(f"{at}/symbol={label}", recursive=True)
        out = files.open_output_stream(f"{at}/symbol={label}/part-{TaskContext.get().partitionId():05d}.{ending}")
        return out, pq.ParquetWriter(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, out, made = None, None, 0
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("symbol"))
            own = batch.drop_columns(["symbol"])
            # Where the next row has another symbol; NULL differs from all but NULL.
            known = pc.fill_null(names, ""), pc.is_null(names)
            new = [pc.not_equal(c[1:], c[:-1]) for c in known]
            ends = [*pc.indices_nonzero(pc.or_(*new)).to_pylist(), batch.num_rows - 1] if batch.num_rows else []
            start = 0
            for end in ends:
                if out is None or names[end].as_py() != symbol:
                    if out is not None:
                        writer.close(), out.close()
                    symbol = names[end].as_py()
                    out, writer = opened(symbol, own.schema)
                    made += 1
                writer.write_batch(own.slice(start, end + 1 - start))
                start = end + 1
        if out is not None:
            writer.close(), out.close()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], names=["files"])

    files, at = _files(folder)
    files.create_dir(at, recursive=True)
    rows.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def landed_files(folder: str) -> Fetch:
    """A provider that answers from files landed in folders by symbol (``symbol=NAME``)."""

    def fetch(request: Request) -> pa.Table:
        files, at = _files(folder)
        parts = []
        bounds = [pads.field("dt") > request.after] if request.after else []
        bounds += [pads.field("dt") >= request.first] if request.first else []
        bounds += [pads.field("dt") <= request.last] if request.last else []
        for symbol in request.symbols:
            path = f"{at}/symbol={symbol}"
            if files.get_file_info(path).type != pafs.FileType.Directory:
                continue
            kept = None
            for b in bounds:
                kept = b if kept is None else kept & b
            rows = pads.dataset(path, filesystem=files, format="parquet").to_table(filter=kept)
            parts.append(rows.append_column("symbol", pa.array([symbol] * rows.num_rows, pa.string())))
        return pa.concat_tables(parts) if parts else pa.table({"symbol": pa.array([], pa.string())})

    return fetch
