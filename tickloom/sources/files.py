"""Readers for files at a path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.schemas import OHLCV, schema_for


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet under ``path``; a path that does not exist reads as no rows.

    Every other failure, such as unreadable files, is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


# Header names of the public symbol directory, each after ours.
DIRECTORY_HEADER = {
    "symbol": ("symbol", "NASDAQ Symbol"),
    "security_name": ("security_name", "Security Name"),
    "market_category": ("market_category", "Market Category"),
    "etf": ("etf", "ETF"),
    "test_issue": ("test_issue", "Test Issue"),
    "round_lot_size": ("round_lot_size", "Round Lot Size"),
}


def by_header(
    spark: SparkSession, path: str, schema: StructType, names: dict[str, tuple[str, ...]] | None = None, **options
) -> DataFrame:
    """The columns of ``schema`` from delimited text, found by their header names in any order.

    ``names`` gives the header names a column may have. Every file is read as
    text first and cast after; what cannot be cast is NULL. A header without one
    of the columns is an error. All files under the path share one header.
    """
    rows = spark.read.options(header=True, inferSchema=False, enforceSchema=False, **options).csv(path)
    columns = []
    for f in schema:
        found = [n for n in (names or {}).get(f.name, (f.name,)) if n in rows.columns]
        if not found:
            raise ValueError(f"no column {f.name!r} in the header {rows.columns}")
        value = F.col(f"`{found[0]}`")
        columns.append((value if f.dataType.simpleString() == "string" else value.try_cast(f.dataType)).alias(f.name))
    return rows.select(*columns)


def directory_listing(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited symbol directory with a header line, read in parallel by column name."""
    return by_header(spark, path, schema_for("directory"), DIRECTORY_HEADER, sep="|")


def metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Symbol metadata as CSV; a missing file reads as no symbols.

    Timestamps in ``last_update`` are cut to their date. An unquoted empty
    field is NULL and a quoted one is the empty string.
    """
    schema = schema_for("metadata")
    raw = StructType.fromDDL("symbol string, last_update string, sector string")
    try:
        # Only with a null mark of its own does Spark tell "" from an empty field.
        rows = by_header(spark, path, raw, nullValue="\\N", emptyValue="")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)
    day = F.substring("last_update", 1, 10).try_cast("date")
    return rows.select("symbol", day.alias("last_update"), "sector")


def price_csv_tree(spark: SparkSession, root: str) -> DataFrame:
    """One table from ``stocks/<symbol>.csv`` and ``etfs/<symbol>.csv`` under ``root``.

    Folders named ``symbol=<symbol>``, as Spark writes them, and files named so are read too. Kind
    and symbol come from the path, so the files themselves need no key column;
    their columns are found by header name. Symbols are decoded once from the
    path's own escapes, and again below ``symbol=``, where the writer escaped
    them too. A file in neither folder is an error.
    """
    schema = StructType.fromDDL("Date date, Open double, High double, Low double, Close double, Volume bigint")
    place = r"/(stocks|etfs)/(symbol=)?([^/]+?)(?:\.csv|/[^/]*)$"
    reader = spark.read.options(header=True, enforceSchema=False, recursiveFileLookup=True)
    # The header comes from one line: to infer it Spark would list every file by a task of its own.
    lines = spark.read.option("recursiveFileLookup", True).text(root).where("trim(value) <> ''").limit(1).collect()
    if lines:
        names = spark.read.csv(spark.sparkContext.parallelize([lines[0].value], 1), header=True).columns
        reader = reader.schema(StructType([StructField(n, StringType()) for n in names]))
    rows = reader.csv(root)
    missing = [f.name for f in schema if f.name not in rows.columns]
    if missing:
        raise ValueError(f"no columns {missing} in the header {rows.columns}")
    path = F.col("_metadata.file_path")
    kind = F.regexp_extract(path, place, 1)
    plain = _decoded(F.regexp_extract(path, place, 3))
    symbol = F.when(F.regexp_extract(path, place, 2) == "", plain).otherwise(_decoded(plain))
    return rows.select(
        F.when(kind == "", F.raise_error(F.concat(F.lit("neither stocks nor etfs: "), path)).cast("string"))
        .otherwise(kind).alias("kind"),
        symbol.alias("symbol"),
        F.col("Date").try_cast("date").alias("trade_date"),
        *[F.col(c.capitalize()).try_cast(schema[c.capitalize()].dataType).alias(c) for c in OHLCV],
    )


def _decoded(name: Column) -> Column:
    """Percent escapes of a path resolved; a plus sign stays one."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
