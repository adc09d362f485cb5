"""Catalog tables: create, read, write, replace, list.

Tables are parquet. Price tables are partitioned by ``trade_month`` (year and
month as one number), derived from ``trade_date``, and ordered by symbol inside
the files, so a date range prunes folders and a symbol prunes row groups. A
changed bar rewrites its month.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickloom.schemas import PRICE_COLUMNS
from tickloom.sources import by_symbol
from tickloom.sources.files import empty
from tickloom.storage import mounted, remove_folder, shuffles_removed

MONTH = "trade_month"
VERSION = "-version-"


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{at}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partitioned_by: Sequence[str] = (),
    comment: str = "",
    properties: dict[str, str] | None = None,
) -> None:
    """Create a parquet table from a schema, only if it is absent."""
    names = [f.name for f in schema]
    unknown = [c for c in partitioned_by if c not in names]
    if unknown:
        raise ValueError(f"partition columns {unknown} are not in the schema")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partitioned_by:
        parts.append(f"PARTITIONED BY ({', '.join(partitioned_by)})")
    if comment:
        parts.append(f"COMMENT '{_quoted(comment)}'")
    if properties:
        pairs = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({pairs})")
    spark.sql(" ".join(parts))


def with_month(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(MONTH, IntegerType())])


def create_price_table(spark: SparkSession, name: str, schema: StructType) -> None:
    create_table(
        spark,
        name,
        with_month(schema),
        partitioned_by=[MONTH],
        comment="Daily price bars",
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or no rows if there is none; every other failure is raised."""
    try:
        return spark.table(name)
    except AnalysisException as error:
        if error.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise
        return empty(spark, schema)


def prices(spark: SparkSession, name: str) -> DataFrame:
    """A price table without its partition column."""
    return spark.table(name).drop(MONTH)


def prices_in_months(spark: SparkSession, name: str, months: Iterable[int]) -> DataFrame:
    """The bars of some calendar months; only their folders are read."""
    return spark.table(name).where(F.col(MONTH).isin(sorted(months))).drop(MONTH)


def prices_from(spark: SparkSession, name: str, first_day: date) -> DataFrame:
    """The bars from a day on; only the folders of its month and later ones are read."""
    month = first_day.year * 100 + first_day.month
    return spark.table(name).where((F.col(MONTH) >= month) & (F.col("trade_date") >= F.lit(first_day))).drop(MONTH)


def prices_on(spark: SparkSession, name: str, day: date) -> DataFrame:
    """The bars of one day; only its month's folder is read."""
    return prices_in_months(spark, name, [day.year * 100 + day.month]).where(F.col("trade_date") == F.lit(day))


def month_of(day: str = "trade_date") -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def months_in(df: DataFrame, day: str = "trade_date") -> list[int]:
    """The calendar months present: at most twelve values per year of history."""
    months = df.select(month_of(day).alias("m")).where("m is not null").distinct()
    return sorted(row.m for row in months.collect())


def by_month(df: DataFrame) -> DataFrame:
    """Bars laid out for a price table, in its column order.

    Range partitioning spreads a large month over many files and, if one symbol
    fills it, that symbol too; each file covers a narrow range of symbols.
    """
    order = [MONTH, "symbol", "trade_date"]
    return (
        df.select(*PRICE_COLUMNS, month_of().alias(MONTH))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )


def append(df: DataFrame, name: str) -> int:
    """Append rows, matched to the table's columns by name. Returns how many."""
    counted, seen = _counted(df)
    with shuffles_removed(df.sparkSession):
        counted.select(*df.sparkSession.table(name).columns).write.insertInto(name)
    return seen.get["rows"]


def append_nonempty(df: DataFrame, name: str) -> int:
    """Append, but leave the table alone if there is nothing to add.

    An append of no rows adds no file, so the input is run once and not tried
    for emptiness first.
    """
    return append(df, name)


def overwrite_partitions(df: DataFrame, name: str) -> int:
    """Replace the partitions that occur in ``df`` and keep all others.

    ``df`` may be computed from the table: files are written beside the old ones
    and take their place when all are there.
    """
    spark = df.sparkSession
    counted, seen = _counted(df)
    # insertInto takes the mode from the session only, not from a write option.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        with shuffles_removed(spark):
            counted.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return seen.get["rows"]


def location_of(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").collect()
    return rows[-1].data_type.rstrip("/")


def next_version(spark: SparkSession, name: str) -> str:
    """A new folder for a table's rows, beside the one it has now."""
    parent, _, last = location_of(spark, name).rpartition("/")
    return f"{parent}/{last.split(VERSION)[0]}{VERSION}{uuid.uuid4().hex}"


def replace_table(df: DataFrame, name: str, location: str | None = None) -> int:
    """Replace all rows of a table, also by a result computed from that table.

    The rows go to a new version beside the old one and the catalog entry is
    then pointed at it, so readers see the old or the new rows and a failed
    write changes nothing. The old version is deleted after the switch.
    """
    spark = df.sparkSession
    before = location_of(spark, name)
    location = location or next_version(spark, name)
    counted, seen = _counted(df)
    counted.select(*spark.table(name).columns).write.mode("overwrite").parquet(location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    remove_folder(spark, before)
    return seen.get["rows"]


def append_by_symbol(df: DataFrame, path: str) -> None:
    """Append bars to a parquet folder partitioned by symbol.

    Sorted ranges keep the number of files near one per symbol and append, and
    a symbol too large for one task is cut by date. On a mounted file system
    tasks write and move the files themselves, on any other Spark's writer does.
    """
    order = ["symbol", "trade_date"]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    root = mounted(df.sparkSession, path)
    if root is None:
        rows.write.mode("append").partitionBy("symbol").parquet(path)
    else:
        by_symbol.append(rows, root)


def migrate(spark: SparkSession, sources: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write every source table to its own parquet folder; returns name to path.

    A source is any DataFrame, for instance ``spark.read.jdbc``. The loop is over
    table names; each table is read and written in parallel.
    """
    targets = {name: f"{root}/{name}.parquet" for name in sources}
    for name, source in sources.items():
        source.write.mode("overwrite").parquet(targets[name])
    return targets


def table_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders right below ``root`` that hold parquet files, at any depth, by name.

    Names that start with a dot or an underscore are working folders.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if not entry.isDirectory() or name[0] in "._":
            continue
        below = files.listFiles(entry.getPath(), True)
        while below.hasNext():
            if below.next().getPath().getName().endswith(".parquet"):
                found[name] = entry.getPath().toString()
                break
    return found


def register_existing(spark: SparkSession, namespace: str, folders: dict[str, str]) -> None:
    """Make existing parquet folders readable as tables, partitions included."""
    create_namespace(spark, namespace)
    for table, folder in folders.items():
        name = f"{namespace}.{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{folder}'")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Namespace and name of every permanent table."""
    return (
        spark.sql(f"SHOW TABLES IN {namespace}")
        .where(~F.col("isTemporary"))
        .select("namespace", F.col("tableName").alias("table_name"))
    )


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
