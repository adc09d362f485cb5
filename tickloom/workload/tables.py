"""Scans, sinks and catalog tables: written below the shared folder and read back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tickloom.operators import digest
from tickloom.operators.relational import clean_rows, normalize_prices, union_all
from tickloom.schemas import OHLCV, PRICE_COLUMNS, schema_for
from tickloom.sources import buckets, files, ledger, provider
from tickloom.sources import tables as t
from tickloom.storage import Scratch, fresh_path
from tickloom.workload import fixtures as fx
from tickloom.workload.registry import query

COMMITTED_AT = datetime(2001, 1, 2, 18, 0)
LATER = datetime(2001, 1, 3, 18, 0)
TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(count(*) AS bigint) AS row_count FROM {name}" for name in TPCH
)


def new_namespace(spark) -> str:
    """A namespace no other query uses, in the shared folder."""
    name = f"tickloom_{uuid.uuid4().hex}"
    t.create_namespace(spark, name, fresh_path(spark, name))
    return name


def price_table(spark, *loads) -> str:
    """A new price table with the given frames appended."""
    name = f"{new_namespace(spark)}.stock_prices"
    t.create_price_table(spark, name, schema_for("stock_prices"))
    for load in loads:
        t.append(t.by_month(load), name)
    return name


def counts(spark, tables) -> list:
    """One (label, count) frame per table, labelled by its bare name."""
    return [
        spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name.split(".")[-1]).alias("table_name"), "row_count"
        )
        for name in tables
    ]


# -- files -------------------------------------------------------------------


@query("scan_parquet_or_empty", "SELECT * FROM bars")
def scan_parquet_or_empty(spark, sf):
    path, schema = fresh_path(spark, "scan"), schema_for("stock_prices")
    fx.bars(spark, sf).write.parquet(path)
    present = files.parquet_or_empty(spark, path, schema)
    return union_all(present, files.parquet_or_empty(spark, path + "-missing", schema))


@query("scan_directory_psv", "SELECT * FROM directory")
def scan_directory_psv(spark, sf):
    path = fresh_path(spark, "directory")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fx.provider_directory(spark, sf).write.options(**keep).csv(path, sep="|", header=True)
    return files.directory_listing(spark, path)


@query("scan_metadata_csv", "SELECT * FROM metadata")
def scan_metadata_csv(spark, sf):
    path = fresh_path(spark, "metadata")
    fx.metadata(spark, sf).select("symbol", "sector", "last_update").write.csv(path, header=True)
    present = files.metadata_csv(spark, path)
    return union_all(present, files.metadata_csv(spark, path + "-missing"))


@query(
    "csv_tree_to_table",
    """SELECT CASE WHEN l.is_etf THEN 'etfs' ELSE 'stocks' END AS kind, b.symbol || ' ^A+%' AS symbol, b.trade_date,
              b.open, b.high, b.low, b.close, b.volume
       FROM bars AS b JOIN listing AS l ON b.symbol = l.symbol""",
)
def csv_tree_to_table(spark, sf):
    from tickloom.workload.relational import listing

    root, target = fresh_path(spark, "tree"), fresh_path(spark, "prices")
    # The provider's column order, and a space and a caret in every name.
    order = ["close", "high", "low", "open", "volume"]
    named = fx.bars(spark, sf).select(
        "symbol", F.col("trade_date").alias("Date"), *[F.col(c).alias(c.capitalize()) for c in order]
    )
    flagged = named.join(listing(spark, sf).select("symbol", "is_etf"), "symbol")
    flagged = flagged.withColumn("symbol", F.concat("symbol", F.lit(" ^A+%")))
    for kind, etf in (("stocks", False), ("etfs", True)):
        part = flagged.where(F.col("is_etf") == etf).drop("is_etf").repartitionByRange("symbol")
        provider.write_by_symbol(part.sortWithinPartitions("symbol", "Date"), f"{root}/{kind}", "csv")
    with Scratch(spark) as scratch:
        # Ranges are found from a first pass over the rows: each file of the tree is opened once.
        tree = scratch.stage(files.price_csv_tree(spark, root), "tree-rows")
        tree.repartitionByRange("kind", "symbol", "trade_date").write.partitionBy("kind").parquet(target)
    return spark.read.parquet(target).select("kind", *PRICE_COLUMNS)


@query("sink_partitioned_append", "SELECT * FROM bars")
def sink_partitioned_append(spark, sf):
    path = fresh_path(spark, "by-symbol")
    bars, cut = fx.bars(spark, sf), F.lit(fx.STORED_BEFORE)
    t.append_by_symbol(bars.where(F.col("trade_date") < cut), path)
    t.append_by_symbol(bars.where(F.col("trade_date") >= cut), path)
    return files.parquet_or_empty(spark, path, schema_for("stock_prices"))


@query("migrate_tables", COUNTS_SQL)
def migrate_tables(spark, sf):
    sources = {name: fx.table(spark, sf, name) for name in TPCH}
    targets = t.migrate(spark, sources, fresh_path(spark, "migrated"))
    return union_all(
        *[
            spark.read.parquet(path)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count")
            for name, path in targets.items()
        ]
    )


@query(
    "migrate_verified",
    """SELECT 'orders' AS table_name, CAST(part AS varchar) AS part, n AS rows_source, n + (part = changed - 3)::int AS rows_target,
              part NOT IN (changed, changed - 3) AS is_equal
       FROM (SELECT CAST(floor(o_orderkey / 100) AS bigint) AS part, CAST(count(*) AS bigint) AS n FROM orders GROUP BY 1),
            (SELECT CAST(floor(max(o_orderkey) / 100) AS bigint) - 3 AS changed FROM orders)
       UNION ALL
       SELECT 'customer', CAST(CAST(floor(c_custkey / 1000) AS bigint) AS varchar), count(*), count(*), true
       FROM customer GROUP BY floor(c_custkey / 1000)""",
)
def migrate_verified(spark, sf):
    """Two tables; in the copy of one, a row is changed in one key range and one repeated in another."""
    sources = {name: fx.table(spark, sf, name) for name in ("orders", "customer")}
    parts = {"orders": F.floor(F.col("o_orderkey") / 100), "customer": F.floor(F.col("c_custkey") / 1000)}
    targets, report = digest.migrate_verified(spark, sources, fresh_path(spark, "verified"), parts)
    changed = sources["orders"].agg(F.floor(F.max("o_orderkey") / 100)).first()[0] - 3
    copy = spark.read.parquet(targets["orders"])
    in_part = copy.where(parts["orders"] == changed).agg(F.max("o_orderkey")).first()[0]
    planted = copy.withColumn("o_orderpriority", F.when(F.col("o_orderkey") != in_part, F.col("o_orderpriority")))
    other = copy.where(parts["orders"] == changed - 3).orderBy("o_orderkey").limit(1)
    again = digest.verified(sources["orders"], planted.unionByName(other), parts["orders"])
    named = again.select(F.lit("orders").alias("table_name"), F.col("part").cast("string").alias("part"), "rows_source", "rows_target", "is_equal")
    return named.unionByName(report.where("table_name = 'customer'"))


@query(
    "new_bars_bucketed",
    """SELECT c.symbol, c.trade_date, c.open, c.high, c.low, c.close, c.volume FROM clean_incoming AS c
       WHERE NOT EXISTS (SELECT 1 FROM stored_prices AS s WHERE s.symbol = c.symbol AND s.trade_date = c.trade_date)""",
)
def new_bars_bucketed(spark, sf):
    name = f"{new_namespace(spark)}.bucketed"
    with Scratch(spark) as scratch:
        # Counted before the table is made: its number of buckets is for good.
        stored = scratch.stage(fx.stored_prices(spark, sf), "stored")
        buckets.create_bucketed(spark, name, buckets.buckets_for(stored.count()))
        buckets.append_bucketed(stored, name)
    return buckets.new_bars_bucketed(normalize_prices(clean_rows(fx.incoming(spark, sf), "dt"), "dt"), name)


# -- tables ------------------------------------------------------------------


@query("scan_table_or_empty", "SELECT * FROM bars")
def scan_table_or_empty(spark, sf):
    name, schema = price_table(spark, fx.bars(spark, sf)), schema_for("stock_prices")
    present = t.table_or_empty(spark, name, schema).drop(t.MONTH)
    return union_all(present, t.table_or_empty(spark, name + "_missing", schema))


@query("sink_append", "SELECT * FROM bars")
def sink_append(spark, sf):
    bars, cut = fx.bars(spark, sf), F.lit(fx.STORED_BEFORE)
    old, new = bars.where(F.col("trade_date") < cut), bars.where(F.col("trade_date") >= cut)
    return t.prices(spark, price_table(spark, old, new))


@query(
    "sink_overwrite_partitions",
    """SELECT symbol, trade_date, open, high, low, close,
              CASE WHEN year(trade_date) = 2000 THEN volume + 1 ELSE volume END AS volume FROM bars""",
)
def sink_overwrite_partitions(spark, sf):
    bars = fx.bars(spark, sf)
    name = price_table(spark, bars)
    changed = bars.where(F.year("trade_date") == 2000).withColumn("volume", F.col("volume") + 1)
    t.overwrite_partitions(t.by_month(changed), name)
    return t.prices(spark, name)


@query(
    "sink_full_replace",
    "SELECT symbol, DATE '2001-01-02' AS last_update, sector FROM metadata WHERE sector <> ''",
)
def sink_full_replace(spark, sf):
    name = f"{new_namespace(spark)}.metadata"
    t.create_table(spark, name, schema_for("metadata"))
    t.append(fx.metadata(spark, sf), name)
    known = spark.table(name).where("sector <> ''").withColumn("last_update", F.lit(fx.RUN_DATE))
    t.replace_table(known, name)
    return spark.table(name)


@query("sink_append_nonempty", "SELECT * FROM bars")
def sink_append_nonempty(spark, sf):
    bars = fx.bars(spark, sf)
    name = price_table(spark)
    t.append_nonempty(t.by_month(bars.where("symbol is null")), name)
    t.append_nonempty(t.by_month(bars), name)
    return t.prices(spark, name)


@query(
    "create_table_from_schema",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, {part} AS is_partition,
                   CAST(count({value}) AS bigint) AS filled FROM bars"""
        for i, (c, kind, part, value) in enumerate(
            [
                ("symbol", "string", "false", "symbol"),
                ("trade_date", "date", "false", "trade_date"),
                *[(c, "double", "false", c) for c in OHLCV[:4]],
                ("volume", "bigint", "false", "volume"),
                ("trade_month", "int", "true", "trade_date"),
            ]
        )
    ),
)
def create_table_from_schema(spark, sf):
    name = price_table(spark, fx.bars(spark, sf))
    listed = spark.catalog.listColumns(name)
    columns = spark.createDataFrame(
        [(i, c.name, c.dataType, c.isPartition) for i, c in enumerate(listed)],
        "position int, column_name string, data_type string, is_partition boolean",
    )
    table = spark.table(name)
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot(
        [], table.columns, "column_name", "filled"
    )
    return columns.join(filled, "column_name")


def _loaded_tables(spark, sf) -> str:
    """A namespace holding the nation, supplier and orders tables."""
    namespace = new_namespace(spark)
    for name in ("nation", "supplier", "orders"):
        source = fx.table(spark, sf, name)
        t.create_table(spark, f"{namespace}.{name}", source.schema)
        t.append(source, f"{namespace}.{name}")
    return namespace


def _listed_counts(spark, namespace):
    listed = t.list_tables(spark, namespace)
    names = [f"{namespace}.{row.table_name}" for row in listed.collect()]
    return listed.select("table_name").join(union_all(*counts(spark, names)), "table_name")


def _counts_sql(*names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(count(*) AS bigint) AS row_count FROM {n}" for n in names
    )


@query("drop_table", _counts_sql("nation", "supplier"))
def drop_table(spark, sf):
    namespace = _loaded_tables(spark, sf)
    t.drop_table(spark, f"{namespace}.orders")
    t.drop_table(spark, f"{namespace}.never_there")
    return _listed_counts(spark, namespace)


@query("list_tables", _counts_sql("nation", "supplier", "orders"))
def list_tables(spark, sf):
    return _listed_counts(spark, _loaded_tables(spark, sf))


@query(
    "register_existing",
    _counts_sql("supplier") + " UNION ALL SELECT 'stored', CAST(count(*) AS bigint) FROM bars",
)
def register_existing(spark, sf):
    root, namespace = fresh_path(spark, "existing"), new_namespace(spark)
    fx.table(spark, sf, "supplier").write.parquet(f"{root}/supplier")
    stored = fx.bars(spark, sf).withColumn(t.MONTH, t.month_of())
    stored.repartitionByRange(t.MONTH, "symbol", "trade_date").write.partitionBy(t.MONTH).parquet(f"{root}/stored")
    t.register_existing(spark, namespace, t.table_folders(spark, root))
    return _listed_counts(spark, namespace)


# -- ledger ------------------------------------------------------------------


def _recorded_loads(spark, sf) -> str:
    """Two price loads and a metadata load, noted in a ledger; returns its name."""
    namespace = new_namespace(spark)
    prices, metadata, book = (f"{namespace}.{n}" for n in ("stock_prices", "metadata", "load_ledger"))
    t.create_price_table(spark, prices, schema_for("stock_prices"))
    t.create_table(spark, metadata, schema_for("metadata"))
    ledger.create_ledger(spark, book)
    bars, cut = fx.bars(spark, sf), F.lit(fx.STORED_BEFORE)
    added = t.append(t.by_month(bars.where(F.col("trade_date") < cut)), prices)
    ledger.record(spark, book, "append", "stock_prices", added, COMMITTED_AT)
    added = t.replace_table(fx.metadata(spark, sf), metadata)
    ledger.record(spark, book, "replace", "metadata", added, COMMITTED_AT)
    added = t.append(t.by_month(bars.where(F.col("trade_date") >= cut)), prices)
    ledger.record(spark, book, "append", "stock_prices", added, LATER)
    return book


@query(
    "load_ledger",
    """SELECT CAST(1 AS bigint) AS snapshot_id, TIMESTAMP '2001-01-02 18:00:00' AS committed_at,
              'append' AS operation, 'stock_prices' AS table_name, CAST(count(*) AS bigint) AS added_rows
       FROM stored_prices
       UNION ALL SELECT 2, TIMESTAMP '2001-01-02 18:00:00', 'replace', 'metadata', count(*) FROM metadata
       UNION ALL SELECT 3, TIMESTAMP '2001-01-03 18:00:00', 'append', 'stock_prices', count(*)
       FROM bars WHERE trade_date >= DATE '2000-01-01'""",
)
def load_ledger(spark, sf):
    return spark.table(_recorded_loads(spark, sf))


@query(
    "load_ledger_current",
    """SELECT 'stock_prices' AS table_name, CAST(3 AS bigint) AS current_snapshot_id,
              TIMESTAMP '2001-01-03 18:00:00' AS committed_at, CAST(2 AS bigint) AS snapshots,
              CAST((SELECT count(*) FROM bars) AS bigint) AS added_rows
       UNION ALL SELECT 'metadata', 2, TIMESTAMP '2001-01-02 18:00:00', 1,
              CAST((SELECT count(*) FROM metadata) AS bigint)""",
)
def load_ledger_current(spark, sf):
    return ledger.current_snapshot(spark.table(_recorded_loads(spark, sf)))
