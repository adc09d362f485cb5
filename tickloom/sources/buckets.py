"""Price tables in symbol buckets: joins and look-ups on the symbol without moving the stored bars.

A bucketed table is partitioned by month like the others; inside a month the
bars of a symbol lie in one bucket, sorted by symbol and date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import PRICE_COLUMNS, PRICE_KEY
from tickloom.sources import tables as t

BUCKET_ROWS = 1_000_000  # what one task lays out and sorts on an append


def buckets_for(rows: int, least: int = 8) -> int:
    """How many buckets keep each near BUCKET_ROWS bars; a bucket is one task, however many bars it has."""
    return max(least, -(-rows // BUCKET_ROWS))


def create_bucketed(spark: SparkSession, name: str, buckets: int) -> None:
    """An empty bucketed price table, if there is none."""
    kinds = {"symbol": "string", "trade_date": "date", "volume": "bigint"}
    columns = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in PRICE_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {t.MONTH} int) USING parquet PARTITIONED BY ({t.MONTH}) "
        f"CLUSTERED BY (symbol) SORTED BY (symbol, trade_date) INTO {buckets} BUCKETS"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{name} is not bucketed")
    return int(rows[0].data_type)


def append_bucketed(df: DataFrame, name: str) -> int:
    """Append bars; one file for each month and bucket that occurs."""
    n = buckets_of(df.sparkSession, name)
    laid = df.select(*PRICE_COLUMNS, t.month_of().alias(t.MONTH)).repartition(n, "symbol")
    return t.append(laid.sortWithinPartitions(t.MONTH, "symbol", "trade_date"), name)


def new_bars_bucketed(batch: DataFrame, name: str) -> DataFrame:
    """Bars of the batch that the bucketed table lacks.

    The batch is dealt by the table's buckets, so only the batch moves; of the
    stored bars the keys of the batch's months are read where they lie. Repeats
    in the batch stay.
    """
    spark = batch.sparkSession
    months = t.months_in(batch)
    stored = spark.table(name).where(F.col(t.MONTH).isin(months)).select(*PRICE_KEY)
    dealt = batch.repartition(buckets_of(spark, name), "symbol")
    # One row a symbol, with at most the days of the batch's months: joined on the symbol alone, which
    # is what both sides are dealt by. The merge hint keeps a small table from being broadcast.
    days = stored.groupBy("symbol").agg(F.collect_set("trade_date").alias("_days")).hint("merge")
    held = F.coalesce(F.array_contains("_days", F.col("trade_date")), F.lit(False))
    return dealt.join(days, "symbol", "left").where(~held).select(*batch.columns)


def bars_of(spark: SparkSession, name: str, symbol: str) -> DataFrame:
    """One symbol's bars: one bucket of each month is read."""
    return spark.table(name).where(F.col("symbol") == symbol).drop(t.MONTH)
