"""The price model laid over the test tables.

Symbol = supplier, day = ship date, tick = line item. ``FIXTURES.md`` states
each table; every function takes the session and the folder of one scale.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.positions import with_position
from tickloom.schemas import OHLCV

RUN_DATE = date(2001, 1, 2)
STORED_BEFORE = date(2000, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _symbol(key: str) -> Column:
    return F.concat(F.lit("SUP"), F.col(key).cast("string"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    arrival = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"))
        .agg(
            F.min_by(price, arrival).alias("open"),
            F.max(price * (1 + F.col("l_tax"))).alias("high"),
            F.min(price * (1 - F.col("l_discount"))).alias("low"),
            F.max_by(price, arrival).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(_symbol("l_suppkey").alias("symbol"), "trade_date", *OHLCV)
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    nation = F.col("s_nationkey") % 3
    return table(spark, sf_dir, "supplier").select(
        _symbol("s_suppkey").alias("symbol"),
        F.col("s_name").alias("security_name"),
        F.when(nation == 0, "Q").when(nation == 1, "G").otherwise("S").alias("market_category"),
        F.when(key % 17 == 16, " ").when(key % 5 == 0, "Y").otherwise("N").alias("etf"),
        F.when(key % 11 == 10, "Y").otherwise("N").alias("test_issue"),
        F.lit(100).alias("round_lot_size"),
    )


def provider_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directory under the public file's twelve headers, in its order (fixed values)."""
    c, lit = F.col, F.lit
    return directory(spark, sf_dir).select(
        lit("Y").alias("Nasdaq Traded"), lit("other").alias("Symbol"), c("security_name").alias("Security Name"),
        lit("N").alias("Listing Exchange"), c("market_category").alias("Market Category"), c("etf").alias("ETF"),
        c("round_lot_size").alias("Round Lot Size"), c("test_issue").alias("Test Issue"),
        lit("N").alias("Financial Status"), lit("cqs").alias("CQS Symbol"), c("symbol").alias("NASDAQ Symbol"),
        lit("N").alias("NextShares"),
    )


def _supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # TPC-H fixes nation at 25 rows and region at 5, whatever the scale.
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.expr("n_regionkey = r_regionkey")
    )
    return table(spark, sf_dir, "supplier").join(
        F.broadcast(nation), F.expr("s_nationkey = n_nationkey")
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        _supplier_regions(spark, sf_dir)
        .where(key % 4 != 3)
        .select(
            _symbol("s_suppkey").alias("symbol"),
            F.when(key % 13 == 12, None)
            .when(key % 3 == 0, F.lit(date(2001, 1, 1)))
            .otherwise(F.lit(RUN_DATE))
            .alias("last_update"),
            F.when(key % 3 == 0, None).when(key % 3 == 1, "").otherwise(F.col("r_name")).alias("sector"),
        )
    )


def sector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _supplier_regions(spark, sf_dir).select(
        _symbol("s_suppkey").alias("symbol"),
        F.when(key % 2 == 0, F.col("r_name")).when(key % 6 == 1, "").alias("sector"),
    )


def stored_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).where(F.col("trade_date") < F.lit(STORED_BEFORE))


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batch: lower-case symbols, overlap, all-null rows, copies, null dates."""
    day = F.col("trade_date")
    blank = F.col("volume") % 10 == 0

    def copy(dt: Column, is_blank: Column) -> Column:
        return F.struct(dt.alias("dt"), is_blank.alias("is_blank"))

    plain = F.lit(False)
    copies = F.concat(
        F.array(copy(day, blank)),
        F.when(
            (day >= F.lit(date(2000, 12, 1))) & (day < F.lit(date(2001, 1, 1))),
            F.array(copy(day, plain)),
        ).otherwise(F.array().cast("array<struct<dt:date,is_blank:boolean>>")),
        F.when(
            day == F.lit(date(2000, 6, 1)), F.array(copy(F.lit(None).cast("date"), plain))
        ).otherwise(F.array().cast("array<struct<dt:date,is_blank:boolean>>")),
    )
    return (
        bars(spark, sf_dir)
        .where(day >= F.lit(date(1999, 7, 1)))
        .select(F.lower("symbol").alias("symbol"), F.explode(copies).alias("copy"), *OHLCV)
        .select(
            "symbol",
            F.col("copy.dt").alias("dt"),
            *[F.when(~F.col("copy.is_blank"), F.col(c)).alias(c) for c in OHLCV],
        )
    )


def dirty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with bad values by symbol ending, some without a symbol; ``seq`` is the arrival order."""
    base = bars(spark, sf_dir)
    ends = F.col("symbol").endswith
    # One symbol has at most one bar a day.
    offset = F.datediff("trade_date", F.lit(date(1995, 1, 1)))
    arrival = F.when(ends("9"), -offset).otherwise(offset)
    return base.select(
        F.when(F.col("volume") % 13 != 0, F.col("symbol")).alias("symbol"),
        F.col("trade_date").alias("dt"),
        F.when(F.col("volume") % 7 != 0, F.col("open")).alias("open"),
        "high",
        "low",
        F.when(ends("3"), -F.col("close")).otherwise(F.col("close")).alias("close"),
        F.when(ends("6"), F.lit(-1).cast("bigint")).otherwise(F.col("volume")).alias("volume"),
        F.row_number().over(Window.partitionBy("symbol").orderBy(arrival)).alias("seq"),
    )


GRID_SIZE = 50


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All symbols in blocks of GRID_SIZE, each with its slot in its block: the grids a provider would send."""
    names = directory(spark, sf_dir).select("symbol").where("symbol IS NOT NULL").distinct()
    place = F.col("position") - 1
    return with_position(names, "symbol").select(
        "symbol", F.floor(place / GRID_SIZE).alias("grid"), (place % GRID_SIZE).cast("int").alias("slot")
    )


def wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider-style grids: one row a grid and day, one column per (slot, field), ``names`` from slot to ticker.

    All grids have the same columns, so their number is one of rows and not of plans.
    """
    places = tickers(spark, sf_dir)
    slot = F.col("slot")
    cells = [
        F.max(F.when(slot == i, F.col(c))).alias(f"{i}_{c}")
        for i in range(GRID_SIZE)
        for c in ("close", "volume")
    ]
    # Dealt before it is grouped: a wide row for every bar would be moved otherwise.
    laid = bars(spark, sf_dir).join(places, "symbol").repartition("grid", "trade_date")
    name = F.struct(slot.cast("string").alias("slot"), "symbol")
    names = places.groupBy("grid").agg(F.map_from_entries(F.collect_list(name)).alias("names"))
    return laid.groupBy("grid", "trade_date").agg(*cells).join(names, "grid").drop("grid")


def patchy_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of which some lack the close and some the volume."""
    return bars(spark, sf_dir).withColumns({
        "close": F.when(F.col("volume") % 23 != 0, F.col("close")),
        "volume": F.when(F.col("volume") % 19 != 0, F.col("volume")),
    })


def trading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stored_prices(spark, sf_dir).select("trade_date").distinct()
    return with_position(days, "trade_date", name="date_id").select(
        F.col("date_id").cast("int").alias("date_id"), "trade_date"
    )


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = (
        directory(spark, sf_dir)
        .where(F.col("test_issue") == "N")
        .join(metadata(spark, sf_dir).select("symbol"), "symbol", "left_semi")
        .select("symbol", (F.col("etf") == "Y").alias("is_etf"))
    )
    return with_position(known, "symbol", name="symbol_id").select(
        F.col("symbol_id").cast("int").alias("symbol_id"), "symbol", "is_etf"
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .select(day.alias("holiday"))
        .where((F.month("holiday") == 12) & F.dayofmonth("holiday").isin(24, 25))
        .distinct()
    )
