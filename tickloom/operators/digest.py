"""Order-free digests of tables, to prove that two hold the same rows or find where they differ."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.tables import migrate

_WIDE = "decimal(38,0)"


def table_digest(df: DataFrame, part: Column) -> DataFrame:
    """(part, row_count, digest, check): sums of two hashes of the rows, for each key range ``part``.

    Sums do not depend on the order or the layout of rows, and digests of parts
    of a table add up. Repeated rows count. Two rows that differ in a NULL have
    different hashes. Columns are taken by name, in any order.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    nulls = F.concat(*[c.isNull().cast("string") for c in columns])
    one, two = F.xxhash64(*columns, nulls), F.xxhash64(nulls, *columns, F.lit(1))
    return df.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(one.cast(_WIDE)).alias("digest"), F.sum(two.cast(_WIDE)).alias("check")
    )


def merged_digests(*digests: DataFrame) -> DataFrame:
    """The digest of the union of tables."""
    rows = reduce(DataFrame.unionByName, digests)
    return rows.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("row_count", "digest", "check")])


def compared(one: DataFrame, other: DataFrame) -> DataFrame:
    """(part, rows_source, rows_target, is_equal) of two digests; a part that one side lacks has no rows there."""
    a, b = one.alias("a"), other.alias("b")
    same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("row_count", "digest", "check")])
    return a.join(b, F.col("a.part").eqNullSafe(F.col("b.part")), "full").select(
        F.coalesce("a.part", "b.part").alias("part"),
        F.coalesce("a.row_count", F.lit(0)).alias("rows_source"),
        F.coalesce("b.row_count", F.lit(0)).alias("rows_target"),
        same.alias("is_equal"),
    )


def verified(source: DataFrame, target: DataFrame, part: Column) -> DataFrame:
    """Where two tables differ, by key range; only one row for each range is compared."""
    return compared(table_digest(source, part), table_digest(target, part))


def migrate_verified(
    spark: SparkSession, sources: dict[str, DataFrame], root: str, parts: dict[str, Column]
) -> tuple[dict[str, str], DataFrame]:
    """Migrate tables and compare what was written with its source.

    Returns the paths, and (table_name, part, rows_source, rows_target,
    is_equal). ``parts`` maps each table to its key ranges.
    """
    targets = migrate(spark, sources, root)
    reports = [
        verified(source, spark.read.parquet(targets[name]), parts[name]).select(
            F.lit(name).alias("table_name"), F.col("part").cast("string").alias("part"), "rows_source", "rows_target", "is_equal"
        )
        for name, source in sources.items()
    ]
    return targets, reduce(DataFrame.unionByName, reports)
