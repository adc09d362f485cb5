"""Dense positions 1..n in a total order, without a single-task window."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.storage import ready_for_checkpoint

# monotonically_increasing_id() keeps the row's place in its partition in the
# low 33 bits and the partition number above them.
_PLACE_BITS = 33


def with_position(df: DataFrame, *order_by: str | Column, name: str = "position") -> DataFrame:
    """Add the 1-based place of every row in the order of ``order_by``.

    A distributed sort puts consecutive ranges into consecutive partitions; the
    place within the partition plus the sizes of those before it is the
    position. The sorted rows are checkpointed, so both steps see the same
    partitions even if executors are lost. ``order_by`` must be unique for the
    result to be reproducible; pass narrow frames, as the rows are written once.
    """
    ready_for_checkpoint(df.sparkSession)
    ordered = df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_place", _PLACE_BITS)
    # One row per partition: as many as the sort had tasks, not as the data has rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place + 1).alias(name))
    )


def with_position_in(
    df: DataFrame, group: list[str], *order_by: str | Column, name: str = "position"
) -> DataFrame:
    """Add the 1-based place of every row within its group, however large the group."""
    placed = with_position(df, *group, *order_by, name="_overall")
    starts = placed.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(
        F.min("_overall").alias("_start")
    )
    same_group = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group])
    return placed.join(starts, same_group).select(
        *df.columns, (F.col("_overall") - F.col("_start") + 1).alias(name)
    )


def with_running_sum(df: DataFrame, weight: str, *order_by: str | Column, name: str = "running") -> DataFrame:
    """Add the sum of ``weight`` over all rows up to each one, in the order of ``order_by``.

    As ``with_position``: a distributed sort, sums within its partitions, and the
    sums of the partitions before. A NULL weight counts as 0. ``order_by`` must
    be unique for the result to be reproducible; pass narrow frames.
    """
    ready_for_checkpoint(df.sparkSession)
    ordered = df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    own = F.coalesce(F.col(weight), F.lit(0))
    marked = ordered.withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    # One row per partition: as many as the sort had tasks, not as the data has rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy("_part")
        .agg(F.sum(own).alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    # A partition of the sort is one task's share of the rows.
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("_within", F.sum(own).over(within))
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))
    )
