"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written


def _stars(both: DataFrame, large: bool) -> DataFrame:
    """Connect the neighbours of every node to the smallest node around it.

    ``both`` holds (u, v). The large star moves the neighbours above u, the
    small star those below it and u itself. No neighbourhood is gathered: its
    minimum is a grouped aggregate, joined back to the edges.
    """
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
    moved = both.where("v > u") if large else both
    out = moved.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select("u", "m"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node with an edge (a, b) to another; the root is its component's least node.

    Repeats large and small stars until the edges stay the same. Every round is
    written to the shared folder, so its lineage is short and survives lost
    executors. Self loops and repeated edges are ignored; no edges, no rows.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(ordered.where("a <> b").distinct(), label)
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        seen = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = _stars(both, large=True)
        now = written(_stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), large=False), label)
