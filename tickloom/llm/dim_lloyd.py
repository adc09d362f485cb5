"""Centroid clustering: Lloyd's rounds with the dimensions dealt over shards.

Vectors are cut into blocks of BLOCK components, and the blocks of one column
range are stored together. A task reads one column block, knows only that
block's slice of the centroids, and computes exact partial distances of its
pieces to all of them. Partial distances are added by row (a sum per key) and
the row takes the smallest. The row's cluster goes back to its pieces, and each
column block adds up its own slice of the new centroids. No task holds a whole
vector, and what a round sends to all tasks is k centroids.

All numbers are whole, so sums do not depend on their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import received, shared, travels, written
from tickloom.storage import Scratch

travels(__name__)

K = 16
ROUNDS = 3
WIDTH = 64
BLOCK = 16
SCALE = 64
_LARGEST = 1 << 27  # of a component: WIDTH squared differences of such stay below 2 ** 63


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH) -> DataFrame:
    """(row, vec_id, vector): floor(SCALE x) of each component of the vectors with ``width`` finite components.

    Every such row has its own number, so repeated ids and repeated rows stay
    apart; a null id is kept. Other rows take no part.
    """
    x = F.col(vector_col)

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    usable = table.where(x.isNotNull() & (F.size(x) == width) & F.forall(x, finite))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), scaled.alias("vector"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = 1) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``; equal ids by their vectors, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k)
    return [r.vector for r in first.collect()]


def _partial(handle, k: int):
    """Squared distances of each piece to its block's slice of every centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = received(handle)
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column(1).to_numpy(zero_copy_only=False)
            pieces = batch.column(2)
            out = np.empty((batch.num_rows, k), dtype=np.int64)
            for block in np.unique(blocks):
                at = np.nonzero(blocks == block)[0]
                centroids = slices[int(block)]
                values = pieces.take(pa.array(at)).flatten().to_numpy().reshape(len(at), centroids.shape[1])
                for j in range(k):
                    out[at, j] = ((values - centroids[j]) ** 2).sum(axis=1)
            columns = [pa.array(out[:, j]) for j in range(k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *[f"d{j}" for j in range(k)]])

    return run


def _assigned(pieces: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(row, cluster, distance): partial distances added by row, the smallest taken, ties to the smaller number."""
    k, width = centroids.shape
    slices = {b: centroids[:, b * block : (b + 1) * block] for b in range(-(-width // block))}
    handle = shared(pieces.sparkSession, slices)
    names = [f"d{j}" for j in range(k)]
    schema = ", ".join(["row long", *[f"{n} long" for n in names]])
    partial = pieces.select("row", "block", "piece").mapInArrow(_partial(handle, k), schema)
    added = partial.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    least = F.least(*names) if k > 1 else F.col(names[0])
    cluster = reduce(lambda rest, j: F.when(F.col(names[j]) == least, j).otherwise(rest), reversed(range(k)), F.lit(None))
    return added.select("row", cluster.cast("int").alias("cluster"), least.alias("distance"))


def _moved(pieces: DataFrame, assigned: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """New centroids: every column block adds up its own slice; an empty cluster's centroid stays."""
    width = centroids.shape[1]
    sums = [F.sum(F.get("piece", F.lit(i))).alias(f"s{i}") for i in range(min(block, width))]
    joined = pieces.join(assigned.select("row", "cluster"), "row")
    # At most k rows a block, each with one number per component.
    found = joined.groupBy("block", "cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    new = centroids.copy()
    for r in found:
        for i in range(min(block, width - r.block * block)):
            new[r.cluster, r.block * block + i] = r[f"s{i}"] // r.n
    return new


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """Lloyd's rounds over (row, vec_id, vector of integers, all of one width); see ``integer_vectors``.

    Returns for every row vec_id, cluster, distance (squared, to the final
    centroid), cluster_inertia, inertia and centroid_sha256 (of the final
    centroid's components as decimal integers joined by commas). Centroids start
    as the k vectors whose ids hash lowest; fewer vectors, fewer centroids. A
    centroid becomes the exact floor of its vectors' mean; ties go to the
    smaller number and empty clusters keep their centroid. Repeated rows count
    as often as they occur. No rows give no rows. A component of 2 ** 27 or more
    raises ValueError: its distances would not fit into 64 bits.
    """
    with Scratch(vectors.sparkSession) as scratch:
        vectors = scratch.stage(vectors.select("row", "vec_id", "vector"), "vectors")
        largest = vectors.agg(F.max(F.greatest(F.array_max("vector"), -F.array_min("vector")))).first()[0]
        if largest is not None and largest >= _LARGEST:
            raise ValueError("a component is too large for exact distances in 64 bits")
        start = first_centroids(vectors, k, seed)
        if not start:
            none = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
            return vectors.sparkSession.createDataFrame([], f"vec_id long, {none}")
        centroids = np.array(start, dtype=np.int64)
        blocks = -(-centroids.shape[1] // block)
        cut = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.slice("vector", b * block + 1, block))
        pieces = vectors.select("row", F.posexplode(cut).alias("block", "piece")).hint("rebalance", "block")
        pieces = scratch.stage(pieces, "pieces")
        for _ in range(rounds):
            centroids = _moved(pieces, _assigned(pieces, centroids, block), centroids, block)
        last = scratch.stage(_assigned(pieces, centroids, block), "assigned")
        digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
        # At most k rows.
        inertia = {r.cluster: r.s for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
        c = F.col("cluster")
        result = vectors.select("row", "vec_id").join(last, "row").select(
            "vec_id", "cluster", "distance",
            F.get(F.array(*[F.lit(inertia.get(j, 0)).cast("long") for j in range(len(centroids))]), c).alias("cluster_inertia"),
            F.lit(sum(inertia.values())).cast("long").alias("inertia"),
            F.get(F.array(*map(F.lit, digests)), c).alias("centroid_sha256"),
        )
        return written(result, "clusters")
