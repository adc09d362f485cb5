"""Exact top-k inner products by ball-tree branch and bound.

Every task turns its vectors into shards, builds a ball tree per shard and
searches it for all queries of the current block. A node's inner products with
q are at most q.centre + |q| * radius; nodes are visited in the order of that
bound until it falls below the k-th score, which a task keeps per query from
shard to shard. A first pass over one shard's worth of sampled rows gives all
tasks a k-th score to start from.

Queries come in blocks of at most ``block`` rows, the proven bound of what is
broadcast; each block is searched against all vectors. Scores are exact
integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import received, shared, travels, written
from tickloom.storage import Scratch

travels(__name__)

K = 10
BLOCK = 4096  # queries searched (and broadcast) at once
SHARD = 8192  # vectors of one tree
LEAF = 64
_EXACT = 2**53  # below it sums of products of float64 are exact integers


class BallTree:
    """Nodes in arrays; the rows of a node are contiguous in ``order``."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.arange(len(rows))
        self.first, self.last, self.left, self.right = [], [], [], []
        self.centres, self.radii = [], []
        if len(rows):
            self._build(0, len(rows))
        self.centre_matrix = np.array(self.centres).reshape(len(self.centres), rows.shape[1])
        self.radius = np.array(self.radii)

    def _build(self, a: int, b: int) -> int:
        stack, root = [(a, b, -1, 0)], len(self.first)
        while stack:
            a, b, parent, side = stack.pop()
            points = self.rows[self.order[a:b]]
            centre = points.mean(axis=0)
            away = points - centre
            distance = np.sqrt((away**2).sum(axis=1))
            node = len(self.first)
            if parent >= 0:
                (self.left if side == 0 else self.right)[parent] = node
            self.first.append(a), self.last.append(b), self.left.append(-1), self.right.append(-1)
            # The bound must hold for rounded centres and radii too.
            self.centres.append(centre), self.radii.append(distance.max() * (1 + 1e-9) + 1e-6)
            if b - a <= LEAF or not distance.max():
                continue
            one = points[distance.argmax()]
            two = points[((points - one) ** 2).sum(axis=1).argmax()]
            along = points @ (two - one)
            middle = (b - a) // 2
            split = np.argpartition(along, middle)
            self.order[a:b] = self.order[a:b][split]
            stack += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        return root

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        length = np.sqrt((queries**2).sum(axis=1))
        upper = queries @ self.centre_matrix.T + length[:, None] * self.radius
        return upper + 1e-9 * np.abs(upper) + 1e-3


class Best:
    """The k best (score, smaller id first) of one query."""

    def __init__(self, k: int, floor: int | None):
        self.k, self.floor, self.heap = k, floor, []

    def kth(self) -> float:
        """A lower bound of the final k-th score."""
        own = self.heap[0][0] if len(self.heap) == self.k else None
        known = [x for x in (own, self.floor) if x is not None]
        return max(known) if known else -np.inf

    def offer(self, score: int, vec_id: int) -> None:
        item = (score, -vec_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, item)
        elif item > self.heap[0]:
            heapq.heapreplace(self.heap, item)


def search(
    tree: BallTree, ids: np.ndarray, own: np.ndarray, exact: np.ndarray, queries: list, best: dict[int, Best]
) -> None:
    """Offer the tree's rows to every query: nodes by falling bound, until it is below the k-th score.

    ``own`` numbers the rows; a query is named by its row and does not meet itself.
    """
    if not len(ids):
        return
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        vectors = np.stack([v for _, v in part])
        bounds = tree.bounds(vectors.astype(np.float64))
        for (query, v), upper in zip(part, bounds):
            found = best[query]
            fast = v.astype(exact.dtype)
            todo = [(-upper[0], 0)]
            while todo and -todo[0][0] >= found.kth():
                node = heapq.heappop(todo)[1]
                if tree.left[node] >= 0:
                    for child in (tree.left[node], tree.right[node]):
                        heapq.heappush(todo, (-upper[child], child))
                    continue
                rows = tree.order[tree.first[node] : tree.last[node]]
                scores = exact[rows] @ fast
                for i in np.nonzero(scores >= found.kth())[0]:
                    if own[rows[i]] != query:
                        found.offer(int(scores[i]), int(ids[rows[i]]))


def _matrix(vectors: list) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros. float64 where its sums are exact."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _searched(handle, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = received(handle)
        best = {q: Best(k, floors.get(q)) for q, _ in queries}
        held_rows: list[int] = []
        held_ids: list[int] = []
        held: list = []

        def flush() -> None:
            width = max(max(map(len, held)), max(len(v) for _, v in queries))
            rows = _matrix([*held, *[v for _, v in queries]])
            assert rows.shape[1] == width
            own, asked = rows[: len(held)], rows[len(held) :]
            largest = int(np.abs(own).max(initial=0)) * int(np.abs(asked).max(initial=0)) * max(width, 1)
            exact = own.astype(np.float64) if largest < _EXACT else own
            tree = BallTree(own.astype(np.float64))
            search(tree, np.array(held_ids), np.array(held_rows), exact, list(zip([q for q, _ in queries], asked)), best)
            held_rows.clear(), held_ids.clear(), held.clear()

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            for row, vec_id, v in zip(*columns):
                held_rows.append(row), held_ids.append(vec_id), held.append(v)
                if len(held) >= SHARD:
                    flush()
        if held:
            flush()
        rows = [(q, -i, s) for q, b in best.items() for s, i in b.heap]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query", "vec_id", "score"]
        )

    return run


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, vector): floor(1024 x) of every component.

    Rows with a null id, a null vector or a null or non-finite component take
    no part. Every other row has a number of its own, so repeated ids and
    repeated rows stay apart.
    """
    x = F.col(vector_col)

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    usable = table.where(F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, finite))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * 1024).cast("long"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), scaled.alias("vector"))


_FOUND = "query long, vec_id long, score long"


def top_k(vectors: DataFrame, wanted: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each row that ``wanted`` selects.

    ``vectors`` has (row, vec_id, vector of integers); see ``integer_vectors``.
    Candidates are all rows but the query's own: of rows that share an id each
    is a query and a candidate of the others. Ties go to the smaller vec_id; a
    query has fewer rows if there are fewer candidates. Vectors of different
    length are compared as if the shorter one ended in zeros. No queries, no
    rows. Components whose scores might not fit into 64 bits raise ValueError.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        vectors = scratch.stage(vectors.select("row", "vec_id", "vector"), "vectors")
        queries = scratch.stage(vectors.where(wanted), "queries")
        span = vectors.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
            F.max(F.greatest(F.array_max("vector"), -F.array_min("vector"))).alias("x"),
        ).first()
        if (span.x or 0) ** 2 * max(span.width or 0, 1) >= 2**63:
            raise ValueError("a component is too large for exact scores in 64 bits")
        asked = queries.count()
        parts = max(1, -(-asked // block))
        bucket = F.pmod(F.xxhash64("row"), F.lit(parts))
        while parts > 1 and queries.groupBy(bucket).count().agg(F.max("count")).first()[0] > block:
            parts *= 2  # hash blocks are uneven; split until the bound holds
            bucket = F.pmod(F.xxhash64("row"), F.lit(parts))
        sample = vectors.where(F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(max(1, span.n // SHARD))) == 0)
        results = []
        for part in range(parts):
            rows = [(r.row, np.array(r.vector, dtype=np.int64)) for r in queries.where(bucket == part).collect()]
            if not rows:
                continue
            seeds = sample.mapInArrow(_searched(shared(spark, (rows, {})), k), _FOUND)
            by_score = F.reverse(F.sort_array(F.collect_list("score")))
            # A query has at most k rows from each task of the small sample.
            kth = seeds.groupBy("query").agg(F.get(by_score, k - 1).alias("s")).where("s IS NOT NULL")
            floors = {r.query: r.s for r in kth.collect()}
            found = vectors.mapInArrow(_searched(shared(spark, (rows, floors)), k), _FOUND)
            results.append(scratch.stage(_ranked(found, k), "top-k"))
        if not results:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        out = results[0]
        for more in results[1:]:
            out = out.union(more)
        ids = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
        return written(out.join(ids, "query").select("query_id", "rank", "vec_id", "score"), "top-k")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", "vec_id", "score")
