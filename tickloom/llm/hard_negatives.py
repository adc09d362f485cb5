"""Hard negatives from rotated one-bit codes with exact bounds.

Every vector is rotated (random signs and Hadamard transforms, the same for
all) and stored with the signs of its rotated components, one bit each, its
length and its alignment: the inner product of the unit vector with the unit
vector b its code stands for. An anchor's rotated components are rounded to
PLANES bits, so its inner product with b is estimated from popcounts of the
code with the anchor's bit planes. What the code leaves out is orthogonal to b,
so by Cauchy-Schwarz the true score lies within

    |v| (alignment * t -+ sqrt(1 - alignment ** 2) * sqrt(|q| ** 2 - t ** 2)).

Only rows whose interval reaches what is still wanted are scored in whole
numbers; the intervals hold for certain, so no row is lost.

Anchors come in blocks of at most BLOCK_COMPONENTS numbers, the proven bound of
what is sent to the tasks, and every block meets all rows: once for its
positives, once for the negatives of those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import received, shared, sliced, travels, written
from tickloom.storage import Scratch

travels(__name__)

SCALE = 256
POSITIVES = NEGATIVES = 5
LEAST_PERCENT = 80
PLANES = 6
BLOCK = 4096  # anchors that meet all rows at once, at most
BLOCK_COMPONENTS = 1 << 22  # and so many components of them
_SHARD, _ANCHORS = 4096, 128  # rows by anchors whose intervals are held at once
_EXACT = 2**53  # below it sums of products of float64 are exact whole numbers
_INDEX = "row long, vec_id long, label long, vector array<long>, length double, code array<long>, alignment double"


def labelled_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(row, vec_id, label, vector): floor(SCALE x) of every component.

    Rows with a null label, a null vector or a null or non-finite component
    take no part. Every row has a number of its own, so repeated ids and
    repeated rows stay apart.
    """
    x = F.col(vector_col)

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    usable = table.where(F.col(label_col).isNotNull() & x.isNotNull() & F.forall(x, finite))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return usable.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"), scaled.alias("vector"),
    )


def rotated(vectors: np.ndarray, width: int) -> np.ndarray:
    """Rows turned by a fixed orthogonal map of ``width`` (a power of two) dimensions."""
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    for turn in range(3):
        out *= np.random.default_rng(turn).integers(0, 2, width) * 2.0 - 1.0
        step = 1
        while step < width:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            out = out.reshape(len(vectors), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), dtype=np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column; shorter ones end in zeros."""
    values, sizes = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _coded(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, _SHARD):
            if not batch.num_rows:
                continue
            turned = rotated(_matrix(batch.column(3), width), width)
            length = np.sqrt((turned**2).sum(axis=1))
            # <v / |v|, b> for the unit vector b with components +-1 / sqrt(width).
            aligned = np.abs(turned).sum(axis=1) / np.sqrt(width) / np.where(length > 0, length, 1.0)
            codes = _packed(turned >= 0).view("<i8")
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(length), lists, pa.array(np.minimum(aligned, 1.0))],
                names=["row", "vec_id", "label", "vector", "length", "code", "alignment"],
            )

    return run


@dataclass
class Anchors:
    """A block of anchors: their vectors, and their rotated vectors as bit planes."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    planes: np.ndarray  # anchors, planes, words
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray  # sum of the rounded components, in steps
    error: np.ndarray  # length of what rounding leaves out
    length: np.ndarray

    @staticmethod
    def of(rows: list[int], labels: list[int], vectors: np.ndarray, width: int) -> Anchors:
        turned = rotated(vectors, width)
        low, high = turned.min(axis=1), turned.max(axis=1)
        step = np.where(high > low, (high - low) / (2**PLANES - 1), 1.0)
        rounded = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        planes = np.stack([_packed((rounded >> j) & 1) for j in range(PLANES)], axis=1)
        left = turned - (low[:, None] + step[:, None] * rounded)
        return Anchors(
            np.array(rows, dtype=np.int64), np.array(labels, dtype=np.int64), vectors, planes, low, step,
            rounded.sum(axis=1), np.sqrt((left**2).sum(axis=1)), np.sqrt((turned**2).sum(axis=1)),
        )


class Shard:
    """Rows of the index, with what the intervals need."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.rows = batch.column(0).to_numpy()
        self.no_id = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        self.ids = batch.column(1).fill_null(0).to_numpy()
        self.labels = batch.column(2).to_numpy()
        self.vectors = _matrix(batch.column(3), width)
        self.length = batch.column(4).to_numpy()
        self.codes = _matrix(batch.column(5), -(-width // 64)).view(np.uint64)
        self.alignment = batch.column(6).to_numpy()
        self.width = width

    def intervals(self, a: Anchors, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Certain lower and upper bounds of the scores of some anchors (rows) with all rows (columns)."""
        planes = a.planes[part]
        ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        met = np.zeros((len(planes), len(self.codes)))
        for j in range(PLANES):
            for w in range(self.codes.shape[1]):
                met += float(1 << j) * np.bitwise_count(planes[:, j, w, None] & self.codes[None, :, w])
        low, step, total = (x[part, None] for x in (a.low, a.step, a.total))
        length, error = a.length[part, None], a.error[part, None]
        # Signs +-1 from bits: twice the part where the bit is set, less the whole.
        t = (low * (2 * ones - self.width) + step * (2 * met - total)) / np.sqrt(self.width)
        least = np.maximum(np.abs(t) - error, 0.0)
        rest = np.sqrt(np.maximum(length**2 - least**2, 0.0)) * np.sqrt(np.maximum(1 - self.alignment**2, 0.0))
        half = self.length * (self.alignment * error + rest)
        # The bounds must hold for rounded numbers too.
        half += 1e-7 * length * self.length + 1e-6
        centre = self.length * self.alignment * t
        return centre - half, centre + half

    def scores(self, at: np.ndarray, vector: np.ndarray) -> np.ndarray:
        rows = self.vectors[at]
        largest = int(np.abs(rows).max(initial=0)) * int(np.abs(vector).max(initial=0)) * self.width
        if largest < _EXACT:
            return (rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
        return rows @ vector

    def ordered(self, at: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
        """The first k rows: higher scores first, then smaller ids, null ids last."""
        order = np.lexsort((self.rows[at], self.ids[at], self.no_id[at], -scores))[:k]
        return [
            (-int(s), bool(n), int(i), int(r))
            for s, n, i, r in zip(scores[order], self.no_id[at][order], self.ids[at][order], self.rows[at][order])
        ]


def _flat(found: Iterator[tuple]) -> pa.RecordBatch:
    """Rows (anchor, cap, row, vec_id, score) of (anchor, cap, (-score, no id, id, row))."""
    flat = [(anchor, cap, r, None if no_id else i, -s) for anchor, cap, (s, no_id, i, r) in found]
    columns = list(zip(*flat)) or [[]] * 5
    names = ["anchor", "cap", "row", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


_FOUND = "anchor long, cap long, row long, vec_id long, score long"


def _positives(handle, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = received(handle)
        best: list[list[tuple]] = [[] for _ in a.rows]
        for batch in sliced(batches, _SHARD):
            if not batch.num_rows:
                continue
            shard = Shard(batch, width)
            for start in range(0, len(a.rows), _ANCHORS):
                part = slice(start, min(start + _ANCHORS, len(a.rows)))
                low, high = shard.intervals(a, part)
                fit = (shard.labels == a.labels[part, None]) & (shard.rows != a.rows[part, None])
                # k rows reach the k-th lower bound, so nothing below it is among the first k.
                floor = np.full(len(low), -np.inf)
                if low.shape[1] >= k:
                    floor = np.partition(np.where(fit, low, -np.inf), low.shape[1] - k, axis=1)[:, low.shape[1] - k]
                for i, n in enumerate(range(part.start, part.stop)):
                    kept = best[n]
                    wanted = max(floor[i], -kept[-1][0] if len(kept) == k else -np.inf)
                    at = np.nonzero(fit[i] & (high[i] >= wanted))[0]
                    if len(at):
                        best[n] = sorted(kept + shard.ordered(at, shard.scores(at, a.vectors[n]), k))[:k]
        yield _flat((int(r), 0, b) for r, found in zip(a.rows, best) for b in found)

    return run


def _negatives(handle, width: int, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, caps = received(handle)  # caps: the different positive scores of each anchor
        best: dict[tuple[int, int], list[tuple]] = {(n, c): [] for n, own in enumerate(caps) for c in own}
        for batch in sliced(batches, _SHARD):
            if not batch.num_rows:
                continue
            shard = Shard(batch, width)
            for start in range(0, len(a.rows), _ANCHORS):
                part = slice(start, min(start + _ANCHORS, len(a.rows)))
                low, high = shard.intervals(a, part)
                for i, n in enumerate(range(part.start, part.stop)):
                    other = shard.labels != a.labels[n]
                    reach = np.zeros(len(other), dtype=bool)
                    for cap in caps[n]:
                        kept = best[n, cap]
                        floor = max(percent * cap / 100, -kept[-1][0] if len(kept) == k else -np.inf)
                        reach |= (high[i] >= floor) & (low[i] <= cap)
                    at = np.nonzero(other & reach)[0]
                    if not len(at):
                        continue
                    scores = shard.scores(at, a.vectors[n])
                    for cap in caps[n]:
                        least = -(-percent * cap // 100)
                        fit = (scores <= cap) & (scores >= least)
                        if fit.any():
                            found = best[n, cap] + shard.ordered(at[fit], scores[fit], k)
                            best[n, cap] = sorted(found)[:k]
        yield _flat((int(a.rows[n]), cap, b) for (n, cap), found in best.items() for b in found)

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "cap").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def index(vectors: DataFrame, width: int) -> DataFrame:
    """Codes, lengths and alignments of (row, vec_id, label, vector), every row, nothing shuffled."""
    return vectors.select("row", "vec_id", "label", "vector").mapInArrow(_coded(width), _INDEX)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows that ``anchors`` selects.

    ``vectors`` has (row, vec_id, label, vector); see ``labelled_vectors``. The
    score of two rows is their integer inner product, a shorter vector ending in
    zeros; higher scores come first, ties by smaller vec_id, null ids last. An
    anchor's positives are the first rows of its label but itself, by position
    in the table, not by id: of repeated rows each is an anchor and may be the
    other's positive. Negatives have another label and ``percent`` to 100
    percent of the positive's score; a pair without any has no rows. Empty
    tables give no rows. Components whose scores might not fit into 64 bits
    raise ValueError.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        vectors = scratch.stage(vectors, "labelled")
        span = vectors.agg(
            F.max(F.size("vector")).alias("n"),
            F.max(F.greatest(F.array_max("vector"), -F.array_min("vector"))).alias("x"),
        ).first()
        n, largest = max(span.n or 1, 1), span.x or 0
        if largest * largest * n * 100 >= 2**63:
            raise ValueError("a component is too large for exact scores in 64 bits")
        width = 1 << (n - 1).bit_length()
        stored = scratch.stage(index(vectors, width), "codes")
        asked = scratch.stage(stored.where(anchors).select("row", "label", "vector"), "anchors")
        block = max(1, min(block, BLOCK_COMPONENTS // width))
        parts = -(-asked.count() // block)
        bucket = F.pmod(F.xxhash64("row"), F.lit(max(1, parts)))
        while parts > 1 and asked.groupBy(bucket).count().agg(F.max("count")).first()[0] > block:
            parts *= 2  # hash blocks are uneven; split until the bound holds
            bucket = F.pmod(F.xxhash64("row"), F.lit(parts))
        found = []
        for part in range(parts):
            rows = asked.where(bucket == part).collect()
            if not rows:
                continue
            matrix = np.zeros((len(rows), width), dtype=np.int64)
            for line, r in zip(matrix, rows):
                line[: len(r.vector)] = r.vector
            of = Anchors.of([r.row for r in rows], [r.label for r in rows], matrix, width)
            near = stored.mapInArrow(_positives(shared(spark, of), width, positives), _FOUND)
            near = scratch.stage(_first(near, positives), "positives")
            caps: dict[int, set[int]] = {}
            for r in near.select("anchor", "score").collect():  # at most ``positives`` rows an anchor of the block
                caps.setdefault(r.anchor, set()).add(r.score)
            wanted = [sorted(caps.get(r.row, ())) for r in rows]
            far = stored.mapInArrow(_negatives(shared(spark, (of, wanted)), width, negatives, percent), _FOUND)
            far = _first(far, negatives)
            pair = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
            far = far.select("anchor", F.col("cap").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            found.append(scratch.stage(pair.join(far, ["anchor", "positive_score"]), "mined"))
        if not found:
            return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        ids = stored.where(anchors).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        named = out.join(ids, "anchor")
        return written(
            named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives"
        )
