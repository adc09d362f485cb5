"""Temperature mixing of sources, realised as block permutations.

A source with the token share p gets a weight in proportion to p ** exponent.
The exponent is bisected to the flattest mix that keeps every source within a
repetition limit, or that just reaches a target entropy. The budget of a source
is its weight's part of all tokens to draw. Its documents lie in hash blocks;
an epoch is a permutation of the blocks, full epochs take all of them and the
last one takes blocks while the budget lasts. Everything is DataFrame work:
sources and blocks are grouped sums, the permutation is the order of a hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written

BLOCKS = 1024
SEED = 42
REPETITIONS = 2.0
_PARTS = 16  # exponents judged by one pass: four halvings at once
_PASSES = 10


def word_count(text: Column) -> Column:
    """Words without ASCII white space, the measure of tokens; a null text has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+")
    return F.size(pieces) - (pieces[0] == "").cast("int") - F.when(
        F.size(pieces) > 1, (F.element_at(pieces, -1) == "").cast("int")
    ).otherwise(0)


@dataclass(frozen=True)
class Target:
    """Either limit: repetitions of a source (at least 1), or entropy as a share of the largest one."""

    repetitions: float | None = None
    entropy: float | None = None
    budget: int | None = None  # tokens to draw; None: as many as cut no source

    def __post_init__(self) -> None:
        if (self.repetitions is None) == (self.entropy is None):
            raise ValueError("give a repetition limit or a target entropy")
        if self.repetitions is not None and self.budget is None and self.repetitions < 1:
            raise ValueError("without a budget a source is drawn at least once")


def _measure(totals: DataFrame, exponents: list[float], target: Target) -> list[float]:
    """Largest repetition, or entropy, of the mix at each exponent: one pass over the sources.

    A source is a row for each exponent, so every pass has the same few sums and
    runs the code compiled for the first.
    """
    ratio = F.col("tokens") / F.col("most")
    part = F.pow(ratio, F.col("a"))
    rows = (
        totals.select("tokens", "most", F.posexplode(F.array(*map(F.lit, exponents))).alias("i", "a"))
        .groupBy("i").agg(
            F.sum(part), F.sum(part * F.log(part)), F.max(part / ratio), F.min(part / ratio),
            F.count(F.lit(1)), F.max("most"),
        )
    ).collect()
    out = []
    for _, z, zlog, high, low, n, most in sorted(rows):
        if target.entropy is not None:
            # The largest entropy is log(n); less negative is flatter.
            out.append(1.0 - (math.log(z) - zlog / z) / math.log(n) if n > 1 else 0.0)
        elif target.budget is None:
            out.append(high / low)
        else:
            out.append(high / z * target.budget / most)
    return out


def exponent(totals: DataFrame, target: Target) -> float:
    """The smallest exponent in 0..1 whose mix keeps the repetition limit, or the largest whose
    entropy reaches the target; 1 (the natural mix) if none keeps the limit, 0 if none is flat enough."""
    limit = target.repetitions if target.repetitions is not None else 1.0 - target.entropy
    low, high = 0.0, 1.0
    for _ in range(_PASSES):
        grid = [low + (high - low) * i / _PARTS for i in range(_PARTS + 1)]
        values = _measure(totals, grid, target)
        if target.entropy is not None:  # the distance to the flat mix grows with the exponent
            fit = max((i for i, v in enumerate(values) if v <= limit), default=None)
            if fit is None or fit == _PARTS:
                return grid[0] if fit is None else grid[-1]
            low, high = grid[fit], grid[fit + 1]
        else:  # repetition falls as the exponent grows
            fit = min((i for i, v in enumerate(values) if v <= limit), default=None)
            if fit is None or fit == 0:
                return grid[-1] if fit is None else grid[0]
            low, high = grid[fit - 1], grid[fit]
    return low if target.entropy is not None else high


def weights(totals: DataFrame, a: float, budget: int | None) -> DataFrame:
    """(_source, tokens, weight, epochs): epochs x tokens is the source's budget."""
    part = F.pow(F.col("tokens") / F.col("most"), F.lit(a))
    z, low = totals.agg(F.sum(part), F.min(part / (F.col("tokens") / F.col("most")))).first()
    repeat = part / (F.col("tokens") / F.col("most")) / F.lit(low or 1.0)
    if budget is not None:
        repeat = part / F.lit(z or 1.0) * F.lit(float(budget)) / F.col("tokens")
    return totals.select("_source", "tokens", (part / F.lit(z or 1.0)).alias("weight"), repeat.alias("epochs"))


def _draw(block_tokens: DataFrame, by_source: DataFrame, seed: int) -> DataFrame:
    """(_source, _block, epoch, place): the blocks of every epoch, in its permutation.

    ``place`` is the share of the source's budget drawn before the block, so
    that ordering all sources by it keeps the weights at every point. The last
    epoch takes a block if more than half of it lies within the budget.
    """
    plan = block_tokens.join(by_source, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil("epochs").cast("int"))))
    order = F.xxhash64(F.lit(seed), "epoch", "_source", "_block")
    before = Window.partitionBy("_source", "epoch").orderBy(order, "_block")
    drawn = F.sum("block_tokens").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    plan = plan.withColumn("_start", drawn - F.col("block_tokens"))
    within = (F.col("epoch") - 1) * F.col("tokens") + F.col("_start") + F.col("block_tokens") / 2
    place = ((F.col("epoch") - 1) * F.col("tokens") + F.col("_start")) / (F.col("epochs") * F.col("tokens"))
    # An epsilon keeps whole epochs whole when the exponent's last bits are off.
    kept = plan.where(within <= F.col("epochs") * F.col("tokens") + F.lit(0.5))
    return kept.select("_source", "_block", "epoch", place.alias("place"), "weight")


def mix(
    docs: DataFrame,
    target: Target = Target(repetitions=REPETITIONS),
    tokens: Column | None = None,
    source: str = "source",
    key: str = "doc_id",
    blocks: int = BLOCKS,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows: all columns of ``docs``, then epoch, block, place and weight.

    A row appears once per epoch it is drawn in. Without a budget the most
    frequent source is drawn exactly once and every other at least once, so no
    document is lost. A null source is a source of its own. Rows count at least
    one token, so empty and null texts are drawn too. Equal rows fall into one
    block and are each drawn. Columns named like a new one are replaced. An
    empty table gives an empty result. A block holds about 1/``blocks`` of its
    source, which is how closely a cut epoch meets its budget.
    """
    added = ("epoch", "block", "place", "weight")
    docs = docs.drop(*added)
    count = F.greatest(F.lit(1), tokens if tokens is not None else word_count(F.col("text"))).cast("long")
    block = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(blocks)).cast("int")
    # Partial sums come before the shuffle, so a source of any size is at most one row per task and block.
    sums = written(
        docs.select(F.col(source).alias("_source"), block.alias("_block"), count.alias("_n"))
        .groupBy("_source", "_block").agg(F.sum("_n").alias("block_tokens")),
        "blocks",
    )
    totals = sums.groupBy("_source").agg(F.sum("block_tokens").alias("tokens"))
    top = totals.agg(F.max("tokens")).first()[0]
    totals = written(totals.withColumn("most", F.lit(top or 1).cast("double")), "sources")
    a = exponent(totals, target) if top else 1.0
    by_source = weights(totals, a, target.budget).withColumnRenamed("_source", "_s")
    plan = written(_draw(sums, by_source, seed), "draw")
    plan = plan.select(F.col("_source").alias("_ps"), F.col("_block").alias("_pb"), "epoch", "place", "weight")
    placed = docs.withColumn("_block", block)
    same = F.col(source).eqNullSafe(F.col("_ps")) & (F.col("_block") == F.col("_pb"))
    return placed.join(plan, same).select(
        *docs.columns, "epoch", F.col("_block").alias("block"), "place", "weight"
    )
