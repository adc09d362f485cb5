"""Exponential smoothing as a distributed computation.

y[n] = q * y[n-1] + a * x[n] is recursive, which no built-in window expresses,
but it is linear: inside a block the sum of x[j] * q**-j times q**k is exact
once the value carried into the block is added, times its decay. Blocks are two
months long, so q**-k stays bounded. The carries are folded from one row a
block, and joined back to the bars without moving them again.

The seed of a series is the mean of its first ``length`` inputs. It needs no
extra pass: while the look-back fills, inputs are summed without decay, and the
sum divided by ``length`` is the seed. States are kept as ``length`` times the
output, so the first output is that plain mean.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.series import ERA, in_block


@dataclass(frozen=True)
class Smoother:
    """One smoothed column.

    ``source`` is an input column, or a mapping from smoothers to factors when
    the input is a linear combination of their outputs. ``first`` is the ``n``
    of the first input; the output is NULL before input number ``length``.
    """

    name: str
    source: Column | dict[Smoother, float] = field(hash=False, compare=False)
    length: int
    gain: float
    first: int = 1

    @property
    def decay(self) -> float:
        return 1.0 - self.gain

    @property
    def defined_from(self) -> int:
        return self.first + self.length - 1

    def weight(self, n: Column) -> Column:
        """What one unit of input number ``n`` adds to the state."""
        return (
            F.when(n < self.first, F.lit(0.0))
            .when(n <= self.defined_from, F.lit(1.0))
            .otherwise(F.lit(self.gain * self.length))
        )

    def decayed_over(self, rows: Column) -> Column:
        """The factor by which the last ``rows`` bars up to ``n`` shrink a state."""

        def steps(n: Column) -> Column:
            return F.greatest(n - self.defined_from, F.lit(0))

        n = F.col("n")
        return F.pow(F.lit(self.decay), steps(n) - steps(n - rows))


def ema(name: str, source: Column | dict[Smoother, float], length: int, first: int = 1) -> Smoother:
    return Smoother(name, source, length, 2.0 / (length + 1), first)


def wilder(name: str, source: Column, length: int, first: int = 1) -> Smoother:
    return Smoother(name, source, length, 1.0 / length, first)


def smooth(
    rows: DataFrame, smoothers: list[Smoother], state: DataFrame | None = None, keep_states: bool = False
) -> DataFrame:
    """Add one column per smoother to ``in_order`` rows; context rows are dropped.

    A smoother that reads others comes after them in the list. ``state``
    (symbol, carry) holds the states before the first bar, as the struct of
    ``carry_of``; ``keep_states`` adds that struct after each bar as ``carry``.
    """
    if any(not 0.0 < s.decay < 1.0 for s in smoothers):
        raise ValueError("a smoother needs a gain strictly between 0 and 1")
    local = _within_blocks(rows, smoothers).where(~F.col("is_context"))
    carries = _carries(local, smoothers, state)
    carried = F.array(F.col("_carries")[F.col("block")])
    joined = local.join(carries, ERA, "left").select(*local.columns, F.inline(carried))
    outputs, states = [], []
    for s in smoothers:
        now = F.col(f"_l_{s.name}") + F.col(f"_d_{s.name}") * F.col(f"_c_{s.name}")
        for read, factor in _reads(s):
            now = now + F.col(f"_g_{s.name}_{read.name}") * factor * F.col(f"_c_{read.name}")
        outputs.append(F.when(F.col("n") >= s.defined_from, now / s.length).alias(s.name))
        states.append(now.alias(f"_c_{s.name}"))
    kept = [F.struct(*states).alias("carry")] if keep_states else []
    return joined.select(*rows.columns, *outputs, *kept).drop("is_context")


def carry_of(smoothers: list[Smoother]) -> str:
    """The type of the states carried from bar to bar."""
    return "struct<" + ", ".join(f"_c_{s.name}: double" for s in smoothers) + ">"


def _reads(s: Smoother) -> list[tuple[Smoother, float]]:
    return list(s.source.items()) if isinstance(s.source, dict) else []


def _within_blocks(rows: DataFrame, smoothers: list[Smoother]) -> DataFrame:
    """States as if every block started from zero, and the factors for what is carried in."""
    run = in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def scan(s: Smoother, term: Column) -> Column:
        decay = F.col(f"_d_{s.name}")
        return F.sum(s.weight(F.col("n")) * term / decay).over(run) * decay

    numbered = rows.withColumns(
        {
            "_rows": F.row_number().over(in_block()),
            "_ends_block": F.lead("n").over(in_block()).isNull(),
        }
    )
    direct = [s for s in smoothers if not _reads(s)]
    chained = [s for s in smoothers if _reads(s)]
    out = numbered.withColumns({f"_d_{s.name}": s.decayed_over(F.col("_rows")) for s in smoothers})
    out = out.withColumns(
        {f"_l_{s.name}": scan(s, F.coalesce(s.source, F.lit(0.0))) for s in direct}
    )
    for s in chained:
        mixed = F.lit(0.0)
        echoes = {}
        for read, factor in _reads(s):
            mixed = mixed + F.col(f"_l_{read.name}") * (factor / read.length)
            echoes[f"_g_{s.name}_{read.name}"] = scan(s, F.col(f"_d_{read.name}") / read.length)
        out = out.withColumns({f"_l_{s.name}": scan(s, mixed), **echoes})
    return out


def _carries(local: DataFrame, smoothers: list[Smoother], state: DataFrame | None) -> DataFrame:
    """(symbol, era) -> map from block to the states at the end of the block before.

    One row a block reaches the fold. A series has six blocks a year, so the
    folded array is bounded by the calendar, not by the number of bars.
    """
    ends = local.where("_ends_block").groupBy("symbol").agg(
        F.sort_array(
            F.collect_list(
                # A filter on usable bars would part this plan from the one it shares a shuffle with.
                F.when(F.col("usable"), F.struct(
                    "block",
                    "era",
                    *[
                        c
                        for s in smoothers
                        for c in (
                            f"_l_{s.name}",
                            f"_d_{s.name}",
                            *[f"_g_{s.name}_{read.name}" for read, _ in _reads(s)],
                        )
                    ],
                ))
            )
        ).alias("ends")
    )
    first = F.struct(*[F.lit(0.0).alias(f"_c_{s.name}") for s in smoothers])
    if state is not None:
        ends = ends.join(state.select("symbol", "carry"), "symbol", "left")
        first = F.coalesce("carry", first)
    start = F.struct(
        first.cast(carry_of(smoothers)).alias("state"),
        F.array().cast(f"array<struct<block: int, era: int, carry: {carry_of(smoothers)}>>").alias("seen"),
    )

    def step(acc: Column, end: Column) -> Column:
        state = acc["state"]

        def advance(s: Smoother) -> Column:
            after = end[f"_l_{s.name}"] + end[f"_d_{s.name}"] * state[f"_c_{s.name}"]
            for read, factor in _reads(s):
                after = after + end[f"_g_{s.name}_{read.name}"] * factor * state[f"_c_{read.name}"]
            return after.alias(f"_c_{s.name}")

        here = F.struct(end["block"].alias("block"), end["era"].alias("era"), state.alias("carry"))
        return F.struct(
            F.struct(*[advance(s) for s in smoothers]).alias("state"),
            F.concat(acc["seen"], F.array(here)).alias("seen"),
        )

    return (
        ends.select("symbol", F.explode(F.aggregate("ends", start, step)["seen"]).alias("at"))
        .groupBy("symbol", F.col("at.era").alias("era"))
        .agg(F.map_from_entries(F.collect_list(F.struct("at.block", "at.carry"))).alias("_carries"))
    )
