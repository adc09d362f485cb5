"""Quality rules as weak supervision: rules vote or abstain, a posterior decides.

Every rule reads a few counts of a text and votes keep (1), junk (-1) or
abstains (0). The counts of all vote patterns over all documents (at most
3 ** rules of them) are the input of the expectation-maximisation that
estimates each rule's accuracy. A text is kept if its posterior is at least
one half. All of it is DataFrame expressions over a row, without a shuffle of
texts or words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import CAPITALS
from tickloom.llm.weak import Reliability, estimate

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_capitals", "_shouts")
RULES = 7


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three found twice or more in the text.

    Windows are 64-bit hashes. Where all differ the answer is 0 without a sort;
    else hashes are sorted with their places and those equal to a neighbour
    give the covered words.
    """
    places = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        found = _let(ordered, _equal_to_a_neighbour)
        starts = F.sort_array(F.transform(found, lambda e: e["i"]))
        begin = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            starts, begin,
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")),
            lambda s: s["n"],
        )

    counted = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(F.size(words) < 3, 0).otherwise(counted)


def _equal_to_a_neighbour(s: Column) -> Column:
    def met(e: Column, k: Column) -> Column:
        return F.coalesce(e["x"] == F.get(s, k - 1)["x"], F.lit(False)) | F.coalesce(
            e["x"] == F.get(s, k + 1)["x"], F.lit(False)
        )

    return F.filter(s, met)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of MEASURES; columns so named are replaced."""
    docs = docs.drop(*MEASURES, "_text", "_words")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    rows = docs.withColumn("_words", _words(text))
    return rows.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        _count(text, CAPITALS).cast("long").alias("_capitals"),
        _count(text, "!").cast("long").alias("_shouts"),
    )


def votes() -> list[Column]:
    """One vote per rule, from the measures.

    Rules that look for one fault abstain where they find none: its absence says
    little. Only plausible word lengths and few repeats vote to keep a text.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))

    def vote(share: Column, junk_above: float, keep_below: float = -1.0) -> Column:
        return F.when(share <= keep_below, 1).when(share > junk_above, -1).otherwise(0)

    length = F.col("word_chars") / n
    found = [
        F.when(length.between(3, 10), 1).when((length < 2) | (length > 15), -1).otherwise(0),
        vote(F.col("n_symbols") / n, 0.1),
        vote(F.col("n_symbols") / chars, 0.03),
        vote(F.col("n_dup_lines") / n, 0.05),
        vote(F.col("n_repeat_words") / n, 0.3, 0.1),
        vote(F.col("_capitals") / chars, 0.3),
        vote(F.col("_shouts") / n, 0.1),
    ]
    return [v.cast("int").alias(f"_v{i}") for i, v in enumerate(found)]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Quality:
    reliability: Reliability

    def posterior(self) -> Column:
        model = self.reliability
        odds = F.lit(model.log_odds((0,) * len(model.given)))
        for i, (yes, no) in enumerate(model.given):
            for v in (-1, 1):
                delta = _log_ratio(yes, no, v) - _log_ratio(yes, no, 0)
                odds = odds + F.when(F.col(f"_v{i}") == v, F.lit(delta)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _log_ratio(yes: dict[int, float], no: dict[int, float], vote: int) -> float:
    return math.log(yes[vote] / no[vote])


def train(counted: DataFrame) -> Quality:
    """Rule accuracies from the vote patterns of all measured rows with a word."""
    names = [f"_v{i}" for i in range(RULES)]
    patterns = counted.where("n_words > 0").select(*votes()).groupBy(*names).count().collect()
    counts = {tuple(row[n] for n in names): row["count"] for row in patterns}
    return Quality(estimate(counts or {(0,) * RULES: 0}, prior=0.7))


def judge(docs: DataFrame, quality: Quality | None = None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its measures, base_failed, quality (0 to 1) and kept.

    kept is false where base_failed, else whether the posterior is at least one
    half. A null text has no words, as an empty one, and fails the base. Rows
    are judged one by one: repeated rows alike, no rows give no rows. Columns
    named like a new one are replaced.
    """
    return judged(measured(docs.drop("base_failed", "quality", "kept"), text_col), quality)


def judged(counted: DataFrame, quality: Quality | None = None) -> DataFrame:
    """The verdicts on rows that are measured already, for instance written without their texts."""
    model = quality or train(counted)
    names = [c for c in counted.columns]
    voted = counted.select("*", *votes())
    scored = voted.select(*names, base_failed().alias("base_failed"), model.posterior().alias("quality"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
