r"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line, a template a set of words; a block holds a template if at
least THRESHOLD of the template's words are in it. Words are ordered by their
document frequency over the whole corpus, rarest first. A block that holds a
template of n words shares at least needed = ceil(THRESHOLD * n) of them, so it
shares a word within the first n - needed + 1 words of the template and the
first m - needed + 1 of its own m: the prefix filter, an equi-join on words.
The length filter (m >= needed) and the positional filter (enough words left
from the shared one on, on both sides) thin the candidates, and the whole sets
decide.

Only words of templates can be shared, so a block is reduced to those first.
The templates, and with them every broadcast, are fixed in size by this module.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

# Exact phrases with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices as they are commonly written, with their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def template_words(templates: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({w for _, t in templates for w in t.split()})


def word_order(docs: DataFrame, templates: tuple[tuple[str, str], ...], text_col: str = "text") -> list[str]:
    """The templates' words, rarest first by their document frequency over all rows."""
    known = F.array(*map(F.lit, template_words(templates)))
    found = F.explode(F.array_intersect(words(ascii_lower(F.col(text_col))), known))
    counts = dict(docs.select(found.alias("w")).groupBy("w").count().collect())
    return sorted(template_words(templates), key=lambda w: (counts.get(w, 0), w))


def _index(docs: DataFrame, order: list[str], templates: tuple[tuple[str, str], ...], threshold: float) -> DataFrame:
    """(word, template, label, at, size, needed, members): the templates' prefixes."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, (label, text) in enumerate(templates):
        members = sorted({rank[w] for w in text.split()})
        needed = max(1, math.ceil(threshold * len(members) - 1e-9))
        for at, word in enumerate(members[: len(members) - needed + 1]):
            rows.append((word, number, label, at, len(members), needed, members))
    return docs.sparkSession.createDataFrame(
        rows, "word int, template int, label string, at int, size int, needed int, members array<int>"
    )


def matches(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD,
    text_col: str = "text",
) -> DataFrame:
    """(text_md5, block, template, label, containment): every block that holds a template.

    Rows are told apart by their text, so equal texts (and repeated rows) give
    equal rows. Null and empty texts have no blocks.
    """
    order = word_order(docs, templates, text_col)
    index = _index(docs, order, templates, threshold)
    first = sorted({order[r.word] for r in index.select("word").distinct().collect()})
    text = ascii_lower(F.col(text_col))
    # Blocks without any prefix word end here, before a row is made of them.
    prefixed = rf"(?<![0-9a-z])(?:{'|'.join(first)})(?![0-9a-z])"
    rank = F.create_map(*map(F.lit, chain.from_iterable((w, i) for i, w in enumerate(order))))
    blocks = (
        docs.where(F.rlike(text, F.lit(prefixed)))
        .select(F.md5(F.col(text_col).cast("binary")).alias("text_md5"), F.posexplode(F.split(text, "\n")).alias("block", "_line"))
        .where(F.rlike("_line", F.lit(prefixed)))
    )
    known = F.array(*map(F.lit, order))
    ranks = F.sort_array(F.transform(F.array_intersect(words(F.col("_line")), known), lambda w: F.element_at(rank, w)))
    blocks = blocks.select("text_md5", "block", ranks.alias("_ranks"))
    probes = blocks.select("*", F.size("_ranks").alias("_m"), F.posexplode("_ranks").alias("_at", "word"))
    # The index has a row per prefix word of the templates above: a size fixed by this module.
    candidates = probes.join(F.broadcast(index), "word")
    candidates = candidates.where("_m >= needed AND _at <= _m - needed AND least(size - at, _m - _at) >= needed")
    both = F.size(F.array_intersect("_ranks", "members"))
    held = candidates.where(both >= F.col("needed"))
    return held.select("text_md5", "block", "template", "label", (both / F.col("size")).alias("containment"))


def _places(tokens: Column, phrase: str) -> Column:
    """Starts of a phrase's words in a row of words."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        met = F.get(tokens, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            met = met & (F.get(tokens, i + k) == part)
        return met

    starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - len(parts)), here)
    rare = max(parts, key=len)
    likely = (F.size(tokens) >= len(parts)) & F.array_contains(tokens, rare)
    return F.when(likely, starts).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD,
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with its license findings.

    Adds n_words, n_base, first_word, last_word (null without a base place),
    base_labels, labels and score: 1 with a base place, else the largest
    containment of a template held by a block, else 0. Columns so named are
    replaced. A null text is empty; empty texts have no words and no labels.
    Repeated rows are scanned alike and all returned; no rows give no rows.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    docs = docs.drop(*added, "_tokens", "_text_md5")
    held = matches(docs, templates, threshold, text_col)
    by_text = held.groupBy("text_md5").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best")
    )
    placed = docs.withColumn("_tokens", words(ascii_lower(F.col(text_col))))
    names = [f"_places_{i}" for i in range(len(PHRASES))]
    for name, phrase in zip(names, PHRASES):
        placed = placed.withColumn(name, _places(F.col("_tokens"), phrase))
    starts = F.concat(*names)
    base = F.filter(
        F.array(*[F.when(F.size(n) > 0, F.lit(label)) for n, label in zip(names, PHRASES.values())]),
        lambda label: label.isNotNull(),
    )
    # Only the short findings are shuffled, not the texts.
    placed = placed.select(
        *docs.columns,
        F.size("_tokens").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("_base"),
        F.md5(F.col(text_col).cast("binary")).alias("_text_md5"),
    )
    all_labels = F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    return placed.join(by_text, F.col("_text_md5") == F.col("text_md5"), "left").select(
        *docs.columns, "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(all_labels)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
