r"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words of a benchmark item (a shorter item is one
window). Its fingerprint is the smallest hash of the GRAM-word sequences in it.
Equal windows have equal fingerprints, so every shared span of WINDOW words
shares one: the join of the fingerprints of documents and items misses none. A
fingerprint that is met is extended to the windows it stands for, and those are
joined with the items' windows word for word.

Documents are read once. Their fingerprints are held against the slots that the
items' fingerprints fall into, at most MAX_SLOTS whole numbers however large the
benchmark is; that is what is broadcast. It only thins the rows: what passes is
decided by the joins. The texts are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower, written
from tickloom.storage import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 22
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _starts(words: Column, length: int) -> Column:
    """0, 1, ... for every window of so many words, none if there are too few words."""
    all_starts = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length, all_starts).otherwise(F.array().cast("array<int>"))


def _hash(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, start + k) for k in range(length)])


def _prints(words: Column, grams: Column, length: int) -> Column:
    """The fingerprint of every window of so many words; ``grams`` holds the hashes of all GRAM-word sequences."""
    if length < WINDOW:
        return F.transform(_starts(words, length), lambda i: _hash(words, i, length))
    places = range(WINDOW - GRAM + 1)
    return F.transform(_starts(words, length), lambda i: F.least(*[F.get(grams, i + k) for k in places]))


def _marks(prints: str, length: int) -> Column:
    """The different fingerprints of a document's windows of so many words."""
    return F.transform(F.array_distinct(prints), lambda p: F.struct(F.lit(length).alias("length"), p.alias("print")))


def _fingerprinted(rows: DataFrame, words: str, lengths: list[int], names: dict[int, str], grams: str) -> DataFrame:
    """``rows`` with one array for every window length: the fingerprint of the window at each start."""
    w, g = F.col(words), F.col(grams)
    if WINDOW in lengths:
        rows = rows.withColumn(grams, F.transform(_starts(w, GRAM), lambda i: _hash(w, i, GRAM)))
    for length in lengths:
        rows = rows.withColumn(names[length], _prints(w, g, length))
    return rows.drop(grams)


def _joined(words: Column, start: Column, length: Column) -> Column:
    # Words hold no blank, so equal strings are equal sequences of words.
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, length, window, print) of all items that have a word."""
    rows = items.select(F.col(item_col).alias("item"), _words(F.col(text_col)).alias("words")).where("size(words) > 0")
    rows = rows.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    names = {n: f"prints_{n}" for n in range(1, WINDOW + 1)}
    rows = _fingerprinted(rows, "words", list(names), names, "grams")
    prints = reduce(lambda rest, n: F.when(F.col("length") == n, F.col(names[n])).otherwise(rest), names, F.lit(None))
    placed = rows.select("item", "words", "length", F.posexplode(prints).alias("start", "print"))
    window = _joined(F.col("words"), F.col("start"), F.col("length"))
    return placed.select("item", "length", window.alias("window"), "print").distinct()


def _slots_needed(n: int) -> int:
    slots = MIN_SLOTS
    while slots < min(64 * n, MAX_SLOTS):
        slots *= 2
    return slots


def contamination(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", keep_text: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with what it shares with ``items``.

    Adds n_words, n_hit (words inside any occurrence of an item's window),
    n_items (items with an occurring window), items_sha256 (of their ids as
    sorted strings, comma-joined; of the empty text if there are none) and
    contaminated (n_hit > 0). Columns so named are replaced; the text itself is
    returned only with ``keep_text``.

    A null or empty text has no words and no hits; an item without words is no
    window. Repeated documents are judged alike and all returned. Repeated items
    count once by their id; an item without an id makes words hit, but is not
    counted or listed. Empty tables: no documents give no rows, no items give no
    hits. Texts are read whole, however long.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in RESULT and (keep_text or c != text_col)]
    with Scratch(spark) as scratch:
        windows = scratch.stage(item_windows(items, item_col, item_text_col), "item-windows")
        # At most WINDOW numbers.
        lengths = sorted(r.length for r in windows.select("length").distinct().collect())
        slots = _slots_needed(windows.select("print").distinct().count())
        read = scratch.stage(_candidates(docs, windows, kept, text_col, lengths, slots), "fingerprints")
        found = read.where("window IS NOT NULL")
        hits = found.join(windows.select("window").distinct(), "window", "left_semi")
        spans = F.array_sort(F.collect_set(F.struct("start", "length")))
        seen = F.array_sort(F.collect_set("window"))
        by_row = hits.groupBy("row").agg(spans.alias("spans"), seen.alias("windows"))
        by_row = by_row.select(
            "row", _covered(F.col("spans")).alias("n_hit"), "windows",
            F.md5(F.array_join("windows", "\n").cast("binary")).alias("set"),
        )
        by_row = scratch.stage(by_row, "hits")
        # Copies share their set of windows: its items are looked up once.
        sets = by_row.groupBy("set").agg(F.any_value("windows").alias("windows"))
        met = sets.select("set", F.explode("windows").alias("window")).join(windows.where("item IS NOT NULL"), "window")
        ids = met.groupBy("set").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("ids"))
        judged = by_row.select("row", "n_hit", "set").join(ids, "set", "left")
        rows = read.where("window IS NULL").join(judged, "row", "left")
        listed = F.coalesce("ids", F.array().cast("array<string>"))
        result = rows.select(
            *[F.col(f"kept.{_quoted(c)}").alias(c) for c in kept], "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
        return written(result, "contamination")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _candidates(
    docs: DataFrame, windows: DataFrame, kept: list[str], text_col: str, lengths: list[int], slots: int
) -> DataFrame:
    """(row, kept, n_words, window, start, length): one row without a window for every document, and
    one for each of its windows whose fingerprint falls into a slot of the items'."""
    names = {n: f"prints_{n}" for n in lengths}
    own = F.struct(*[F.col(_quoted(c)) for c in kept]) if kept else F.struct(F.lit(None).alias("none"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("kept"), _words(F.col(_quoted(text_col))).alias("words"))
    rows = _fingerprinted(rows, "words", lengths, names, "grams")

    def slot(length: Column, print_: Column) -> Column:
        return F.pmod(F.xxhash64(length, print_), F.lit(slots)).cast("int")

    itself = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).cast("long").alias("print")))
    each = [_marks(names[n], n) for n in lengths]
    marks = rows.withColumn("mark", F.explode(F.concat(itself, *each)))
    at = F.when(F.col("mark.length") == 0, F.lit(-1)).otherwise(slot(F.col("mark.length"), F.col("mark.print")))
    marks = marks.withColumn("slot", at)
    known = windows.select(slot(F.col("length"), F.col("print")).alias("slot")).distinct()
    known = known.union(docs.sparkSession.range(1).select(F.lit(-1).alias("slot")))
    met = marks.join(F.broadcast(known), "slot", "left_semi")  # at most MAX_SLOTS + 1 whole numbers
    prints = reduce(lambda rest, n: F.when(F.col("mark.length") == n, F.col(names[n])).otherwise(rest), lengths, F.array().cast("array<bigint>"))
    here = F.filter(
        F.transform(prints, lambda p, i: F.when(p == F.col("mark.print"), i)), lambda i: i.isNotNull()
    )
    placed = met.select(
        "row", F.when(F.col("mark.length") == 0, F.col("kept")).alias("kept"), "words", "mark.length",
        F.explode(F.when(F.col("mark.length") == 0, F.array(F.lit(-1))).otherwise(here)).alias("start"),
    )
    window = F.when(F.col("start") >= 0, _joined(F.col("words"), F.col("start"), F.col("length")))
    size = F.when(F.col("start") < 0, F.size("words").cast("long"))
    return placed.select("row", "kept", size.alias("n_words"), window.alias("window"), "start", "length")


def _covered(spans: Column) -> Column:
    """Words in the union of (start, length) spans in order of their starts."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(spans, none, add, lambda acc: acc["n"])
