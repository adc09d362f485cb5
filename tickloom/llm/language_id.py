"""Language identification with interpolated Kneser-Ney character models.

Training counts words per language over all labelled rows, in Spark, turns them
into character 5-grams there, and keeps every one of them: counts of counts,
context sums and continuation counts of each order are Spark aggregates over all
grams. The fitted model is a table in the shared folder, a discounted
probability for each gram and a back-off weight for each context, with one
number per language.

A text is a sequence of words, each preceded by four start marks and followed
by an end mark; a character's history does not reach beyond its word. So the
window of a character is scored once, by joins with the model, a word once, from
its windows, and a text from its words. Window scores are sorted arrays of
hashes, searched by binary search; they go to the tasks in blocks of at most
``_BLOCK_WINDOWS`` windows, and what a word has in each block is added up. Scores
are whole numbers of 1/SCALE nats, so sums do not depend on their order. The
scores of the most common words (at most ``_KEPT_WORDS``) are sent to every task;
this only saves their rows a shuffle, all other words are joined.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import received, shared, sliced, texts, travels, unused, written
from tickloom.storage import Scratch, remove_folder

travels(__name__)

ORDER = 5
START, END = "\x01", "\x02"
LONGEST = 40  # longer words are scored in parts of so many characters
SCALE = 1 << 20
BUCKETS = 64  # hash buckets of words, each with the same share of the common ones
BANDS = (0, 64, 256, 1024)  # lower ends of the length bands of the calibration
_COUNTED_WORDS = 400_000  # counts kept by a task, a bound of its memory
_BLOCK_WINDOWS = 1 << 20  # windows whose scores a task holds at once
_KEPT_WORDS = 1 << 18  # common words whose scores every task has
_KEPT_SCORES = 1 << 22  # and at most so many numbers
_WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters (with the odd numeral sign), lower case, in parts of at most LONGEST."""
    found = _WORD.findall(text.lower())
    if found and max(map(len, found)) > LONGEST:
        found = [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def _windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each character's window of ORDER, and the number of characters per word."""
    padded = "".join(START * (ORDER - 1) + w + END for w in words)
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes) + np.repeat(starts, sizes)
    return codes[place[:, None] + np.arange(ORDER)], sizes


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row of code points; rows of different width differ by their seed."""
    h = np.full(len(codes), codes.shape[1] + 1, dtype=np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ codes[:, k]) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Level:
    """One order of all languages in memory, for small inputs and the tests' measure: sorted arrays of hashes, each hash with a row of one number per language.

    A gram has its interpolated probability, a context its back-off weight.
    """

    grams: np.ndarray
    probability: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    levels: list[Level] = field(default_factory=list)  # order 1 first; only of a model in memory
    table: DataFrame | None = None  # (key, v): d and a gram, or g and a context, with one number per language
    first: list[float] = field(default_factory=list)  # back-off weight of the empty context per language
    alphabet: int = 1
    limits: np.ndarray | None = None  # per language and length band: the highest accepted cross-entropy

    def probabilities(self, codes: np.ndarray, order: int) -> np.ndarray:
        """p of the last character of every window given the order - 1 before it, per language.

        A gram no language has seen leaves its context's back-off weight times
        the probability of the next lower order.
        """
        if not order:
            return np.full((len(codes), len(self.languages)), 1.0 / (self.alphabet + 1))
        level = self.levels[order - 1]
        at, seen = _found(level.grams, _hashes(codes[:, ORDER - order :]))
        p = level.probability[at] if len(level.grams) else np.zeros((len(codes), len(self.languages)))
        rest = np.nonzero(~seen)[0]
        if len(rest):
            at, known = _found(level.contexts, _hashes(codes[rest, ORDER - order : ORDER - 1]))
            lower = self.probabilities(codes[rest], order - 1)
            p[rest] = np.where(known[:, None], level.backoff[at], 1.0) * lower
        return p

    def word_scores(self, words: list[str]) -> np.ndarray:
        """log p of every word (rows) in every language (columns)."""
        codes, sizes = _windows(words)
        sums = np.vstack([np.zeros(len(self.languages)), np.cumsum(np.log(self.probabilities(codes, ORDER)), axis=0)])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def _counted(counts: dict[str, int]) -> list[tuple[pd.Series, pd.Series]]:
    """Per order, 1 first: discounted probability by gram and back-off weight by context, of one language."""
    frame = pd.DataFrame({"gram": list(counts), "n": list(counts.values())})
    found = []
    for _ in range(ORDER):
        once, twice = int((frame.n == 1).sum()), int((frame.n == 2).sum())
        discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
        context = frame.gram.str[:-1]
        by = frame.n.groupby(context).agg(["sum", "size"])
        prob = (frame.n - discount) / context.map(by["sum"])
        found.append((pd.Series(prob.to_numpy(), index=frame.gram), discount * by["size"] / by["sum"]))
        # The lower order counts in how many different contexts a gram was seen.
        frame = frame.gram.str[1:].value_counts().rename_axis("gram").reset_index(name="n")
    return found[::-1]


def _levels(counts: list[dict[str, int]], alphabet: int) -> list[Level]:
    """Interpolated Kneser-Ney levels from each language's counts of grams of ORDER characters."""
    each = [_counted(c) for c in counts]
    lower = pd.DataFrame([[1.0 / (alphabet + 1)] * len(counts)], index=[""])
    levels = []
    for k in range(ORDER):
        disc = pd.concat([e[k][0] for e in each], axis=1).fillna(0.0).sort_index()
        gamma = pd.concat([e[k][1] for e in each], axis=1).fillna(1.0).sort_index()
        disc.columns = gamma.columns = lower.columns = range(len(counts))
        p = disc + gamma.loc[disc.index.str[:-1]].to_numpy() * lower.loc[disc.index.str[1:]].to_numpy()
        grams, contexts = _keys(p.index, k + 1), _keys(gamma.index, k)
        g, c = np.argsort(grams), np.argsort(contexts)
        levels.append(Level(grams[g], p.to_numpy()[g], contexts[c], gamma.to_numpy()[c]))
        lower = p
    return levels


def _keys(grams: Iterable[str], order: int) -> np.ndarray:
    grams = list(grams)
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _hashes(codes.astype(np.uint64).reshape(len(grams), order))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        flat = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        counts.clear()
        cols = list(zip(*flat)) or [[], [], []]
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["lang", "word", "n"]
        )

    for batch in sliced(batches):
        for lang, text in zip(texts(batch, "lang"), texts(batch, "text")):
            if text:
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > _COUNTED_WORDS:
                yield rows()
    yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows (lang, text); a NULL language is one of its own."""
    words = docs.where("text IS NOT NULL").select("lang", "text")
    counted = words.mapInArrow(_count_words, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _grams(word: str) -> Column:
    """The windows of ORDER characters of a word, one for each character and its end."""
    padded = F.concat(F.lit(START * (ORDER - 1)), word, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: padded.substr(i, F.lit(ORDER)))


def _vectors(rows: DataFrame, languages: int) -> DataFrame:
    """(key, v) of rows (key, k, v): a number per language, 0 for grams and 1 for contexts it has not seen."""
    known = rows.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))
    other = F.when(F.col("key").startswith("d"), 0.0).otherwise(1.0)
    places = F.sequence(F.lit(0), F.lit(languages - 1))
    return known.select("key", F.transform(places, lambda i: F.coalesce(F.try_element_at("m", i), other)).alias("v"))


def _fill(model: Model, words: DataFrame, scratch: Scratch, keep: bool) -> None:
    """The model's table, from the counts of all grams of all orders."""
    known = F.array(*map(F.lit, model.languages))
    k = (F.array_position(known, F.col("lang")) - 1).cast("int").alias("k")
    longest = words.select(k, "n", F.explode(_grams("word")).alias("gram")).groupBy("k", "gram").agg(F.sum("n").alias("n"))
    longest = scratch.stage(longest.select("k", F.lit(ORDER).alias("o"), "gram", "n"), "grams")
    # A lower order counts in how many different contexts a gram was seen: the different grams one
    # character longer that end in it.
    ends = F.array(*[F.struct(F.lit(o).alias("o"), F.right("gram", F.lit(o + 1)).alias("wide")) for o in range(1, ORDER)])
    wide = longest.select("k", F.explode(ends).alias("e")).select("k", "e.o", "e.wide").distinct()
    lower = wide.groupBy("k", "o", F.col("wide").substr(2, ORDER).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    orders = scratch.stage(longest.unionByName(lower), "orders")
    stats = orders.groupBy("k", "o").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
    discounts = [0.5] * (len(model.languages) * ORDER)
    for r in stats.collect():
        discounts[r.k * ORDER + r.o - 1] = min(0.9, max(0.1, r.once / (r.once + 2 * r.twice))) if r.once else 0.5
    discount = F.get(F.array(*map(F.lit, discounts)), F.col("k") * ORDER + F.col("o") - 1)
    placed = orders.withColumn("context", F.left("gram", F.col("o") - 1))
    contexts = placed.groupBy("k", "o", "context").agg(F.sum("n").alias("sum"), F.count(F.lit(1)).alias("size"))
    contexts = scratch.stage(contexts, "contexts")
    weight = (discount * F.col("size") / F.col("sum")).alias("v")
    model.first = [r.v for r in contexts.where("o = 1").select("k", weight).orderBy("k").collect()]
    model.alphabet = orders.where("o = 1").select("gram").distinct().count()
    probability = ((F.col("n") - discount) / F.col("sum")).alias("v")
    grams = placed.join(contexts, ["k", "o", "context"]).select(F.concat(F.lit("d"), "gram").alias("key"), "k", probability)
    weights = contexts.where("o > 1").select(F.concat(F.lit("g"), "context").alias("key"), "k", weight)
    table = _vectors(grams.unionByName(weights), len(model.languages))
    model.table = written(table, "model") if keep else scratch.stage(table, "model")


def window_scores(words: DataFrame, model: Model) -> DataFrame:
    """(w, lp) of the different windows of ``words``: log p of the last character in every language, in 1/SCALE nats."""
    places = F.sequence(F.lit(0), F.lit(len(model.languages) - 1))
    w = F.col("w")
    keys = [F.concat(F.lit("d"), w.substr(ORDER - o + 1, o)) for o in range(1, ORDER + 1)]
    keys += [F.concat(F.lit("g"), w.substr(ORDER - o + 1, o - 1)) for o in range(2, ORDER + 1)]
    windows = words.select(F.explode(_grams("word")).alias("w")).distinct()
    wanted = windows.select("w", F.posexplode(F.array(*keys)).alias("slot", "key"))
    met = wanted.join(model.table, "key", "left").groupBy("w").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("m")
    )
    parts = [F.try_element_at("m", F.lit(i)).alias(f"v{i}") for i in range(len(keys))]

    def log_p(i: Column) -> Column:
        first = F.get(F.array(*map(F.lit, model.first)), i)
        p = F.coalesce(F.get("v0", i), F.lit(0.0)) + first * F.lit(1.0 / (model.alphabet + 1))
        for o in range(2, ORDER + 1):
            backoff = F.coalesce(F.get(f"v{ORDER + o - 2}", i), F.lit(1.0))
            p = F.coalesce(F.get(f"v{o - 1}", i), F.lit(0.0)) + backoff * p
        return F.round(F.log(p) * SCALE).cast("long")

    return met.select("w", *parts).select("w", F.transform(places, log_p).alias("lp"))


def _lists(matrix: np.ndarray) -> pa.Array:
    """A list column with the rows of a matrix."""
    offsets = np.arange(len(matrix) + 1) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.reshape(-1), pa.int64()))


def _summed(handle):
    """What the windows of each word within the block of sorted hashes add up to; words without a letter are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, scores = received(handle)
        for batch in sliced(batches, 16_384):
            words = [w for w in batch.column(0).to_pylist()]
            kept = np.fromiter(map(has_letter, words), dtype=bool, count=len(words))
            if not kept.any():
                continue
            codes, sizes = _windows([w for w, k in zip(words, kept) if k])
            at, known = _found(keys, _hashes(codes))
            sums = np.vstack([np.zeros((1, scores.shape[1]), dtype=np.int64), np.cumsum(scores[at] * known[:, None], axis=0)])
            ends = np.cumsum(sizes)
            out = batch.filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays([*out.columns, _lists(sums[ends] - sums[ends - sizes])], names=["word", "n", "s"])

    return run


def score_words(words: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """(word, n, s) of distinct words (word, n) with a letter: log p in every language, in 1/SCALE nats; written."""
    languages = len(model.languages)
    windows = scratch.stage(window_scores(words, model), "windows")
    blocks = max(1, -(-windows.count() * languages // (4 * _BLOCK_WINDOWS)))
    parts = []
    for block in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("w"), F.lit(blocks)) == block).toArrow()  # about _BLOCK_WINDOWS rows
        keys = _keys(rows.column("w").to_pylist(), ORDER)
        order = np.argsort(keys)
        scores = rows.column("lp").combine_chunks().flatten().to_numpy().reshape(len(keys), languages)[order]
        handle = shared(words.sparkSession, (keys[order], scores))
        parts.append(words.select("word", "n").mapInArrow(_summed(handle), "word string, n long, s array<long>"))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.union(part)
    if blocks > 1:
        sums = F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(languages)])
        scored = scored.groupBy("word").agg(F.any_value("n").alias("n"), sums.alias("s"))
    return scratch.stage(scored, "scores")


def _common(scored: DataFrame, model: Model) -> tuple[list[str], np.ndarray]:
    """The most common words with their scores: a fixed number of rows."""
    languages = len(model.languages)
    share = max(1, min(_KEPT_WORDS, _KEPT_SCORES // languages) // BUCKETS)
    bucket = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(BUCKETS))).orderBy(F.desc("n"), "word")
    top = scored.withColumn("_rank", F.row_number().over(bucket)).where(F.col("_rank") <= share).select("word", "s").toArrow()
    words = top.column("word").to_pylist()
    return words, top.column("s").combine_chunks().flatten().to_numpy().reshape(len(words), languages).astype(np.int64)


def _model(words: DataFrame, scratch: Scratch, keep: bool) -> Model:
    """The model of the counted words that have a language, without limits; ``keep`` its table beyond the scratch rows."""
    known = words.where("lang IS NOT NULL")
    model = Model(sorted(r.lang for r in known.select("lang").distinct().collect()))
    if model.languages:
        _fill(model, known, scratch, keep)
    return model


def _totals(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def _band() -> Column:
    return sum(((F.col("_chars") >= low).cast("int") for low in BANDS[1:]), F.lit(0))


def _calibrate(model: Model, entropies: DataFrame, slack: float) -> None:
    """Limits from the entropies of all different labelled texts that are not ``und``.

    For each language and length band the 99.9 % quantile of the cross-entropy
    plus ``slack`` nats is the highest accepted one: ordinary texts with codes or
    foreign passages in them stay well below it.
    """
    stats = entropies.where("known AND lang_pred <> 'und'").groupBy("lang_pred", _band().alias("band")).agg(
        F.percentile_approx("cross_entropy", 0.999, 10_000).alias("q")
    )
    # Few rows say little about a language's spread: up to three quarters of a uniform guess is accepted.
    floor = 0.75 * math.log(model.alphabet + 1)
    limits = np.full((len(model.languages), len(BANDS)), np.nan)
    for row in stats.collect():
        limits[model.languages.index(row.lang_pred), row.band] = max(row.q + slack, floor)
    # A band without rows takes the highest limit of its language, and one of no language never rejects.
    highest = np.where(np.isnan(limits).all(axis=1), np.inf, np.nanmax(np.nan_to_num(limits, nan=-1.0), axis=1))
    model.limits = np.where(np.isnan(limits), highest[:, None], limits)


def _key(text: Column | str) -> Column:
    return F.unhex(F.md5((F.col(text) if isinstance(text, str) else text).cast("binary")))


def fit(labelled: DataFrame, slack: float = 1.0) -> Model:
    """Train on the columns ``lang`` and ``text`` of all labelled rows, then calibrate on all of their texts.

    Rows without a language or a text are no training rows; without any the
    model knows no language and every text is ``und``. The model's table stays
    in the shared folder.
    """
    with Scratch(labelled.sparkSession) as scratch:
        rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
        words = scratch.stage(word_counts(rows), "words")
        model = _model(words, scratch, keep=True)
        if model.languages:
            keyed = rows.select(_key("text").alias("_key"), "text", F.lit(True).alias("known"))
            _calibrate(model, scratch.stage(_entropies(keyed, model, _totals(words), scratch), "entropies"), slack)
        return model


_NEW = ("lang_pred", "score", "cross_entropy", "rejected", "_chars")


def learn_and_identify(docs: DataFrame, label: Column | str = "lang", text_col: str = "text", slack: float = 1.0) -> DataFrame:
    """``identify(docs, fit(...))`` with the label of each row given by ``label``, reading the texts only twice.

    Rows whose label is NULL are identified, but nothing is learned from them:
    they add words to be scored, not counts.
    """
    docs = docs.drop(*_NEW)
    with Scratch(docs.sparkSession) as scratch:
        named = docs.select((F.col(label) if isinstance(label, str) else label).alias("lang"), F.col(text_col).alias("text"))
        words = scratch.stage(word_counts(named), "words")
        model = _model(words, scratch, keep=False)
        if not model.languages:
            return _placed(docs, None, model, text_col)
        keyed = named.where("text IS NOT NULL").select(_key("text").alias("_key"), "text", F.col("lang").isNotNull().alias("known"))
        found = written(_entropies(keyed, model, _totals(words), scratch), "languages")
        _calibrate(model, found, slack)
        return _placed(docs, found, model, text_col)


def _placed(docs: DataFrame, found: DataFrame | None, model: Model, text_col: str) -> DataFrame:
    """The rows of ``docs`` with what was found for their texts, and the verdict on it."""
    if found is None:
        kinds = ("string", "double", "double", "boolean", "long")
        docs = docs.select("*", *[F.lit(None).cast(k).alias(c) for c, k in zip(_NEW, kinds)])
    else:
        limits = F.array(*[F.lit(float(x)) for x in model.limits.reshape(-1)])
        known = F.array(*map(F.lit, model.languages))
        place = (F.array_position(known, F.col("lang_pred")) - 1) * len(BANDS) + _band()
        judged = found.withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("cross_entropy") > F.get(limits, place.cast("int"))))
        (key,) = unused(docs, "_key")
        judged = judged.select(F.col("_key").alias(key), *_NEW)
        docs = docs.select("*", _key(F.col(text_col)).alias(key)).join(judged, key, "left").select(*docs.columns, *_NEW)
    none = {"lang_pred": "und", "score": 0.0, "rejected": True, "_chars": 0}
    return docs.withColumns({c: F.coalesce(c, F.lit(v).cast("long") if c == "_chars" else F.lit(v)) for c, v in none.items()})


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its language.

    Adds ``lang_pred``, ``score`` (0 to 1, the posterior of the chosen language
    on at most 200 characters), ``cross_entropy`` (nats per character, null if
    ``und``), ``rejected`` and ``_chars``; columns of these names are replaced.
    A null or empty text, or one without a letter, is ``und`` with score 0 and
    rejected. Ties go to the language that sorts first. Repeated rows are
    scored alike and all returned; an empty table gives an empty result.
    """
    docs = docs.drop(*_NEW)
    if not model.languages:
        return _placed(docs, None, model, text_col)
    with Scratch(docs.sparkSession) as scratch:
        keyed = docs.where(F.col(text_col).isNotNull()).select(
            _key(text_col).alias("_key"), F.col(text_col).alias("text"), F.lit(False).alias("known")
        )
        words = scratch.stage(_totals(word_counts(keyed.select(F.lit(None).cast("string").alias("lang"), "text"))), "words")
        return _placed(docs, written(_entropies(keyed, model, words, scratch), "languages"), model, text_col)


def _entropies(keyed: DataFrame, model: Model, vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """The best language of each different text of ``keyed`` (_key, text, known); only short rows are shuffled.

    ``vocabulary`` (word, n) holds all words of the texts.
    """
    spark, languages = keyed.sparkSession, len(model.languages)
    scored = score_words(vocabulary, model, scratch)
    handle = shared(spark, _common(scored, model))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the common words of a text add up to, and its other words with their numbers."""
        words, table = received(handle)
        index = dict(zip(words, range(len(words))))
        table = np.vstack([table, np.zeros((1, table.shape[1]), dtype=np.int64)])  # the last row is of the others
        for batch in sliced(batches):
            sums, chars, others, numbers = [], [], [], []
            for text in texts(batch):
                c = Counter(words_of(text))
                places = np.fromiter(map(index.get, c, repeat(-1)), dtype=np.int64, count=len(c))
                n = np.fromiter(c.values(), dtype=np.int64, count=len(c))
                lengths = np.fromiter(map(len, c), dtype=np.int64, count=len(c)) + 1
                size = int(n @ lengths)
                rest: list[str] = []
                times: list[int] = []
                if (places < 0).any():
                    for w, p in zip(c, places.tolist()):
                        if p < 0:
                            if has_letter(w):
                                rest.append(w), times.append(c[w])
                            else:
                                size -= c[w] * (len(w) + 1)
                sums.append(n @ table[places])
                chars.append(size), others.append(rest), numbers.append(times)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("_key")), batch.column(batch.schema.get_field_index("known")),
                    pa.array(chars, pa.int64()),
                    pa.array(sums, pa.list_(pa.int64())), pa.array(others, pa.list_(pa.string())),
                    pa.array(numbers, pa.list_(pa.int64())),
                ],
                names=["_key", "known", "_chars", "s", "words", "times"],
            )

    parts = "_key binary, known boolean, _chars long, s array<long>, words array<string>, times array<long>"
    parts = scratch.stage(keyed.mapInArrow(split, parts), "parts")
    others = parts.where(F.size("words") > 0).dropDuplicates(["_key"])
    others = others.select("_key", F.explode(F.arrays_zip("words", "times")).alias("o"))
    others = others.select("_key", F.col("o.words").alias("word"), F.col("o.times").alias("n"))
    sums = F.array(*[F.sum(F.col("n") * F.get("s", F.lit(i))) for i in range(languages)])
    added = others.join(scored.select("word", "s"), "word").groupBy("_key").agg(sums.alias("more"))
    # Repeated texts are alike in all but ``known``.
    single = parts.groupBy("_key").agg(
        F.bool_or("known").alias("known"), F.max("_chars").alias("_chars"), F.max("s").alias("s")
    )
    whole = single.join(added, "_key", "left")
    names = model.languages

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            key, known, chars = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            lang, score, entropy = [], [], []
            for n, s, more in zip(chars, texts(batch, "s"), texts(batch, "more")):
                if not n:
                    lang.append("und"), score.append(0.0), entropy.append(None)
                    continue
                h = -(np.array(s) + np.array(more or [0])) / (SCALE * n)
                best = int(np.argmin(h))
                lang.append(names[best])
                score.append(float(1.0 / np.exp((h[best] - h) * min(n, 200)).sum()))
                entropy.append(float(h[best]))
            yield pa.RecordBatch.from_arrays(
                [
                    key, known, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                    pa.array(entropy, pa.float64()), pa.array(chars, pa.int64()),
                ],
                names=["_key", "known", "lang_pred", "score", "cross_entropy", "_chars"],
            )

    schema = "_key binary, known boolean, lang_pred string, score double, cross_entropy double, _chars long"
    return whole.select("_key", "known", "_chars", "s", "more").mapInArrow(judge, schema)
