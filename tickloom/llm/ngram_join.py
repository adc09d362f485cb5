"""Exact Jaccard links between documents by a grouped prefix join.

A document is the set of its word n-grams, each a 64-bit hash; documents with
the same set are one node. Under a total order of the grams, two sets that meet
the threshold share a gram within their prefixes. Nodes with the same prefix
and size form a group, which stands in the index once. The index lists groups
by prefix gram; size and positional filters judge the pairs of a list, groups
are then expanded and the members' whole sets compared.

The order is frequent grams last. The most frequent ones (at most
``max_frequent``, so their broadcast is bounded) are found over all documents,
the others follow their hash. Any order gives the exact result; this one keeps
shared passages out of the prefixes.

Only connected classes are asked for, so pairs within one class need not all be
compared. First every node is compared with the head of its lists (a star,
linear in the nodes); then the pairs of a list that still lie in different
classes. A list whose members are one class makes no pairs. A pair is made in
the first lists it shares only, short lists first, and what it shares is then
counted once from the lists of both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import extended, received, shared, sliced, texts, travels, with_fields, written
from tickloom.llm.components import components

travels(__name__)

N, PERCENT = 4, 85
MAX_FREQUENT = 1 << 18
MAX_FILTER_BITS = 1 << 28
_BUCKETS = 64
_MARKS = 8  # words of 64 bits in the bitmap of a prefix
_CHUNK = 1 << 21  # grams counted together by a task
_KEPT_WORDS = 100_000  # word hashes kept by a task
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M[3]
    return h ^ (h >> np.uint64(29))


def gram_sets(batch: Iterable[str | None], known: _WordHashes, n: int = N) -> list[np.ndarray]:
    """Sorted distinct gram hashes of each text.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer
    than n words has one gram, its whole sequence; a null text or one without
    words has none.
    """
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in batch]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(sizes.sum()))
    ends = np.cumsum(sizes)
    grams = np.zeros(0, dtype=np.uint64)
    if len(flat) >= n:
        grams = flat[: len(flat) - n + 1].copy()
        for k in range(1, n):
            grams = grams * _M[k % 3] + flat[k : len(flat) - n + 1 + k]
        grams = _mixed(grams)
    out = []
    for size, end in zip(sizes, ends):
        if size >= n:
            out.append(np.unique(grams[end - size : end - n + 1]))
        elif size:
            h = np.full(1, size, dtype=np.uint64)
            for w in flat[end - size : end]:
                h = _mixed(h * _M[0] + w)
            out.append(h)
        else:
            out.append(grams[:0])
    return out


def _node(grams: np.ndarray) -> bytes | None:
    """128-bit digest of a set; null for the empty one."""
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def _frequent_in_chunks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    known, kept, nodes, held = _WordHashes(), [], set(), 0

    def counted() -> pa.RecordBatch:
        grams, times = np.unique(np.concatenate(kept or [np.zeros(0, np.uint64)]), return_counts=True)
        grams, times = grams[times >= 3], times[times >= 3]
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(times)], names=["gram", "n"])

    for batch in sliced(batches):
        for grams in gram_sets(texts(batch), known, n):
            node = _node(grams)
            if node is None or node in nodes:
                continue
            nodes.add(node), kept.append(grams)
            held += len(grams)
            if held >= _CHUNK:
                yield counted()
                kept, nodes, held = [], set(), 0
    yield counted()


def frequent_grams(docs: DataFrame, most: int, n: int = N) -> np.ndarray:
    """The frequent grams, rarest first: counts of all documents, bounded to ``most`` rows."""
    counts = docs.select("text").mapInArrow(lambda batches: _frequent_in_chunks(batches, n), "gram long, n long")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    bucket = Window.partitionBy(F.pmod("gram", F.lit(_BUCKETS))).orderBy(F.desc("n"), "gram")
    top = counts.withColumn("_rank", F.row_number().over(bucket)).where(F.col("_rank") <= most // _BUCKETS)
    found = top.select("gram", "n").toPandas().sort_values(["n", "gram"])
    return found.gram.to_numpy(dtype=np.int64).view(np.uint64)


def _ceil_share(part: int, whole: int) -> int:
    return -(-part * whole // 100)


def sketches(docs: DataFrame, frequent: np.ndarray, percent: int, n: int = N) -> DataFrame:
    """(doc_id, size, node, gid, prefix, marks, hidden) of every row; gid stands for prefix and size.

    marks is a bitmap of the prefix's grams by their last bits, hidden the
    number of grams that fell on a bit already set. Two prefixes share at most
    their common bits and the lesser hidden count.
    """
    by_hash = np.argsort(frequent)
    handle = shared(docs.sparkSession, (frequent[by_hash], by_hash))

    schema = with_fields(
        docs.select("doc_id").schema, size="int", node="binary", gid="long", prefix="array<long>",
        marks="array<long>", hidden="int",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rank = received(handle)
        known = _WordHashes()
        for batch in sliced(batches):
            size, node, gid, prefix, marks, hidden = [], [], [], [], [], []
            for grams in gram_sets(texts(batch), known, n):
                many = len(grams)
                length = many - _ceil_share(percent, many) + 1 if many else 0
                if len(hashes) and many:
                    at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
                    is_frequent = hashes[at] == grams
                    late = grams[is_frequent][np.argsort(rank[at[is_frequent]], kind="stable")]
                    grams_in_order = np.concatenate([grams[~is_frequent], late])
                else:
                    grams_in_order = grams
                head = grams_in_order[:length]
                size.append(many)
                node.append(_node(grams))
                gid.append(xxhash.xxh3_64_intdigest(head.tobytes(), seed=many) - (1 << 63) if many else None)
                prefix.append(head.view(np.int64))
                field = np.zeros(_MARKS * 8, dtype=np.uint8)
                np.bitwise_or.at(field, (head >> np.uint64(3)).astype(np.int64) % len(field), np.left_shift(1, (head & np.uint64(7)).astype(np.uint8)))
                marks.append(field.view(np.int64))
                hidden.append(length - int(np.unpackbits(field).sum()))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            columns = [ids, pa.array(size, pa.int32()), pa.array(node, pa.binary())]
            columns += [pa.array(gid, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))]
            columns += [pa.array(marks, pa.list_(pa.int64())), pa.array(hidden, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _bits(needed: DataFrame) -> np.ndarray:
    """A filter over the representatives' ids: fixed bounds of size, false positives only."""
    bits = 1 << 20
    count = needed.count()
    while bits < min(MAX_FILTER_BITS, 16 * count):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            at = _places(batch.column(0), bits)
            np.bitwise_or.at(field, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([field.tobytes()], pa.binary())], names=["field"])

    field = np.zeros(bits // 8, dtype=np.uint8)
    for row in needed.where("rep IS NOT NULL").select("rep").coalesce(8).mapInArrow(run, "field binary").toLocalIterator():
        field |= np.frombuffer(row.field, dtype=np.uint8)
    return field


def _places(ids: pa.Array, bits: int) -> np.ndarray:
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (_mixed(known * _M[0]) & np.uint64(bits - 1)).astype(np.int64)


def sets_of(docs: DataFrame, needed: DataFrame, label: str, n: int = N) -> DataFrame:
    """(node, grams) of the needed nodes, from the text of each one's representative, written.

    Only texts whose id passes the filter, and those without an id, are cut into
    grams. A few others may be among them, and a node twice if its representative's row is repeated;
    joins on the node sort that out.
    """
    handle = shared(docs.sparkSession, _bits(needed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, known = received(handle), _WordHashes()
        for batch in sliced(batches):
            ids = batch.column(0)
            at = _places(ids, len(field) * 8)
            hit = (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            chosen = np.nonzero(hit.astype(bool) | ids.is_null().to_numpy(zero_copy_only=False))[0]
            sets = [g for g in gram_sets(batch.column(1).take(pa.array(chosen)).to_pylist(), known, n) if len(g)]
            columns = [pa.array(map(_node, sets), pa.binary()), pa.array([g.view(np.int64) for g in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "grams"])

    found = docs.select("doc_id", "text").mapInArrow(run, "node binary, grams array<long>")
    return written(found, label)


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, n: int = N) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets meet the threshold, written."""
    if pairs.isEmpty():
        return pairs
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = written(wanted.join(nodes.select("node", "rep"), "node"), "needed")
    sets = sets_of(docs, needed, "sets", n)
    one, two = sets.toDF("a", "grams_a"), sets.toDF("b", "grams_b")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    met = 100 * both >= percent * (F.size("grams_a") + F.size("grams_b") - both)
    return written(pairs.join(one, "a").join(two, "b").where(met).select("a", "b"), "links")


def _close_in_size(s: Column, t: Column, percent: int) -> Column:
    return 100 * F.least(s, t) >= percent * F.greatest(s, t)


def _position_allows(s: Column, p: Column, t: Column, q: Column, percent: int) -> Column:
    """Enough grams from the first shared one on."""
    return (100 + percent) * F.least(s - p, t - q) >= percent * (s + t)


def _shared_enough(k: Column, s: Column, t: Column, percent: int) -> Column:
    """Enough shared grams within both prefixes.

    What two sets share up to the end of the prefix that ends first lies in both
    prefixes; what follows is at most the rest behind a prefix, whose length
    follows from the size.
    """
    rest = F.ceil(percent * F.greatest(s, t) / 100) - 1
    return (100 + percent) * (k + rest) >= percent * (s + t)


def _star_pairs(lists: DataFrame, heads: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Each node with its group's head, each group's head with that of its two best pivots.

    The pivot of a list is its group with the most company over all its lists:
    of near copies, the one closest to the rest. A group meets the pivots of its
    own size band and of the two beside it. Pivots that share too few lists are
    left out here; they are judged with the pairs that cross classes.
    """
    entries = lists.where("pos >= 0")
    company = entries.groupBy("gid").agg(F.sum("groups").alias("company"))
    by_band = Window.partitionBy("gram").orderBy("band")
    best = F.max(F.struct("company", "gid", "size"))
    votes = (
        entries.join(company, "gid")
        .select("gid", "size", F.array(*[best.over(by_band.rangeBetween(i, i)) for i in (-1, 0, 1)]).alias("_pivots"))
        .select("gid", "size", F.explode("_pivots").alias("pivot"))
        .where("pivot.gid <> gid")
        .groupBy("gid", F.col("pivot.gid").alias("p"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("s"), F.max("pivot.size").alias("t"))
        # In some of the shared lists another group may be the pivot.
        .where(_shared_enough(2 * F.col("n"), F.col("s"), F.col("t"), percent))
        .where(_close_in_size(F.col("s"), F.col("t"), percent))
    )
    rank = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("n"), "p"))
    pivots = votes.withColumn("_at", rank).where("_at <= 2")
    across = (
        pivots.join(heads.toDF("gid", "a"), "gid").join(heads.toDF("p", "b"), "p").select("a", "b")
    )
    within = members.join(heads.toDF("gid", "b"), "gid").select(F.col("node").alias("a"), "b")
    return _ordered(across.union(within))


def _ordered(pairs: DataFrame) -> DataFrame:
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def _crossing_pairs(
    rows: DataFrame, lists: DataFrame, members: DataFrame, classes: DataFrame, percent: int
) -> DataFrame:
    """Pairs of nodes that share a list, lie in different classes and pass the filters."""
    placed = members.join(classes, "node", "left").select("gid", "node", F.coalesce("root", "node").alias("root"))
    spans = placed.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    lists = lists.drop("groups")
    mixed = (
        lists.join(spans, "gid")
        .groupBy("gram").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("groups"))
        .where("lo <> hi").select("gram", "groups")
    )
    marks = [F.col("marks")[i].alias(f"m{i}") for i in range(_MARKS)]
    marked = rows.select("gid", "hidden", *marks).where("gid IS NOT NULL").dropDuplicates(["gid"])
    # Of a group's lists, short ones first: how many are left, this one included.
    behind = Window.partitionBy("gid").orderBy(F.col("pos") < 0, F.desc("groups"), F.desc("gram"))
    left = F.when(F.col("pos") < 0, F.col("size")).otherwise(F.row_number().over(behind)).alias("left")
    entries = lists.join(mixed, "gram").select("gram", "gid", "size", "pos", left)
    entries = written(entries.join(placed, "gid").join(marked, "gid"), "mixed")
    pairs = written(_meetings(entries, percent).distinct(), "pairs")
    return _fitting(pairs, entries, percent)


def _meetings(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b, gid_a, gid_b) wherever two entries of a list might be a pair across classes, some pairs more than once.

    Such a pair has a node outside the list's largest class, so only those are
    joined with the list. Two groups that share enough lists have as many left
    behind the first of them, so they meet there; in the lists behind it, most of
    which are longer, they need not meet again.
    """
    columns = ("node", "gid", "root", "size", "left", "hidden", *[f"m{i}" for i in range(_MARKS)])
    home = (
        entries.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("gram").agg(F.max_by("root", F.struct("n", "root")).alias("home"))
    )
    placed = entries.join(home, "gram")
    x = placed.where("root <> home").select("gram", *[F.col(c).alias(f"{c}_x") for c in columns])
    y = placed.select("gram", "home", *[F.col(c).alias(f"{c}_y") for c in columns])
    # The bitmaps bound what both prefixes share, so hopeless pairs never leave the join.
    common = sum((F.bit_count(F.col(f"m{i}_x").bitwiseAND(F.col(f"m{i}_y"))) for i in range(_MARKS)), F.least("hidden_x", "hidden_y"))
    most = F.least(common, "left_x", "left_y")
    likely = _shared_enough(most, F.col("size_x"), F.col("size_y"), percent)
    pairs = x.join(y, "gram").where("root_x <> root_y AND (root_y = home OR node_x > node_y)")
    pairs = pairs.where(_close_in_size(F.col("size_x"), F.col("size_y"), percent) & likely)
    swap = F.col("node_x") < F.col("node_y")
    one, two = (
        F.struct(*[F.when(swap, F.col(f"{c}_{m}")).otherwise(F.col(f"{c}_{n}")).alias(c) for c in ("node", "gid")])
        for m, n in (("y", "x"), ("x", "y"))
    )
    pairs = pairs.select(one.alias("a"), two.alias("b"))
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.gid").alias("gid_a"), F.col("b.gid").alias("gid_b"))


def _fitting(pairs: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share enough lists, from the lists of each group, and whose first shared gram stands early enough."""
    wanted = pairs.select(F.col("gid_a").alias("gid")).union(pairs.select("gid_b")).distinct()
    listed = (
        entries.where("pos >= 0").join(wanted, "gid", "left_semi")
        .groupBy("gid").agg(F.sort_array(F.collect_set(F.struct("pos", "gram"))).alias("l"), F.max("size").alias("size"))
        .select("gid", "size", F.col("l.gram").alias("grams"), F.col("l.pos").alias("at"))
    )
    one, two = listed.toDF("gid_a", "s", "grams_a", "at_a"), listed.toDF("gid_b", "t", "grams_b", "at_b")
    met = pairs.join(one, "gid_a", "left").join(two, "gid_b", "left")
    met = met.withColumn("both", F.array_intersect("grams_a", "grams_b")).withColumn("first", F.get("both", F.lit(0)))
    p, q = (F.get(f"at_{c}", (F.array_position(f"grams_{c}", F.col("first")) - 1).cast("int")) for c in "ab")
    s, t = F.col("s"), F.col("t")
    enough = _shared_enough(F.size("both"), s, t, percent) & _position_allows(s, p, t, q, percent)
    # Members of one group share their whole prefix, of which not every gram is listed.
    return met.where((F.col("gid_a") == F.col("gid_b")) | enough).select("a", "b")


def _lists(rows: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(gram, gid, size, pos, band, groups): the lists of prefix grams, without groups that cannot link.

    A group of several nodes is a list of its own, with position -1.
    """
    groups = rows.where("gid IS NOT NULL").select("gid", "size", "prefix").distinct()
    entries = groups.select("gid", "size", F.posexplode("prefix").alias("pos", "gram"))
    # Sizes that are close enough lie at most two bands apart.
    band = F.floor(F.log("size") / F.lit(-np.log(percent / 100) / 2)).cast("int")
    entries = (
        entries.withColumn("groups", F.count(F.lit(1)).over(Window.partitionBy("gram")))
        .where("groups > 1")
        .select("gram", "gid", "size", "pos", band.alias("band"))
    )
    lists = _able_to_link(written(entries, "entries"), percent)
    several = members.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gid")
    own = groups.select("gid", "size").distinct().join(several, "gid").select(
        F.col("gid").alias("gram"), "gid", "size", F.lit(-1).alias("pos"), F.lit(0).alias("band"),
        F.lit(0).cast("long").alias("groups"),
    )
    return written(lists.union(own), "lists")


def _able_to_link(entries: DataFrame, percent: int) -> DataFrame:
    """The entries of groups that share enough of their prefix with others of a size close to theirs.

    How much two groups must share within their prefixes depends on both sizes
    and is least at the ends of the range of sizes. A group with fewer shared
    grams than at either end of the sizes it meets has no links. Sizes are
    gathered by band, so a list of any length is a few rows.
    """
    near = Window.partitionBy("gram").orderBy("band").rangeBetween(-2, 2)
    met = (
        entries.groupBy("gram", "band")
        .agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("lo"), F.max("size").alias("hi"))
        .select("gram", "band", F.sum("n").over(near).alias("groups"), F.min("lo").over(near).alias("lo"), F.max("hi").over(near).alias("hi"))
        .where("groups > 1")
    )
    entries = entries.join(met, ["gram", "band"])
    least, most = F.ceil(F.col("size") * percent / 100), F.floor(F.col("size") * 100 / percent)
    able = (
        entries.groupBy("gid")
        .agg(
            F.count(F.lit(1)).alias("k"), F.first("size").alias("s"),
            F.min(F.greatest("lo", least)).alias("lo"), F.max(F.least("hi", most)).alias("hi"),
        )
        .where(
            _shared_enough(F.col("k"), F.col("s"), F.col("lo"), percent)
            | _shared_enough(F.col("k"), F.col("s"), F.col("hi"), percent)
        )
    )
    columns = ("gram", "gid", "size", "pos", "band", "groups")
    return entries.join(able.select("gid"), "gid", "left_semi").select(*columns)


def linked(docs: DataFrame, percent: int = PERCENT, max_frequent: int = MAX_FREQUENT, n: int = N) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, node, root.

    root is the least node of the class and tells classes apart, also those that
    share a doc_id; a document without words has none. component_id is the smallest doc_id of the documents reachable by links,
    its own included. A document without words has size 0, no links and its own
    id. Rows with a null doc_id link like others; a class of such rows only
    has a null component_id. Repeated
    rows are one node and all returned. Columns other than doc_id and text are
    not read. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    rows = written(sketches(docs, frequent_grams(docs, max_frequent, n), percent, n), "sketches")
    nodes = written(
        rows.where("node IS NOT NULL").groupBy("node", "gid").agg(F.min("doc_id").alias("rep")), "nodes"
    )
    members = nodes.select("gid", "node")
    heads = members.groupBy("gid").agg(F.min("node").alias("node"))
    lists = _lists(rows, members, percent)
    stars = written(_star_pairs(lists, heads, members, percent), "stars")
    links = verified(docs, nodes, stars, percent, n)
    classes = written(components(links), "classes")
    crossing = _crossing_pairs(rows, lists, members, classes, percent)
    crossing = written(crossing.join(stars, ["a", "b"], "left_anti"), "crossing")
    links = links.union(verified(docs, nodes, crossing, percent, n))
    classes = written(components(links), "classes")
    named = nodes.join(classes, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_node = named.join(least, "root").select("node", "component_id", "root")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(by_node, "node", "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), own.alias("component_id"), "node", "root"
    )


def with_node(docs: DataFrame, n: int = N) -> DataFrame:
    """``docs`` with ``_node``, the digest of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in sliced(batches):
            nodes = [_node(grams) for grams in gram_sets(texts(batch), known, n)]
            yield extended(batch, {"_node": pa.array(nodes, pa.binary())})

    return docs.mapInArrow(run, with_fields(docs.schema, _node="binary"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """The rows of ``docs`` without those linked to another kept one, all columns as they are.

    Of a class the row with the smallest doc_id stays (one of equal rows, and
    rows with an id before those without). Rows without words all stay.
    """
    found = linked(docs, percent, n=n).where("node IS NOT NULL")
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("_k")
    )
    key = F.coalesce("doc_id", F.xxhash64("_node")).alias("_key")
    kept = kept.select(
        F.coalesce("_k.doc_id", F.xxhash64("_k.node")).alias("_key"), F.col("_k.node").alias("_node")
    )
    marked = with_node(docs, n).select("*", key).join(kept.withColumn("_kept", F.lit(True)), ["_key", "_node"], "left")
    first = F.row_number().over(Window.partitionBy("_key", "_node").orderBy(F.lit(0)))
    chosen = marked.withColumn("_first", first).where("_node IS NULL OR (_kept AND _first = 1)")
    return chosen.select(*docs.columns)


def all_links_by_brute_force(spark: SparkSession, rows: list[tuple[int, str | None]], percent: int = PERCENT):
    """Components by comparing all pairs on the driver: the tests' measure, for small inputs only."""
    grams = gram_sets([t for _, t in rows], _WordHashes())
    sets = [set(g.tolist()) for g in grams]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}
