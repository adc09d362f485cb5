"""Decontamination, hard negatives and centroid clustering against brute force and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontamination, dim_lloyd, hard_negatives

# decontamination

WORD = re.compile(decontamination.WORD)


def _judged(docs, items):
    """Every window of every item looked for at every place."""
    windows = {}
    for item_id, text in items:
        w = WORD.findall(text.lower()) if text else []
        m = min(len(w), 10)
        for s in range(len(w) - m + 1) if w else ():
            windows.setdefault(tuple(w[s : s + m]), set()).add(item_id)
    rows = []
    for doc_id, text in docs:
        w, hit, ids = WORD.findall(text.lower()) if text else [], set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[s : s + m]))) is not None:
                    hit.update(range(s, s + m))
                    ids |= found
        ids = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        rows.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return Counter(rows)


def _result(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_decontamination_agrees_with_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] if seed > 1 else ["a", "b"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 10, 11, 30])))) for i in range(25)]
    items += [(3, items[0][1]), (None, "n u l l"), (77, None), (78, " ,. ")]
    docs = []
    for i in range(60):
        w = rng.choices([f"x{k}" for k in range(30)] + vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1] or ""
            part = source.split()[rng.randint(0, 2) :]
            w[rng.randint(0, len(w)) : 0] = part
        docs.append((i, " ".join(w).upper() if i % 3 else "\n".join(w)))
    docs += [(5, None), (5, ""), (None, "N u-l, l"), docs[0], docs[0]]
    got = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert _result(got) == _judged(docs, items)


def test_every_shared_span_of_a_window_is_found(spark):
    # No two spans alike: only the guarantee of the smallest hash per window finds them.
    item = [f"q{i}" for i in range(200)]
    docs = [(s, " ".join(["left", *item[s : s + 10], "right"])) for s in range(191)]
    docs += [(1000 + s, " ".join(["left", *item[s : s + 9], "right"])) for s in range(50)]
    got = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"),
    ).collect()
    assert {(r.doc_id < 1000, r.n_hit) for r in got} == {(True, 10), (False, 0)}


def test_decontamination_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 4, "x", 7)], "doc_id long, text string, n_hit int, window string, `row.x` int")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    got = decontamination.contamination(docs, items, keep_text=True)
    assert got.columns == ["doc_id", "text", "window", "row.x", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    r = got.first()
    assert (r.text, r.window, r["row.x"], r.n_hit, r.contaminated) == ("a b", "x", 7, 1, True)
    assert decontamination.contamination(docs.limit(0), items).collect() == []
    none = decontamination.contamination(docs, items.limit(0)).first()
    assert (none.n_words, none.n_hit, none.contaminated) == (2, 0, False)
    long = spark.createDataFrame([(1, "z " * 300_000 + "b", 0, "", 0)], docs.schema)
    assert decontamination.contamination(long, items).first().n_hit == 1


# hard negatives


def _mined(rows, k=5):
    """By all pairs: rows of (vec_id, vector of integers, label)."""

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    def order(pair):
        s, i = pair
        return -s, rows[i][0] is None, rows[i][0] or 0, i

    out = []
    for n, (vec_id, v, label) in enumerate(rows):
        if vec_id is None or vec_id % 100:
            continue
        scored = [(score(v, w), i) for i, (_, w, _) in enumerate(rows) if i != n]
        near = sorted((p for p in scored if rows[p[1]][2] == label), key=order)[:k]
        for ps, p in near:
            fit = [x for x in scored if rows[x[1]][2] != label and 80 * ps <= 100 * x[0] <= 100 * ps]
            for rank, (ns, m) in enumerate(sorted(fit, key=order)[:k], 1):
                out.append((vec_id, rows[p][0], rank, rows[m][0], ps, ns))
    return Counter(out)


@pytest.mark.parametrize("seed, width, block", [(1, 64, 4096), (2, 7, 2), (3, 130, 4096)])
def test_hard_negatives_agree_with_brute_force(spark, seed, width, block):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(400):
        v = centres[rng.integers(6)] * rng.choice([0.2, 1.0]) + rng.normal(size=width) * rng.choice([0.05, 0.5])
        rows.append((int(i * 25 if i % 2 else i), [float(np.float32(x)) for x in v], int(rng.integers(3))))
    rows += [rows[0], rows[4], (100, [0.0] * width, 1), (200, rows[1][1][: width // 2], 2), (None, rows[2][1], 0), (300, [], 0)]
    odd = [(400, None, 1), (500, [float("nan")] * width, 1), (600, [float("inf")], 1), (700, rows[0][1], None), (800, [None, 1.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(3)
    vectors = hard_negatives.labelled_vectors(df)
    got = hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, block=block)
    want = _mined([(i, [int(np.floor(256 * x)) for x in v], y) for i, v, y in rows])
    assert want and Counter(tuple(r) for r in got.collect()) == want


def test_intervals_hold_and_thin_the_rows():
    rng = np.random.default_rng(5)
    width = 128
    centres = rng.normal(size=(20, width)) * 300
    vectors = np.floor(centres[rng.integers(20, size=2000)] + rng.normal(size=(2000, width)) * 60).astype(np.int64)
    vectors[7] = 0
    import pyarrow as pa

    raw = pa.RecordBatch.from_arrays(
        [pa.array(range(2000), pa.int64()), pa.array(range(2000), pa.int64()), pa.array([0] * 2000, pa.int64()), pa.array(vectors.tolist(), pa.list_(pa.int64()))],
        names=["row", "vec_id", "label", "vector"],
    )
    shard = hard_negatives.Shard(next(hard_negatives._coded(width)(iter([raw]))), width)
    anchors = hard_negatives.Anchors.of(list(range(50)), [0] * 50, vectors[:50], width)
    low, high = shard.intervals(anchors, slice(0, 50))
    exact = vectors[:50] @ vectors.T
    assert (low <= exact).all() and (exact <= high).all()
    tenth = np.sort(exact, axis=1)[:, -10, None]
    assert (high >= tenth).mean() < 0.2


def test_hard_negatives_odd_tables(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], "vec_id long, embedding array<double>, label int")
    every = F.col("vec_id") % 100 == 0
    assert hard_negatives.mine(hard_negatives.labelled_vectors(df), every).collect() == []
    assert hard_negatives.mine(hard_negatives.labelled_vectors(df.limit(0)), every).collect() == []
    huge = spark.createDataFrame([(0, [1e30], 1)], df.schema)
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(hard_negatives.labelled_vectors(huge), every)


# centroid clustering


def _lloyd(rows, k, rounds):
    """Plain Lloyd over (vec_id, vector of integers)."""

    def key(r):
        return r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]

    centroids = [list(v) for _, v in sorted(rows, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in rows:
            members[nearest(v)[1]].append(v)
        for j, m in enumerate(members):
            if m:
                centroids[j] = [sum(x) // len(m) for x in zip(*m)]
    last = [(i, *nearest(v)) for i, v in rows]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), shas[j]) for i, d, j in last)


@pytest.mark.parametrize("n, k, width, block", [(300, 16, 64, 16), (300, 5, 10, 4), (3, 16, 64, 16), (60, 1, 3, 16)])
def test_clusters_agree_with_plain_lloyd(spark, n, k, width, block):
    rng = np.random.default_rng(n + k)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=width) + 3 * rng.integers(4)]) for i in range(n)]
    if n > 100:
        rows += [rows[0], rows[0], (5, rows[1][1]), (None, rows[2][1]), *[(1000 + i, rows[3][1]) for i in range(150)]]
    odd = [(7, None), (8, [1.0] * (width - 1)), (9, [float("nan")] * width), (10, [float("-inf")] * width), (11, [None] * width)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    got = dim_lloyd.cluster(dim_lloyd.integer_vectors(df, width=width), k=k, block=block)
    assert Counter(tuple(r) for r in got.collect()) == _lloyd([(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows], k, 3)


def test_clustering_odd_tables(spark):
    df = spark.createDataFrame([(1, [0.5] * 64, 9)], "vec_id long, embedding array<float>, cluster int")
    assert dim_lloyd.cluster(dim_lloyd.integer_vectors(df.limit(0))).collect() == []
    assert [tuple(r)[:5] for r in dim_lloyd.cluster(dim_lloyd.integer_vectors(df)).collect()] == [(1, 0, 0, 0, 0)]
    huge = spark.createDataFrame([(1, [1e30] * 64, 9)], df.schema)
    with pytest.raises(ValueError, match="64 bits"):
        dim_lloyd.cluster(dim_lloyd.integer_vectors(huge))
