"""N-gram join, mixing, the pipeline, and every registered query."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tickloom.llm import mixing, ngram_join
from tickloom.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


def _near_copies(rng: random.Random) -> list[tuple[int, str | None]]:
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=25)
    rows: list[tuple[int, str | None]] = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        if rng.random() < 0.5:
            base[5:5] = passage
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            words = words[: len(words) - rng.choice([0, 0, 1, 4, 9])] or ["w0"]
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(words)))
    chain = rng.choices(vocabulary, k=100)  # neighbours are linked, the ends are not
    for i in range(30):
        rows.append((len(rows), " ".join(chain[2 * i : 2 * i + 60])))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "A b", "a B", "a b c", "a b c d", "a b c"])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_links_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = _near_copies(rng)
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, size int").repartition(5)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(df, max_frequent=128).collect()}
    want = ngram_join.all_links_by_brute_force(spark, rows)
    assert got == want and len({c for _, _, c in want}) < len(rows)


def test_a_large_group_of_near_copies_makes_few_pairs(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketches = ngram_join.sketches(docs, ngram_join.frequent_grams(docs, 1 << 12), 85).cache()
    members = sketches.select("gid", "node").distinct()
    lists = ngram_join._lists(sketches, members, 85)
    heads = members.groupBy("gid").agg(F.min("node").alias("node"))
    assert ngram_join._star_pairs(lists, heads, members, 85).count() <= 3 * len(rows)
    assert {r.component_id for r in ngram_join.linked(docs).collect()} == {0}


def test_odd_rows_of_the_join(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (5, "q r s t u"), (None, "a b c d e"), (None, "only here x y"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(df).collect())
    assert got == Counter([(5, 2, 5), (5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 1, None), (2, 0, 2)])
    assert ngram_join.linked(df.limit(0)).collect() == []
    kept = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect())
    assert kept[(2, None)] == 1 and kept[(None, "only here x y")] == 1 and sum(n for (d, _), n in kept.items() if d == 5) >= 1
    assert kept[(5, "a b c d e")] <= 1 and (None, "a b c d e") not in kept


def test_rows_without_an_id_carry_links(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[2 * i : 2 * i + 40]) for i in range(3)]  # neighbours share 35 of 39 grams, the ends 31 of 43
    rows = [(1, texts[0]), (None, texts[1]), (3, texts[2]), (None, "x y z q r"), (None, "x y z q r"), (9, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.linked(df, percent=85).collect())
    assert got == Counter([(1, 1), (None, 1), (3, 1), (None, None), (None, None), (9, 9)])
    assert {r.doc_id for r in ngram_join.one_of_each(df, percent=85).where("doc_id IS NOT NULL").collect()} == {1, 9}


def test_classes_that_share_an_id_keep_one_row_each(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (5, "q r s t u"), (7, "q r s t u"), (None, "x y"), (None, "x y"), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect())
    assert kept == Counter([(5, "a b c d e"), (5, "q r s t u"), (None, "x y"), (None, "z")])


def test_the_stage_links_five_word_shingles_at_80_percent(spark):
    words = [f"w{i}" for i in range(98)]
    spread = [f"x{i}" if i in (20, 60) else w for i, w in enumerate(words)]  # 84 of 104 shingles, 87 of 103 in four words
    cut = words[:82]  # 78 of 94, 79 of 95 in four words
    apart = words[:74] + [f"y{i}" for i in range(24)]  # 70 of 118
    rows = [(1, " ".join(words)), (2, " ".join(spread)), (3, " ".join(cut)), (4, " ".join(apart)), (5, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["ngram_join"]
    assert {r.doc_id for r in stage(spark, docs, SF_DIR).collect()} == {1, 4, 5}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 70), (3, 3)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(21)} | {(50, 50), (70, 50), (100, 50)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_misses_meet_in_few_lists_and_no_link_is_lost(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [
        (i, " ".join(w if rng.random() < 0.975 else f"x{rng.randrange(10**9)}" for w in base)) for i in range(20)
    ]
    # A link across classes: 20 is near to 0 and 21 to 20.
    for i, of in ((20, 0), (21, 20)):
        words = rows[of][1].split()
        words[200 + i] = f"y{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    real = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, label: seen.setdefault(label, real(df, label)) if label == "mixed" else real(df, label))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked(docs).collect()}
    assert got == ngram_join.all_links_by_brute_force(spark, rows)
    entries = seen["mixed"].where("pos >= 0").select("gram", "node", "root")
    other = entries.toDF("gram", "n", "r")
    shared = entries.join(other, "gram").where("node > n AND root <> r").count()
    met = ngram_join._meetings(seen["mixed"], 85)
    assert 0 < met.count() <= shared / 3


# mixing


def _docs(spark):
    rows = [(i, "big", "w " * 20, 7) for i in range(600)] + [(1000 + i, "mid", "w " * 20, 7) for i in range(150)]
    rows += [(2000 + i, None, "w " * (20 if i else 1), 7) for i in range(60)] + [(3000, "one", None, 7), (3000, "one", "", 7)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, place int")


def test_every_row_is_drawn_and_repeats_are_limited(spark):
    docs = _docs(spark).where("source IS NULL OR source <> 'one'")
    got = mixing.mix(docs, mixing.Target(repetitions=3.0), blocks=64).collect()
    by = defaultdict(Counter)
    for r in got:
        by[r.source][r.doc_id] += 1
    assert set(by["big"].values()) == {1} and len(by["big"]) == 600
    assert set(by[None].values()) == {3} and len(by[None]) == 60  # the rarest source meets the limit
    assert set(by["mid"].values()) <= {1, 2} and len(by["mid"]) == 150
    weight = {r.source: r.weight for r in got}
    tokens = {s: sum(n * (1 if d == 2000 else 20) for d, n in c.items()) for s, c in by.items()}
    total = sum(tokens.values())
    for s in weight:
        assert tokens[s] / total == pytest.approx(weight[s], abs=0.02)
    # Ordered by place, every prefix holds about the target weights.
    half = [r for r in got if r.place < 0.5]
    assert sum(r.source == "big" for r in half) / len(half) == pytest.approx(weight["big"], abs=0.05)
    # An epoch is a permutation: each block once.
    assert max(Counter((r.source, r.epoch, r.doc_id) for r in got).values()) == 1


def test_exponent_by_hand(spark):
    totals = spark.createDataFrame([("a", 900, 900.0), ("b", 100, 900.0)], "_source string, tokens long, most double")
    assert mixing.exponent(totals, mixing.Target(repetitions=3.0)) == pytest.approx(0.5, abs=1e-6)
    assert mixing.exponent(totals, mixing.Target(repetitions=1.0)) == 1.0
    assert mixing.exponent(totals, mixing.Target(repetitions=100.0)) == 0.0
    flat = mixing.exponent(totals, mixing.Target(entropy=1.0))
    assert flat == pytest.approx(0.0, abs=1e-3)
    some = mixing.exponent(totals, mixing.Target(entropy=0.8))
    import math
    p = 900**some / (900**some + 100**some)
    assert -(p * math.log(p) + (1 - p) * math.log(1 - p)) / math.log(2) == pytest.approx(0.8, abs=1e-6)


def test_passes_of_the_exponent_share_their_code(spark):
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    counts = []
    for most in (1000, 800):
        totals = spark.createDataFrame([("a", most, float(most)), ("b", 10, float(most))], "_source string, tokens long, most double")
        before = compiled.getCount()
        mixing.exponent(totals, mixing.Target(repetitions=3.0))
        counts.append(compiled.getCount() - before)
    assert counts[0] <= 6 and counts[1] == 0


def test_a_budget_cuts_by_whole_blocks(spark):
    got = mixing.mix(_docs(spark), mixing.Target(repetitions=1.5, budget=6000), blocks=64)
    n = got.groupBy("source").agg(F.sum(F.greatest(F.lit(1), mixing.word_count(F.col("text")))).alias("n"), F.first("weight").alias("w"))
    for r in n.where("n > 100").collect():
        assert r.n == pytest.approx(6000 * r.w, abs=6000 * 0.04)
    assert mixing.mix(_docs(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.Target()


def test_word_count(spark):
    rows = [(None, 0), ("", 0), (" ", 0), ("a", 1), (" a\tb \n", 2), ("a b", 2)]
    got = spark.createDataFrame(rows, "text string, n int").select(mixing.word_count(F.col("text")), "n").collect()
    assert all(a == b for a, b in got)


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "ngram_join", "pii", "mixing", "packing"]
    known = stages["language_id"](spark, docs, SF_DIR).cache()
    assert known.columns == docs.columns and known.count() >= 0.98 * docs.where("length(text) > 0").count()
    single = stages["ngram_join"](spark, known, SF_DIR).cache()
    groups = ngram_join.all_links_by_brute_force(spark, [(r.doc_id, r.text) for r in known.collect()])
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in groups} and single.count() < known.count()
    masked = stages["pii"](spark, single, SF_DIR).cache()
    assert masked.count() == single.count() and masked.columns == docs.columns
    both = masked.select("doc_id", F.col("text").alias("new"), "n_chars").join(single.select("doc_id", "text"), "doc_id")
    from llm import oracles
    for r in both.collect():
        assert not oracles.personal(r.new)[1] and len(r.new) == r.n_chars
        assert (r.new == r.text) == (not oracles.personal(r.text)[1])
    mixed = stages["mixing"](spark, masked, SF_DIR).cache()
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == masked.count()
    packed = stages["packing"](spark, mixed, SF_DIR)
    starts = packed.where("start = 0").groupBy("doc_id").count()
    assert {tuple(r) for r in starts.collect()} == {tuple(r) for r in mixed.groupBy("doc_id").count().collect()}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert stage(spark, empty, SF_DIR).collect() == []


def test_every_query_is_registered():
    names = set(corpus_pipeline.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", [n for n, q in corpus_pipeline.QUERIES.items() if not q.sql])
def test_query_without_sql_runs_whole(spark, name):
    """A row for every row of its table; mixing repeats some, packing cuts some, the pipeline does both and drops some."""
    rows = corpus_pipeline.QUERIES[name].run(spark, SF_DIR)
    table, key = ("pages", "page_id") if name.startswith("op4") else ("documents", "doc_id")
    every = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    got = Counter(r[0] for r in rows.select(key).collect())
    assert set(got) <= every and (name == "pipeline" or set(got) == every)
    assert name in ("op7_mixing", "op9_packing", "pipeline") or set(got.values()) == {1}


@pytest.mark.parametrize("name", [n for n, q in corpus_pipeline.QUERIES.items() if q.sql])
def test_query_agrees_with_its_sql(spark, name):
    from compare import connect, difference

    query = corpus_pipeline.QUERIES[name]
    assert difference(query.run(spark, SF_DIR), connect(SF_DIR), query.sql) is None
