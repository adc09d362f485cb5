"""License scan, personal data and quality rules against brute force, and their edge cases."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm import oracles
from pyspark.sql import functions as F

from tickloom.llm import licenses, pii, quality_rules
from tickloom.llm.weak import estimate, logistic

TEXTS = [
    None, "", " \n\t", "a", "Released under the MIT License.", "under the mit license under the MIT-license",
    "Apache License, Version 2.0\ncc by nc CC-BY-NC", "this work is licensed under the gnu general public license, version 3",
    "x@y.com_a@b.cd, mail a@b.c.d@e.f; 1.2.3.4.5.6.7.8 999.1.1.1 010.0.00255.1", "4111 1111 1111 1111 and 4111111111111112",
    "+1 (988) 555-2485 +44 20 7946 0958) +12 ", "call (212) 555-0100 or 212-555-0100 x", "ssn 123-45-6789 000-00-0000",
    "1" * 3000, "a" * 3000 + "@", "é@x.de Ünï 1.1.1.1 😀 a@b.co", "a a a a a b\na a a a a b\n\na a a a a b", "w " * 5000,
    "One two three four. " * 30, "#$% <b> | & *", "A" * 50 + "!!", " nbsp em", "12 34-56 78-90 12 34 5 6", "-1@-.-", "0.0.0.0",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(None, "a@b.cd", None), (4, TEXTS[4], "z"), (4, TEXTS[4], "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string").cache()


def test_licenses_agree_with_brute_force(docs):
    got = licenses.scan(docs.drop("n_words")).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == oracles.licenses(r.text), r.text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_template_join_is_exact(docs):
    """Every line that holds enough of a template's words is found, and no other."""
    got = {(r.text_md5, r.block, r.template) for r in licenses.matches(docs, threshold=0.5).collect()}
    want = set()
    for r in docs.select("text", F.md5(F.col("text").cast("binary")).alias("h")).collect():
        for block, line in enumerate((r.text or "").split("\n")):
            words = set(oracles.re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate(oracles.LOW)))
            for number, (_, template) in enumerate(licenses.TEMPLATES):
                members = set(template.split())
                if len(words & members) >= 0.5 * len(members):
                    want.add((r.h, block, number))
    assert got == want and want


def test_base_spans_agree_with_brute_force(docs):
    found = pii.find(docs, pii.train(docs))
    got = found.select("text", pii.joined(F.filter("pii", lambda s: s["kind"] < 4)).alias("base")).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.base == oracles.personal(r.text)[1], r.text


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a1@.+ -(é\n0", max_size=40), min_size=1, max_size=60))
def test_base_spans_of_any_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    spans = F.filter(pii.candidates(F.col("text")), lambda s: s["kind"] < 4)
    for r in rows.select("text", pii.joined(spans).alias("base")).collect():
        assert r.base == oracles.personal(r.text)[1]


def test_looser_spans_and_masking(spark):
    rows = [(f"please call (212) 555-01{i:02d} now", ) for i in range(30)] + [("part no 0000000",), (None,)]
    docs = spark.createDataFrame(rows, "text string")
    found = pii.find(docs, pii.train(docs))
    got = [r[0] for r in found.select(pii.masked(F.col("text"), F.col("pii"))).collect()]
    assert got[:30] == ["please call <LOCAL_PHONE> now"] * 30 and got[30:] == ["part no 0000000", None]


def test_masking_keeps_the_rest(spark):
    row = spark.createDataFrame([("é a@b.cd, 4111111111111111.",)], "text string")
    found = row.select(pii.masked(F.col("text"), pii.candidates(F.col("text")))).first()[0]
    assert found == "é <EMAIL>, <CARD>."


def test_quality_measures_agree_with_brute_force(docs):
    got = quality_rules.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        want = oracles.quality(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.text
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_ordinary_texts_are_kept_and_shouted_repeats_are_not(spark):
    plain = [(" ".join(f"word{i}x{j}" for j in range(80)),) for i in range(60)]
    junk = [(" ".join(f"AB{i}{j}!! #*$" for j in range(60)),) for i in range(12)]
    got = quality_rules.judge(spark.createDataFrame(plain + junk, "text string")).collect()
    assert all(r.kept for r in got[:60]) and not any(r.kept for r in got[60:])


@pytest.mark.parametrize("run", [
    licenses.scan, quality_rules.judge, lambda d: pii.find(d, pii.train(d)),
])
def test_no_rows_give_no_rows(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_estimated_reliability_tells_good_labelers_from_bad():
    counts = {(1, 1, 1): 800, (1, 1, -1): 100, (-1, -1, -1): 80, (-1, -1, 1): 20}
    model = estimate(counts)
    assert model.posterior((1, 1, -1)) > 0.9 > 0.1 > model.posterior((-1, -1, 1))
    weights = logistic([((1.0,), 1.0, 10.0), ((-1.0,), 0.0, 10.0)])
    assert weights[0] > 1 and abs(weights[1]) < 1e-6
