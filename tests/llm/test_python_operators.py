"""Language identification, search, extraction, counting and packing."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm import oracles
from pyspark.sql import functions as F

from tickloom.llm import ball_search, html_text, language_id, packing, token_counts

SF_DIR = "/root/testdata/sf0.001"


# language identification


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = F.col("doc_id") % 4 == 0
    model = language_id.fit(docs.where(~held))
    got = language_id.identify(docs.where(held), model).where("length(text) > 60")
    n, right, rejected = got.agg(
        F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int"))
    ).first()
    assert right >= 0.98 * n and rejected <= 0.02 * n


def test_language_edge_cases(spark):
    labelled = [("a", "the cat and the dog " * 5), ("b", "zut qui vive " * 5), (None, "x y"), ("c", None)]
    model = language_id.fit(spark.createDataFrame(labelled, "lang string, text string"))
    assert model.languages == ["a", "b"]
    rows = [(1, None, 9), (2, "", 9), (3, "12 34 !?", 9), (4, "the cat", 9), (4, "the cat", 9), (None, "zut", 9), (5, "x" * 200_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = language_id.identify(docs, model).collect()
    assert [r.lang_pred for r in got[:6]] == ["und", "und", "und", "a", "a", "b"]
    assert all(0 <= r.score <= 1 for r in got) and got[0].rejected and len(got) == 7
    assert language_id.identify(docs.limit(0), model).collect() == []
    none = language_id.fit(docs.limit(0).selectExpr("'q' AS lang", "text"))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_learning_and_identifying_at_once_is_the_same(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = F.col("doc_id") % 4 == 0
    model = language_id.fit(docs.where(~held))
    apart = language_id.identify(docs, model).select("doc_id", *language_id._NEW)
    label = F.when(~held, F.col("lang"))
    once = language_id.learn_and_identify(docs, label).select("doc_id", *language_id._NEW)
    assert Counter(map(tuple, apart.collect())) == Counter(map(tuple, once.collect()))
    rows = language_id.learn_and_identify(docs.limit(3).withColumn("_key", F.lit("mine")), F.lit(None).cast("string")).collect()
    assert {(r.lang_pred, r._key) for r in rows} == {("und", "mine")}


def test_kneser_ney_probabilities_sum_to_one():
    grams = {"aabab": 3, "abaab": 1, "babab": 2, "aabaa": 1}
    model = language_id.Model(["x"], alphabet=3)
    model.levels = language_id._levels([grams], 3)
    history = np.array([[ord(c) for c in "aaba"]] * 4)
    codes = np.hstack([history, np.array([[ord(c)] for c in "abcd"])]).astype(np.uint64)
    assert model.probabilities(codes, 5).sum() == pytest.approx(1.0)
    # By hand: discount 2 / (2 + 2 * 1) for the highest order.
    unseen = model.probabilities(codes[3:], 5)[0, 0]
    assert 0 < unseen < model.probabilities(codes[:1], 5)[0, 0]


def test_every_gram_counts_and_scores_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_id, "_KEPT_WORDS", 64)  # most words are joined
    monkeypatch.setattr(language_id, "_BLOCK_WINDOWS", 1 << 16)  # and scored in several blocks
    rng = random.Random(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    rows = [("a", " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(80))) for _ in range(300)]
    rows += [("b", " ".join("".join(rng.choices(letters, k=5)) for _ in range(80))) for _ in range(800)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    counts = {"a": Counter(), "b": Counter()}
    for lang, text in rows:
        for w in language_id.words_of(text):
            padded = language_id.START * 4 + w + language_id.END
            counts[lang].update(padded[i : i + 5] for i in range(len(w) + 1))
    # 2^18 grams over all languages were kept before.
    assert sum(map(len, counts.values())) > 1 << 18
    assert model.table.where("length(key) = 6 AND key LIKE 'd%'").count() == len(set().union(*counts.values()))
    brute = language_id.Model(["a", "b"], alphabet=model.alphabet)
    brute.levels = language_id._levels([counts["a"], counts["b"]], model.alphabet)
    docs = [(i, t, None) for i, (_, t) in enumerate(rows[::40])] + [(100, "abc hgf xyz 12 zzzzz", 1), (101, "xyz " + rows[-1][1], 1)]
    docs += docs[-2:]  # repeated rows
    got = language_id.identify(spark.createDataFrame(docs, "doc_id long, text string, score int"), model).collect()
    assert len(got) == len(docs)
    for r in got:
        words = language_id.words_of(r.text)
        h = -brute.word_scores(words).sum(axis=0) / sum(len(w) + 1 for w in words)
        assert r.cross_entropy == pytest.approx(h.min(), abs=1e-5) and r.lang_pred == "ab"[int(h.argmin())]


# exact search


def test_search_agrees_with_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = {i: rng.normal(size=6).round(2).tolist() for i in range(700)}
    rows |= {700 + i: rows[i] for i in range(20)}  # ties
    table = [(i, v, "x") for i, v in rows.items()]
    bad = [(900, None, "n"), (1000, [1.0, None], "n"), (1100, [float("nan")] * 6, "n"), (None, [1.0] * 6, "n")]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>, score string")
    vectors = ball_search.integer_vectors(df)
    got = ball_search.top_k(vectors, F.col("vec_id") % 100 == 0, block=4)
    as_float = {r.vec_id: r.embedding for r in df.where("vec_id < 900").collect()}
    assert {tuple(r) for r in got.collect()} == oracles.top_k(as_float)


def test_search_with_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [3.0])], "vec_id long, embedding array<float>")
    vectors = ball_search.integer_vectors(df)
    got = {tuple(r) for r in ball_search.top_k(vectors, F.lit(True)).collect()}
    assert got == {(0, 1, 100, 3 * 1024**2), (100, 1, 0, 3 * 1024**2)}
    empty = ball_search.integer_vectors(df.limit(0))
    assert ball_search.top_k(empty, F.lit(True)).collect() == []
    huge = ball_search.integer_vectors(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<float>"))
    with pytest.raises(ValueError, match="64 bits"):
        ball_search.top_k(huge, F.lit(True))


def test_rows_that_share_an_id_are_all_searched(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (100, [5.0]), (100, [5.0])]
    vectors = ball_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = Counter(tuple(r) for r in ball_search.top_k(vectors, F.col("vec_id") % 100 == 0).collect())
    m = 1024**2
    others = [(1, 100, 25 * m), (2, 1, 15 * m), (3, 1, 10 * m), (4, 0, 5 * m)]
    assert got == Counter(
        [(0, 1, 100, 5 * m), (0, 2, 100, 5 * m), (0, 3, 1, 3 * m), (0, 4, 1, 2 * m)] + [(100, *o) for o in others] * 2
    )


# page text


def _page(body: str) -> str:
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


PAGES = {
    None: "", "": "", "plain &amp; simple": "plain & simple",
    _page("<nav>Menu</nav><article><h1>A &lt; B</h1><p>one<br>two  three<p>four</article><footer>F</footer>"): "A < B\none two three\nfour",
    _page("<div class='ad-box'>buy</div><p>text</p><div id=comments>me too</div><form>f<input></form>"): "text",
    _page("<script>var t='</p>';</script><style>p{}</style><p>a<!-- x > y --></p>b"): "a\nb",
    _page("<article><header><h1>H</h1></header><p>x</p><section class='share'>s</section></article><p>out</p>"): "H\nx",
    _page("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>"): "one\ntwo\na\nb",
    "<p>cut off in a tag <b": "cut off in a tag", "<p>a</p></div></p><p>b</i>c": "a\nbc", "1 < 2 &am; &#233;&#xe9;": "1 < 2 &am; éé",
}


LOST_BEFORE = {
    _page(f"<h1>Title</h1><p>{'Long body. ' * 20}</p><article class='teaser'>Read on</article>"):
        f"Title\n{('Long body. ' * 20).strip()}\nRead on",
    _page("<div class='content related-work'><p>Main story of the day.</p></div>"): "Main story of the day.",
    _page("<p class='share-price'>Shares rose.</p><p>More.</p>"): "Shares rose.\nMore.",
    _page("<div class='nav-top'>Home</div><div class='comments_list'>me</div><p>text</p>"): "text",
    _page('<p title="a > b">x</p><p title=\'c\'>y</p>'): "x\ny",
    '<p>a</p><p title="never closed>b</p><p>c</p>': "a\nb\nc",
    "<p>a <b <i>c</i>": "a c", "<p>a <b": "a", "<p>a <b c <": "a <b c <",
}


def test_main_text_is_not_lost():
    for page, text in LOST_BEFORE.items():
        got = html_text.main_text(html_text.parsed(page))
        assert " ".join(got.split()) == " ".join(text.split()), page


@pytest.mark.parametrize("piece", ["<a ", '<a b="', "<svg ", "<svg><svg ", "<b></i>", "<!--", "<p title='", "<select><option ", "</script", "<li "])
def test_hostile_pages_take_linear_time(piece):
    import time

    def seconds(n):
        page, start = piece * (n // len(piece)), time.process_time()
        html_text.main_text(html_text.parsed(page))
        return time.process_time() - start

    assert seconds(1_000_000) < 4


def test_host_counting_agrees_with_brute_force(spark):
    rng = random.Random(6)
    menus = [f"<div class=m{i}><p>Menu {i}</p><ul><li>one<li>two {i}</ul></div>" for i in range(3)]
    rows = []
    for i in range(120):
        own = "".join(f"<p>Text {rng.randrange(10**6)} of {i}</p>" for _ in range(3))
        parts = [m for m, share in zip(menus, (0.9, 0.3, 0.03)) if rng.random() < share] + [own]
        rows.append((i, f"http://{rng.choice('abc')}.org/{i}", _page("".join(parts))))
    rows += [(200 + i, *rows[i][1:]) for i in range(5)] + [(300, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    seen, sizes = {}, {}
    for _, url, page in rows:
        site, root = (url or "//").split("/")[2], html_text.parsed(page or "")
        key = html_text.main_text(root)
        sizes.setdefault(site, set()).add(key)
        for e in html_text.hashed(root):
            seen.setdefault((site, e.hash), set()).add(key)
    want = {}
    for page_id, url, page in rows:
        site, root = (url or "//").split("/")[2], html_text.parsed(page or "")
        html_text.hashed(root)
        gone = {h for (s, h), k in seen.items() if s == site and len(k) >= 5 and len(k) >= len(sizes[site]) ** (1 / 3)}
        want[page_id] = html_text.main_text(root, frozenset(gone))
    got = {r.page_id: r.text for r in html_text.extract(pages.withColumn("doc", F.lit(1)).withColumn("hashes", F.lit(2))).collect()}
    assert got == want and any("Menu" in html_text.main_text(html_text.parsed(p or "")) and "Menu 0" not in want[i] for i, _, p in rows)


def test_pages(spark):
    rows = [(i, "http://h.example/x", h, "y") for i, h in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(PAGES.values())}


@pytest.mark.parametrize("page, text", [
    ('<p>one</p><svg-icon name="x"></svg-icon><p>two</p><p>three</p>', "one\ntwo\nthree"),
    ('<p>a <svg class="i"/> b</p><p>c</p>', "a b\nc"),
    ('<p>a <svg title="x > y" /> b</p><p>c</p><svg><text>no</text></svg><p>d</p>', "a b\nc\nd"),
    ("<p>a<svg> b</p><svg><g><svg><text>no</text></svg></g><text>no</text></svg><p>c</p>", "a b\nc"),
    ("<p>a</p><video src=v><p>b</p><video>no</video><p>c</p>", "a\nb\nc"),
    ("<p>a</p><select><option>no<option>no</option><p>b</p>", "a\nb"),
    ("<p>a</p><video-player>v</video-player><title-bar>t</title-bar><p>b</p>", "a\nvt\nb"),
    ("<p>a</p><SCRIPT>x = '<svg>'</Script ><p>b</p><script>no</p>", "a\nb"),
    ("<p>a</p><iframe src=x><p>b</p>", "a\nb"),
])
def test_embedded_elements_take_only_their_own_part(page, text):
    assert html_text.main_text(html_text.parsed(page)) == text


def test_many_unclosed_elements_take_linear_time():
    assert html_text.main_text(html_text.parsed("<svg><iframe>" * 20_000 + "x")) == "x"


def test_recurring_subtrees_of_a_host_are_deleted(spark):
    def rows(host: str, n: int):
        return [(f"http://{host}/{i}", _page(f"<div>Welcome to {host}</div><p>story {host} {i}</p><div>word</div>")) for i in range(n)]

    copies = [("http://big.example/c", _page("<p>copied story</p>"))] * 50
    docs = rows("BIG.example", 40) + rows("small.example", 3) + copies + [(None, "<p>no host</p>")]
    df = spark.createDataFrame(docs, "url string, html string")
    got = html_text.extract(df).collect()
    assert len(got) == len(docs)
    by = [(r.url, r.text) for r in got]
    assert ("http://BIG.example/7", "story BIG.example 7") in by
    assert ("http://small.example/1", "Welcome to small.example\nstory small.example 1\nword") in by
    assert by.count(("http://big.example/c", "copied story")) == 50 and (None, "no host") in by
    assert html_text.extract(df.limit(0)).collect() == []


def test_templates_of_sections_go_and_shared_passages_stay(spark):
    menu = "<div>Section menu</div>"  # on 20 of 200 pages
    rows = [(f"http://h/{i}", _page(f"{menu if i % 10 == 0 else ''}<p>story {i}</p>")) for i in range(200)]
    for i in range(12):  # a passage at other places of 6 articles of 12; a notice at the end of all
        body = [f"<p>own {i} {j}</p>" for j in range(9)]
        if i < 6:
            body[i] = "<p>shared</p>"
        body += [f"<p>more {i} {j}</p>" for j in range(i)] + ["<p>notice</p>"]
        rows.append((f"http://a/{i}", _page(f"<article>{''.join(body)}</article>")))
    got = {r.url: r.text for r in html_text.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert all(got[f"http://h/{i}"] == f"story {i}" for i in range(200))
    assert ["shared" in got[f"http://a/{i}"] for i in range(12)] == [True] * 6 + [False] * 6
    assert not any("notice" in t for t in got.values())


def test_very_deep_page():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    root = html_text.parsed(deep)
    html_text.hashed(root)
    assert html_text.main_text(root) == "x"


# token counts


def _brute(vocabulary, text: str) -> int:
    best = {0: (0, 0)}
    for end in range(1, len(text) + 1):
        options = []
        for start in range(end):
            piece = text[start:end]
            if piece in vocabulary.cost:
                options.append((best[start][0] + vocabulary.cost[piece], best[start][1] + 1))
        if text[end - 1] not in vocabulary.cost:
            n = len(text[end - 1].encode())
            options.append((best[end - 1][0] + n * vocabulary.byte_cost, best[end - 1][1] + n))
        best[end] = min(options)
    return best[len(text)][1]


def test_trie_agrees_with_brute_force(spark):
    vocabulary = token_counts.Vocabulary.from_file(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    words = ["".join(rng.choice("theationsr😀ß") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    trie = token_counts.Trie(vocabulary, max_nodes=500)  # dropped many times on the way
    assert [trie.count(w) for w in words] == [_brute(vocabulary, "▁" + w) for w in words]
    assert len(trie.scores) <= 500
    rows = [(None, "q"), ("", "q"), (" \n", "q"), (" ".join(words), "q"), ("x" * 5000, "q"), ("a a", "q"), ("a a", "q")]
    df = spark.createDataFrame(rows, "text string, n_tokens string")
    got = token_counts.count_tokens(df).collect()
    assert [r.n_pretokens for r in got] == [0, 0, 0, 400, 1, 2, 2]
    assert got[3].n_tokens == sum(_brute(vocabulary, "▁" + w) for w in words) and got[0].n_tokens == 0


def test_prefixes_are_scored_once():
    class Counting(token_counts.Vocabulary):
        calls = 0

        def step(self, *a):
            Counting.calls += 1
            return super().step(*a)

    trie = token_counts.Trie(Counting(["a", "b", "ab", "▁"], 9))
    trie.count("abab"), trie.count("abaa"), trie.count("abab")
    assert Counting.calls == 6  # the mark and a, b, a, b; then one more a


# packing


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_ids_are_those_of_the_tokenizer_file(spark, encoder):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()
    odd = ["a<|endoftext|>b  <|endoftext|>", "  x\n\n y \t", "it's WE'LL 123abc ½", " \x1c x", "é" * 1500, "", "<|endoftext|>"]
    for text in [r.text for r in rows] + odd:
        assert encoder(text or "") == encoder.own.encode(text or "", add_special_tokens=False).ids


def test_packing_is_a_partition_of_all_ids(spark, encoder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (None, "no id"), (-3, "w " * 30_000)], "doc_id long, text string")
    docs = docs.union(more).repartition(3)
    pieces = packing.pack(docs.withColumn("start", F.lit("clash"))).collect()
    ids = {r.doc_id: np.array([*encoder(r.text or ""), 1], "<u4") for r in docs.collect()}
    covered = {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.start)):
        assert p.start == covered.get(p.doc_id, 0) and p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        covered[p.doc_id] = p.start + p.length
    assert covered == {d: len(i) for d, i in ids.items()}
    fills = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fills.get(p.sequence_id, 0)
        fills[p.sequence_id] = p.offset + p.length
    assert max(fills.values()) <= 2048 and sum(f < 2048 for f in fills.values()) <= 3  # one per task
    assert packing.pack(docs.limit(0)).collect() == []


def test_levels_follow_the_sum_of_squares():
    rng = random.Random(5)
    packer = packing.SumOfSquares(window=10)

    def change(level: int, size: int) -> int:
        after = packer.counts.copy()
        after[level] -= level > 0
        if level + size < 10:
            after[level + size] += 1
        return int((after[1:10] ** 2).sum() - (packer.counts[1:10] ** 2).sum())

    for _ in range(400):
        size = rng.randint(1, 9)
        open_ = [0] + [h for h in range(1, 11 - size) if packer.counts[h]]
        chosen = packer.choose(size)
        assert chosen in open_ and change(chosen, size) == min(change(h, size) for h in open_)
        packer.add(packing.Piece(1, 0, np.zeros(size, "<u4"), size))
    assert packer.counts.sum() < 60


def test_the_second_tokenizer_is_loaded_when_a_text_needs_it():
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = encode("plain words") + encode("")
    assert plain and "own" not in vars(encode)
    text = "a<|endoftext|>b" + "x" * 1200
    assert encode(text) == encode.own.encode(text, add_special_tokens=False).ids and "own" in vars(encode)
    assert encode("plain words") == plain
