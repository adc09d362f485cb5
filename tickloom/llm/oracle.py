"""DuckDB SQL of the queries that SQL can express on whole tables, by all pairs or per row."""

from __future__ import annotations

import math

from tickloom.llm.common import CAPITALS, SMALL
from tickloom.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, WORD
from tickloom.llm.ngram_join import N, PERCENT

LOWER = f"translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}')"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _places(phrase: str) -> str:
    words = phrase.split()
    met = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))
    return f"list_filter(range(len(w) - {len(words) - 1}), lambda i: {met})"


def license_scan() -> str:
    shares, labels = [], []
    for label, text in TEMPLATES:
        members = sorted(set(text.split()))
        needed = max(1, math.ceil(THRESHOLD * len(members) - 1e-9))
        held = f"coalesce(list_max(list_transform(lines, lambda l: len(list_intersect(l, {_list(members)})))), 0)"
        shares.append(f"CASE WHEN {held} >= {needed} THEN {held} / {len(members)}.0 ELSE 0.0 END")
        labels.append(f"'{label}'")
    base = ", ".join(f"CASE WHEN len({_places(p)}) > 0 THEN '{label}' END" for p, label in PHRASES.items())
    starts = " || ".join(_places(p) for p in PHRASES)
    return f"""
    WITH rows_ AS (SELECT doc_id, {LOWER} AS t FROM documents),
    words AS (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS w,
                     list_transform(string_split(t, chr(10)), lambda x: regexp_extract_all(x, '{WORD}')) AS lines FROM rows_),
    found AS (SELECT doc_id, len(w) AS n, {starts} AS starts,
                     list_filter([{base}], lambda x: x IS NOT NULL) AS base,
                     [{", ".join(shares)}]::DOUBLE[] AS shares FROM words)
    SELECT doc_id, CAST(n AS bigint) AS n_words, CAST(len(starts) AS bigint) AS n_base,
           CAST(list_min(starts) AS bigint) AS first_word, CAST(list_max(starts) AS bigint) AS last_word,
           array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(base || list_filter(
             list_transform(range(1, {len(labels) + 1}), lambda i: CASE WHEN shares[i] > 0 THEN [{", ".join(labels)}][i] END),
             lambda x: x IS NOT NULL))), ',') AS labels,
           CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE ELSE list_max(shares) END AS score
    FROM found"""


EXACT_SEARCH = """
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, CAST(vec_id AS bigint) AS vec_id,
             list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.rid, q.vec_id AS query_id, c.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS int) AS rank FROM s)
    WHERE rank <= 10"""

NGRAM_JOIN = rf"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) >= {N}
                          THEN list_distinct(list_transform(range(1, len(w) - {N - 2}), lambda i: array_to_string(w[i:i + {N - 1}], ' ')))
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS grams FROM words),
    grams AS MATERIALIZED (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
    links AS MATERIALIZED (
      SELECT a.doc_id AS a, b.doc_id AS b FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
    reach AS (
      SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a)
    SELECT s.doc_id, CAST(len(s.grams) AS bigint) AS n_shingles,
           least(s.doc_id, coalesce(m.least_id, s.doc_id)) AS component_id
    FROM sets AS s LEFT JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) AS m ON m.a = s.doc_id"""

DECONTAMINATION = rf"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
    items AS (SELECT item_id, w, least(len(w), 10) AS m
              FROM (SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark) WHERE len(w) > 0),
    wanted AS MATERIALIZED (
      SELECT DISTINCT item_id, m, array_to_string(w[s + 1 : s + m], ' ') AS win
      FROM (SELECT item_id, w, m, unnest(range(len(w) - m + 1)) AS s FROM items)),
    placed AS (
      SELECT rid, m, s, array_to_string(w[s + 1 : s + m], ' ') AS win
      FROM (SELECT rid, w, m, unnest(range(len(w) - m + 1)) AS s
            FROM d, (SELECT DISTINCT m FROM wanted) WHERE len(w) >= m)),
    hits AS MATERIALIZED (SELECT DISTINCT rid, s, p.m, item_id FROM placed AS p JOIN wanted AS i ON p.win = i.win AND p.m = i.m),
    hit_words AS (SELECT rid, count(DISTINCT s + k) AS n_hit FROM (SELECT rid, s, unnest(range(m)) AS k FROM hits) GROUP BY rid),
    met AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
           CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN met USING (rid)"""


def centroid_clustering(k: int = 16, rounds: int = 3) -> str:
    def nearest(n: int) -> str:
        return f"""
    a{n} AS MATERIALIZED (
      SELECT rid, c AS cluster, dist FROM (
        SELECT rid, c, dist, row_number() OVER (PARTITION BY rid ORDER BY dist, c) AS place FROM (
          SELECT rid, c, CAST(list_sum(list_transform(list_zip(v.e, k.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS dist
          FROM v, k{n} AS k)) WHERE place = 1)"""

    def moved(n: int) -> str:
        return f"""
    k{n} AS MATERIALIZED (
      SELECT k.c, coalesce(m.e, k.e) AS e FROM k{n - 1} AS k LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS e FROM (
          SELECT cluster AS c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
          FROM (SELECT a.cluster, unnest(v.e) AS x, unnest(range(64)) AS i FROM a{n - 1} AS a JOIN v USING (rid))
          GROUP BY cluster, i) GROUP BY c) AS m USING (c))"""

    steps = [nearest(0)]
    for n in range(1, rounds + 1):
        steps += [moved(n), nearest(n)]
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS vec_id,
             list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    k0 AS MATERIALIZED (
      SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS INT) AS c, e
      FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k})),
    {",".join(steps)},
    per AS (SELECT cluster, CAST(sum(dist) AS BIGINT) AS s FROM a{rounds} GROUP BY cluster)
    SELECT vec_id, CAST(cluster AS INT) AS cluster, dist AS distance, s AS cluster_inertia,
           (SELECT CAST(sum(s) AS BIGINT) FROM per) AS inertia,
           sha256(array_to_string(k.e, ',')) AS centroid_sha256
    FROM v JOIN a{rounds} USING (rid) JOIN per USING (cluster) JOIN k{rounds} AS k ON k.c = cluster"""


HARD_NEGATIVES = """
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (
      SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label = c.label AS same, c.rid, c.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
      FROM v AS a JOIN v AS c ON a.rid <> c.rid WHERE a.vec_id % 100 = 0),
    p AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST, rid) AS place
        FROM s WHERE same) WHERE place <= 5)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
      SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.rid) AS INT) AS rank
      FROM p JOIN s AS n ON n.arid = p.arid AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
    WHERE rank <= 5"""
