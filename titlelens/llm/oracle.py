"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from titlelens.llm.licenses import BASE, OWN

LOWERED = ("translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
WORDS = ("regexp_extract_all(" + LOWERED.format("coalesce(text, '')")
         + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
items AS (
    SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n,
           array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
scanned AS (
    SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT r, i, windows.n, item_id FROM scanned JOIN windows USING (gram)),
words AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
listed AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN listed USING (r)
"""

MIX = r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || left(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 15))::BIGINT AS key
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0::DOUBLE, 2.0, 1.0][
               ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM sized GROUP BY source),
capped AS (
    SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS fill
    FROM sources),
levels AS (
    SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER before, 0.0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level
    FROM capped
    WINDOW before AS (ORDER BY fill, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
    SELECT source, source_size, least(cap, weight * (
        SELECT level FROM levels WHERE fill >= level ORDER BY fill, source NULLS LAST LIMIT 1))
        AS target
    FROM levels),
open AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)
                    * source_size AS quota
    FROM goals),
filled AS (
    SELECT s.source, s.key, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key) AS upto
    FROM sized s),
cuts AS (
    SELECT o.source, coalesce(min(struct_pack(off := abs(upto - quota), key := key)),
                              struct_pack(off := quota, key := -1)) AS best, any_value(quota) AS quota
    FROM open o JOIN filled f ON o.source IS NOT DISTINCT FROM f.source
    GROUP BY o.source, quota),
cut AS (
    SELECT source, CASE WHEN quota <= best.off THEN -1 ELSE best.key END AS cut FROM cuts)
SELECT s.doc_id, s.size, o.source_size, o.target,
       ((o.whole + CASE WHEN s.key <= c.cut THEN 1 ELSE 0 END) * s.size)::BIGINT AS taken,
       (o.whole + CASE WHEN s.key <= c.cut THEN 1 ELSE 0 END)::INTEGER AS copies
FROM sized s
JOIN open o ON s.source IS NOT DISTINCT FROM o.source
JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
"""

TOP_K = """
WITH sound AS (
    SELECT row_number() OVER () AS number, vec_id,
           list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT q.number, q.vec_id AS query_id, c.vec_id, c.number AS other,
           list_dot_product(q.v, c.v)::BIGINT AS score
    FROM sound q JOIN sound c ON q.number <> c.number AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY number ORDER BY score DESC, vec_id, other)
QUALIFY row_number() OVER best <= 10
"""

LICENSES = f"""
WITH phrases(label, exact, phrase) AS (VALUES {", ".join(
    f"('{label}', {exact}, '{phrase}')"
    for exact, phrases in (("true", BASE), ("false", OWN)) for label, phrase in phrases)}),
places AS (
    SELECT label, exact, len(ws) AS length, i - 1 AS place, ws[i] || ' ' || ws[i + 1] AS gram
    FROM (SELECT label, exact, ws, unnest(range(1, len(ws))) AS i
          FROM (SELECT *, string_split(phrase, ' ') AS ws FROM phrases))),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
votes AS (
    SELECT r, label, exact, length, pos, place, pos - place AS diagonal
    FROM (SELECT r, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram
          FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs)) JOIN places USING (gram)),
diagonals AS (
    SELECT r, label, exact, length, diagonal, list(DISTINCT place) AS voted,
           min(pos) AS first, max(pos) AS last
    FROM votes GROUP BY ALL),
marked AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line > 2 THEN 1 ELSE 0 END AS new
    FROM diagonals
    WINDOW line AS (PARTITION BY r, label, exact ORDER BY diagonal)),
spans AS (
    SELECT r, label, exact, length, span,
           coalesce(list(diagonal) FILTER (len(voted) = length - 1), []) AS starts,
           len(list_distinct(flatten(list(voted)))) AS voted,
           max(last) + 2 - min(first) AS width
    FROM (SELECT *, sum(new) OVER (PARTITION BY r, label, exact ORDER BY diagonal) AS span
          FROM marked)
    GROUP BY r, label, exact, length, span),
judged AS (
    SELECT *, CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE
                   WHEN width <= length + 4 THEN voted::DOUBLE / (length - 1)
                   ELSE 0.0::DOUBLE END AS cover
    FROM spans),
per_doc AS (
    SELECT r, sum(len(starts)) FILTER (exact) AS n_base,
           min(list_min(starts)) FILTER (exact) AS first_word,
           max(list_max(starts)) FILTER (exact) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND len(starts) > 0)
               AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label)
               FILTER (CASE WHEN exact THEN len(starts) > 0 ELSE cover >= 0.75 END) AS labels,
           max(cover) AS score
    FROM judged GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN per_doc USING (r)
"""

JACCARD = """
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN
        [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' ')) END) AS grams FROM docs),
spread AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS shared
    FROM spread a JOIN spread b ON a.gram = b.gram AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 75 * (n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, root) AS (
    SELECT doc_id, doc_id FROM sets
    UNION SELECT ways.b, root FROM reached JOIN ways ON ways.a = reached.doc_id)
SELECT doc_id, any_value(len(grams))::BIGINT AS n_shingles, min(root)::BIGINT AS component_id
FROM sets JOIN reached USING (doc_id) GROUP BY doc_id"""

ORACLE: dict[str, str] = {
    "op2_license_scan": LICENSES,
    "op4_decontaminate": DECONTAMINATE,
    "op5_exact_topk": TOP_K,
    "op6_ngram_jaccard": JACCARD,
    "op8_mix_sources": MIX,
}
