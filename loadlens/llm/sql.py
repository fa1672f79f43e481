"""DuckDB counterparts of the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

ORACLES["op12_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), kept AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
v AS (SELECT lang, count(*) AS terms FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
n AS (SELECT lang, source, term, count(*) AS n FROM d SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
    SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source)::HUGEINT AS total,
           sum(coalesce(n, 0)) OVER (PARTITION BY lang, term)::HUGEINT AS all_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang)::HUGEINT AS whole, terms
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)
), share AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * terms) AS p, 1 + (1000000000 * (all_n + 5)) // (whole + 5 * terms) AS q
    FROM dense
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM share WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM part QUALIFY part = 'pair' OR rank <= 50
"""

ORACLES["op13_hard_negatives"] = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2]))::BIGINT AS score
    FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
