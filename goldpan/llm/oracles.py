"""The corpus operators in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP1 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""

# Windows of ten words, or the whole item where it has fewer; words are numbered from 1.
OP2 = r"""
WITH dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (
    SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM iw WHERE len(w) > 0),
pats AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p FROM starts),
lens AS (SELECT DISTINCT m FROM pats),
wins AS (
    SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM dw, lens WHERE len(w) >= m),
hits AS (
    SELECT doc_id, i, wins.m, item_id FROM wins
    JOIN pats ON pats.m = wins.m AND p = array_to_string(w[i:i + wins.m - 1], ' ')),
pos AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS q FROM hits) GROUP BY doc_id),
its AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP4 = r"""
WITH d AS (
    SELECT doc_id, source, coalesce('s' || source, 'n') AS k,
        ('0x' || md5(coalesce(doc_id::VARCHAR, 'n') || ':' || coalesce(text, ''))[1:8])::BIGINT AS spread,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
s AS (
    SELECT k, source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY k, source),
w AS (SELECT *, ([3, 1, 2])[((r - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s),
f AS (
    SELECT *, source_size / weight AS fill,
        (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER b, 0))::BIGINT AS words_left,
        (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::BIGINT AS weight_left
    FROM w WINDOW b AS (ORDER BY source_size / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (
    SELECT fill AS lfill, words_left AS lw, weight_left AS lg FROM f
    WHERE weight * words_left <= 4 * source_size * weight_left ORDER BY fill, r LIMIT 1),
goal AS (
    SELECT k, source_size, CASE WHEN lfill IS NOT NULL AND fill >= lfill
        THEN least((weight * lw)::DOUBLE / (2 * lg)::DOUBLE, (2 * source_size)::DOUBLE)
        ELSE (2 * source_size)::DOUBLE END AS target
    FROM f LEFT JOIN lv ON true),
e AS (
    SELECT *, spread % ceil(count(*) OVER (PARTITION BY k, size) / 100000)::BIGINT AS salt FROM d),
o AS (
    SELECT doc_id, k, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY k ORDER BY size, salt, doc_id NULLS FIRST, spread) AS p,
        ('0x' || md5('mix:' || k)[1:8])::BIGINT::DOUBLE / 4294967296.0 AS u
    FROM e JOIN goal USING (k))
SELECT doc_id, size, source_size, target,
    least((floor(rate * p + u) - floor(rate * (p - 1) + u))::BIGINT, 2) * size AS taken
FROM o
"""

OP11 = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.q, b.q)::BIGINT AS score
    FROM (SELECT * FROM e WHERE vec_id % 50 = 0) a, e b),
p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12 = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS big_n, sum(len(w))::BIGINT AS big_l FROM d),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark),
tf AS (SELECT r, t, count(*) AS f FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS n FROM tf GROUP BY t),
wt AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * n + 1)::DOUBLE))::BIGINT AS weight FROM df, c),
p AS (
    SELECT r, tf.t, weight * ((1000000000 * f) // (1000 * f + 20 * (100 - 50 + (50 * len(w) * big_n) // big_l))) AS impact
    FROM tf JOIN wt USING (t) JOIN d USING (r), c),
s AS (SELECT item_id, r, sum(impact)::BIGINT AS score FROM q JOIN p USING (t) GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s JOIN d USING (r) WHERE score > 0
QUALIFY rank <= 50
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op2_decontaminate": OP2,
        "op4_mix": OP4,
        "op11_hard_negatives": OP11,
        "op12_ranked_search": OP12,
    }
