"""DuckDB SQL of the queries that SQL can state."""

from __future__ import annotations

_OP9 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[p:p + least(10, len(w)) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
spots AS (SELECT doc_id, n, p, w[p:p + n - 1] AS g
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT s.doc_id, s.p, s.n, win.item_id FROM spots s JOIN win ON s.g = win.g),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)
"""

_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
      FROM d GROUP BY source),
t AS (SELECT CAST(sum(source_size) AS DOUBLE) AS total FROM s),
-- the share of a unit of weight, after more and more sources have reached three times their size
r(n, share) AS (
  SELECT 0, (SELECT total FROM t) / (SELECT sum(w) FROM s)
  UNION ALL
  SELECT n + 1, (SELECT ((SELECT total FROM t) - coalesce(sum(CASE WHEN w * share > 3 * source_size THEN 3 * source_size END), 0))
                        / sum(CASE WHEN w * share > 3 * source_size THEN 0 ELSE w END) FROM s)
  FROM r WHERE n < (SELECT count(*) FROM s)),
f AS (SELECT arg_max(share, n) AS share FROM r),
g AS (SELECT source, source_size, CASE WHEN w * share > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE w * share END AS target FROM s, f),
k AS (SELECT *, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM d),
u AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM k),
q AS (SELECT u.*, epoch, CAST(epoch * source_size + upto AS DOUBLE) / target AS finish
      FROM u JOIN g ON u.source IS NOT DISTINCT FROM g.source, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0 AND target > 0),
o AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS so_far FROM q),
x AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM o, t WHERE so_far <= total GROUP BY doc_id)
SELECT d.doc_id, d.size, g.source_size, g.target, coalesce(x.taken, 0) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN x ON d.doc_id = x.doc_id
"""

_OP13 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a, r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""

SQL: dict[str, str] = {
    "op6_mixing": _OP6,
    "op7_decontaminate": _OP7,
    "op9_exact_dedup": _OP9,
    "op13_hard_negatives": _OP13,
}
