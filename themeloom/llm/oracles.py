"""DuckDB SQL for the document queries that SQL can express."""

from __future__ import annotations

import string

_WORDS = "list_filter(string_split_regex({text}, '{sep}'), lambda x: x <> '')"
_LOWER_AZ = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER_AZ, sep="[ \\t\\n\\x0b\\f\\r]+")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(generate_series(1, len(w) - 3), lambda j: array_to_string(w[j:j + 3], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a
  JOIN e b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (na + nb - c) UNION ALL SELECT y, x FROM p WHERE 100 * c >= 80 * (na + nb - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT l.x, r.root FROM r JOIN l ON l.y = r.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m ON s.doc_id = m.doc_id
"""

_ALNUM = _WORDS.format(text="lower(coalesce(max(text), ''))", sep=r"[^\p{L}\p{N}]+")

OP9 = f"""
WITH iw AS (SELECT item_id, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL GROUP BY 1),
i AS (SELECT item_id, least(5, len(w)) AS k, list_distinct(list_transform(generate_series(1, len(w) - least(5, len(w)) + 1),
  lambda j: array_to_string(w[j:j + least(5, len(w)) - 1], ' '))) AS s
  FROM iw WHERE len(w) > 0),
dw AS (SELECT doc_id, {_ALNUM} AS w FROM documents WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS sh
  FROM dw, (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
x AS (SELECT item_id, k, len(s) AS n, unnest(s) AS sh FROM i)
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared, count(*)::DOUBLE / any_value(n) AS containment
FROM x JOIN d ON x.k = d.k AND x.sh = d.sh GROUP BY 1, 2 HAVING count(*) >= 0.8 * any_value(n)
"""

OP13 = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
