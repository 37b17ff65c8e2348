"""SQL equivalents of the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS x FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(x[i:i + 4], ' ')) AS g FROM (SELECT doc_id, x, unnest(range(1, greatest(2, len(x) - 3))) AS i FROM w WHERE len(x) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
l AS (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
r(u, v) AS (SELECT DISTINCT u, u FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS low FROM r GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id, doc_id = coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.u = doc_id
"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS x FROM documents),
h AS (SELECT doc_id, i, md5(array_to_string(x[i:i + 12], ' ')) AS g FROM (SELECT doc_id, x, unnest(range(1, greatest(1, len(x) - 11))) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS first FROM h GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + o AS pos FROM h JOIN f USING (g), range(0, 13) AS t(o) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(x) AS word, unnest(range(1, len(x) + 1)) AS pos FROM w),
k AS (SELECT doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY words.pos) FILTER (WHERE gone.pos IS NULL) AS kept FROM words LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(x) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""
