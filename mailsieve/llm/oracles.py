"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_LOW = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda p: array_to_string(w[p:p + 9], ' '))) AS g
  FROM i WHERE len(w) > 0
),
s AS (SELECT DISTINCT size FROM v),
o AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, s),
h AS (
  SELECT DISTINCT o.doc_id, v.item_id, o.p, o.size
  FROM o JOIN v ON v.size = o.size AND v.g = array_to_string(o.w[o.p:o.p + o.size - 1], ' ')
),
n AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS x FROM h) GROUP BY 1),
t AS (
  SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM h) GROUP BY 1
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP8 = r"""
WITH c AS (
  SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, len(regexp_extract_all(role || chr(0) || text,
    '<\\*(?:\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|im_sep\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\])')) AS n
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(23 + length(role) + length(text) + n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9 = r"""
WITH r AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages
),
q AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'), lambda x: x <> '')), '&')
    AS query,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^.*@', ''), ':(80|443)$', ''),
      '^www[0-9]*\.', '') AS host
  FROM r
),
p AS (
  SELECT page_id AS n, html, host || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS page,
    page_id * 60 AS stored_at, page_id * 60 + 30 + (page_id % 1009) * 977 AS asked_at,
    '"' || md5(html)[1:16] || '"' AS tag, 'day ' || (page_id % 97) AS day
  FROM q WHERE page_id IS NOT NULL AND url IS NOT NULL
),
m AS (
  SELECT a.n, max(struct_pack(t := b.stored_at, n := b.n)).n AS f
  FROM p a JOIN p b ON a.page = b.page AND (b.stored_at < a.asked_at OR (b.stored_at = a.asked_at AND b.n <= a.n))
    AND b.html IS NOT NULL
  GROUP BY 1
),
j AS (
  SELECT a.n, a.page, a.asked_at, m.f, s.tag AS old_tag, s.day AS old_day, s.html,
    CASE WHEN a.n % 5 IN (0, 1) THEN a.tag WHEN a.n % 5 = 3 THEN '"stale"' END AS new_tag,
    CASE WHEN a.n % 5 = 2 THEN a.day END AS new_day
  FROM p a LEFT JOIN m USING (n) LEFT JOIN p s ON s.n = m.f
),
o AS (
  SELECT *, CASE WHEN f IS NULL THEN 'orphan'
    WHEN coalesce(old_tag = new_tag, old_day = new_day) IS NULL THEN 'unvalidated'
    WHEN coalesce(old_tag = new_tag, old_day = new_day) THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM j
)
SELECT 2 * n + 1 AS record_id, page, asked_at AS captured, outcome, 2 * f AS full_id,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN
    'content-type: text/html' || chr(10) || 'date: checked ' || n || chr(10) || 'etag: '
    || CASE WHEN n % 5 = 1 THEN 'W/' ELSE '' END || coalesce(new_tag, old_tag) || chr(10) || 'last-modified: '
    || coalesce(new_day, old_day) END AS headers,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN sha256(html) END AS payload_sha256
FROM o
"""

OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOW.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) END) AS g
  FROM w WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
  WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)
),
r(doc_id, x) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.x
),
k AS (SELECT doc_id, min(x) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, k.component_id, w.doc_id = k.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN k USING (doc_id)
"""

OP11 = f"""
WITH t AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOW.format('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
g AS (
  SELECT lang, len(w) AS total, unnest(list_concat(
    w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')),
    list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g
  FROM p
),
f AS (SELECT lang, g, string_split(g, ' ') AS w, count(*)::HUGEINT AS f FROM g GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT lang, g, w, f AS a, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1),
s AS (
  SELECT c.lang, c.g, c.w, c.a, c.k, x.f AS l, y.f AS r, 2000000 * c.a // (x.f + y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.g = array_to_string(c.w[c.k + 1:], ' ')
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
v AS (
  SELECT lang, unnest(list_concat(
    list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    CASE WHEN len(w) = 4 THEN [array_to_string(w[1:3], ' '), array_to_string(w[2:4], ' ')] ELSE [] END)) AS g, f
  FROM f WHERE len(w) > 2
),
m AS (SELECT lang, g, max(f) AS f FROM v GROUP BY 1, 2),
k AS (
  SELECT b.* FROM b LEFT JOIN m ON m.lang = b.lang AND m.g = b.g WHERE m.f IS NULL OR 100 * m.f < 80 * b.a
),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM k)
SELECT o.lang, o.rank::BIGINT AS rank, o.g AS phrase, o.a::BIGINT AS a, o.l::BIGINT AS l, o.r::BIGINT AS r, n.n, o.score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE o.rank <= 2000
"""
