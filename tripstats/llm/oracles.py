"""SQL over the same tables for operators that SQL can express."""

from __future__ import annotations

# Cost, audit and text of the cheapest edits per state (e, s, u, a) after each row, row by row.
_STEP = """
SELECT conv, pos, e0 AS e, s0 AS s, u1 AS u, least(a0, {'c': u1.c + 3, 'a': u1.a || 'I', 't': u1.t || chr(10) || 'assistant:'}) AS a
FROM (
  SELECT *, least(u0, {'c': b0.c + 3, 'a': b0.a || 'I', 't': b0.t || chr(10) || 'user:'}) AS u1
  FROM (
    SELECT conv, pos, e0, s0, u0, a0, least(e0, s0, a0) AS b0
    FROM (
      SELECT conv, pos, {'c': e.c + 4, 'a': e.a || 'D', 't': e.t} AS e0,
        least({'c': s.c + 4, 'a': s.a || 'D', 't': s.t},
          {'c': e.c + CASE WHEN i = 's' THEN k ELSE 1000000000 END, 'a': e.a || 'K', 't': e.t || line}) AS s0,
        least({'c': u.c + 4, 'a': u.a || 'D', 't': u.t},
          {'c': b.c + CASE WHEN i = 'u' THEN k ELSE 1000000000 END, 'a': b.a || 'K', 't': b.t || line},
          {'c': b.c + k + 3, 'a': b.a || 'R', 't': b.t || chr(10) || 'user:' || text}) AS u0,
        least({'c': a.c + 4, 'a': a.a || 'D', 't': a.t},
          {'c': u.c + CASE WHEN i = 'a' THEN k ELSE 1000000000 END, 'a': u.a || 'K', 't': u.t || line},
          {'c': u.c + k + 3, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text}) AS a0
      FROM (
        SELECT r.conv, m.pos, e, s, u, a, least(e, s, a) AS b, m.text, left(m.role, 1) AS i, chr(10) || m.role || ':' || m.text AS line,
          CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS k
        FROM rec r JOIN marked m ON r.conv IS NOT DISTINCT FROM m.conv_id AND m.pos = r.pos + 1
      )
    )
  )
)
"""

CONVERSATIONS = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM range(256) AS r(i)
  )
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      [4294967295] || list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc
), changed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, kind
  FROM kinds WHERE kind <> 0
), copied AS (
  SELECT conv_id, turn, role, text FROM changed UNION ALL SELECT conv_id, turn, role, text FROM changed WHERE kind = 3
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM copied
), marked AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM marked GROUP BY conv_id
), rec AS (
  SELECT conv_id AS conv, CAST(0 AS BIGINT) AS pos, {{'c': 0, 'a': '', 't': ''}} AS e, {{'c': 1000000000, 'a': '', 't': ''}} AS s,
    {{'c': 3, 'a': 'I', 't': chr(10) || 'user:'}} AS u, {{'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a
  FROM counted
  UNION ALL
  ({_STEP})
), best AS (
  SELECT counted.*, least(e, a) AS b FROM rec JOIN counted ON conv IS NOT DISTINCT FROM conv_id AND pos = n
), original AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM original o LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
phrases AS (
  SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS a FROM places, range(1, 6) AS sizes(k)
  WHERE i + k - 1 <= len(w) GROUP BY lang, k, p HAVING count(*) >= 100
), cuts AS (SELECT lang, p, k, a, unnest(range(1, k)) AS c FROM phrases WHERE k > 1),
scores AS (
  SELECT x.lang, x.p, x.a, n, c, f.a AS l, g.a AS r, CAST(CAST(1000 AS HUGEINT) * x.a * n // (CAST(f.a AS HUGEINT) * g.a) AS BIGINT) AS score
  FROM cuts x JOIN totals USING (lang)
  JOIN phrases f ON f.lang = x.lang AND f.p = x.p[1:c] JOIN phrases g ON g.lang = x.lang AND g.p = x.p[c + 1:x.k]
), best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
within AS (
  SELECT lang, p[1:k - 1] AS p, a FROM phrases WHERE k > 2 UNION ALL SELECT lang, p[2:k] AS p, a FROM phrases WHERE k > 2
), kept AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM within w WHERE w.lang = b.lang AND w.p = b.p AND 100 * w.a >= 100 * b.a)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def similar_documents(words: int, percent: int, kept: bool) -> str:
    """Documents linked by the Jaccard similarity of their shingles; equal sets are one node."""
    verdict = ", component_id = doc_id AS kept" if kept else ""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, least(len(w), {words}) AS k, unnest(range(1, len(w) - least(len(w), {words}) + 2)) AS i
  FROM d WHERE len(w) > 0
), shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM places),
sets AS (SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS digest FROM shingles GROUP BY doc_id),
nodes AS (SELECT min(doc_id) AS doc_id, digest, n FROM sets GROUP BY digest, n),
held AS (SELECT doc_id, s, n FROM shingles JOIN nodes USING (doc_id)),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM held x JOIN held y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), lowest AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
named AS (SELECT digest, least(doc_id, coalesce(m, doc_id)) AS component FROM nodes LEFT JOIN lowest ON a = doc_id),
found AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
  FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN named USING (digest)
)
SELECT doc_id, n_shingles, component_id{verdict} FROM found
"""
