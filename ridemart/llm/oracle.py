"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op5_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, n, i FROM dg JOIN (SELECT DISTINCT n, g FROM win) USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit
          FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM dg JOIN win USING (n, g)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_PII_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "len(list_filter(string_split(m, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0"),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
     "CASE WHEN i % 2 = 1 THEN CAST(d[length(d) - i + 1] AS INT) "
     "ELSE (2 * CAST(d[length(d) - i + 1] AS INT)) // 10 + (2 * CAST(d[length(d) - i + 1] AS INT)) % 10 END)) % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
]


def _pii_kind(k: int, name: str, pattern: str, valid: str) -> str:
    return f"""
  SELECT doc_id, {k} AS k, '{name}' AS kind, b, b + length(m) AS e FROM (
    SELECT doc_id, m[i] AS m, regexp_replace(m[i], '[^0-9]', '', 'g') AS d,
           CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS b
    FROM (SELECT doc_id, m, s, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS s
      FROM documents WHERE text IS NOT NULL)))
  WHERE {valid}"""


# Base spans only: the added kinds and scores of op9_pii have no counterpart here.
ORACLE["pii_base"] = "WITH f AS (" + " UNION ALL ".join(
    _pii_kind(k, *kind) for k, kind in enumerate(_PII_KINDS)) + """)
SELECT d.doc_id, """ + ", ".join(f"count(*) FILTER (kind = '{k[0]}') AS n_{k[0]}" for k in _PII_KINDS) + """,
       sha256(coalesce(string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k), '')) AS base_sha256
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
"""

# Bytes are pairs of hexadecimal digits; a window's 800 digits are compared by their hash.
ORACLE["op7_suffix_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
p AS (SELECT r, unnest(range(0, length(x) // 2 - 399)) AS i FROM d WHERE length(x) >= 800),
w AS (SELECT r, i, md5_number(substr(x, 2 * i + 1, 800)) AS h FROM p JOIN d USING (r)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
edge AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) + 400 AS fresh FROM hit),
run AS (SELECT r, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY i) AS g FROM edge),
span AS (SELECT r, g, min(i) AS a, max(i) + 400 AS z FROM run GROUP BY r, g),
gap AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS p FROM span),
kept AS (SELECT r, string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS front, max(z) AS z, sum(z - a) AS gone,
                count(*) AS n FROM gap JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLE["op8_lz_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, i, md5_number(array_to_string(w[i:i + 12], ' ')) AS h
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
hit AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY h) AS least FROM g) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, i + j AS p FROM hit, range(0, 13) t(j)),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
edge AS (SELECT r, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -9) > 1 AS fresh FROM hit),
runs AS (SELECT r, count(*) FILTER (fresh) AS f FROM edge GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256, CAST(coalesce(f, 0) AS BIGINT) AS n_factors
FROM d LEFT JOIN kept USING (r) LEFT JOIN runs USING (r)
"""

ORACLE["op6_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(min(y), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id, n
"""

# Candidates share a word of both prefixes (rarest words first); every candidate pair is then counted in full.
ORACLE["op1_line_dedup"] = r"""
WITH l AS (SELECT doc_id, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
           FROM (SELECT doc_id, unnest(p) AS line, unnest(range(1, len(p) + 1)) AS i
                 FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL))),
node AS (SELECT line, any_value(list_distinct(w)) AS w, min((doc_id, i)) AS first FROM l WHERE len(w) > 0 GROUP BY line),
word AS (SELECT line, len(w) AS n, unnest(w) AS t FROM node),
df AS (SELECT t, count(*) AS c FROM word GROUP BY t),
pre AS (SELECT line, t FROM (SELECT line, n, t, row_number() OVER (PARTITION BY line ORDER BY c, t) AS r FROM word JOIN df USING (t))
        WHERE r <= n - (4 * n + 4) // 5 + 1),
cand AS (SELECT DISTINCT a.line AS x, b.line AS y FROM pre a JOIN pre b USING (t) WHERE a.line <> b.line),
sim AS (SELECT y FROM cand JOIN node a ON a.line = x JOIN node b ON b.line = y
        WHERE a.first < b.first AND 100 * len(list_intersect(a.w, b.w)) >= 80 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))),
gone AS (SELECT doc_id, i FROM l JOIN node USING (line)
         WHERE (doc_id, i) <> first OR line IN (SELECT y FROM sim)),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS k, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(t.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.n, 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM documents d LEFT JOIN total t USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op12_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT page_id, n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

# Counts all phrases of one to three words; the walk over edges whose inner nodes are unary gives path_words.
ORACLE["op11_phrases"] = r"""
WITH RECURSIVE t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
p AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM t),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p WHERE len(w) > 0),
g1 AS (SELECT lang, w[i] AS x, count(*) AS f FROM o GROUP BY ALL),
g2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM o WHERE i < len(w) GROUP BY ALL),
g3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM o WHERE i + 1 < len(w) GROUP BY ALL),
e AS (SELECT * FROM g3 WHERE f >= 10),
tot AS (SELECT lang, sum(f) AS n FROM g1 GROUP BY lang),
mo AS (SELECT lang, x, y, max(f) AS m FROM e GROUP BY ALL),
mi AS (SELECT lang, y AS x, z AS y, max(f) AS m FROM e GROUP BY ALL),
nd AS (SELECT g2.*, coalesce(mo.m, 0) AS mo, coalesce(mi.m, 0) AS mi FROM g2 LEFT JOIN mo USING (lang, x, y) LEFT JOIN mi USING (lang, x, y) WHERE g2.f >= 10),
un AS (SELECT lang, x, y FROM nd WHERE f = mo AND f = mi),
wk AS (SELECT e.lang, e.x AS hx, e.y AS hy, e.z AS hz, e.x, e.y, e.z, 3 AS k FROM e ANTI JOIN un USING (lang, x, y)
       UNION ALL
       SELECT wk.lang, hx, hy, hz, e.x, e.y, e.z, k + 1 FROM wk JOIN un ON un.lang = wk.lang AND un.x = wk.y AND un.y = wk.z
       JOIN e ON e.lang = wk.lang AND e.x = wk.y AND e.y = wk.z),
pw AS (SELECT lang, x, y, z, max(k) OVER (PARTITION BY lang, hx, hy, hz) AS k FROM wk),
c3 AS (SELECT e.lang, e.x || ' ' || e.y || ' ' || e.z AS phrase, e.f AS a, a1.f AS f1, b23.f AS f23, b12.f AS f12, a3.f AS f3, pw.k,
         CAST(e.f AS HUGEINT) * e.f * 1000000 // (CAST(a1.f AS HUGEINT) * b23.f) AS s1,
         CAST(e.f AS HUGEINT) * e.f * 1000000 // (CAST(b12.f AS HUGEINT) * a3.f) AS s2
       FROM e JOIN g1 a1 ON a1.lang = e.lang AND a1.x = e.x JOIN g1 a3 ON a3.lang = e.lang AND a3.x = e.z
       JOIN g2 b12 ON b12.lang = e.lang AND b12.x = e.x AND b12.y = e.y JOIN g2 b23 ON b23.lang = e.lang AND b23.x = e.y AND b23.y = e.z
       JOIN pw ON pw.lang = e.lang AND pw.x = e.x AND pw.y = e.y AND pw.z = e.z),
c AS (SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN f1 ELSE f12 END AS l, CASE WHEN s1 <= s2 THEN f23 ELSE f3 END AS r, least(s1, s2) AS score, k FROM c3
      UNION ALL
      SELECT nd.lang, nd.x || ' ' || nd.y, nd.f, a.f, b.f, CAST(nd.f AS HUGEINT) * nd.f * 1000000 // (CAST(a.f AS HUGEINT) * b.f), 2
      FROM nd JOIN g1 a ON a.lang = nd.lang AND a.x = nd.x JOIN g1 b ON b.lang = nd.lang AND b.x = nd.y
      WHERE 100 * greatest(mo, mi) < 50 * nd.f),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM c)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score, CAST(k AS BIGINT) AS path_words
FROM r JOIN tot USING (lang) WHERE rank <= 2000
"""
