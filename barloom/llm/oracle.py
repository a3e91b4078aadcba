"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_EQUAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

EXACT = f"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256({_EQUAL}) AS text_sha256 FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
       text_sha256
FROM t
"""

_STRENGTH = """
SELECT 1 / rho - 1 AS strength FROM (
  SELECT CASE WHEN a > 0 AND p > 0 AND p < 1 AND a - q / a - (g - 1) > 0
    THEN least(greatest((r - a * p * p - p * (1 - p) * (g - 1)) / (p * (1 - p) * (a - q / a - (g - 1))), 0.001), 0.5)
    ELSE 0.001 END AS rho
  FROM (SELECT *, CASE WHEN a > 0 THEN k / a ELSE 0.5 END AS p FROM (
    SELECT coalesce(sum(n), 0)::DOUBLE AS a, coalesce(sum(good), 0)::DOUBLE AS k, count(*)::DOUBLE AS g,
           coalesce(sum(good::DOUBLE * good / n), 0) AS r, coalesce(sum(n * n), 0)::DOUBLE AS q
    FROM {counts} WHERE n > 0)))
"""

URLS = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
label AS (SELECT doc_id AS page_id, count(quality) AS n, sum(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
host_n AS (
  SELECT host, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(good), 0)::BIGINT AS good
  FROM p LEFT JOIN label USING (page_id) GROUP BY host),
hosts AS (
  SELECT *, list_extract(parts, -1) AS suffix,
    CASE WHEN len(parts) > 1 THEN list_extract(parts, -2) || '.' || list_extract(parts, -1) ELSE bare END AS domain
  FROM (SELECT *, string_split(bare, '.') AS parts FROM (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS bare FROM host_n))),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good FROM domains GROUP BY 1),
top AS (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END AS mean FROM suffixes),
m1 AS ({_STRENGTH.format(counts="suffixes")}), m2 AS ({_STRENGTH.format(counts="domains")}), m3 AS ({_STRENGTH.format(counts="hosts")}),
s AS (SELECT suffix, (m1.strength * top.mean + good) / (m1.strength + n) AS mean FROM suffixes, top, m1),
d AS (SELECT domain, (m2.strength * s.mean + good) / (m2.strength + n) AS mean FROM domains JOIN s USING (suffix), m2),
h AS (
  SELECT host, m3.strength + n AS weight, (m3.strength * d.mean + good) / (m3.strength + n) AS mean
  FROM hosts JOIN d USING (domain), m3),
reputation AS (SELECT host, least(mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)), 1) AS upper FROM h),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN reputation USING (host)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BENCHMARK = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
met AS (SELECT doc_id, n, i, item_id FROM place JOIN win USING (n, g)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS shown
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(shown, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM pair JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
least AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
size AS (SELECT count(*)::BIGINT AS N, sum(len(w))::BIGINT AS L FROM d WHERE len(w) > 0),
q AS (
  SELECT DISTINCT item_id, t
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark)),
f AS (
  SELECT r, doc_id, own, t, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(w)::BIGINT AS own, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, count(*)::BIGINT AS df FROM f GROUP BY t),
part AS (
  SELECT r, doc_id, t, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * own * N) // L))) AS p
  FROM f JOIN df USING (t), size),
scored AS (SELECT item_id, r, doc_id, sum(p)::BIGINT AS score FROM q JOIN part USING (t) GROUP BY ALL HAVING sum(p) > 0)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 10
"""

# The checksum as a fold over bytes; its table of 256 entries comes from eight shifts of each index.
_CRC_ROWS = "SELECT i, i AS c0 FROM range(256) r(i)"
for _k in range(8):
    _CRC_ROWS = f"SELECT i, CASE WHEN c{_k} & 1 = 1 THEN xor(c{_k} >> 1, 3988292384) ELSE c{_k} >> 1 END AS c{_k + 1} FROM ({_CRC_ROWS})"

VARIANTS = rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c8 ORDER BY i) AS t FROM ({_CRC_ROWS})),
run AS (
  SELECT name, w, count(*)::BIGINT AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name || ':' || w, ''), lambda x:
      CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) AS h
  FROM run, crc),
noisy AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN less b USING (rest, i) WHERE a.word <> b.word),
best AS (
  SELECT word, count(*)::BIGINT AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS root, 1 AS k FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, last(root ORDER BY k) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)
"""

ORACLE = {
    "op5_decontaminate": BENCHMARK,
    "op7_jaccard_join": NEAR,
    "op8_exact_dedup": EXACT,
    "op10_url_filter": URLS,
    "op11_lexical_search": RANKED,
    "op13_spelling_variants": VARIANTS,
}
