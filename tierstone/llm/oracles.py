"""SQL of the queries that SQL can express, beside those that stand with their query."""

#: The table of the CRC-32 polynomial (a fixed value, in reversed bit order), made in SQL.
CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32_sql(blob: str) -> str:
    """The unsigned CRC-32 of a blob, with ``tab`` in reach."""
    byte = f"('0x' || hex({blob}[i + 1:i + 1]))::BIGINT"
    steps = f"list_transform(range(octet_length({blob})), lambda i: {byte})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295)"


CONVERSATION_TRIE = rf"""
WITH {CRC_TABLE},
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, {crc32_sql("encode(c::VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM t), crc),
x AS (
  SELECT c.c, 0 AS part, i, role, text FROM c JOIN t ON t.c = c.c - c.c % 20 WHERE i <= h
  UNION ALL SELECT c.c, 1, i, role, text FROM c JOIN t ON t.c = c.c WHERE i > h),
s AS (
  SELECT c.c, coalesce(list({{'role': role, 'text': text}} ORDER BY part, i) FILTER (i IS NOT NULL), []) AS s
  FROM c LEFT JOIN x ON x.c = c.c GROUP BY c.c),
m AS (SELECT c, s[1:d] AS p, d, len(s) = d AS ends FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM s)),
n AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends,
    CASE WHEN d > 0 THEN (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
b AS (
  SELECT p[1:u] AS p, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT n.p, saved, n_children, unnest(range(d + 1)) AS u FROM n LEFT JOIN k ON k.p = n.p) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN b ON b.p = n.p LEFT JOIN k ON k.p = n.p LEFT JOIN n up ON n.d > 0 AND up.p = n.p[1:n.d - 1]"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
    FROM documents) GROUP BY ALL),
h AS (SELECT run, k, {crc32_sql("encode(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM r, crc),
w AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
d AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT d.word AS a, w.word AS b FROM d JOIN w ON d.less = w.word
  UNION SELECT w.word, d.word FROM d JOIN w ON d.less = w.word
  UNION SELECT x.word, y.word FROM d x JOIN d y ON x.i = y.i AND x.less = y.less AND x.word <> y.word),
f AS (
  SELECT a, count(*) AS n_near, max(o.n) AS top, min(b) FILTER (o.n = best) AS b FROM (
    SELECT a, b, max(n) OVER (PARTITION BY a) AS best FROM p JOIN w ON w.word = b) JOIN w o ON o.word = b GROUP BY a),
g AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN b END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM w LEFT JOIN f ON f.a = word),
e AS (SELECT word, word AS root FROM g UNION SELECT e.word, g.form FROM e JOIN g ON g.word = e.root WHERE g.form IS NOT NULL)
SELECT g.word, g.form, e.root, g.n, g.n_near, g.form_n
FROM g JOIN e ON e.word = g.word JOIN g last ON last.word = e.root AND last.form IS NULL"""

REPEATED_BYTES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(b[i + 1:i + 200]) AS h FROM (SELECT r, b, unnest(range(octet_length(b) - 199)) AS i FROM d)),
m AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
s AS (
  SELECT r, min(i) AS a, max(i) + 200 AS z FROM (
    SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM (
      SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS new FROM m))
  GROUP BY r, g),
k AS (
  SELECT r, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last, string_agg(hex(b[before + 1:a]), '' ORDER BY a) AS x FROM (
    SELECT s.r, a, z, b, coalesce(lag(z) OVER (PARTITION BY s.r ORDER BY a), 0) AS before FROM s JOIN d ON d.r = s.r)
  GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(x, '') || hex(b[coalesce(last, 0) + 1:octet_length(b)]))) AS kept_sha256
FROM d LEFT JOIN k ON k.r = d.r"""
