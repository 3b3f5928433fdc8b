"""DuckDB twins of the text queries that SQL can express."""

from __future__ import annotations

BLANKS = r"[\x20\x09-\x0D]+"

#: Words of a text as a list; leading and trailing blanks leave no empty words.
WORDS = rf"list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda w: w <> '')"

QUALITY = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
lines AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{BLANKS}', '', 'g') <> '') AS ls FROM w),
tri AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT r, t FROM tri GROUP BY r, t HAVING count(*) > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM tri JOIN twice USING (r, t), (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
c AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * n_symbols <= n_words
    AND 100 * n_dup_lines <= 30 * n_lines AND word_chars BETWEEN 2 * n_words AND 15 * n_words AS kept
FROM c
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN last IS NOT NULL AND d.page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d LEFT JOIN g USING (payload_digest, payload_bytes)
"""

REPEATS = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
win AS (
  SELECT r, i, md5(array_to_string(words[i : i + 34], ' ')) AS h
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)),
hit AS (SELECT r, list(DISTINCT i ORDER BY i) AS starts FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1 GROUP BY r),
gone AS (SELECT r, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 35)))) AS cut FROM hit),
pos AS (
  SELECT r, doc_id, words, coalesce(cut, []) AS cut, range(1, len(words) + 1) AS all_at FROM w LEFT JOIN gone USING (r))
SELECT doc_id, len(words)::BIGINT AS n_words, len(cut)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_sort(list_filter(all_at, lambda i: NOT list_contains(cut, i))), lambda i: words[i]), ' ')) AS kept_sha256
FROM pos
"""

TRIE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, conv_id::VARCHAR AS s FROM t),
h AS (
  SELECT conv_id, base, list_reduce(
      list_prepend(4294967295, flatten(list_transform(range(1, len(s) + 1), lambda i: [256 + ord(s[i]), 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, x: CASE WHEN x >= 256 THEN xor(a, x - 256) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS crc
  FROM c),
o AS (SELECT conv_id, base, xor(crc, 4294967295) % 4 AS h FROM h),
r AS (
  SELECT o.conv_id, t.role, t.text, 0 AS part, t.p FROM o JOIN t ON t.conv_id = o.base AND t.p <= o.h
  UNION ALL SELECT o.conv_id, t.role, t.text, 1, t.p FROM o JOIN t ON t.conv_id = o.conv_id AND t.p > o.h),
n AS (
  SELECT conv_id, role, text, row_number() OVER w AS d, string_agg(md5(len(role) || ' ' || role || text), '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS UNBOUNDED PRECEDING)),
a AS (
  SELECT conv_id, 0 AS d, '' AS path, '' AS text FROM c
  UNION ALL SELECT conv_id, d, md5(path), text FROM n),
node AS (
  SELECT d, path, min(conv_id) AS first, count(*) AS members, (count(*) - 1) * len(any_value({WORDS})) AS saved FROM a GROUP BY d, path),
link AS (SELECT x.d, x.path, y.path AS up FROM node x JOIN a y ON y.conv_id = x.first AND y.d = x.d - 1),
kids AS (SELECT d - 1 AS d, up AS path, count(*) AS n FROM link GROUP BY ALL),
own AS (SELECT node.*, coalesce(n, 0) AS children FROM node LEFT JOIN kids USING (d, path)),
sums AS (
  SELECT a.d, a.path, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM own JOIN a ON a.conv_id = own.first AND a.d <= own.d GROUP BY ALL),
last AS (SELECT conv_id, max(d) AS d FROM a GROUP BY conv_id),
ends AS (
  SELECT d, path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM a JOIN last USING (conv_id, d) GROUP BY ALL)
SELECT own.first AS conv_id, own.d::BIGINT AS depth, p.first AS parent_conv_id, own.members::BIGINT AS n_convs,
  own.children::BIGINT AS n_children, sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens,
  coalesce(sha, sha256('')) AS ends_sha256
FROM own JOIN sums USING (d, path) LEFT JOIN link USING (d, path)
  LEFT JOIN node p ON p.d = own.d - 1 AND p.path = link.up LEFT JOIN ends ON ends.d = own.d AND ends.path = own.path
"""

TWINS: dict[str, str] = {"op5_quality": QUALITY, "op8_warc": WARC, "op10_substring": REPEATS, "op11_prefix_trie": TRIE}
