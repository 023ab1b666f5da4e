"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

import string

#: crc32 by its linearity: bytes[b] is what byte b does to the last eight bits, shift(d, b) the same d bytes before the end,
#: and zero(n) the value for n zero bytes. The crc of a text is the XOR of zero(length) and its bytes' shifts.
_CRC = """
bytes AS (
  SELECT b, list_reduce([b] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)::BIGINT AS v
  FROM range(256) r(b)),
shift AS (
  SELECT 0 AS d, b, v FROM bytes
  UNION ALL
  SELECT d + 1, s.b, xor(s.v >> 8, t.v) FROM shift s JOIN bytes t ON t.b = s.v & 255 WHERE d < (SELECT max(n) FROM crc_input)),
zero AS (
  SELECT 0 AS n, 4294967295::BIGINT AS state
  UNION ALL
  SELECT n + 1, xor(state >> 8, t.v) FROM zero JOIN bytes t ON t.b = state & 255 WHERE n < (SELECT max(n) FROM crc_input)),
crc_bytes AS (
  SELECT x, n, n - 1 - i AS d, ('0x' || substr(h, 2 * i + 1, 2))::INT AS b
  FROM (SELECT x, n, hex(encode(x)) AS h, unnest(range(n)) AS i FROM crc_input)),
crcs AS (
  SELECT x, xor(any_value(xor(state, 4294967295)), bit_xor(v)) AS crc
  FROM crc_bytes JOIN shift USING (d, b) JOIN zero USING (n) GROUP BY x)
"""

_WORDS = f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

OP11 = f"""
WITH RECURSIVE words AS (
  SELECT 'd' AS side, doc_id AS id, coalesce({_WORDS}, []) AS w FROM documents
  UNION ALL
  SELECT 'b', NULL, coalesce({_WORDS}, []) FROM benchmark),
features AS (
  SELECT side, id, len(w) AS n_words, list_concat(
    w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM words),
each AS (SELECT side, id, unnest(f) AS x FROM features),
crc_input AS (SELECT DISTINCT x, strlen(x) AS n FROM each),
{_CRC},
held AS (SELECT side, id, crc % 10000 AS bucket, count(*) AS n FROM each JOIN crcs USING (x) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM held GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
  FROM sums),
weights AS (SELECT id, sum(n * gain)::BIGINT AS weight FROM held JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, n_words, len(f)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM features LEFT JOIN weights USING (id) WHERE side = 'd'),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
  QUALIFY rank <= floor(5 * count(*) OVER () / 100))
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
"""

OP12 = f"""
WITH RECURSIVE crc_input AS (SELECT DISTINCT conv_id::VARCHAR AS x, strlen(conv_id::VARCHAR) AS n FROM conversations WHERE conv_id IS NOT NULL),
{_CRC},
original AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t, [])[:(crc % 4)::INT], c.t[(crc % 4)::INT + 1:]) AS t
  FROM original c JOIN crcs ON x = c.conv_id::VARCHAR LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, t, unnest(range(len(t) + 1)) AS depth FROM rebuilt),
members AS (SELECT conv_id, depth, t[:depth] AS path, len(t) = depth AS ends FROM steps),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS own
  FROM members GROUP BY path, depth),
kids AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
above AS (SELECT unnest(range(depth + 1)) AS d, path AS below, own, n_children IS NULL AS leaf FROM nodes LEFT JOIN kids USING (path)),
sums AS (SELECT below[:d] AS path, sum(own)::BIGINT AS saved_tokens, count_if(leaf)::BIGINT AS n_leaves FROM above GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN kids USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""

ORACLES = {"op11_importance_resampling": OP11, "op12_prefix_trie": OP12}
