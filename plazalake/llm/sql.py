"""DuckDB statements that say the same as the registered queries, by other means."""

from __future__ import annotations

CHUNK_RECIPES = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS pos,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, pos = 1 AS kept, text_sha256 FROM r
"""

FAIR_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), 1, 15))::BIGINT AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][rank % 3 + 1]::BIGINT AS weight, 2 * source_size AS cap FROM s),
f AS (
  SELECT *, row_number() OVER fill AS pos,
         3 * (SELECT sum(source_size) FROM w)
           - 2 * coalesce(sum(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         (SELECT sum(weight) FROM w)
           - coalesce(sum(weight) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights_left
  FROM w WINDOW fill AS (ORDER BY cap / weight, rank)),
l AS (
  SELECT min(pos) AS pos, arg_min(left_over, pos) AS left_over, arg_min(weights_left, pos) AS weights_left
  FROM f WHERE cap * weights_left * 2 > left_over * weight),
t AS (
  SELECT f.source, source_size, rank,
         CASE WHEN f.pos < coalesce(l.pos, 1e9) THEN cap::DOUBLE
              ELSE (l.left_over * weight)::DOUBLE / (l.weights_left * 2)::DOUBLE END AS target
  FROM f, l),
q AS (
  SELECT d.*, source_size, rank, target,
         sum(size) OVER (PARTITION BY rank ORDER BY place, doc_id NULLS LAST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served,
         row_number() OVER () AS r
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (
  SELECT r, size, sum(size) OVER (
           ORDER BY (served + turn * source_size)::DOUBLE / target, place, rank, doc_id NULLS LAST, size, turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM q, (VALUES (0), (1)) v(turn) WHERE size > 0),
k AS (
  SELECT r, sum(CASE WHEN upto * 2 <= 3 * (SELECT sum(size) FROM d) THEN size ELSE 0 END) AS taken
  FROM i GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM q LEFT JOIN k USING (r)
"""

_ESCAPED = (
    r"regexp_replace({}, '([\[<])(\\*)(/?(?:SYS\]|INST\]|TURN\]|s>)|END\])', '\1\\\2\3', 'g')"
)

CHAT_FORMAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT *, {_ESCAPED.format("text")} AS body, {_ESCAPED.format("role")} AS name,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum(length(body) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                                 ELSE length(name) + 18 END) AS formatted_chars
  FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM g
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
i AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM i QUALIFY part = 'pair' OR rank <= 10
"""

_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(id) + 1), "
    "lambda i: list_prepend(ascii(id[i])::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))), "
    "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
)

PREFIX_TRIE = rf"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS id FROM o),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM i),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN o ON o.conv_id = base AND pos < h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND pos >= h),
m AS (
  SELECT conv_id, row_number() OVER turns AS depth, strlen(text) AS bytes,
         string_agg(sha256(strlen(role) || ':' || role || text), '') OVER turns AS node
  FROM r WINDOW turns AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(bytes) AS worth
  FROM m GROUP BY node, depth),
p AS (
  SELECT n.*, u.node AS parent, u.conv_id AS parent_conv_id
  FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
  LEFT JOIN n u ON u.node = m.node),
k AS (SELECT parent AS node, count(*) AS n_children FROM p WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT m.node, sum(p.worth) AS saved_tokens, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
  FROM p LEFT JOIN k USING (node) JOIN m ON m.conv_id = p.conv_id AND m.depth <= p.depth
  GROUP BY m.node),
e AS (
  SELECT node, string_agg(conv_id, ',' ORDER BY conv_id) AS ids
  FROM (SELECT * FROM m QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM p LEFT JOIN k USING (node) JOIN s USING (node) LEFT JOIN e USING (node)
"""
