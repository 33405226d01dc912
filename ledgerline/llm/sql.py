"""SQL of the operators on trees and vectors, for an independent engine."""


CRC32 = r"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""

OP11_SQL = rf"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, text, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    {CRC32.format("doc_id")} % 5 = 0 AS chosen FROM documents),
d AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN chosen THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS seen FROM f),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
low AS (
  SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16 FROM low WHERE n > 1 GROUP BY tree, level, place // 16),
lows AS MATERIALIZED (SELECT * FROM low),
sub AS MATERIALIZED (SELECT tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM lows WHERE n = 1),
high AS (
  SELECT 0 AS level, place, subroot AS digest, n FROM sub
  UNION ALL SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16 FROM high WHERE n > 1 GROUP BY level, place // 16),
highs AS MATERIALIZED (SELECT * FROM high),
nodes AS MATERIALIZED (SELECT 0 AS part, * FROM lows UNION ALL SELECT 1, '', level, place, digest, n FROM highs),
steps AS (
  SELECT l.tree, l.place AS leaf_place, x.part, x.level, coalesce(string_agg(x.digest, '' ORDER BY x.place) FILTER (WHERE x.place < x.own), '') AS l, coalesce(string_agg(x.digest, '' ORDER BY x.place) FILTER (WHERE x.place > x.own), '') AS r
  FROM leaves l JOIN sub s ON s.name = l.tree, LATERAL (
    SELECT n.*, CASE n.part WHEN 0 THEN l.place ELSE s.place END // (16 ** n.level)::BIGINT AS own FROM nodes n WHERE n.n > 1 AND n.tree = CASE n.part WHEN 0 THEN l.tree ELSE '' END
      AND n.place // 16 = CASE n.part WHEN 0 THEN l.place ELSE s.place END // (16 ** (n.level + 1))::BIGINT) x
  GROUP BY l.tree, l.place, x.part, x.level),
proof AS MATERIALIZED (SELECT tree, leaf_place, string_agg(l || r, '' ORDER BY part, level) AS siblings, list([l, r] ORDER BY part, level) AS pairs FROM steps GROUP BY tree, leaf_place),
fold AS (
  SELECT l.tree, l.place, 0 AS k, seen AS h, coalesce(pairs, []) AS pairs FROM leaves l LEFT JOIN proof p ON p.tree = l.tree AND p.leaf_place = l.place
  UNION ALL SELECT tree, place, k + 1, sha256(pairs[k + 1][1] || h || pairs[k + 1][2]), pairs FROM fold WHERE k < len(pairs))
SELECT l.doc_id, l.leaf, s.subroot, t.digest AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256, f.h AS folded_root, f.h = t.digest AS verified
FROM leaves l JOIN sub s ON s.name = l.tree JOIN highs t ON t.n = 1 JOIN fold f ON f.tree = l.tree AND f.place = l.place AND f.k = len(f.pairs)
LEFT JOIN proof p ON p.tree = l.tree AND p.leaf_place = l.place
"""


OP12_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.w, b.w), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP13_SQL = rf"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT c, count(*) AS n, {CRC32.format("c")} % 9 AS h, c - c % 5 AS base FROM t GROUP BY c),
s AS (SELECT n.*, least(n.h, coalesce(b.n, 0)) AS taken FROM n LEFT JOIN n b ON b.c = n.base),
w AS (
  SELECT s.c, t.place + 1 AS d, role, text FROM s JOIN t ON t.c = s.base AND t.place < s.h
  UNION ALL SELECT s.c, t.place - s.h + s.taken + 1, role, text FROM s JOIN t ON t.c = s.c AND t.place >= s.h),
k AS MATERIALIZED (
  SELECT c, d, strlen(text) AS bytes, sha256(string_agg(sha256(role || chr(0) || text), '' ) OVER (PARTITION BY c ORDER BY d)) AS node FROM w
  UNION ALL SELECT c, 0, 0, '' FROM n),
e AS (SELECT c, max(d) AS total FROM k GROUP BY c),
nodes AS MATERIALIZED (
  SELECT d, node, min(k.c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(k.c::VARCHAR, ',' ORDER BY k.c) FILTER (WHERE d = total), '')) AS ends_sha256
  FROM k JOIN e ON e.c = k.c GROUP BY d, node),
up AS MATERIALIZED (SELECT x.d, x.node, x.c, x.saved, k.d AS above_d, k.node AS above FROM nodes x JOIN k ON k.c = x.c AND k.d <= x.d),
kids AS (SELECT above_d AS d, above AS node, count(*) AS n_children FROM up WHERE above_d = d - 1 GROUP BY ALL),
sums AS (
  SELECT above_d AS d, above AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
  FROM up LEFT JOIN kids ON kids.d = up.d AND kids.node = up.node GROUP BY above_d, above)
SELECT x.c AS conv_id, x.d::BIGINT AS depth, p.c AS parent_conv_id, x.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums USING (d, node) LEFT JOIN kids USING (d, node) LEFT JOIN up u ON u.d = x.d AND u.node = x.node AND u.above_d = x.d - 1
LEFT JOIN nodes p ON p.d = u.above_d AND p.node = u.above
"""
