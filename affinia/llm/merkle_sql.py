"""The Merkle manifest of ``documents`` in SQL."""

from __future__ import annotations

#: CRC-32 by its usual table (reversed polynomial 0xEDB88320), then the trees level by level.
MERKLE_SQL = """
WITH RECURSIVE
steps AS (
  SELECT i, 0 AS k, i AS c FROM range(256) AS t(i)
  UNION ALL
  SELECT i, k + 1, xor(c >> 1, 3988292384 * (c & 1)) FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS entries FROM steps WHERE k = 8),
plain AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: xor(a >> 8, entries[xor(a & 255, b) + 1]))) AS checksum
  FROM documents, crc
),
suspect AS (
  SELECT *, CASE WHEN checksum % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered FROM plain
),
digests AS (
  SELECT doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS altered_leaf
  FROM suspect
),
leaves AS (
  SELECT doc_id, leaf, altered_leaf,
    row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS rid,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n
  FROM digests
),
nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3, n
),
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, tree AS idx, count(*) OVER () AS n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM crown WHERE n > 1 GROUP BY lvl, idx // 3, n
),
both_levels AS (
  SELECT tree, 0 AS part, lvl, idx, n, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT -1, 1, lvl, idx, n, h FROM crown WHERE n > 1
),
sides AS (
  SELECT a.tree, a.part, a.lvl, a.idx,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS after
  FROM both_levels a JOIN both_levels b
    ON a.tree = b.tree AND a.part = b.part AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3
  GROUP BY a.tree, a.part, a.lvl, a.idx
),
path AS (
  SELECT rid, before, after, row_number() OVER (PARTITION BY rid ORDER BY part, lvl) AS k
  FROM (
    SELECT l.rid, s.part, s.lvl, s.before, s.after FROM leaves l JOIN sides s
      ON s.part = 0 AND s.tree = l.tree AND s.idx = l.idx // (3 ** s.lvl)::BIGINT
    UNION ALL
    SELECT l.rid, s.part, s.lvl, s.before, s.after FROM leaves l JOIN sides s
      ON s.part = 1 AND s.idx = l.tree // (3 ** s.lvl)::BIGINT
  )
),
folds AS (
  SELECT rid, 0 AS k, altered_leaf AS h FROM leaves
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(p.before || f.h || p.after) FROM folds f JOIN path p ON p.rid = f.rid AND p.k = f.k + 1
),
ends AS (SELECT rid, arg_max(h, k) AS folded_root FROM folds GROUP BY rid),
proofs AS (SELECT rid, string_agg(before || after, '' ORDER BY k) AS told FROM path GROUP BY rid)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.told, '')) AS proof_sha256,
  e.folded_root, e.folded_root = r.h AS verified
FROM leaves l
JOIN subroots s ON s.tree = l.tree
JOIN (SELECT h FROM crown WHERE n = 1) r ON true
JOIN ends e ON e.rid = l.rid
LEFT JOIN proofs p ON p.rid = l.rid
"""
