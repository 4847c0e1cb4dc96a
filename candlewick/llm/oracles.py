"""DuckDB SQL for the queries that SQL can express (operators 1, 5 and 6)."""

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
  FROM embeddings
),
link AS (
  SELECT a.r AS a, b.r AS b
  FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE a.good AND b.good AND list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (
  SELECT r, r AS o FROM v
  UNION
  SELECT reach.r, link.b FROM reach JOIN link ON reach.o = link.a
),
component AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.o GROUP BY reach.r),
degree AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN component USING (r) LEFT JOIN degree USING (r)"""

TOP_INNER_PRODUCTS = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.r AS cr, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.r <> c.r
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id ASC NULLS LAST, cr) AS rank FROM scored) s
WHERE rank <= 5"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT r, o, s, array_to_string(w[s + 1:s + 20], ' ') AS k
  FROM (SELECT r, o, w, unnest(range(0, len(w) - 19)) AS s FROM d) x
),
earliest AS (SELECT k, min({'o': o, 's': s}) AS m FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT r, unnest(range(s + 1, s + 21)) AS i
  FROM windows JOIN earliest USING (k) WHERE {'o': o, 's': s} > m
),
kept AS (
  SELECT x.r, string_agg(x.word, ' ' ORDER BY x.i) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d) x
  LEFT JOIN gone ON gone.r = x.r AND gone.i = x.i
  WHERE gone.r IS NULL GROUP BY x.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def _leaf(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"


#: CRC32 of the decimal id: a byte is taken in, then eight steps (-1) follow.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295)"""

#: Nodes of every level of every tree, then each path folded upwards from its leaf.
MERKLE_MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN coalesce({_CRC32} % 7 = 0, false) THEN {_leaf("n_chars::HUGEINT + 1")} ELSE {_leaf("n_chars")} END AS other
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, row_number() OVER () AS rid FROM hashed),
t(lang, lvl, k, h) AS (
  SELECT lang, 0, k, leaf FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, k // 2, sha256(string_agg(h, '' ORDER BY k))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM t) s WHERE n > 1 GROUP BY lang, lvl, k // 2),
sizes AS (SELECT lang, lvl, count(*) AS n FROM t GROUP BY lang, lvl),
subroots AS (SELECT lang, arg_max(h, lvl) AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k FROM t GROUP BY lang),
g(lvl, k, h) AS (
  SELECT 0, k, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, k // 2, sha256(string_agg(h, '' ORDER BY k))
  FROM (SELECT *, count(*) OVER () AS n FROM g) s WHERE n > 1 GROUP BY lvl, k // 2),
g_sizes AS (SELECT lvl, count(*) AS n FROM g GROUP BY lvl),
up(rid, lang, lvl, k, cur, proof) AS (
  SELECT rid, lang, 0, k, other, '' FROM leaves
  UNION ALL
  SELECT up.rid, up.lang, up.lvl + 1, up.k // 2,
         sha256(CASE WHEN s.h IS NULL THEN cur WHEN up.k % 2 = 0 THEN cur || s.h ELSE s.h || cur END), proof || coalesce(s.h, '')
  FROM up JOIN sizes z ON z.lang IS NOT DISTINCT FROM up.lang AND z.lvl = up.lvl AND z.n > 1
  LEFT JOIN t s ON s.lang IS NOT DISTINCT FROM up.lang AND s.lvl = up.lvl AND s.k = xor(up.k, 1)),
tops AS (SELECT rid, lang, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM up GROUP BY rid, lang),
paths(rid, lvl, k, cur, proof) AS (
  SELECT rid, 0, k, cur, proof FROM tops JOIN subroots ON subroots.lang IS NOT DISTINCT FROM tops.lang
  UNION ALL
  SELECT o.rid, o.lvl + 1, o.k // 2,
         sha256(CASE WHEN s.h IS NULL THEN cur WHEN o.k % 2 = 0 THEN cur || s.h ELSE s.h || cur END), proof || coalesce(s.h, '')
  FROM paths o JOIN g_sizes z ON z.lvl = o.lvl AND z.n > 1 LEFT JOIN g s ON s.lvl = o.lvl AND s.k = xor(o.k, 1)),
folded AS (SELECT rid, arg_max(cur, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM paths GROUP BY rid),
root AS (SELECT arg_max(h, lvl) AS root FROM g)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN folded USING (rid) JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang, root
"""
