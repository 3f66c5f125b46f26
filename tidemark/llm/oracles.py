"""DuckDB SQL for the queries of the operators that SQL can express (same column names)."""

from __future__ import annotations

#: Lower-cases A-Z alone.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
TERMS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS.format("text")}, []) AS ws FROM documents),
items AS (SELECT item_id, ws, least(len(ws), 10) AS k
          FROM (SELECT item_id, {WORDS.format("text")} AS ws FROM benchmark WHERE text IS NOT NULL) WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win
            FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM items)),
grams AS (SELECT r, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win
          FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(ws) >= k)),
met AS (SELECT r, i, g.k, item_id FROM grams g JOIN windows w ON g.k = w.k AND g.win = w.win),
hits AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS at FROM met) GROUP BY r),
named AS (SELECT r, count(*) AS n, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS digest
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM met) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)
"""

NEAR_VECTORS = """
WITH RECURSIVE vecs AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (SELECT vec_id, v FROM vecs
         WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
          ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM vecs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
comps AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vecs JOIN comps ON vec_id = comps.a LEFT JOIN links ON vec_id = links.a
"""

RANKED_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format("text")} AS ws FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM docs WHERE len(ws) > 0),
tf AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM docs) GROUP BY r, w),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
weights AS (SELECT w, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight FROM df, total),
sizes AS (SELECT r, doc_id, 100 - 50 + ((50 * len(ws) * n_docs) // n_terms) AS m FROM docs, total),
asked AS (SELECT i, item_id, unnest(list_distinct({TERMS.format("text")})) AS w
          FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark WHERE text IS NOT NULL)),
scores AS (SELECT i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM asked JOIN weights USING (w) JOIN tf USING (w) JOIN sizes USING (r) GROUP BY i, item_id, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

_LEAF = "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in (
    "doc_id::VARCHAR", "source", "lang", "{n}::VARCHAR", "text")) + ")"
_PARENTS = "list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"
_SIDE = "CASE WHEN p_here % 2 = 1 THEN 'L' ELSE 'R' END"

#: CRC-32 of the decimal doc_id: a byte is XORed in, then eight shifts (marked -1) by the reversed polynomial; null for null.
_CRC32 = ("xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
          "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), "
          "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)")

MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf, {_LEAF.format(n="(n_chars + 1)")} AS bent, row_number() OVER () AS r FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
tree AS (SELECT lang, 0 AS level, list(leaf ORDER BY p) AS nodes FROM placed GROUP BY lang
         UNION ALL SELECT lang, level + 1, {_PARENTS} FROM tree WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q FROM tree WHERE len(nodes) = 1),
crown AS (SELECT 0 AS level, list(subroot ORDER BY q) AS nodes FROM subroots
          UNION ALL SELECT level + 1, {_PARENTS} FROM crown WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1),
steps AS (
  SELECT r, level, (p >> level) AS p_here, nodes, 0 AS part
  FROM placed JOIN tree ON placed.lang IS NOT DISTINCT FROM tree.lang WHERE len(nodes) > 1
  UNION ALL SELECT r, level, (q >> level) AS p_here, nodes, 1 AS part
  FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang, crown WHERE len(nodes) > 1),
paths AS (SELECT r, list(side || sibling ORDER BY part, level) AS path
          FROM (SELECT r, part, level, {_SIDE} AS side, coalesce(nodes[xor(p_here, 1) + 1], '') AS sibling FROM steps) GROUP BY r),
proofs AS (SELECT p.*, subroot, root, coalesce(path, []) AS path,
           list_reduce([CASE WHEN {_CRC32} % 7 = 0 THEN bent ELSE leaf END] || coalesce(path, []),
                       lambda a, x: CASE WHEN len(x) = 1 THEN sha256(a) WHEN x[1] = 'L' THEN sha256(x[2:] || a) ELSE sha256(a || x[2:]) END)
             AS folded_root
           FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (r), root)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM proofs
"""
