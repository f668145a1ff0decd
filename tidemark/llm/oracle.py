"""DuckDB SQL with the rows of the corpus queries that SQL can express."""

LLM_ORACLES: dict[str, str] = {}

LLM_ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS target FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN k.target IS NULL OR k.target = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k.target <> p.page_id THEN k.target END AS refers_to
FROM p LEFT JOIN k ON p.d = k.d AND p.n >= 1000
"""

LLM_ORACLES["op8_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LLM_ORACLES["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, w FROM (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, win.item_id FROM dw JOIN win ON dw.s = win.s AND dw.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS c,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.c, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.c, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(pos.c, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""

LLM_ORACLES["op3_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps
         FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep ON win.s = rep.s) GROUP BY doc_id),
kept AS (SELECT d.doc_id, d.w, CASE WHEN g.ps IS NULL THEN range(1, len(d.w) + 1)
                               ELSE list_sort(list_filter(range(1, len(d.w) + 1), lambda p: NOT list_contains(g.ps, p))) END AS ks
         FROM d LEFT JOIN gone g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(ks) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(ks, lambda p: w[p]), ' ')) AS kept_sha256
FROM kept
"""

LLM_ORACLES["op2_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.root AS component_id, m.root = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = d.doc_id
"""

LLM_ORACLES["op11_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.root AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = d.doc_id
"""

# CRC-32 of a decimal id, bit by bit (3988292384 is the reversed polynomial)
_CRC32 = """4294967295 - list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS UBIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1))))"""

LLM_ORACLES["op13_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, g, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) AS i FROM t),
c AS (SELECT conv_id, ({_CRC32}) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (
  SELECT c.conv_id, o.i, o.g, o.w FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, o.i, o.g, o.w FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
n AS (
  SELECT conv_id, 0 AS d, 0 AS w, '' AS k FROM c
  UNION ALL
  SELECT conv_id, row_number() OVER p AS d, w, string_agg(g, '') OVER p AS k FROM b WINDOW p AS (PARTITION BY conv_id ORDER BY i)),
z AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w FROM n GROUP BY k, d),
e AS (SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
      FROM (SELECT conv_id, arg_max(k, d) AS k FROM n GROUP BY conv_id) GROUP BY k),
ch AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS c FROM z WHERE d > 0 GROUP BY 1),
zc AS (SELECT z.*, coalesce(ch.c, 0) AS c FROM z LEFT JOIN ch ON z.k = ch.k),
sub AS (SELECT left(k, 32 * j) AS k, sum((n_convs - 1) * w) AS saved, count(*) FILTER (c = 0) AS leaves
        FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM zc) GROUP BY 1)
SELECT zc.conv_id, CAST(zc.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, zc.n_convs, CAST(zc.c AS BIGINT) AS n_children,
       CAST(sub.leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM zc JOIN sub ON sub.k = zc.k LEFT JOIN e ON e.k = zc.k LEFT JOIN z u ON zc.d > 0 AND u.k = left(zc.k, 32 * (zc.d - 1))
"""

LLM_ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
neg AS (
  SELECT p.anchor_id, p.positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE r <= 5
"""
