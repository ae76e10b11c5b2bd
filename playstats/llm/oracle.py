"""DuckDB statements for the queries that SQL can express."""

_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), " \
       "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
           GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT d.doc_id, d.pos, d.line, s.k IS NOT NULL AND d.doc_id <> s.keeper AS gone
           FROM keyed d LEFT JOIN shared s ON d.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op3_exact_top_k": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every pair of documents with a common shingle is compared; components by transitive closure.
ORACLE["op7_minhash_near_dedup"] = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded),
classes AS (
  SELECT md5(array_to_string(list_sort(s), chr(10))) AS k, min(doc_id) AS node, any_value(s) AS s
  FROM sets WHERE len(s) > 0 GROUP BY 1),
parts AS (SELECT node, len(s) AS n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.node AS x, b.node AS y FROM parts a JOIN parts b ON a.g = b.g AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(node, other) AS (
  SELECT node, node FROM classes
  UNION SELECT r.node, b.y FROM reach r JOIN both_ways b ON b.x = r.other),
component AS (SELECT node, min(other) AS c FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
       coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes k ON len(d.s) > 0 AND k.k = md5(array_to_string(list_sort(d.s), chr(10)))
LEFT JOIN component m ON m.node = k.node"""

# Units as a list; the cuts are list slices.
ORACLE["op11_fill_in_middle"] = """
WITH read AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
parts AS (
  SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
         list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS d FROM read),
cuts AS (
  SELECT *, len(u) AS n, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS a,
         greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
              WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM parts),
cut AS (
  SELECT doc_id, n, form, t, coalesce(array_to_string(u[1:a], ''), '') AS p,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut"""
