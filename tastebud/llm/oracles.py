"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op8_embeddings"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::double) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::bigint AS n_links, coalesce(least.component_id, e.vec_id)::bigint AS component_id,
  coalesce(least.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""

ORACLES["op10_substrings"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
place AS (
  SELECT doc_id, list(i) AS pos FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(len(pos), 0)::bigint AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: pos IS NULL OR NOT list_contains(pos, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN place USING (doc_id)
"""

# bytes as pairs of hexadecimal digits
ORACLES["op3_suffix_array"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, x, unnest(range(0, (length(x) // 2 - 49)::bigint)) AS i FROM d)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM win) WHERE doc_id > least),
edge AS (
  SELECT doc_id, i, i + 50 AS stop,
    CASE WHEN i <= max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM later),
span AS (
  SELECT doc_id, min(i) AS a, max(stop) AS b FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM edge) GROUP BY doc_id, g),
piece AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM span),
cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS e,
    string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(x) // 2)::bigint AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed, coalesce(n_spans, 0)::bigint AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLES["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
word AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
size AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (
  SELECT DISTINCT lang, source FROM d),
n AS (
  SELECT lang, source, term, count(*) AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
cell AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(n.c, 0)::hugeint AS c FROM grp JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
share AS (
  SELECT lang, source, term, c, 1 + (1000000000 * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v)::hugeint AS p FROM cell JOIN size USING (lang)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (c + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v)::hugeint AS q
  FROM (SELECT lang, term, sum(c)::hugeint AS c FROM cell GROUP BY lang, term) JOIN size USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::bigint AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
above AS (
  SELECT s.lang, s.source, s.term AS item, (s.p - w.q)::bigint AS value FROM share s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.c > 0 AND s.p > w.q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::int AS rank FROM pair
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::int AS rank FROM above) WHERE rank <= 50
"""


def _rounds(n: int) -> str:
    """``n`` rounds of assigning and averaging, each from the centroids ``c<i - 1>``."""
    out = []
    for i in range(n + 1):
        out.append(f"""
a{i} AS MATERIALIZED (
  SELECT v.r, arg_min(c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint * 8 + c.k) AS k,
    min(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint) AS d FROM v, c{i} c GROUP BY v.r),""")
        if i < n:
            out.append(f"""
s{i} AS MATERIALIZED (
  SELECT k, p, sum(x)::hugeint AS s, count(*) AS n FROM (SELECT a.k, unnest(v.x) AS x, unnest(range(64)) AS p FROM a{i} a JOIN v USING (r)) GROUP BY k, p),
c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT k, list(((s - ((s % n) + n) % n) // n)::bigint ORDER BY p) AS x FROM s{i} GROUP BY k) m USING (k)),""")
    return "".join(out)


ORACLES["op11_centroids"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor(1024 * y::double)::bigint) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::int AS k, x FROM (
    SELECT sha256('3:' || vec_id::varchar) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT 8)),{_rounds(10)}
t AS (
  SELECT k, sum(d)::bigint AS s FROM a10 GROUP BY k)
SELECT v.vec_id, a10.k::int AS cluster, a10.d::bigint AS distance, t.s AS cluster_inertia, (SELECT sum(s) FROM t)::bigint AS inertia,
  sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM a10 JOIN v USING (r) JOIN t USING (k) JOIN c10 USING (k)
"""
