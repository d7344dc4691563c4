"""DuckDB oracles for the text queries."""

from __future__ import annotations

from ..functions.text import PUNCTUATION, default_stopwords
from .oracle import r6, with_views
from .text import (KEYWORDS_PER_ITEM, MAX_VOCAB, SIMILAR_ITEMS, TFIDF_MAX_DF, TFIDF_MAX_FEATURES,
                   TFIDF_MIN_DF)

P_SQL = "'" + PUNCTUATION.replace("'", "''") + "'"
WS_SQL = "'[ \\t\\n\\r\\f\\x0B]+'"
WORDPUNCT_SQL = "'([\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]+)'"
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in default_stopwords()) + "]"


def clean_sql(x: str) -> str:
    return (f"array_to_string(list_filter(regexp_split_to_array(translate(replace({x}, '\\n', ' '), "
            f"{P_SQL}, ''), {WS_SQL}), lambda t: t <> '' AND NOT list_contains({STOP_SQL}, lower(t))), ' ')")


def vec_tokens_sql(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(translate(lower(replace({x}, '\\n', ' ')), {P_SQL}, ''), "
            f"{WS_SQL}), lambda t: t <> '')")


TFIDF_CTES = [
    f"""tok AS (SELECT business_id,
  unnest(regexp_extract_all(lower({clean_sql('text')}), {WORDPUNCT_SQL}, 1)) AS token FROM reviews)""",
    "tf AS (SELECT business_id, token, COUNT(*) AS tf FROM tok GROUP BY business_id, token)",
    "nd AS (SELECT COUNT(DISTINCT business_id) AS n FROM reviews)",
    f"""vocab AS (
  SELECT token, df FROM (SELECT token, COUNT(*) AS df, SUM(tf) AS ctf FROM tf GROUP BY token), nd
  WHERE df >= {TFIDF_MIN_DF} AND df <= {TFIDF_MAX_DF} * n
  ORDER BY ctf DESC, token LIMIT {TFIDF_MAX_FEATURES})""",
    """w AS (SELECT tf.business_id, tf.token, tf.tf * (ln((1.0 + nd.n) / (1.0 + v.df)) + 1.0) AS w
  FROM tf JOIN vocab v ON tf.token = v.token CROSS JOIN nd)""",
    """wt AS (SELECT w.business_id, w.token, w.w / nr.nrm AS tfidf FROM w
  JOIN (SELECT business_id, sqrt(SUM(w * w)) AS nrm FROM w GROUP BY business_id) nr
  ON w.business_id = nr.business_id)""",
]

TRAIN = """train AS (
  SELECT review_id, text FROM (
    SELECT review_id, text, row_number() OVER (ORDER BY review_id) - 1 AS pos, COUNT(*) OVER () AS n
    FROM reviews WHERE stars IS NOT NULL) WHERE pos < CAST(floor(n * 0.8) AS BIGINT))"""

VOCAB_CTES = [
    TRAIN,
    f"vt AS (SELECT unnest({vec_tokens_sql('text')}) AS token FROM train)",
    f"""tvocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS BIGINT) AS idx, n
  FROM (SELECT token, COUNT(*) AS n FROM vt GROUP BY token) QUALIFY idx < {MAX_VOCAB}
  UNION ALL SELECT '' AS token, CAST(0 AS BIGINT) AS idx, CAST(0 AS BIGINT) AS n
  UNION ALL SELECT '[UNK]' AS token, CAST(1 AS BIGINT) AS idx, CAST(0 AS BIGINT) AS n)""",
    f"""lab AS (SELECT review_id, {vec_tokens_sql('text')} AS toks FROM reviews)""",
    """enc AS (SELECT p.review_id, p.pos, COALESCE(v.idx, 1) AS idx
  FROM (SELECT review_id, unnest(range(len(toks))) AS pos, unnest(toks) AS token FROM lab) p
  LEFT JOIN (SELECT token, idx FROM tvocab WHERE idx >= 2) v ON p.token = v.token)""",
    """wvec AS (
  SELECT v.token, v.idx, e.dim, e.value FROM tvocab v JOIN (
    SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(embedding) AS value FROM embeddings) e
  ON v.idx - 2 = e.vec_id WHERE v.idx >= 2
  UNION ALL
  SELECT v.token, v.idx, d.dim, CAST(0.0 AS FLOAT) AS value FROM tvocab v
  CROSS JOIN (SELECT unnest(range(MAX(len(embedding)))) AS dim FROM embeddings) d WHERE v.idx < 2)""",
]

ORACLES: dict[str, str] = {}

ORACLES["clean_text"] = with_views(["reviews"], body=f"SELECT review_id, {clean_sql('text')} AS text FROM reviews")
ORACLES["wordpunct_tokens"] = with_views(["reviews"], body=f"""
SELECT business_id, token, COUNT(*) AS n FROM (
  SELECT business_id, unnest(regexp_extract_all(lower(text), {WORDPUNCT_SQL}, 1)) AS token FROM reviews)
GROUP BY business_id, token""")
ORACLES["item_text"] = with_views(["reviews"], body=f"""
SELECT business_id, CAST(row_number() OVER (PARTITION BY business_id ORDER BY review_id) - 1 AS BIGINT) AS part,
       {clean_sql('text')} AS text FROM reviews""")
ORACLES["tfidf"] = with_views(["reviews"], TFIDF_CTES, f"""
SELECT business_id, token, {r6('tfidf')} AS tfidf FROM wt""")
ORACLES["tfidf_keywords"] = with_views(["reviews"], TFIDF_CTES, f"""
SELECT business_id, rank, token, {r6('tfidf')} AS tfidf FROM (
  SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY round(tfidf, 6) DESC, token) AS rank
  FROM wt) WHERE rank <= {KEYWORDS_PER_ITEM}""")
ORACLES["item_item_topk"] = with_views(["reviews"], TFIDF_CTES + [
    """docs AS (SELECT DISTINCT business_id FROM wt)""",
    """sims AS (
  SELECT a.business_id, b.business_id AS other_business_id,
         COALESCE((SELECT SUM(x.tfidf * y.tfidf) FROM wt x JOIN wt y ON x.token = y.token
                   WHERE x.business_id = a.business_id AND y.business_id = b.business_id), 0.0) AS sim
  FROM docs a JOIN docs b ON a.business_id <> b.business_id)"""], f"""
SELECT business_id, rank, other_business_id, {r6('sim')} AS sim FROM (
  SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY round(sim, 6) DESC, other_business_id) AS rank
  FROM sims) WHERE rank <= {SIMILAR_ITEMS}""")
ORACLES["item_item_cosine"] = with_views(["reviews"], TFIDF_CTES + [
    """docs AS (SELECT DISTINCT business_id FROM wt)""",
    """dots AS (
  SELECT x.business_id AS a, y.business_id AS b, SUM(x.tfidf * y.tfidf) AS s
  FROM wt x JOIN wt y ON x.token = y.token GROUP BY x.business_id, y.business_id)"""], f"""
SELECT a.business_id, b.business_id AS other_business_id, {r6('COALESCE(d.s, 0.0)')} AS sim
FROM docs a CROSS JOIN docs b
LEFT JOIN dots d ON d.a = a.business_id AND d.b = b.business_id""")
ORACLES["text_vocab"] = with_views(["reviews"], VOCAB_CTES, "SELECT token, idx, n FROM tvocab")
ORACLES["text_encode"] = with_views(["reviews"], VOCAB_CTES, "SELECT review_id, pos, idx FROM enc")
ORACLES["text_decode"] = with_views(["reviews"], VOCAB_CTES, """
SELECT e.review_id, string_agg(v.token, ' ' ORDER BY e.pos) AS text
FROM enc e JOIN tvocab v ON e.idx = v.idx GROUP BY e.review_id""")
ORACLES["word_vectors"] = with_views(["reviews"], VOCAB_CTES, f"""
SELECT token, idx, CAST(dim AS BIGINT) AS dim, {r6('value')} AS value FROM wvec""")
ORACLES["doc_vectors"] = with_views(["reviews"], VOCAB_CTES + [
    f"lt AS (SELECT review_id, unnest({vec_tokens_sql('text')}) AS token FROM reviews)",
    "per AS (SELECT review_id, token, COUNT(*) AS c FROM lt GROUP BY review_id, token)",
    "ntok AS (SELECT review_id, SUM(c) AS n FROM per GROUP BY review_id)"], f"""
SELECT p.review_id, CAST(w.dim AS BIGINT) AS dim, {r6('SUM(p.c * CAST(w.value AS DOUBLE)) / MAX(n.n)')} AS value
FROM per p JOIN wvec w ON p.token = w.token AND w.idx >= 2
JOIN ntok n ON n.review_id = p.review_id
GROUP BY p.review_id, w.dim""")
