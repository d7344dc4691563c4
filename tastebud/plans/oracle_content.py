"""DuckDB oracles for the content-based recommender (brute force over all pairs)."""

from __future__ import annotations

from ..operators.content import DEFAULT_MIN_DF
from .base import TOP_N
from .oracle import r6, with_views
from .oracle_tables import _PAIR, _unquote

CONTENT_CTES = [
    f"""oh AS (
  SELECT iid, var || '_' || {_unquote('raw')} AS feature, CAST(1.0 AS DOUBLE) AS value
  FROM (SELECT iid, 'NoiseLevel' AS var, attr_NoiseLevel AS raw FROM items
        UNION ALL SELECT iid, 'GoodForKids' AS var, attr_GoodForKids AS raw FROM items)
  WHERE raw IS NOT NULL)""",
    f"""pairs AS (
  SELECT iid, CASE WHEN k1 <> '' THEN k1 ELSE k2 END AS key, v3, v4, v5
  FROM (SELECT iid,
               unnest(regexp_extract_all(a, '{_PAIR}', 1)) AS k1,
               unnest(regexp_extract_all(a, '{_PAIR}', 2)) AS k2,
               unnest(regexp_extract_all(a, '{_PAIR}', 3)) AS v3,
               unnest(regexp_extract_all(a, '{_PAIR}', 4)) AS v4,
               unnest(regexp_extract_all(a, '{_PAIR}', 5)) AS v5
        FROM (SELECT iid, COALESCE(attr_Ambience, '') AS a FROM items)))""",
    """dictf AS (
  SELECT iid, feature, value FROM (
    SELECT iid,
           CASE WHEN v5 = '' THEN 'Ambience.' || key || '=' || (CASE WHEN v3 <> '' THEN v3 ELSE v4 END)
                ELSE 'Ambience.' || key END AS feature,
           CASE WHEN v5 = '' THEN 1.0 WHEN v5 = 'True' THEN 1.0 WHEN v5 IN ('False', 'None') THEN 0.0
                ELSE TRY_CAST(v5 AS DOUBLE) END AS value
    FROM pairs) WHERE value IS NOT NULL AND value <> 0)""",
    "features AS (SELECT * FROM oh UNION ALL SELECT * FROM dictf)",
    "m AS (SELECT COUNT(*) AS m FROM items)",
    f"""idf AS (
  SELECT feature, SUM(value) AS df, CAST(SUM(value) >= {DEFAULT_MIN_DF} AS INTEGER) AS kept,
         CASE WHEN SUM(value) >= {DEFAULT_MIN_DF} THEN ln(MAX(m.m) / SUM(value)) END AS idf
  FROM features CROSS JOIN m GROUP BY feature)""",
    """kf AS (SELECT f.iid, f.feature, f.value, i.idf FROM features f JOIN idf i ON f.feature = i.feature
  WHERE i.kept = 1)""",
    """prof AS (
  SELECT t.uid, kf.feature, SUM(greatest(t.stars - 2.9, 0.0) * kf.value) * MAX(kf.idf) AS weight
  FROM triples t JOIN kf ON t.iid = kf.iid GROUP BY t.uid, kf.feature
  HAVING SUM(greatest(t.stars - 2.9, 0.0) * kf.value) * MAX(kf.idf) > 0)""",
    "norms AS (SELECT iid, greatest(sqrt(SUM(value * value)), 0.01) AS norm FROM kf GROUP BY iid)",
]

ALLSCORES = [
    """dots AS (SELECT p.uid, kf.iid, SUM(kf.value * p.weight) AS dot
  FROM prof p JOIN kf ON p.feature = kf.feature GROUP BY p.uid, kf.iid)""",
    """allscores AS (
  SELECT u.uid, it.iid, COALESCE(d.dot, 0.0) / COALESCE(n.norm, 0.01) AS score
  FROM (SELECT DISTINCT uid FROM triples) u CROSS JOIN items it
  LEFT JOIN dots d ON d.uid = u.uid AND d.iid = it.iid
  LEFT JOIN norms n ON n.iid = it.iid)""",
    f"""topn AS (
  SELECT uid, iid, score,
         row_number() OVER (PARTITION BY uid ORDER BY round(score, 6) DESC, iid) AS rank
  FROM allscores QUALIFY rank <= {TOP_N})""",
]


def content_sql(body: str, extra: list[str] | None = None) -> str:
    return with_views(["triples", "items"], CONTENT_CTES + (extra or []), body)


ORACLES: dict[str, str] = {}

ORACLES["attr_onehot"] = content_sql("SELECT it.business_id, oh.feature FROM oh JOIN items it USING (iid)")
ORACLES["attr_value_counts"] = with_views(["items"], body=f"""
SELECT variable, {_unquote('raw')} AS value, COUNT(*) AS n
FROM (SELECT 'NoiseLevel' AS variable, attr_NoiseLevel AS raw FROM items
      UNION ALL SELECT 'GoodForKids', attr_GoodForKids FROM items)
WHERE raw IS NOT NULL GROUP BY 1, 2""")
ORACLES["attr_dict_features"] = content_sql(
    "SELECT it.business_id, d.feature, d.value FROM dictf d JOIN items it USING (iid)")
ORACLES["item_features"] = content_sql(
    "SELECT it.business_id, f.feature, f.value FROM features f JOIN items it USING (iid)")
ORACLES["feature_idf"] = content_sql(f"SELECT feature, df, kept, {r6('idf')} AS idf FROM idf")
ORACLES["content_profile"] = content_sql(f"""
SELECT uid, rank, feature, {r6('weight')} AS weight FROM (
  SELECT uid, feature, weight,
         row_number() OVER (PARTITION BY uid ORDER BY round(weight, 6) DESC, feature) AS rank
  FROM prof) WHERE rank <= 5""")
ORACLES["content_score"] = content_sql(f"""
SELECT p.uid, p.iid, {r6('COALESCE(d.dot, 0.0) / COALESCE(n.norm, 0.01)')} AS score
FROM (SELECT DISTINCT uid, iid FROM triples) p
LEFT JOIN (SELECT p2.uid, kf.iid, SUM(kf.value * p2.weight) AS dot
           FROM prof p2 JOIN kf ON p2.feature = kf.feature GROUP BY p2.uid, kf.iid) d
  ON d.uid = p.uid AND d.iid = p.iid
LEFT JOIN norms n ON n.iid = p.iid""")
ORACLES["content_topn"] = content_sql(f"""
SELECT t.uid, t.rank, t.iid, it.business_id, it.name, {r6('t.score')} AS score
FROM topn t JOIN items it ON it.iid = t.iid""", ALLSCORES)
ORACLES["content_topn_explain"] = content_sql("""
SELECT t.uid, t.rank, t.iid, f.feature_rank, f.feature
FROM topn t JOIN (
  SELECT iid, feature,
         row_number() OVER (PARTITION BY iid ORDER BY round(idf, 9) DESC, feature) AS feature_rank
  FROM kf QUALIFY feature_rank <= 3) f ON f.iid = t.iid""", ALLSCORES)
