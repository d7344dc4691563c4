"""DuckDB oracles for the table, ETL, nested-record, literal and split queries."""

from __future__ import annotations

from ..operators.filters import KEYWORD_GROUPS
from .base import KEYWORDS, MIN_REVIEWS
from .oracle import r6, with_views
from .tables import CITY, PROFILE_COLUMNS

IN_CAT = f"COALESCE(list_has_any(string_split(categories, ', '), {KEYWORDS!r}), false)"
MD5_INT = "CAST('0x' || substr(md5({k}), 1, 8) AS UBIGINT)"

ORACLES: dict[str, str] = {}

ORACLES["rating_matrix"] = with_views(["triples"], body=f"""
SELECT uid, iid, {r6('AVG(stars)')} AS rating FROM triples GROUP BY uid, iid""")

ORACLES["matrix_sparsity"] = with_views(["triples"], body=f"""
SELECT n_users, n_items, n_cells,
       {r6('1.0 - n_cells / (n_users * n_items)')} AS sparsity,
       {r6('(1.0 - n_cells / (n_users * n_items)) * 100')} AS sparsity_pct
FROM (SELECT COUNT(DISTINCT uid) AS n_users, COUNT(DISTINCT iid) AS n_items,
             COUNT(*) AS n_cells FROM (SELECT DISTINCT uid, iid FROM triples))""")

ORACLES["category_counts"] = with_views(["business"], body="""
SELECT category, COUNT(*) AS n
FROM (SELECT unnest(string_split(categories, ', ')) AS category FROM business)
GROUP BY category""")

ORACLES["null_profile"] = with_views(["business"], body="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_null, COUNT({c}) AS n_nonnull, "
    f"{r6(f'(COUNT(*) - COUNT({c})) / COUNT(*)')} AS frac_null FROM business"
    for c in PROFILE_COLUMNS))

ORACLES["filter_report"] = with_views(["business"], body=f"""
SELECT COUNT(*) AS n_business, COUNT(*) FILTER (WHERE {IN_CAT}) AS n_category,
       COUNT(*) FILTER (WHERE {IN_CAT} AND review_count > {MIN_REVIEWS}) AS n_selected
FROM business""")

ORACLES["city_filter"] = with_views(["business"], body=f"""
SELECT business_id, name, city, review_count, {r6('stars')} AS stars
FROM business WHERE city = '{CITY}'""")

ORACLES["stars_by_open"] = with_views(["business"], body=f"""
SELECT {r6('floor(stars * 2) / 2')} AS stars_bin, is_open, COUNT(*) AS n,
       {r6('AVG(review_count)')} AS avg_review_count
FROM business GROUP BY 1, 2""")

ORACLES["geo_grid"] = with_views(["business"], body=f"""
SELECT CAST(floor(latitude / CAST(0.05 AS DOUBLE)) AS BIGINT) AS lat_cell,
       CAST(floor(longitude / CAST(0.05 AS DOUBLE)) AS BIGINT) AS lon_cell,
       COUNT(*) AS n, {r6('AVG(stars)')} AS avg_stars
FROM business GROUP BY 1, 2""")

ORACLES["checkin_summary"] = with_views(["business"], [
    """ev AS (SELECT concat('b', lpad(CAST(user_id AS VARCHAR), CAST(greatest(7, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS business_id,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS date FROM events)""",
    """s AS (SELECT business_id, CAST(COUNT(*) AS INTEGER) AS checkin_total,
             MIN(date) AS checkin_first, MAX(date) AS checkin_last FROM ev GROUP BY business_id)"""],
    body="""
SELECT b.business_id, CAST(s.checkin_total AS DOUBLE) AS checkin_total, s.checkin_first, s.checkin_last
FROM s RIGHT JOIN business b ON s.business_id = b.business_id""")

ORACLES["review_semijoin"] = with_views(["selected"], body="""
SELECT review_id, user_id, business_id, stars FROM ratings
WHERE business_id IN (SELECT business_id FROM selected)""")

ORACLES["user_semijoin"] = with_views(["selected", "users"], body="""
SELECT user_id, name FROM users
WHERE user_id IN (SELECT user_id FROM ratings WHERE business_id IN (SELECT business_id FROM selected))""")

ORACLES["id_map"] = with_views(["umap", "imap"], body="""
SELECT 'user' AS kind, user_id AS raw_id, uid AS id FROM umap
UNION ALL SELECT 'item' AS kind, business_id AS raw_id, iid AS id FROM imap""")

ORACLES["string_index"] = with_views(["ratings"], body="""
SELECT 'user' AS kind, user_id AS raw_id,
       CAST(row_number() OVER (ORDER BY COUNT(*) DESC, user_id) - 1 AS BIGINT) AS idx
FROM ratings GROUP BY user_id
UNION ALL
SELECT 'item' AS kind, business_id AS raw_id,
       CAST(row_number() OVER (ORDER BY COUNT(*) DESC, business_id) - 1 AS BIGINT) AS idx
FROM ratings GROUP BY business_id""")

_KEYED = """
FROM ratings r JOIN umap ON r.user_id = umap.user_id JOIN imap ON r.business_id = imap.business_id"""

ORACLES["holdout_split"] = with_views(["umap", "imap"], body=f"""
SELECT r.review_id, umap.uid, imap.iid,
       CASE WHEN {MD5_INT.format(k='r.review_id')} % 100 < 80 THEN 'train' ELSE 'test' END AS split
{_KEYED}""")

ORACLES["fold_assign"] = with_views(["umap", "imap"], body=f"""
SELECT r.review_id, umap.uid, imap.iid,
       CAST({MD5_INT.format(k='r.review_id')} % 5 AS INTEGER) AS fold
{_KEYED}""")

ORACLES["ordered_split"] = with_views(["reviews"], body="""
SELECT review_id, pos,
       CASE WHEN pos < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM (SELECT review_id, CAST(row_number() OVER (ORDER BY review_id) - 1 AS BIGINT) AS pos,
             COUNT(*) OVER () AS n
      FROM reviews WHERE stars IS NOT NULL)""")

_ATTRS = ["NoiseLevel", "GoodForKids", "Ambience"]

ORACLES["json_columns"] = with_views(["business"], body="SELECT DISTINCT column_name FROM (\n" + """
  SELECT 'business_id' AS column_name FROM business WHERE business_id IS NOT NULL
  UNION ALL SELECT 'name' FROM business WHERE name IS NOT NULL
  UNION ALL SELECT 'location.city' FROM business WHERE city IS NOT NULL
  UNION ALL SELECT 'location.latitude' FROM business WHERE latitude IS NOT NULL
  UNION ALL SELECT 'location.longitude' FROM business WHERE longitude IS NOT NULL
  UNION ALL SELECT 'stars' FROM business WHERE stars IS NOT NULL
  UNION ALL SELECT 'review_count' FROM business WHERE review_count IS NOT NULL
  UNION ALL SELECT 'is_open' FROM business WHERE is_open IS NOT NULL
  UNION ALL SELECT 'categories' FROM business WHERE categories IS NOT NULL
""" + "".join(f"  UNION ALL SELECT 'attributes.{a}' FROM business WHERE attr_{a} IS NOT NULL\n"
              for a in _ATTRS) + """
  UNION ALL SELECT unnest(json_keys(props)) FROM events)""")

ORACLES["json_flatten"] = with_views(["business"], body="SELECT " + ",\n  ".join(
    [f"COALESCE(attr_{a}, '') AS \"attributes.{a}\"" for a in _ATTRS] + [
        "business_id",
        "COALESCE(CAST(to_json(string_split(categories, ', ')) AS VARCHAR), '') AS categories",
        "CASE WHEN is_open = 1 THEN 'True' ELSE 'False' END AS is_open",
        "city AS \"location.city\"",
        "CAST(latitude AS VARCHAR) AS \"location.latitude\"",
        "CAST(longitude AS VARCHAR) AS \"location.longitude\"",
        "name",
        "CAST(review_count AS VARCHAR) AS review_count",
        "COALESCE(CAST(round(stars, 2) AS VARCHAR), '') AS stars"]) + "\nFROM business")

ORACLES["json_to_csv"] = ORACLES["json_flatten"]

ORACLES["json_scan"] = with_views(["business"], body=f"""
SELECT business_id, name, city, is_open = 1 AS is_open, review_count, {r6('round(stars, 2)')} AS stars,
       CASE WHEN categories IS NULL THEN NULL ELSE CAST(len(string_split(categories, ', ')) AS DOUBLE) END AS n_categories
FROM business""")

ORACLES["keyword_groups"] = with_views(["business"], body="\nUNION ALL\n".join(
    f"SELECT '{g}' AS group_name, COUNT(*) FILTER (WHERE {hit}) AS n_category, "
    f"COUNT(*) FILTER (WHERE {hit} AND review_count > {MIN_REVIEWS}) AS n_selected FROM business"
    for g, words in sorted((KEYWORD_GROUPS | {"parts": KEYWORDS}).items())
    for hit in [f"COALESCE(list_has_any(string_split(categories, ', '), {list(words)!r}), false)"]))

ORACLES["csv_roundtrip"] = with_views(["business"], body=f"""
SELECT business_id, name, categories, review_count, {r6('stars')} AS stars FROM business""")

_SQ = "''"  # a single quote inside a SQL string literal


def _unquote(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^u?{_SQ}.*{_SQ}$') "
            f"THEN regexp_extract({x}, '^u?{_SQ}(.*){_SQ}$', 1) "
            f"WHEN regexp_matches({x}, '^u?\".*\"$') THEN regexp_extract({x}, '^u?\"(.*)\"$', 1) "
            f"ELSE {x} END")


ORACLES["literal_scalar"] = with_views(["business"], body=f"""
SELECT business_id, {_unquote('attr_NoiseLevel')} AS NoiseLevel,
       {_unquote('attr_GoodForKids')} AS GoodForKids FROM business""")

_PAIR = ("u?(?:\"([^\"]*)\"|{q}([^{q}]*){q})\\s*:\\s*"
         "(?:u?\"([^\"]*)\"|u?{q}([^{q}]*){q}|([A-Za-z0-9_.+-]+))").format(q=_SQ)

ORACLES["literal_dict"] = with_views(["business"], body=f"""
SELECT business_id, CASE WHEN k1 <> '' THEN k1 ELSE k2 END AS key,
       CASE WHEN v5 <> '' THEN v5 WHEN v3 <> '' THEN v3 ELSE v4 END AS value
FROM (SELECT business_id,
             unnest(regexp_extract_all(a, '{_PAIR}', 1)) AS k1,
             unnest(regexp_extract_all(a, '{_PAIR}', 2)) AS k2,
             unnest(regexp_extract_all(a, '{_PAIR}', 3)) AS v3,
             unnest(regexp_extract_all(a, '{_PAIR}', 4)) AS v4,
             unnest(regexp_extract_all(a, '{_PAIR}', 5)) AS v5
      FROM (SELECT business_id, COALESCE(attr_Ambience, '') AS a FROM business))""")

ORACLES["byte_unwrap"] = with_views(["ratings"], body=f"""
SELECT review_id, w AS wrapped_user_id,
       CASE WHEN regexp_matches(w, '^b{_SQ}.*{_SQ}$') THEN regexp_extract(w, '^b{_SQ}(.*){_SQ}$', 1)
            ELSE w END AS user_id,
       CASE WHEN regexp_matches(business_id, '^b{_SQ}.*{_SQ}$')
            THEN regexp_extract(business_id, '^b{_SQ}(.*){_SQ}$', 1) ELSE business_id END AS business_id
FROM (SELECT review_id, concat('b{_SQ}', user_id, '{_SQ}') AS w, business_id FROM ratings)""")
