"""Independent DuckDB SQL for every registered query that SQL can express.

The adapter views are written as CTEs over the driver's pre-registered
tables; each oracle names the views it needs.  Iterative models (bias
baseline) are unrolled into one CTE per half-step.
"""

from __future__ import annotations

from .base import KEYWORDS, MIN_REVIEWS, TOP_N
from .recsys import BIAS_CONFIG

Q = "chr(39)"

VIEWS: dict[str, str] = {
    "ratings": """
ratings AS (
  SELECT o_custkey AS uid, l_partkey AS iid,
         CAST(1 + (CAST(l_quantity AS INT) % 5) AS DOUBLE) AS stars,
         concat('u', lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(7, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')) AS user_id,
         concat('b', lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(7, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')) AS business_id,
         concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS review_id,
         l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "business": f"""
business AS (
  SELECT concat('b', lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0')) AS business_id, p_name AS name,
         concat('City_', CAST(p_partkey % 5 AS VARCHAR)) AS city,
         CAST(40.0 + (p_partkey % 100) / 200.0 AS DOUBLE) AS latitude,
         CAST(-80.0 + (p_partkey % 70) / 100.0 AS DOUBLE) AS longitude,
         CASE WHEN p_size % 4 = 0 THEN 0 ELSE 1 END AS is_open,
         CAST(COALESCE(r.review_count, 0) AS BIGINT) AS review_count, r.stars AS stars,
         CASE WHEN p_size % 11 = 0 THEN NULL
              ELSE concat(p_type, ', ', split_part(p_name, ' ', 2), ', ', p_brand) END AS categories,
         CASE WHEN p_size % 5 = 0 THEN NULL ELSE concat('u', {Q},
              CASE p_size % 4 WHEN 0 THEN 'loud' WHEN 1 THEN 'quiet' ELSE 'average' END, {Q}) END
           AS attr_NoiseLevel,
         CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'None' END AS attr_GoodForKids,
         CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN 'None' ELSE concat(
              '{{', {Q}, 'romantic', {Q}, ': ', CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END,
              ', u', {Q}, 'casual', {Q}, ': ', CASE WHEN p_partkey % 3 = 0 THEN 'True' ELSE 'False' END,
              '}}') END AS attr_Ambience
  FROM part LEFT JOIN (SELECT iid AS k, COUNT(*) AS review_count, AVG(stars) AS stars
                       FROM ratings GROUP BY iid) r ON p_partkey = r.k)""",
    "reviews": """
reviews AS (
  SELECT d.doc_id AS review_id, d.source AS business_id, d.lang AS lang, d.text AS text,
         CAST(1 + 4 * l.quality AS DOUBLE) AS stars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "users": """
users AS (
  SELECT concat('u', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(7, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')) AS user_id, c_custkey AS uid,
         c_name AS name FROM customer)""",
    "selected": f"""
selected AS (
  SELECT * FROM business
  WHERE COALESCE(list_has_any(string_split(categories, ', '), {KEYWORDS!r}), false)
    AND review_count > {MIN_REVIEWS})""",
    "umap": """
umap AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS uid
  FROM (SELECT DISTINCT user_id FROM ratings))""",
    "imap": """
imap AS (
  SELECT business_id, CAST(row_number() OVER (ORDER BY business_id) - 1 AS BIGINT) AS iid
  FROM selected)""",
    "triples": """
triples AS (
  SELECT umap.uid, imap.iid, r.stars
  FROM ratings r JOIN umap ON r.user_id = umap.user_id JOIN imap ON r.business_id = imap.business_id)""",
    "items": """
items AS (
  SELECT s.*, imap.iid FROM selected s JOIN imap ON s.business_id = imap.business_id)""",
}

# views each view depends on (closure computed below)
DEPS = {
    "business": ["ratings"],
    "selected": ["business"],
    "umap": ["ratings"],
    "imap": ["selected"],
    "triples": ["ratings", "umap", "imap"],
    "items": ["selected", "imap"],
}
ORDER = ["ratings", "business", "reviews", "users", "selected", "umap", "imap", "triples", "items"]


def with_views(names: list[str], extra_ctes: list[str] | None = None, body: str = "") -> str:
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in DEPS.get(n, []):
            add(d)

    for n in names:
        add(n)
    ctes = [VIEWS[n].strip() for n in ORDER if n in need] + [c.strip() for c in (extra_ctes or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


def bias_ctes(n_epochs: int, reg_u: float, reg_i: float, src: str = "triples",
              prefix: str = "") -> tuple[list[str], str, str]:
    """Unrolled bias-baseline CTEs; returns (ctes, final user table, final item table)."""
    p = prefix
    ctes = [f"{p}mu AS (SELECT AVG(stars) AS mu FROM {src})"]
    bu = None
    bi = None
    for e in range(1, n_epochs + 1):
        if bu is None:
            ctes.append(f"""{p}bi{e} AS (
  SELECT t.iid, SUM(t.stars - m.mu) / (CAST({reg_i} AS DOUBLE) + COUNT(*)) AS b_i
  FROM {src} t CROSS JOIN {p}mu m GROUP BY t.iid)""")
        else:
            ctes.append(f"""{p}bi{e} AS (
  SELECT t.iid, SUM(t.stars - m.mu - u.b_u) / (CAST({reg_i} AS DOUBLE) + COUNT(*)) AS b_i
  FROM {src} t JOIN {bu} u ON t.uid = u.uid CROSS JOIN {p}mu m GROUP BY t.iid)""")
        bi = f"{p}bi{e}"
        ctes.append(f"""{p}bu{e} AS (
  SELECT t.uid, SUM(t.stars - m.mu - i.b_i) / (CAST({reg_u} AS DOUBLE) + COUNT(*)) AS b_u
  FROM {src} t JOIN {bi} i ON t.iid = i.iid CROSS JOIN {p}mu m GROUP BY t.uid)""")
        bu = f"{p}bu{e}"
    return ctes, bu, bi


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def _bias_sql(body_fn) -> str:
    c = BIAS_CONFIG
    ctes, bu, bi = bias_ctes(c.n_epochs, c.reg_u, c.reg_i)
    return with_views(["triples", "items"], ctes, body_fn(bu, bi))


ORACLES: dict[str, str] = {}

ORACLES["rating_triples"] = with_views(["triples"], body="SELECT uid, iid, stars FROM triples")
ORACLES["category_filter"] = with_views(["selected"], body=f"""
SELECT business_id, name, categories, review_count, {r6('stars')} AS stars FROM selected""")
ORACLES["user_counts"] = with_views(["triples"], body="""
SELECT uid, COUNT(*) AS n_rated FROM triples GROUP BY uid""")
ORACLES["bias_fit_items"] = _bias_sql(lambda bu, bi: f"SELECT iid, {r6('b_i')} AS b_i FROM {bi}")
ORACLES["bias_fit_users"] = _bias_sql(lambda bu, bi: f"SELECT uid, {r6('b_u')} AS b_u FROM {bu}")
ORACLES["bias_topn"] = _bias_sql(lambda bu, bi: f"""
SELECT u.uid, t.rank, t.iid, it.business_id, it.name, it.categories,
       {r6('greatest(least(m.mu + u.b_u + t.b_i, 5.0), 1.0)')} AS pred,
       round(it.stars, 6) AS avg_stars, it.review_count, c.n_rated
FROM {bu} u
JOIN (SELECT uid, COUNT(*) AS n_rated FROM triples GROUP BY uid) c ON u.uid = c.uid
CROSS JOIN (SELECT iid, b_i, row_number() OVER (ORDER BY round(b_i, 9) DESC, iid) AS rank
            FROM {bi} QUALIFY rank <= {TOP_N}) t
JOIN items it ON it.iid = t.iid
CROSS JOIN mu m""")
