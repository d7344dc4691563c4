"""DuckDB oracles for the model-input features and the bias-baseline evaluations."""

from __future__ import annotations

import itertools

from ..operators.features import DEFAULT_MIN_CATEGORY
from .base import KEYWORDS, TOP_N
from .models import ALS_GRID, GRID_EPOCHS, GRID_REG_I, GRID_REG_U, N_FOLDS
from .oracle import r6, with_views
from .oracle_tables import MD5_INT
from .recsys import BIAS_CONFIG

FRAME_CTES = [
    """frame0 AS (
  SELECT r.user_id, s.business_id, r.stars AS rating, r.review_id, s.stars, s.review_count, s.categories
  FROM ratings r RIGHT JOIN selected s ON r.business_id = s.business_id)""",
    """du AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS uid
  FROM (SELECT DISTINCT user_id FROM frame0 WHERE user_id IS NOT NULL))""",
    """di AS (SELECT business_id, CAST(row_number() OVER (ORDER BY business_id) - 1 AS BIGINT) AS iid
  FROM (SELECT DISTINCT business_id FROM frame0))""",
    """frame AS (
  SELECT f.* EXCLUDE (k, dup), du.uid, di.iid, CASE WHEN f.dup = 1 THEN f.k ELSE f.k || '#' || f.dup END AS row_key
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY user_id, business_id, rating) AS dup
        FROM (SELECT *, COALESCE(review_id, 'b:' || business_id) AS k FROM frame0)) f LEFT JOIN du ON f.user_id = du.user_id JOIN di ON f.business_id = di.business_id)""",
    f"""cvocab AS (
  SELECT category, CAST(row_number() OVER (ORDER BY n DESC, category) AS BIGINT) AS idx, n FROM (
    SELECT category, COUNT(*) AS n FROM (SELECT unnest(string_split(categories, ', ')) AS category FROM frame)
    GROUP BY category)
  WHERE n > {DEFAULT_MIN_CATEGORY} AND category NOT IN ({", ".join(repr(k) for k in KEYWORDS)}))""",
]


def frame_sql(body: str, extra: list[str] | None = None) -> str:
    return with_views(["selected"], FRAME_CTES + (extra or []), body)


ORACLES: dict[str, str] = {}

ORACLES["dnn_frame"] = frame_sql(f"""
SELECT row_key, uid, iid, rating, {r6('stars')} AS stars, review_count, categories FROM frame""")

ORACLES["dense_scaling"] = frame_sql(", ".join([
    "SELECT row_key",
    f"{r6('(stars - MIN(stars) OVER ()) / (MAX(stars) OVER () - MIN(stars) OVER ())')} AS stars_minmax",
    f"{r6('(stars - AVG(stars) OVER ()) / STDDEV_POP(stars) OVER ()')} AS stars_std",
    f"{r6('(review_count - MIN(review_count) OVER ()) / (MAX(review_count) OVER () - MIN(review_count) OVER ())')}"
    " AS review_count_minmax",
    f"{r6('(review_count - AVG(review_count) OVER ()) / STDDEV_POP(review_count) OVER ()')} AS review_count_std",
]) + " FROM frame")

ORACLES["category_vocab"] = frame_sql("SELECT category, idx, n FROM cvocab")

ORACLES["category_sequence"] = frame_sql("""
SELECT i.business_id, g.pos, COALESCE(x.idx, 0) AS idx
FROM items_d i
CROSS JOIN (SELECT CAST(unnest(range(m)) AS BIGINT) AS pos FROM maxlen) g
LEFT JOIN idx x ON x.business_id = i.business_id AND x.pos = g.pos""", [
    "items_d AS (SELECT DISTINCT business_id, categories FROM frame)",
    "maxlen AS (SELECT MAX(COALESCE(len(string_split(categories, ', ')), 0)) AS m FROM frame)",
    """idx AS (
  SELECT x.business_id, CAST(x.pos AS BIGINT) AS pos, COALESCE(v.idx, 0) AS idx FROM (
    SELECT business_id, unnest(range(len(cs))) AS pos, unnest(cs) AS category
    FROM (SELECT business_id, string_split(categories, ', ') AS cs FROM items_d WHERE categories IS NOT NULL)) x
  LEFT JOIN cvocab v ON x.category = v.category)"""])

ORACLES["fm_features"] = frame_sql(f"""
SELECT row_key, CAST(feature AS BIGINT) AS feature, {r6('SUM(value)')} AS value
FROM parts GROUP BY row_key, feature HAVING SUM(value) <> 0""", [
    "nn AS (SELECT MAX(uid) + 1 AS nu, MAX(iid) + 1 AS ni FROM frame)",
    """st AS (SELECT MIN(stars) AS s0, MAX(stars) AS s1, MIN(review_count) AS r0, MAX(review_count) AS r1
  FROM frame)""",
    """cats AS (SELECT x.row_key, v.idx FROM (
  SELECT row_key, unnest(string_split(categories, ', ')) AS category FROM frame) x
  JOIN cvocab v ON x.category = v.category)""",
    """parts AS (
  SELECT row_key, uid AS feature, 1.0 AS value FROM frame WHERE uid IS NOT NULL
  UNION ALL SELECT row_key, iid + nu, 1.0 FROM frame, nn
  UNION ALL SELECT row_key, nu + ni, (stars - s0) / (s1 - s0) FROM frame, nn, st
  UNION ALL SELECT row_key, nu + ni + 1, (review_count - r0) / (r1 - r0) FROM frame, nn, st
  UNION ALL SELECT c.row_key, nu + ni + 2 + c.idx, 1.0 / k.k
  FROM cats c JOIN (SELECT row_key, COUNT(*) AS k FROM cats GROUP BY row_key) k ON c.row_key = k.row_key,
  nn)"""])


_LISTS = """
SELECT uid, LEAST({n}, ni) AS n, CAST(1 AS BIGINT) AS first_rank, LEAST({n}, ni) AS last_rank, LEAST({n}, ni) AS n_items
FROM (SELECT DISTINCT uid FROM {t} WHERE uid IS NOT NULL), (SELECT COUNT(DISTINCT iid) AS ni FROM {t})"""
ORACLES["als_topn_keys"] = with_views(["umap", "imap"], [
    """rated AS (SELECT umap.uid, imap.iid FROM ratings r JOIN umap ON r.user_id = umap.user_id
  JOIN imap ON r.business_id = imap.business_id)"""], _LISTS.format(n=TOP_N, t="rated"))
ORACLES["als_topn_items"] = with_views(["umap", "imap"], [
    """rated AS (SELECT umap.uid, imap.iid FROM ratings r JOIN umap ON r.user_id = umap.user_id
  JOIN imap ON r.business_id = imap.business_id)"""], f"""
SELECT uid, COUNT(*) AS n_rated, (SELECT LEAST({TOP_N}, COUNT(DISTINCT iid)) FROM rated) AS n_decorated
FROM rated GROUP BY uid""")
ORACLES["als_grid_keys"] = with_views(["umap", "imap"], [
    "rated AS (SELECT COUNT(*) AS n FROM ratings r JOIN umap ON r.user_id = umap.user_id JOIN imap ON r.business_id = imap.business_id)"],
    "\nUNION ALL\n".join(
        f"SELECT CAST({rank} AS INTEGER) AS rank, CAST({reg} AS DOUBLE) AS reg_param, 1 AS rmse_in_span, 1 AS n_best, n AS n_ratings FROM rated"
        for rank in ALS_GRID["rank"] for reg in ALS_GRID["regParam"]))
ORACLES["fm_topn_keys"] = frame_sql(_LISTS.format(n=TOP_N, t="frame"))


# ------------------------------------------------------------------ bias evaluation

def track_bias_ctes(n_epochs: int, src: str, prefix: str = "t") -> tuple[list[str], dict[int, tuple[str, str]]]:
    """Unrolled keyed bias fit over ``src (track, uid, iid, stars, reg_u, reg_i)``."""
    p = prefix
    ctes = [f"{p}mu AS (SELECT track, AVG(stars) AS mu FROM {src} GROUP BY track)"]
    snaps: dict[int, tuple[str, str]] = {}
    bu = None
    for e in range(1, n_epochs + 1):
        if bu is None:
            ctes.append(f"""{p}bi{e} AS (
  SELECT s.track, s.iid, SUM(s.stars - m.mu) / (MAX(s.reg_i) + COUNT(*)) AS b_i
  FROM {src} s JOIN {p}mu m ON s.track = m.track GROUP BY s.track, s.iid)""")
        else:
            ctes.append(f"""{p}bi{e} AS (
  SELECT s.track, s.iid, SUM(s.stars - m.mu - u.b_u) / (MAX(s.reg_i) + COUNT(*)) AS b_i
  FROM {src} s JOIN {p}mu m ON s.track = m.track JOIN {bu} u ON s.track = u.track AND s.uid = u.uid
  GROUP BY s.track, s.iid)""")
        ctes.append(f"""{p}bu{e} AS (
  SELECT s.track, s.uid, SUM(s.stars - m.mu - i.b_i) / (MAX(s.reg_u) + COUNT(*)) AS b_u
  FROM {src} s JOIN {p}mu m ON s.track = m.track JOIN {p}bi{e} i ON s.track = i.track AND s.iid = i.iid
  GROUP BY s.track, s.uid)""")
        bu = f"{p}bu{e}"
        snaps[e] = (bu, f"{p}bi{e}")
    return ctes, snaps


def track_rmse_sql(test: str, mu: str, bu: str, bi: str) -> str:
    return f"""
  SELECT x.track, COUNT(*) AS n,
         sqrt(AVG(power(x.stars - greatest(least(m.mu + COALESCE(u.b_u, 0.0) + COALESCE(i.b_i, 0.0), 5.0), 1.0), 2)))
           AS rmse
  FROM {test} x JOIN {mu} m ON x.track = m.track
  LEFT JOIN {bu} u ON x.track = u.track AND x.uid = u.uid
  LEFT JOIN {bi} i ON x.track = i.track AND x.iid = i.iid
  GROUP BY x.track"""


def folds_ctes(configs: list[tuple[float, float]]) -> list[str]:
    n_cfg = len(configs)
    cfg_rows = ", ".join(f"({c}, CAST({ru} AS DOUBLE), CAST({ri} AS DOUBLE))" for c, (ru, ri) in enumerate(configs))
    return [
        f"""kt AS (SELECT umap.uid, imap.iid, r.stars,
  CAST({MD5_INT.format(k='r.review_id')} % {N_FOLDS} AS INTEGER) AS fold
  FROM ratings r JOIN umap ON r.user_id = umap.user_id JOIN imap ON r.business_id = imap.business_id)""",
        f"cfgs AS (SELECT * FROM (VALUES {cfg_rows}) v(cfg, reg_u, reg_i))",
        f"""trk AS (SELECT f.fold * {n_cfg} + c.cfg AS track, f.fold, c.cfg, c.reg_u, c.reg_i
  FROM (SELECT unnest(range({N_FOLDS})) AS fold) f CROSS JOIN cfgs c)""",
        """ftrain AS (SELECT t.track, k.uid, k.iid, k.stars, t.reg_u, t.reg_i
  FROM kt k JOIN trk t ON k.fold <> t.fold)""",
        "ftest AS (SELECT t.track, k.uid, k.iid, k.stars FROM kt k JOIN trk t ON k.fold = t.fold)",
    ]


def _holdout_sql(body: str) -> str:
    from .oracle import bias_ctes
    c = BIAS_CONFIG
    ctes, bu, bi = bias_ctes(c.n_epochs, c.reg_u, c.reg_i, src="htrain")
    pre = [
        f"""kt AS (SELECT r.review_id, umap.uid, imap.iid, r.stars,
  CASE WHEN {MD5_INT.format(k='r.review_id')} % 100 < 80 THEN 'train' ELSE 'test' END AS split
  FROM ratings r JOIN umap ON r.user_id = umap.user_id JOIN imap ON r.business_id = imap.business_id)""",
        "htrain AS (SELECT uid, iid, stars FROM kt WHERE split = 'train')",
    ]
    pred = f"""hpred AS (
  SELECT k.review_id, k.uid, k.iid, k.stars,
         greatest(least(m.mu + COALESCE(u.b_u, 0.0) + COALESCE(i.b_i, 0.0), 5.0), 1.0) AS prediction
  FROM kt k CROSS JOIN mu m LEFT JOIN {bu} u ON k.uid = u.uid LEFT JOIN {bi} i ON k.iid = i.iid
  WHERE k.split = 'test')"""
    return with_views(["umap", "imap"], pre + ctes + [pred], body)


ORACLES["bias_predict"] = _holdout_sql(
    f"SELECT review_id, uid, iid, stars, {r6('prediction')} AS prediction FROM hpred")
ORACLES["bias_rmse"] = _holdout_sql(
    f"SELECT COUNT(*) AS n, {r6('sqrt(AVG(power(stars - prediction, 2)))')} AS rmse FROM hpred")

_cv_ctes, _cv_snaps = track_bias_ctes(BIAS_CONFIG.n_epochs, "ftrain")
_cvb = _cv_snaps[BIAS_CONFIG.n_epochs]
ORACLES["bias_cv"] = with_views(
    ["umap", "imap"], folds_ctes([(BIAS_CONFIG.reg_u, BIAS_CONFIG.reg_i)]) + _cv_ctes
    + [f"cvr AS ({track_rmse_sql('ftest', 'tmu', _cvb[0], _cvb[1])})"],
    f"SELECT t.fold, c.n, {r6('c.rmse')} AS rmse FROM cvr c JOIN trk t ON c.track = t.track")

_grid_cfg = [(float(ru), float(ri)) for ru, ri in itertools.product(GRID_REG_U, GRID_REG_I)]
_g_ctes, _g_snaps = track_bias_ctes(max(GRID_EPOCHS), "ftrain")
_g_eval = "\n  UNION ALL\n".join(
    f"SELECT {e} AS n_epochs, r.* FROM ({track_rmse_sql('ftest', 'tmu', *_g_snaps[e])}) r"
    for e in GRID_EPOCHS)
ORACLES["bias_grid"] = with_views(
    ["umap", "imap"], folds_ctes(_grid_cfg) + _g_ctes + [f"gr AS ({_g_eval})",
                                                          """gm AS (SELECT g.n_epochs, t.reg_u, t.reg_i, AVG(g.rmse) AS rmse
  FROM gr g JOIN trk t ON g.track = t.track GROUP BY g.n_epochs, t.reg_u, t.reg_i)"""],
    f"""SELECT CAST(n_epochs AS INTEGER) AS n_epochs, reg_u, reg_i, {r6('rmse')} AS rmse,
  CAST(row_number() OVER (ORDER BY round(rmse, 9), n_epochs, reg_u, reg_i) = 1 AS INTEGER) AS is_best
FROM gm""")
