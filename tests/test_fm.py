"""Factorisation machine in tables: against row-by-row numpy, its objective, planted data, top-n by brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.operators import fm

CFG = fm.FMConfig(factorSize=2, maxIter=1, regLinear=0.5, regFactor=0.8)


def _data(seed=5, n_users=14, n_items=9, n=120):
    rng = np.random.default_rng(seed)
    rows = [(int(u), int(i), float(r), [float(i % 4) / 4, float(x)]) for u, i, r, x in
            zip(rng.integers(0, n_users, n), rng.integers(0, n_items, n), rng.integers(1, 6, n), rng.random(n))]
    rows += rows[:10]  # repeated rows count twice
    cats = {0: {1: 1.0}, 1: {1: 0.5, 2: 0.5}, 2: {2: 2 / 3, 3: 1 / 3}, 3: {3: 1.0}, 5: {1: 1 / 3, 2: 1 / 3, 3: 1 / 3}, 20: {2: 1.0}}
    return rows, cats, [*range(n_items), 20]      # item 20 has no ratings


def _frames(spark, rows, cats, items):
    return (spark.createDataFrame(rows, "uid long, iid long, rating double, dense array<double>"),
            spark.createDataFrame([(i,) for i in items], "iid long"),
            spark.createDataFrame([(i, c, w) for i, ws in cats.items() for c, w in ws.items()], "iid long, idx long, weight double"))


def _table(df, key, prefix, n):
    return {r[key]: np.array([r[f"{prefix}{j}"] for j in range(n)]) for r in df.collect()}


def _score(u, i, c, x, beta):
    """By the definition, pair by pair."""
    return (beta[0] + beta[1:] @ x + u[0] + i[0] + c[0] + u[1:] @ i[1:] + u[1:] @ c[1:] + i[1:] @ c[1:])


def _pool(cats, theta, i, n):
    return sum((w * theta[c] for c, w in cats.get(i, {}).items()), np.zeros(n))


def _sweep(rows, cats, items, own, theta, beta, cfg):
    """One sweep from explicit design rows: a least-squares problem for each user, item and category."""
    n = cfg.factorSize + 1
    reg = np.diag([cfg.regLinear] + [cfg.regFactor] * cfg.factorSize)
    pool = {i: _pool(cats, theta, i, n) for i in items}
    users = {}
    for u in {r[0] for r in rows}:
        z, t = [], []
        for _, i, y, x in (r for r in rows if r[0] == u):
            z.append(np.r_[1.0, own[i][1:] + pool[i][1:]])
            t.append(y - _score(np.zeros(n), own[i], pool[i], np.array(x), beta))
        z, t = np.array(z), np.array(t)
        users[u] = np.linalg.solve(z.T @ z + reg, z.T @ t)
    new = {}
    for i in items:
        z = np.array([np.r_[1.0, users[r[0]][1:] + pool[i][1:]] for r in rows if r[1] == i]).reshape(-1, n)
        t = np.array([r[2] - _score(users[r[0]], np.zeros(n), pool[i], np.array(r[3]), beta) for r in rows if r[1] == i])
        new[i] = np.linalg.solve(z.T @ z + reg, z.T @ t)
    moved = {}
    for c in theta:
        a, b = reg.copy(), -reg @ theta[c]
        for u, i, y, x in rows:
            w = cats.get(i, {}).get(c)
            if w:
                z = np.r_[1.0, users[u][1:] + new[i][1:]]
                a += w * np.outer(z, z)
                b += w * z * (y - _score(users[u], new[i], pool[i], np.array(x), beta))
        moved[c] = theta[c] + np.linalg.solve(a, b)
    pool = {i: _pool(cats, moved, i, n) for i in items}
    xs = np.array([np.r_[1.0, r[3]] for r in rows])
    left = np.array([r[2] - _score(users[r[0]], new[r[1]], pool[r[1]], np.zeros(2), np.zeros(3)) for r in rows])
    return users, new, moved, np.linalg.lstsq(xs, left, rcond=None)[0]


def _close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], atol=1e-7), (k, a[k], b[k])


def test_fm_sweeps_equal_row_by_row_numpy(spark):
    rows, cats, items = _data()
    r, i, c = _frames(spark, rows, cats, items)
    own = _table(fm._start(i, "iid", "i", CFG), "iid", "i", 3)
    theta = _table(fm._start(c.select("idx").distinct(), "idx", "k", CFG), "idx", "k", 3)
    beta = np.array([np.mean([x[2] for x in rows]), 0.0, 0.0])
    for _ in range(2):
        users, own, theta, beta = _sweep(rows, cats, items, own, theta, beta, CFG)
    m = fm.fit_fm(r, i, c, 2, fm.FMConfig(**{**CFG.__dict__, "maxIter": 2}))
    _close(users, _table(m.users, "uid", "u", 3))
    _close(own, _table(m.items, "iid", "i", 3))
    _close(theta, _table(m.cats, "idx", "k", 3))
    assert np.allclose(beta, m.dense)
    known = spark.createDataFrame([(u, j, [0.5, 0.25]) for u in [*users, 99] for j in [*items, 77]], "uid long, iid long, dense array<double>")
    zero = np.zeros(3)
    for p in fm.predict_fm(m, known).collect():   # unknown ids add nothing
        want = _score(users.get(p.uid, zero), own.get(p.iid, zero), _pool(cats, theta, p.iid, 3), np.array(p.dense), beta)
        assert abs(p.prediction - want) < 1e-7


def test_fm_objective_never_rises(spark):
    rows, cats, items = _data(seed=8)
    r, i, c = _frames(spark, rows, cats, items)
    seen = []
    for sweeps in (1, 2, 4):
        m = fm.fit_fm(r, i, c, 2, fm.FMConfig(**{**CFG.__dict__, "maxIter": sweeps}))
        loss = fm.predict_fm(m, r).agg(F.sum(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0]
        for t in (_table(m.users, "uid", "u", 3), _table(m.items, "iid", "i", 3), _table(m.cats, "idx", "k", 3)):
            loss += sum(CFG.regLinear * v[0] ** 2 + CFG.regFactor * v[1:] @ v[1:] for v in t.values())
        seen.append(loss)
    assert seen[0] > seen[1] > seen[2]


def test_fm_beats_global_mean_on_planted_data(spark):
    from .test_models_scoring import _planted
    df = _planted(spark)
    rows = df.select("uid", "iid", F.col("stars").alias("rating"), F.array((F.col("iid") % 7 / 7.0).cast("double")).alias("dense"), "test")
    items = df.select("iid").distinct()
    cats = items.select("iid", (F.col("iid") % 3 + 1).alias("idx"), F.lit(1.0).alias("weight"))
    train, test = rows.where("NOT test"), rows.where("test")
    m = fm.fit_fm(train, items, cats, 1, fm.FMConfig(regLinear=0.5, regFactor=0.5, maxIter=10))
    mu = train.agg(F.avg("rating")).first()[0]
    rmse, base = fm.predict_fm(m, test).select(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))),
                                               F.sqrt(F.avg(F.pow(F.col("rating") - F.lit(mu), 2)))).first()
    assert rmse < 0.6 * base, (rmse, base)


def test_fm_topn_equals_brute_force(spark):
    rows, cats, items = _data(seed=3)
    r, i, c = _frames(spark, rows, cats, items)
    m = fm.fit_fm(r, i, c, 2, CFG)
    dense = i.withColumn("dense", F.array((F.col("iid") % 4 / 4.0).cast("double"), F.lit(0.5)))
    users = spark.createDataFrame([(u,) for u in [*range(14), 99]], "uid long")
    exclude = r.select("uid", "iid").where("uid < 5").distinct()
    pred = fm.predict_fm(m, users.crossJoin(dense)).collect()  # a fixture's pairs
    hidden = {(x.uid, x.iid) for x in exclude.collect()}
    for ex, skip in ((None, set()), (exclude, hidden)):
        got = {}
        for x in fm.fm_topn(m, dense, users, 3, ex).collect():
            got.setdefault(x.uid, []).append((x.rank, x.iid, round(x.score, 6)))
        for u in [*range(14), 99]:
            want = sorted(((round(p.prediction, 6), p.iid) for p in pred if p.uid == u and (u, p.iid) not in skip), key=lambda t: (-t[0], t[1]))[:3]
            have = sorted(got.get(u, []))
            assert [(k, s) for k, _, s in have] == [(k + 1, pytest.approx(s, abs=2e-6)) for k, (s, _) in enumerate(want)]
            assert len({j for _, j, _ in have}) == len(want)


def test_fm_without_rows_or_categories(spark):
    rows, _, items = _data()
    r, i, _ = _frames(spark, rows, {0: {1: 1.0}}, items)
    none = spark.createDataFrame([], "iid long, idx long, weight double")
    m = fm.fit_fm(r, i, none, 2, CFG)
    assert m.cats.count() == 0 and m.items.where("c0 <> 0 OR c1 <> 0").count() == 0
    empty = fm.fit_fm(r.limit(0), i, none, 2, CFG)
    assert empty.users.count() == 0 and {p.prediction for p in fm.predict_fm(empty, r).collect()} == {0.0}
    with pytest.raises(ValueError):
        fm.fit_fm(r, i, none, 2, fm.FMConfig(regFactor=0.0))


def test_fm_keeps_parameters_off_the_driver():
    """Only the dense weights are fetched: one aggregate row at the start and one a sweep."""
    import inspect
    source = inspect.getsource(fm)
    assert "toArray" not in source and "collect()" not in source and "toPandas" not in source


def test_fm_sweeps_leave_one_set_of_tables_and_bound_their_broadcasts(spark):
    import glob
    from tastebud.operators.common import ITERATED_BYTES, scratch_dir
    place = scratch_dir(spark).removeprefix("file:")
    listed = lambda: {p for n in ("users", "items", "cats", "item-sums") for p in glob.glob(f"{place}/fm-{n}-*")}
    before = listed()
    rows = spark.createDataFrame([(u, i, float((u * i) % 5 + 1), [0.5]) for u in range(6) for i in range(4)],
                                 "uid long, iid long, rating double, dense array<double>")
    cats = spark.createDataFrame([(i, i % 2, 1.0) for i in range(4)], "iid long, idx long, weight double")
    cfg = fm.FMConfig(maxIter=3)
    model = fm.fit_fm(rows, rows.select("iid").distinct(), cats, 1, cfg)
    assert len(listed() - before) == 3 and fm.predict_fm(model, rows).count() == 24
    assert fm._sweep_bytes(cfg) * 2 * cfg.maxIter <= ITERATED_BYTES
