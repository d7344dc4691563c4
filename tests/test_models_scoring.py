"""Bias baseline, blocked top-n, content scoring, TF-IDF, ALS/FM on planted data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.operators import bias, blocked, common, content, fm, models, text
from tastebud.sources import catalog


def _bias_numpy(rows, n_epochs, reg_u, reg_i):
    users = sorted({u for u, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    mu = sum(r for _, _, r in rows) / len(rows)
    bu = {u: 0.0 for u in users}
    bi = {i: 0.0 for i in items}
    for _ in range(n_epochs):
        for i in items:
            rs = [(u, r) for u, ii, r in rows if ii == i]
            bi[i] = sum(r - mu - bu[u] for u, r in rs) / (reg_i + len(rs))
        for u in users:
            rs = [(i, r) for uu, i, r in rows if uu == u]
            bu[u] = sum(r - mu - bi[i] for i, r in rs) / (reg_u + len(rs))
    return mu, bu, bi


def _random_ratings(n_users=30, n_items=20, n=300, seed=7):
    rnd = random.Random(seed)
    return [(rnd.randrange(n_users), rnd.randrange(n_items), float(rnd.randint(1, 5))) for _ in range(n)]


def test_bias_fit_matches_direct_computation(spark):
    rows = _random_ratings() + [(1, 1, 5.0), (1, 1, 3.0)]     # duplicate pair counts twice
    df = spark.createDataFrame(rows, "uid long, iid long, stars double")
    m = bias.fit_bias(df, bias.BiasConfig(n_epochs=3, reg_u=15, reg_i=10))
    mu, bu, bi = _bias_numpy(rows, 3, 15, 10)
    assert m.mu == pytest.approx(mu)
    got_u = {r.uid: r.b_u for r in m.user_bias.collect()}
    got_i = {r.iid: r.b_i for r in m.item_bias.collect()}
    assert got_u == pytest.approx(bu) and got_i == pytest.approx(bi)
    pred = bias.predict_bias(m, spark.createDataFrame([(1, 1), (999, 1)], "uid long, iid long")).collect()
    p = {r.uid: r.prediction for r in pred}
    assert p[1] == pytest.approx(min(max(mu + bu[1] + bi[1], 1), 5))
    assert p[999] == pytest.approx(min(max(mu + bi[1], 1), 5))   # unknown user -> zero bias


def test_bias_config_rejects_unknown_parameter():
    with pytest.raises(ValueError):
        bias.BiasConfig().with_params(n_epoch=3)
    assert bias.BiasConfig().with_params(reg_u=5).reg_u == 5


def test_fold_fits_equal_separate_fits(spark):
    rows = _random_ratings(seed=3)
    folds = [(u, i, r, (u * 7 + i) % 3) for u, i, r in rows]
    df = spark.createDataFrame(folds, "uid long, iid long, stars double, fold int")
    cfgs = [(15.0, 10.0), (5.0, 5.0)]
    fits = bias.fit_bias_folds(df, "fold", 3, cfgs, 4, snapshots=(2,))
    for e in (2, 4):
        bu, bi = fits.snapshots[e]
        bu = {r.uid: r.bu for r in bu.collect()}
        bi = {r.iid: r.bi for r in bi.collect()}
        for f in range(3):
            train = [(u, i, r) for u, i, r, ff in folds if ff != f]
            for c, (ru, ri) in enumerate(cfgs):
                t = f * len(cfgs) + c
                mu, eu, ei = _bias_numpy(train, e, ru, ri)
                assert fits.mu[t] == pytest.approx(mu)
                for u, v in eu.items():
                    assert bu[u][t] == pytest.approx(v)
                for i, v in ei.items():
                    assert bi[i][t] == pytest.approx(v)


def test_blocked_top_n_matches_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(0)
    nq, nt, nf, n = 40, 57, 6, 4
    Q = rnd.integers(0, 3, (nq, nf)).astype(float)
    T = rnd.integers(0, 2, (nt, nf)).astype(float)          # many exact ties
    monkeypatch.setattr(blocked, "BLOCK_CELLS", 10 * nf)   # several blocks, several rounds
    monkeypatch.setattr(blocked, "FIRST_TRAY", 1000)
    monkeypatch.setattr(blocked, "TRAY", 1500)
    queries = spark.createDataFrame(
        [(q, [j for j in range(nf) if Q[q, j]], [float(Q[q, j]) for j in range(nf) if Q[q, j]])
         for q in range(nq)], "qid long, fidx array<bigint>, w array<double>")
    targets = spark.createDataFrame([([1000 + t], [j for j in range(nf) if T[t, j]], [float(T[t, j]) for j in range(nf) if T[t, j]])
                                     for t in range(nt)], "cids array<bigint>, fidx array<bigint>, w array<double>")
    got = blocked.blocked_top_n(queries, targets, nf, n).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.qid, []).append((r.rank, r.cid))
    S = Q @ T.T
    for q in range(nq):
        want = sorted(range(nt), key=lambda t: (-round(S[q, t], 6), t))[:n]
        assert [c for _, c in sorted(by_q[q])] == [1000 + t for t in want]
    # excluded pairs: each query asks for n + its own excluded count
    ex = {(q, int(t)) for q in range(nq) for t in rnd.choice(nt, rnd.integers(0, 12), replace=False)}
    exdf = spark.createDataFrame([(q, 1000 + t) for q, t in ex], "qid long, cid long")
    got = blocked.blocked_top_n(queries, targets, nf, n, exclude=exdf).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.qid, []).append((r.rank, r.cid))
    for q in range(nq):
        want = sorted((t for t in range(nt) if (q, t) not in ex), key=lambda t: (-round(S[q, t], 6), t))[:n]
        assert [c for _, c in sorted(by_q[q])] == [1000 + t for t in want]


def test_norm_bound_ends_the_search(spark, monkeypatch):
    """Few targets are long: most queries are done after the first blocks, and the lists are those of all pairs."""
    monkeypatch.setattr(blocked, "BLOCK_CELLS", 50 * 8)
    monkeypatch.setattr(blocked, "FIRST_TRAY", 20_000)
    rnd = np.random.default_rng(4)
    nq, nt, n = 60, 2000, 5
    Q = rnd.normal(size=(nq, 8))
    Q[0], Q[1] = 0, -np.abs(Q[1])                       # all scores zero; mostly negative ones
    T = rnd.normal(size=(nt, 8)) * (1 / (1 + np.arange(nt)))[:, None]
    T[7] = T[3]                                          # a tie
    index = list(range(8))
    queries = spark.createDataFrame([(q, index, v.tolist(), n) for q, v in enumerate(Q)], "qid long, fidx array<bigint>, w array<double>, k int")
    targets = spark.createDataFrame([([t, 5000 + t] if t % 100 == 3 else [t], index, v.tolist()) for t, v in enumerate(T)],
                                    "cids array<bigint>, fidx array<bigint>, w array<double>")
    got = {r.qid: r for r in blocked.best_lists(queries, targets, 8).collect()}
    cids = [(t, t) for t in range(nt)] + [(t, 5000 + t) for t in range(3, nt, 100)]
    S = Q @ T.T
    for q in range(nq):
        assert got[q].ids == [c for _, c in sorted(cids, key=lambda x: (-round(S[q, x[0]], 6), x[1]))[:n]]
        assert got[q].scores == pytest.approx([S[q, c % 5000] for c in got[q].ids])
    assert len(got) == nq and sum(r.scored for r in got.values()) < nq * nt / 5
    none = blocked.blocked_top_n(queries, targets.limit(0), 8, n)
    assert none.count() == 0 and blocked.blocked_top_n(queries.limit(0), targets, 8, n).count() == 0


def test_blocked_top_n_by_direction_scores_a_part_of_the_pairs(spark, monkeypatch):
    """20,000 vectors of norm one on planted topics, in several trays: lists as by brute force, under a fifth of all pairs scored."""
    import pandas as pd
    rng, n, nf, k = np.random.default_rng(6), 20_000, 120, 5
    X = np.zeros((n, nf))
    topic = rng.integers(0, 40, n)
    for j in range(3):                                         # a topic's own terms, then some of anything
        X[np.arange(n), topic * 3 + j] = rng.random(n) + 0.5
    for _ in range(3):
        X[np.arange(n), rng.integers(0, nf, n)] += 0.3 * rng.random(n)
    X[n - 3:] = 0.0                                            # empty items
    X[:40] = X[40:80]                                          # ties
    X /= np.maximum(np.sqrt((X * X).sum(axis=1)), 1e-300)[:, None]
    some = [np.flatnonzero(x) for x in X]
    queries = spark.createDataFrame(pd.DataFrame({"qid": np.arange(n), "fidx": [f.tolist() for f in some], "w": [x[f].tolist() for x, f in zip(X, some)]}),
                                    "qid long, fidx array<long>, w array<double>").withColumn("k", F.lit(k))
    targets = queries.select(F.array("qid").alias("cids"), "fidx", "w")
    queries = queries.join(blocked.term_floor(queries, targets, k), "qid")
    monkeypatch.setattr(blocked, "TRAY", 8 << 20)
    got = {r.qid: r for r in blocked.best_lists(queries, targets, nf, exclude_self=True, by="direction").collect()}
    for a in range(0, n, 2000):
        S = np.round(X[a:a + 2000] @ X.T, 6)
        S[np.arange(len(S)), np.arange(a, a + len(S))] = -1.0
        least = -np.partition(-S, k - 1, axis=1)[:, k - 1]
        for q, (row, t) in enumerate(zip(S, least), a):
            c = np.flatnonzero(row >= t)
            want = c[np.lexsort((c, -row[c]))][:k]
            near = [i for i in got[q].ids if i not in want]
            assert not near or all(abs(row[i] - t) < 2e-6 for i in near), (q, got[q].ids, want)
            assert len(set(got[q].ids)) == k and q not in got[q].ids
    full = sum(r.scored for r in got.values())
    assert len(got) == n and full < n * n / 5, full / n / n


@pytest.mark.parametrize("by", ["norm", "direction"])
def test_blocked_top_n_bounds_hold_for_signed_vectors(spark, monkeypatch, by):
    rng = np.random.default_rng(9)
    Q, T = rng.normal(size=(40, 6)), rng.normal(size=(300, 6)) * rng.random((300, 1)) * 3
    monkeypatch.setattr(blocked, "BLOCK_CELLS", 60)
    index = list(range(6))
    queries = spark.createDataFrame([(q, index, v.tolist()) for q, v in enumerate(Q)], "qid long, fidx array<long>, w array<double>")
    targets = spark.createDataFrame([([t], index, v.tolist()) for t, v in enumerate(T)], "cids array<long>, fidx array<long>, w array<double>")
    got = {(r.qid, r["rank"]): r.cid for r in blocked.blocked_top_n(queries, targets, 6, 7, by=by).collect()}
    S = np.round(Q @ T.T, 6)
    assert got == {(q, i + 1): int(c) for q in range(40) for i, c in enumerate(np.lexsort((np.arange(300), -S[q]))[:7])}
    with pytest.raises(ValueError):
        blocked.pack_targets(targets, 6, "size")


def test_content_scores_and_topn(spark):
    items = spark.createDataFrame(
        [(0, {"NoiseLevel": "u'loud'", "Ambience": "{'romantic': True}"}),
         (1, {"NoiseLevel": "u'loud'"}), (2, {"NoiseLevel": "'quiet'"}), (3, {}),
         (4, {"NoiseLevel": "u'loud'", "Ambience": "{'romantic': True}"})],
        "iid long, attributes map<string,string>")
    feats = content.item_features(items)
    idf = content.feature_idf(feats, items=items, min_df=1)
    kf = content.kept_features(feats, idf)
    triples = spark.createDataFrame([(7, 0, 5.0), (7, 2, 4.0), (8, 1, 2.0), (8, 3, 1.0)],
                                    "uid long, iid long, stars double")
    prof = content.user_profiles(triples, kf)
    assert prof.where("uid = 8").count() == 0                   # no positive weight
    pairs = triples.select("uid").distinct().crossJoin(items.select("iid"))
    s = {(r.uid, r.iid): r.score for r in content.scores_for_pairs(pairs, prof, kf).collect()}
    assert s[(7, 3)] == 0.0 and s[(8, 0)] == 0.0                # no features / no profile
    idf_map = {r.feature: r.idf for r in idf.collect()}
    p_loud = idf_map["NoiseLevel_loud"] * 2.1
    p_rom = idf_map["Ambience.romantic"] * 2.1
    p_quiet = idf_map["NoiseLevel_quiet"] * 1.1
    assert s[(7, 0)] == pytest.approx((p_loud + p_rom) / math.sqrt(2))
    assert s[(7, 2)] == pytest.approx(p_quiet)
    top = content.content_topn_all(triples, items, kf, prof, 3).collect()
    t7 = [r.iid for r in sorted((r for r in top if r.uid == 7), key=lambda r: r.rank)]
    want = sorted(range(5), key=lambda i: (-round(s[(7, i)], 6), i))[:3]
    assert t7 == want
    t8 = [r.iid for r in sorted((r for r in top if r.uid == 8), key=lambda r: r.rank)]
    assert t8 == [0, 1, 2]                                      # all zero -> lowest iids
    unseen = content.content_topn_all(triples, items, kf, prof, 3, exclude_seen=True).collect()
    u7 = [r.iid for r in sorted((r for r in unseen if r.uid == 7), key=lambda r: r.rank)]
    assert u7 == sorted((i for i in range(5) if i not in (0, 2)), key=lambda i: (-round(s[(7, i)], 6), i))[:3]
    u8 = [r.iid for r in sorted((r for r in unseen if r.uid == 8), key=lambda r: r.rank)]
    assert u8 == [0, 2, 4]
    one = spark.createDataFrame([(7,)], "uid long")             # one user's top-n
    sub = content.content_topn_all(triples, items, kf, prof, 3, users=one).collect()
    assert sorted((r.uid, r.rank, r.iid) for r in sub) == sorted(
        (r.uid, r.rank, r.iid) for r in top if r.uid == 7)


def test_tfidf_hand_computed(spark):
    tf = spark.createDataFrame([("d1", "a", 2), ("d1", "b", 1), ("d2", "a", 1), ("d2", "c", 3)],
                               "business_id string, token string, tf long")
    w, vocab = text.tfidf(tf, "business_id", 2, max_features=None, max_df=1.0, min_df=1)
    got = {(r.business_id, r.token): r.tfidf for r in w.collect()}
    idf_a, idf_1 = math.log(3 / 3) + 1, math.log(3 / 2) + 1
    d1 = [2 * idf_a, 1 * idf_1]
    n1 = math.sqrt(sum(x * x for x in d1))
    assert got[("d1", "a")] == pytest.approx(d1[0] / n1)
    assert got[("d1", "b")] == pytest.approx(d1[1] / n1)
    # max_df as a fraction drops "a" (in every document)
    w2, v2 = text.tfidf(tf, "business_id", 2, max_features=None, max_df=0.8, min_df=1)
    assert sorted(r.token for r in v2.collect()) == ["b", "c"]
    # max_features keeps the largest corpus counts, ties by token
    _, v3 = text.tfidf(tf, "business_id", 2, max_features=2, max_df=1.0, min_df=1)
    assert sorted(r.token for r in v3.collect()) == ["a", "c"]


def _planted(spark, n_users=60, n_items=40, rank=2, seed=11):
    rnd = np.random.default_rng(seed)
    U = rnd.normal(0, 1, (n_users, rank))
    V = rnd.normal(0, 1, (n_items, rank))
    bu = rnd.normal(0, 0.7, n_users)   # planted user and item offsets
    bi = rnd.normal(0, 0.7, n_items)
    rows = []
    for u in range(n_users):
        for i in rnd.choice(n_items, 25, replace=False):
            r = 3 + bu[u] + bi[i] + U[u] @ V[i] + rnd.normal(0, 0.2)
            rows.append((u, int(i), float(np.clip(r, 1, 5)), f"r{u}-{i}"))
    df = spark.createDataFrame(rows, "uid long, iid long, stars double, review_id string")
    return df.withColumn("test", F.md5("review_id").substr(1, 1).isin("0", "1", "2"))


def test_als_and_bias_beat_global_mean_on_planted_data(spark):
    df = _planted(spark)
    train, test = df.where("NOT test"), df.where("test")
    mu = train.agg(F.avg("stars")).first()[0]
    base = test.select(F.sqrt(F.avg(F.pow(F.col("stars") - mu, 2)))).first()[0]
    m = models.fit_als(train, models.ALSConfig(rank=4, maxIter=10, regParam=0.05))
    p = m.transform(test.select(F.col("uid").cast("int").alias("uid"), F.col("iid").cast("int").alias("iid"),
                                "stars"))
    als_rmse = p.select(F.sqrt(F.avg(F.pow(F.col("stars") - F.col("prediction"), 2)))).first()[0]
    b = bias.fit_bias(train, bias.BiasConfig(n_epochs=5))
    bp = bias.predict_bias(b, test)
    bias_rmse = bp.select(F.sqrt(F.avg(F.pow(F.col("stars") - F.col("prediction"), 2)))).first()[0]
    assert als_rmse < base and bias_rmse <= base
    top = models.als_topn(m, 3).collect()
    assert len(top) == 3 * train.select("uid").distinct().count()
    sub = models.als_topn(m, 3, users=spark.createDataFrame([(0,), (5,)], "uid long")).collect()
    assert sorted((r.uid, r.rank, r.iid) for r in sub) == sorted(
        (r.uid, r.rank, r.iid) for r in top if r.uid in (0, 5))


def test_deepfm_beats_global_mean_on_planted_data(spark):
    from tastebud.operators import deepfm
    df = _planted(spark)
    rows = df.select(F.col("review_id").alias("row_key"), "uid", "iid", F.col("stars").alias("rating"),
                     F.array(F.lit(0.5), (F.col("iid") % 7 / 7.0).cast("double")).alias("dense"), "test")
    train, test = rows.where("NOT test"), rows.where("test")
    items = df.select("iid").distinct()
    # two known categories per item
    item_cats = items.select("iid", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos")).select(
        "iid", F.col("pos").cast("long").alias("pos"), (F.col("iid") % 3 + 1 + F.col("pos") * 3).alias("idx"))
    mu = train.agg(F.avg("rating")).first()[0]
    for deep in (True, False):        # DeepFM, and the distributed FM alone
        cfg = deepfm.DeepFMConfig(learning_rate=0.02, epochs=12, partitions=2, hidden=(16, 16),
                                  batch_size=64, deep=deep)
        m = deepfm.fit_deepfm(train, df.select("uid").distinct(), items, item_cats, 6, cfg)
        assert len(m.dense) == len(deepfm.init_dense(cfg, 0.0))
        p = deepfm.predict_deepfm(m, test)
        assert p.count() == test.count()
        rmse, base = p.select(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))),
                              F.sqrt(F.avg(F.pow(F.col("rating") - F.lit(mu), 2)))).first()
        assert rmse < 0.9 * base, (deep, rmse, base)


@pytest.mark.parametrize("deep", [True, False])
def test_deepfm_gradients_match_finite_differences(deep):
    from tastebud.operators import deepfm as D
    cfg = D.DeepFMConfig(embedding=3, hidden=(5, 4), n_dense=2, deep=deep)
    rnd = np.random.default_rng(0)
    dense = D.init_dense(cfg, 3.0) + rnd.normal(0, 0.1, len(D.init_dense(cfg, 3.0)))
    B, k = 6, cfg.embedding
    eu, ei, ec = (rnd.normal(0, 0.5, (B, k)) for _ in range(3))
    xd, wsum, y = rnd.normal(0, 1, (B, 2)), rnd.normal(0, 0.1, B), rnd.normal(3, 1, B)

    def loss(vec, eu_=eu):
        pred, _ = D._forward(D._unpack(vec, cfg), eu_, ei, ec, wsum, xd, cfg)
        return ((pred - y) ** 2).sum()

    P = D._unpack(dense, cfg)
    pred, cache = D._forward(P, eu, ei, ec, wsum, xd, cfg)
    G, de_u, _, _ = D._backward(P, 2 * (pred - y), eu, ei, ec, xd, cache, cfg)
    g = np.concatenate([G[n].ravel() for n, _ in D._dense_shapes(cfg)])
    for j in rnd.choice(len(dense), min(25, len(dense)), replace=False):
        e = np.zeros_like(dense)
        e[j] = 1e-6
        assert abs((loss(dense + e) - loss(dense - e)) / 2e-6 - g[j]) < 1e-4 * max(1, abs(g[j]))
    e = np.zeros_like(eu)
    e[2, 1] = 1e-6
    num = (loss(dense, eu + e) - loss(dense, eu - e)) / 2e-6
    assert abs(num - de_u[2, 1]) < 1e-4 * max(1, abs(num))


def test_deepfm_hot_user_is_split_over_tasks(spark):
    """A user with most of the rows is salted over several training tasks;
    other users stay whole; every row is still predicted exactly once."""
    from tastebud.operators import deepfm
    rows = spark.range(0, 2000).select(
        F.col("id").cast("string").alias("row_key"),
        F.when(F.col("id") < 1500, F.lit(0)).otherwise(F.col("id") % 50).cast("long").alias("uid"),
        (F.col("id") % 20).alias("iid"), (F.lit(1) + F.col("id") % 5).cast("double").alias("rating"),
        F.array(F.lit(0.1), F.lit(0.2)).alias("dense"))
    s = deepfm.salted_rows(rows, 4, 7)
    salts = {r.uid: r.k for r in s.groupBy("uid").agg(F.countDistinct("salt").alias("k")).collect()}
    assert salts[0] == 4 and all(v == 1 for u, v in salts.items() if u != 0)  # ceil(1510 / 500)
    tasks = (s.repartition(4, "uid", "salt").where("uid = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert tasks >= 2
    cfg = deepfm.DeepFMConfig(epochs=1, partitions=4, hidden=(8,))
    m = deepfm.fit_deepfm(rows, rows.select("uid").distinct(), rows.select("iid").distinct(),
                          spark.createDataFrame([], "iid long, pos long, idx long"), 0, cfg)
    p = deepfm.predict_deepfm(m, rows)
    assert p.count() == 2000 and p.select("row_key").distinct().count() == 2000
    assert m.users.where("uid = 0").count() == 1


def test_update_config_validates_and_routes_prefixes():
    import warnings
    from tastebud.operators import deepfm
    from tastebud.operators.common import update_config
    a = update_config(models.ALSConfig(), {"rank": 8, "regParam": 0.05})
    assert (a.rank, a.regParam, models.ALSConfig().rank) == (8, 0.05, 20)
    with pytest.raises(ValueError):
        update_config(models.ALSConfig(), {"rnk": 8})
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        f = update_config(fm.FMConfig(), {"factorSize": 6, "nope": 1}, strict=False)
    assert f.factorSize == 6 and len(w) == 1
    mixed = {"deepfm__epochs": 3, "deepfm__hidden": (64,), "fm__factorSize": 2}
    d = update_config(deepfm.DeepFMConfig(), mixed, prefix="deepfm")
    assert (d.epochs, d.hidden, d.embedding) == (3, (64,), 4)
    assert update_config(fm.FMConfig(), mixed, prefix="fm").factorSize == 2


def test_bias_top_items_unseen_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(int(u), int(i), float(rnd.integers(1, 6))) for u in range(30)
            for i in rnd.choice(25, rnd.integers(1, 20), replace=False)]
    t = spark.createDataFrame(rows, "uid long, iid long, stars double")
    m = bias.fit_bias(t, bias.BiasConfig(n_epochs=3))
    bi = {r.iid: r.b_i for r in m.item_bias.collect()}
    got = {}
    for r in bias.top_items_unseen(m, 4, t).collect():
        got.setdefault(r.uid, []).append((r.rank, r.iid))
    for u in range(30):
        seen = {i for uu, i, _ in rows if uu == u}
        want = sorted((i for i in bi if i not in seen), key=lambda i: (-round(bi[i], 9), i))[:4]
        assert [i for _, i in sorted(got.get(u, []))] == want


def test_item_item_cosine_symmetric_unit_diagonal_and_topk_consistent(spark):
    docs = spark.createDataFrame(
        [("a", "x y z"), ("a", "x x"), ("b", "y z w"), ("c", "q r"), ("d", "x w")],
        "business_id string, text string")
    tf = docs.select("business_id", F.explode(F.split("text", " ")).alias("token")).groupBy(
        "business_id", "token").agg(F.count(F.lit(1)).alias("tf"))
    w, v = text.tfidf(tf, "business_id", 4, max_features=None, max_df=1.0, min_df=1)
    m = {(r.business_id, r.other_business_id): r.sim for r in text.item_item_cosine(w, v).collect()}
    assert len(m) == 16
    for (a, b), s in m.items():
        assert s == pytest.approx(m[(b, a)], abs=1e-12)
        if a == b:
            assert s == pytest.approx(1.0)
    assert m[("a", "c")] == 0.0                     # no shared term, still reported
    top = text.item_item_topk(w, v, k=2).collect()
    for r in top:
        others = sorted(((-round(s, 6), o) for (a, o), s in m.items() if a == r.business_id and o != a))
        assert r.other_business_id == others[r.rank - 1][1]


def test_deepfm_streaming_is_independent_of_arrow_batch_size(spark):
    """Rows stream through the task in Arrow batches; mini-batches carry over
    batch boundaries, so the fit does not depend on the Arrow batch size."""
    from tastebud.operators import deepfm
    df = _planted(spark, n_users=30, n_items=30)
    rows = df.select(F.col("review_id").alias("row_key"), "uid", "iid", F.col("stars").alias("rating"),
                     F.array(F.lit(0.5), (F.col("iid") % 7 / 7.0).cast("double")).alias("dense"))
    items = df.select("iid").distinct()
    item_cats = items.select("iid", F.lit(0).cast("long").alias("pos"), (F.col("iid") % 3 + 1).alias("idx"))
    cfg = deepfm.DeepFMConfig(epochs=2, partitions=2, hidden=(8,), batch_size=64)

    def fit():
        m = deepfm.fit_deepfm(rows, df.select("uid").distinct(), items, item_cats, 3, cfg)
        return m.dense, {r.uid: r.vec for r in m.users.collect()}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    d1, u1 = fit()
    spark.conf.set(key, "97")
    try:
        d2, u2 = fit()
    finally:
        spark.conf.set(key, old)
    assert np.allclose(d1, d2, atol=1e-10)
    assert u1.keys() == u2.keys() and all(np.allclose(u1[k], u2[k], atol=1e-10) for k in u1)


def test_als_grid_picks_the_planted_rank(spark):
    """Ratings of two planted factors: rank 2 beats rank 1 and a strong penalty, over the given folds."""
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = [(i, j, float(3 + u[i] @ v[j]), int(rng.integers(3))) for i in range(60) for j in range(40) if rng.random() < 0.6]
    t = spark.createDataFrame(rows, "uid long, iid long, stars double, f int").withColumn("stars", F.col("stars") - 3)
    model, scores = models.als_grid(t, "f", 3, {"rank": (1, 2), "regParam": (0.01, 2.0)}, models.ALSConfig(maxIter=8))
    assert [(c.rank, c.regParam) for c, _ in scores] == [(1, 0.01), (1, 2.0), (2, 0.01), (2, 2.0)]
    best, rmse = min(scores, key=lambda s: s[1])
    assert (best.rank, best.regParam) == (2, 0.01) and rmse < 0.2
    assert model.rank == 2
    with pytest.raises(ValueError):
        models.als_grid(t, "f", 3, {"depth": (1,)})


def test_bias_folds_keep_no_table_but_the_snapshots(spark, monkeypatch):
    """Tables of an epoch that nothing reads again are deleted; broadcasts of all steps have one bound."""
    import glob
    monkeypatch.setattr(bias, "ITERATED_BYTES", 4 * 100)
    rows = spark.createDataFrame([(u, i, float((u * i) % 5 + 1), (u + i) % 2) for u in range(12) for i in range(6)],
                                 "uid long, iid long, stars double, fold int")
    place = common.scratch_dir(spark)
    before = set(glob.glob(f"{place.removeprefix('file:')}/bias-f[iu]-*"))
    fits = bias.fit_bias_folds(rows, "fold", 2, [(15.0, 10.0)], 4, (2,))
    assert len(set(glob.glob(f"{place.removeprefix('file:')}/bias-f[iu]-*")) - before) == 4
    assert set(fits.snapshots) == {2, 4} and fits.snapshots[2][0].count() == 12
    assert bias._step_bytes(2) == 100 and bias._step_bytes(0) == 200
    model = bias.fit_bias(rows.where("fold = 0"), bias.BiasConfig(n_epochs=4))
    assert model.user_bias.join(fits.snapshots[4][0], "uid").where("abs(b_u - bu[1]) > 1e-12").count() == 0


def test_ratings_are_joined_once(spark, tmp_path):
    from tastebud.plans import base, tables
    n = spark.range(400)
    n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    n.select((F.col("id") % 410).alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"), (F.col("id") % 9).cast("double").alias("l_quantity"),
             F.lit(1).alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(6).select(F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name"), F.lit("x").alias("p_brand"), F.lit("PROMO").alias("p_type"),
                          F.col("id").cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    b = base.build(spark, str(tmp_path))
    assert "Join" not in b.rating_rows._jdf.queryExecution().optimizedPlan().toString()
    assert b.rating_rows.count() == 400 and b.rating_rows.exceptAll(catalog.ratings(spark, str(tmp_path))).isEmpty()
    t = tables._keyed_triples(spark, str(tmp_path))
    assert "Join" not in t._jdf.queryExecution().optimizedPlan().toString()
    assert t.count() == 320  # part 0 has no category


def test_scores_below_a_full_list_are_not_sorted(monkeypatch):
    rng = np.random.default_rng(3)
    rows, first, second = np.arange(4), rng.normal(size=(4, 50)), rng.normal(size=(4, 60))
    second[2, 2:4] = first[2].max()  # ties go to the smaller id
    lists = blocked._Lists(np.full(4, 3), np.full(4, -np.inf), np.zeros(0, int), np.zeros(0), np.zeros(0, int))
    lists.offer(rows, first, np.arange(50, 100), None)
    lists.cut()
    monkeypatch.setattr(np, "partition", None)  # would sort all scores of the block
    lists.offer(rows, np.where(second > 1.2, second, -5.0), np.arange(60), np.array([0, 1, 2, 3]))
    lists.cut()
    for q in rows:
        key = np.round(np.append(first[q], np.where(second[q] > 1.2, second[q], -5.0)), 6)
        cid = np.append(np.arange(50, 100), np.arange(60))
        key[50 + q] = -np.inf  # its own id
        assert list(lists.cid[lists.row == q]) == list(cid[np.lexsort((cid, -key))[:3]])


def test_deepfm_epochs_move_packed_parts_and_equal_plain_adam(spark, monkeypatch):
    """An epoch joins nothing and leaves no table; its result equals Adam written out over dicts."""
    import glob
    from tastebud.operators import deepfm as D
    rnd = np.random.default_rng(4)
    data = [(f"r{j}", int(rnd.choice([0, 0, 0, *range(1, 9)])), int(rnd.integers(7)), float(rnd.integers(1, 6)), rnd.random(2).tolist())
            for j in range(150)]
    rows = spark.createDataFrame(data, "row_key string, uid long, iid long, rating double, dense array<double>")
    users, items = spark.range(10).toDF("uid"), spark.range(9).toDF("iid")
    cats = {i: [1 + i % 3, 4, 4][:i % 4] for i in range(9)}           # none, or one twice
    item_cats = spark.createDataFrame([(i, p, c) for i, cs in cats.items() for p, c in enumerate(cs)], "iid long, pos long, idx long")
    cfg = D.DeepFMConfig(epochs=3, partitions=3, hidden=(5,), batch_size=16, learning_rate=0.05, l2_reg=0.01)
    plans, write = [], D.materialize

    def seen(df, name="t"):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name)
    monkeypatch.setattr(D, "materialize", seen)
    monkeypatch.setattr(D, "CHUNK_BATCHES", 2)
    m = D.fit_deepfm(rows, users, items, item_cats, 4, cfg)
    epochs = [p for name, p in plans if name == "deepfm-upd"]
    assert len(epochs) == 3 and not any("Join" in p or "Generate" in p for p in epochs)
    scratch = common.scratch_dir(spark).removeprefix("file:")
    assert not glob.glob(f"{scratch}/deepfm-upd-*") and not glob.glob(f"{scratch}/deepfm-packed-*")

    start = {b: {r.k: np.array(r.vec) for r in D.init_sparse(t, "k", b, cfg).collect()}
             for b, t in (("u", users.toDF("k")), ("i", items.toDF("k")), ("c", spark.range(1, 5).toDF("k")))}
    dense, now = D.init_dense(cfg, float(np.mean([r[3] for r in data]))), start
    parts = {}
    salted = D.salted_rows(rows, 3, cfg.seed).withColumn("p", F.expr("pmod(hash(uid, salt), 3)"))
    for r in salted.orderBy("h").collect():
        parts.setdefault(r.p, []).append(r)
    assert len(parts) > 1

    def step(state, key, P, g):
        mom, v, t = state.get(key, (0.0, 0.0, 0))
        mom, v, t = 0.9 * mom + 0.1 * g, 0.999 * v + 0.001 * g * g, t + 1
        state[key] = mom, v, t
        return P - cfg.learning_rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * mom / (np.sqrt(v) + 1e-7)
    for _ in range(cfg.epochs):
        copies, denses = {}, []
        for own in parts.values():
            d, T, state = dense.copy(), {b: dict(t) for b, t in now.items()}, {}
            for s in range(0, len(own), 16):
                bt = own[s:s + 16]
                u, i = (np.stack([T[b][r[c]] for r in bt]) for b, c in (("u", "uid"), ("i", "iid")))
                c = np.stack([sum((T["c"][x] for x in cats[r.iid]), np.zeros(5)) / max(len(cats[r.iid]), 1) for r in bt])
                xd, y = np.array([r.dense for r in bt]), np.array([r.rating for r in bt])
                P = D._unpack(d, cfg)
                pred, cache = D._forward(P, u[:, 1:], i[:, 1:], c[:, 1:], u[:, 0] + i[:, 0] + c[:, 0], xd, cfg)
                g = 2 * (pred - y) / len(bt)
                G, du, di, dc = D._backward(P, g, u[:, 1:], i[:, 1:], c[:, 1:], xd, cache, cfg)
                gd = np.concatenate([G[n].ravel() for n, _ in D._dense_shapes(cfg)])
                gd[1:3] += 2 * cfg.l2_reg * d[1:3]
                grads = {}
                for k, r in enumerate(bt):
                    for b, idx, x, n in [("u", r.uid, du, 1), ("i", r.iid, di, 1), *(("c", x, dc, len(cats[r.iid])) for x in cats[r.iid])]:
                        grads.setdefault((b, idx), []).append(np.r_[g[k], x[k]] / n)
                d = step(state, "dense", d, gd)
                for (b, idx), gs in grads.items():
                    T[b][idx] = step(state, (b, idx), T[b][idx], sum(gs) + 2 * cfg.l2_reg * T[b][idx])
                    copies.setdefault((b, idx), {}).setdefault(id(own), [0, None])[0] += len(gs)
            for (b, idx), of in copies.items():
                if id(own) in of:
                    of[id(own)][1] = T[b][idx]
            denses.append((len(own), d))
        dense = sum(n * d for n, d in denses) / 150
        now = {b: dict(t) for b, t in now.items()}
        for (b, idx), of in copies.items():
            now[b][idx] = sum(n * x for n, x in of.values()) / sum(n for n, _ in of.values())
    assert np.allclose(m.dense, dense, atol=1e-9)
    for b, t in (("u", m.users), ("i", m.items), ("c", m.cats)):
        got = {r[0]: r[1] for r in t.collect()}
        assert got.keys() == now[b].keys() and all(np.allclose(got[k], now[b][k], atol=1e-9) for k in got)


def test_bias_folds_by_chunks_with_spread_users(spark, monkeypatch):
    """Users of many ratings lie over several chunks; pairs that repeat, ratings without stars and keys that only such have."""
    monkeypatch.setattr(bias, "CHUNKS", 3)
    monkeypatch.setattr(bias, "CHUNK_ROWS", 60)
    monkeypatch.setattr(bias, "SPREAD_ROWS", 20)
    monkeypatch.setattr(bias, "TRACKS", 4)  # two passes
    rows = _random_ratings(seed=5) + [(2, i % 20, float(1 + i % 5)) for i in range(150)]
    folds = [(u, i, r, (u * 3 + i * 5) % 2) for u, i, r in rows]
    df = spark.createDataFrame(folds + [(2, 3, None, 0), (77, 88, None, 1)], "uid long, iid long, stars double, fold int")
    cfgs = [(15.0, 10.0), (5.0, 5.0), (10.0, 15.0)]
    dealt = bias._deal(df, 2, 452, 31, 21)
    assert dealt.spread == [2] and dealt.chunks.count() == 8
    fits = bias.fit_bias_folds(df, "fold", 2, cfgs, 3, snapshots=(1,))
    for e in (1, 3):
        bu, bi = ({x[0]: x[1] for x in t.collect()} for t in fits.snapshots[e])
        assert bu[77] == [None] * 3 + [0.0] * 3 and bi[88] == [None] * 3 + [0.0] * 3 and len(bu) == 31  # of fold 1: counts as zero where held out
        for f in range(2):
            n = [(u, i) for u, i, _, ff in folds + [(2, 3, None, 0), (77, 88, None, 1)] if ff != f]
            train = [(u, i, r) for u, i, r, ff in folds if ff != f]
            mu = sum(r for _, _, r in train) / len(n)
            for c, (ru, ri) in enumerate(cfgs):
                t, eu, ei = f * 3 + c, dict.fromkeys(range(31), 0.0), dict.fromkeys(range(21), 0.0)
                for _ in range(e):
                    ei = {i: sum(r - mu - eu[u] for u, ii, r in train if ii == i) / (ri + sum(ii == i for _, ii in n)) for i in range(20)}
                    eu = {u: sum(r - mu - ei[i] for uu, i, r in train if uu == u) / (ru + sum(uu == u for uu, _ in n)) for u in range(30)}
                assert fits.mu[t] == pytest.approx(mu)
                assert {u: bu[u][t] for u in eu} == pytest.approx(eu) and {i: bi[i][t] for i in ei} == pytest.approx(ei)
    got = {(r.epoch, r.fold, r.cfg): (r.n, r.rmse) for r in bias.fold_rmse(df, "fold", fits, (1, 3)).collect()}
    assert len(got) == 12
    for f in range(2):
        e = [(r - min(max(fits.mu[f * 3 + 1] + bu[u][f * 3 + 1] + bi[i][f * 3 + 1], 1), 5)) ** 2 for u, i, r, ff in folds if ff == f]
        assert got[3, f, 1] == (len(e) + 1, pytest.approx((sum(e) / len(e)) ** 0.5))


def test_als_grid_keeps_the_shuffles_of_one_iteration(spark, monkeypatch):
    """Factors are written in each iteration, with which MLlib deletes its shuffles; those of a fit that is done are freed."""
    freed, intervals = [], []

    class Validator(models.CrossValidator):
        def __init__(self, **kw):
            intervals.append(kw["estimator"].getCheckpointInterval())
            super().__init__(**kw)

    monkeypatch.setattr(models, "CrossValidator", Validator)
    monkeypatch.setattr(models, "free_shuffles", freed.append, raising=False)
    t = spark.createDataFrame([(u, i, float((u * i) % 5), (u + i) % 2) for u in range(8) for i in range(6)], "uid long, iid long, stars double, f int")
    _, scores = models.als_grid(t, "f", 2, {"rank": (1, 2)}, models.ALSConfig(maxIter=2))
    assert intervals == [1] and len(freed) == 4 and len(scores) == 2


def test_single_precision_finds_tiles_and_exact_scores_rank(spark, monkeypatch):
    """Scores that single precision can't tell apart are ranked exactly; a tile without a score for any list is passed over."""
    monkeypatch.setattr(blocked, "TILE_TARGETS", 16)
    monkeypatch.setattr(blocked, "TILE_QUERIES", 4)
    rng, n, nf = np.random.default_rng(8), 200, 5
    T = 50 + 1e-6 * rng.integers(0, 40, (n, nf))             # float32 steps by 4e-6 there
    T[n - 1], Q = 1e16, 1 + 1e-3 * rng.random((9, nf))
    T[n - 1, 0] = -1e17                                       # beyond what single precision is used for
    index = list(range(nf))
    queries = spark.createDataFrame([(q, index, v.tolist()) for q, v in enumerate(Q)], "qid long, fidx array<long>, w array<double>")
    for part in (T[:n - 1], T):
        targets = spark.createDataFrame([([2 * t, 2 * t + 1] if t % 50 == 0 else [2 * t], index, v.tolist()) for t, v in enumerate(part)],
                                        "cids array<long>, fidx array<long>, w array<double>")
        cids = [(t, c) for t in range(len(part)) for c in ([2 * t, 2 * t + 1] if t % 50 == 0 else [2 * t])]
        S = Q @ part.T
        got = {(r.qid, r["rank"]): r.score for r in blocked.blocked_top_n(queries, targets, nf, 6).collect()}
        for q in range(9):
            want = sorted((S[q, t] for t, _ in cids), reverse=True)[:6]
            assert [got[q, k + 1] for k in range(6)] == pytest.approx(want, abs=1e-6)
    V = rng.normal(size=(64, nf))
    block = blocked._Block(float(np.sqrt((V * V).sum(axis=1)).max()), 64, V.tobytes(), np.arange(64, dtype=np.int32).tobytes(), np.arange(64).tobytes())
    score = Q @ V.T
    third = np.sort(score, axis=1)[:, -3]
    lists = blocked._Lists(np.full(9, 3), third, np.zeros(0, int), np.zeros(0), np.zeros(0, int))
    seen = np.zeros(score.shape, bool)
    for rows, a, b in blocked._candidates(block, Q, Q.astype(np.float32), np.arange(9), np.full(9, 1e-4), lists):
        seen[rows, a:b] = True
    assert seen[score >= third[:, None]].all() and not seen.all()
