"""Factorisation machine for ratings, fitted by block descent with its parameters in tables.

Fields are user, item and category (mean of the item's categories), plus dense columns::

    y = w0 + <wd, xd> + w_u + w_i + w_c + <v_u, v_i> + <v_u, v_c> + <v_i, v_c>

With all other blocks held, ``y`` is linear in a block's ``[w, v]``, so each block has a
closed form, and a sweep reads the ratings twice:

* users: ``y = a + [1, g] . [w_u, v_u]`` with the item's ``g = v_i + v_c``.  Each user solves a ridge
  system of size ``k + 1`` whose sums are plain aggregates, partial before the shuffle;
* items: ``y = a + [1, v_u] . g_i`` where ``g_i = [w_i + w_c + <v_i, v_c>, v_i + v_c]``.  An item's sums of
  ``[1, v_u]`` (matrix ``M``, right side ``b``) say all about its ratings that items, categories and dense
  weights need: these three blocks are solved from them, without the ratings;
* categories: an item's pooled vector is a mean, so by convexity its loss is at most the mean of the
  losses with one category moved at a time.  Each category takes the minimum of that bound, all at once;
* ``w0`` and ``wd``: one least-squares system of the number of dense columns, the only numbers that
  pass the driver.

No step raises ``sum (y - prediction)^2 + reg_linear |w|^2 + reg_factor |v|^2``.  Every step uses all rows.
Tables of parameters are flat double columns; users or items without ratings have zeros of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocked
from .common import BROADCAST_MAX_BYTES, ITERATED_BYTES, free_shuffles, join_small, materialize, release


@dataclass(frozen=True)
class FMConfig:
    factorSize: int = 4
    maxIter: int = 8         # sweeps
    regLinear: float = 5.0   # of every weight but w0 and the dense ones
    regFactor: float = 5.0
    initStd: float = 0.1     # of item and category factors at the start
    seed: int = 1024


@dataclass
class FMModel:
    cfg: FMConfig
    users: DataFrame    # uid, u0 (weight), u1.. (factors)
    items: DataFrame    # iid, i0.., c0.. (pooled categories), g0.. (both, as a user's factors meet them)
    cats: DataFrame     # idx, k0..
    dense: np.ndarray   # w0, then a weight for each dense column


def _names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{j}" for j in range(n)]


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(n) for b in range(a, n)]


def _moments(z: list[Column], target: Column) -> list[Column]:
    """Sums of ``z z'`` (upper half: ``m<a>_<b>``) and of ``z * target`` (``b<a>``)."""
    return ([F.sum(z[a] * z[b]).alias(f"m{a}_{b}") for a, b in _pairs(len(z))]
            + [F.sum(z[a] * target).alias(f"b{a}") for a in range(len(z))])


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]).astype(np.float64)


def _matrices(batch: pa.RecordBatch, n: int, prefix: str = "m") -> np.ndarray:
    out = np.empty((batch.num_rows, n, n))
    for a, b in _pairs(n):
        out[:, a, b] = out[:, b, a] = batch.column(f"{prefix}{a}_{b}").to_numpy(zero_copy_only=False)
    return out


def _solve(m: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.linalg.solve(m, b[:, :, None])[:, :, 0]


def _times(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.einsum("nab,nb->na", m, x)


def _ridge(cfg: FMConfig) -> np.ndarray:
    return np.diag([cfg.regLinear] + [cfg.regFactor] * cfg.factorSize)


def _map(df: DataFrame, keep: list[str], new: list[str], fn) -> DataFrame:
    """``df``'s columns ``keep`` and double columns ``new``, which ``fn`` gives as an array of a batch's rows."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch)
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(np.ascontiguousarray(made[:, j])) for j in range(len(new))],
                                                 keep + new)
    return df.mapInArrow(run, ", ".join([f"{n} {kinds[n]}" for n in keep] + [f"{n} double" for n in new]))


def _start(keys: DataFrame, key: str, prefix: str, cfg: FMConfig) -> DataFrame:
    """Zero weights and small factors, drawn from a hash of the key."""
    span = cfg.initStd * 2 * np.sqrt(3.0)
    draw = [(F.pmod(F.xxhash64(F.lit(prefix), F.lit(cfg.seed), F.col(key), F.lit(j)), F.lit(1 << 20)) / float(1 << 20) - 0.5) * span
            for j in range(cfg.factorSize)]
    return keys.select(key, *[x.cast("double").alias(n) for x, n in zip([F.lit(0.0), *draw], _names(prefix, cfg.factorSize + 1))])


def _pooled(item_cats: DataFrame, cats: DataFrame, n: int) -> DataFrame:
    """``iid, c0..``: the weighted mean of each item's categories."""
    x = join_small(item_cats, cats, "idx")
    return x.groupBy("iid").agg(*[F.sum(F.col("weight") * F.col(f"k{j}")).alias(f"c{j}") for j in range(n)])


def _with_pooled(items: DataFrame, pooled: DataFrame, n: int) -> DataFrame:
    """Items with their pooled categories (none: zeros) and ``g``."""
    x = items.join(pooled, "iid", "left").na.fill(0.0, _names("c", n))
    cross = sum((F.col(f"i{j}") * F.col(f"c{j}") for j in range(1, n)), F.lit(0.0))
    g = [F.col("i0") + F.col("c0") + cross] + [F.col(f"i{j}") + F.col(f"c{j}") for j in range(1, n)]
    return x.select("*", *[c.alias(f"g{j}") for j, c in enumerate(g)])


def _dense_part(weights: np.ndarray) -> Column:
    return sum((F.col("dense")[j] * F.lit(float(w)) for j, w in enumerate(weights[1:])), F.lit(float(weights[0])))


def _fit_users(rows: DataFrame, items: DataFrame, weights: np.ndarray, cfg: FMConfig) -> DataFrame:
    n = cfg.factorSize + 1
    x = join_small(rows, items.select("iid", *_names("g", n)), "iid", max_bytes=_sweep_bytes(cfg))
    z = [F.lit(1.0)] + [F.col(f"g{j}") for j in range(1, n)]
    sums = x.groupBy("uid").agg(*_moments(z, F.col("rating") - _dense_part(weights) - F.col("g0")))
    ridge = _ridge(cfg)
    return _map(sums, ["uid"], _names("u", n), lambda b: _solve(_matrices(b, n) + ridge, _columns(b, _names("b", n))))


def _sweep_bytes(cfg: FMConfig) -> int:
    """Bytes under which a step broadcasts a parameter table: those of all sweeps stay within ``ITERATED_BYTES``."""
    return min(BROADCAST_MAX_BYTES, ITERATED_BYTES // (2 * max(1, cfg.maxIter)))


def _item_sums(rows: DataFrame, users: DataFrame, items: DataFrame, n: int, n_dense: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Each item's sums over its ratings, beside its parameters: ``m``, ``b`` of ``[1, v_u]`` against
    ``y - w_u``, and of each dense column ``d`` with those (``x<d>_<a>``) and with ``y - w_u`` (``q<d>``).
    Items without ratings have zeros."""
    x = join_small(rows, users, "uid", max_bytes=max_bytes)
    p = [F.lit(1.0)] + [F.col(f"u{j}") for j in range(1, n)]
    target = F.col("rating") - F.col("u0")
    d = [F.col("dense")[j] for j in range(n_dense)]
    sums = x.groupBy("iid").agg(
        *_moments(p, target), *[F.sum(d[j] * p[a]).alias(f"x{j}_{a}") for j in range(n_dense) for a in range(n)],
        *[F.sum(d[j] * target).alias(f"q{j}") for j in range(n_dense)])
    return items.select("iid", *_names("i", n), *_names("c", n)).join(sums, "iid", "left").na.fill(0.0)


def _fit_items(sums: DataFrame, weights: np.ndarray, cfg: FMConfig) -> DataFrame:
    """``sums`` with new item parameters, and the system of the item's pooled categories around
    their present values: matrix ``s<a>_<b>``, right side ``r<a>``."""
    n, ridge = cfg.factorSize + 1, _ridge(cfg)
    xs = [[f"x{j}_{a}" for a in range(n)] for j in range(len(weights) - 1)]

    def fit(batch: pa.RecordBatch) -> np.ndarray:
        m = _matrices(batch, n)
        b = _columns(batch, _names("b", n)) - weights[0] * m[:, 0]
        for w, names in zip(weights[1:], xs):
            b -= w * _columns(batch, names)
        pooled = _columns(batch, _names("c", n))
        t = np.tile(np.eye(n), (batch.num_rows, 1, 1))     # g = t [w_i, v_i] + pooled
        t[:, 0, 1:] = pooled[:, 1:]
        tt = t.transpose(0, 2, 1)
        own = _solve(tt @ m @ t + ridge, _times(tt, b - _times(m, pooled)))
        s = np.tile(np.eye(n), (batch.num_rows, 1, 1))     # g = s pooled + [w_i, v_i]
        s[:, 0, 1:] = own[:, 1:]
        st = s.transpose(0, 2, 1)
        left = _times(st, b - _times(m, _times(s, pooled) + own))
        square = st @ m @ s
        return np.hstack([own, np.column_stack([square[:, a, b] for a, b in _pairs(n)]), left])

    keep = [c for c in sums.columns if c not in _names("i", n) and c not in _names("c", n)]
    return _map(sums, keep, _names("i", n) + [f"s{a}_{b}" for a, b in _pairs(n)] + _names("r", n), fit)


def _fit_cats(items: DataFrame, item_cats: DataFrame, cats: DataFrame, cfg: FMConfig) -> DataFrame:
    n, ridge = cfg.factorSize + 1, _ridge(cfg)
    system = [f"s{a}_{b}" for a, b in _pairs(n)] + _names("r", n)
    x = item_cats.join(items.select("iid", *system), "iid")
    sums = x.groupBy("idx").agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in system])

    def fit(batch: pa.RecordBatch) -> np.ndarray:
        old = _columns(batch, _names("k", n))
        return old + _solve(_matrices(batch, n, "s") + ridge, _columns(batch, _names("r", n)) - old @ ridge)
    return _map(cats.join(sums, "idx", "left").na.fill(0.0), ["idx"], _names("k", n), fit)


def _fit_dense(items: DataFrame, square: np.ndarray, n: int) -> np.ndarray:
    """Weights of the constant and the dense columns, from the items' sums and new ``g``."""
    rest = [F.col("b0") - sum((F.col(f"m0_{a}") * F.col(f"g{a}") for a in range(1, n)), F.col("m0_0") * F.col("g0"))]
    rest += [F.col(f"q{j}") - sum((F.col(f"x{j}_{a}") * F.col(f"g{a}") for a in range(n)), F.lit(0.0)) for j in range(len(square) - 1)]
    right = items.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in rest]).first()
    return np.linalg.lstsq(square, np.array(right, dtype=np.float64), rcond=None)[0]


def fit_fm(rows: DataFrame, items: DataFrame, item_cats: DataFrame, n_dense: int, cfg: FMConfig = FMConfig()) -> FMModel:
    """Fit on ``rows`` ``(uid, iid, rating, dense array<double> of n_dense, ...)`` without nulls.

    ``items`` ``(iid)`` are all items to know, ``item_cats`` ``(iid, idx, weight)`` their categories, the
    weights of an item summing to one.  No rows give zero parameters for users and items."""
    if cfg.regLinear <= 0 or cfg.regFactor <= 0:
        raise ValueError("regLinear and regFactor must be positive: they make every system solvable")
    n = cfg.factorSize + 1
    rows = materialize(rows.select("uid", "iid", F.col("rating").cast("double").alias("rating"), "dense"), "fm-rows")
    item_cats = materialize(item_cats.select("iid", "idx", "weight"), "fm-item-cats")
    cats = materialize(_start(item_cats.select("idx").distinct(), "idx", "k", cfg), "fm-cats")
    side = materialize(_with_pooled(_start(items.select("iid").distinct(), "iid", "i", cfg), _pooled(item_cats, cats, n), n), "fm-items")
    one = [F.lit(1.0)] + [F.col("dense")[j] for j in range(n_dense)]
    first = rows.agg(*[F.coalesce(F.sum(one[a] * one[b]), F.lit(0.0)).alias(f"m{a}_{b}") for a, b in _pairs(n_dense + 1)],
                     F.coalesce(F.avg("rating"), F.lit(0.0)).alias("mean")).first()
    square = np.zeros((n_dense + 1, n_dense + 1))
    for a, b in _pairs(n_dense + 1):
        square[a, b] = square[b, a] = first[f"m{a}_{b}"]
    weights = np.array([first["mean"]] + [0.0] * n_dense)
    users = None
    for _ in range(max(1, cfg.maxIter)):
        old = [t for t in (users, side, cats) if t is not None]
        users = materialize(_fit_users(rows, side, weights, cfg), "fm-users")
        fitted = materialize(_fit_items(_item_sums(rows, users, side, n, n_dense, _sweep_bytes(cfg)), weights, cfg), "fm-item-sums")
        cats = materialize(_fit_cats(fitted, item_cats, cats, cfg), "fm-cats")
        side = materialize(_with_pooled(fitted, _pooled(item_cats, cats, n), n), "fm-items")
        weights = _fit_dense(side, square, n)
        for t in [*old, fitted]:
            release(t)
        free_shuffles(rows.sparkSession)
    return FMModel(cfg, users, side.select("iid", *_names("i", n), *_names("c", n), *_names("g", n)), cats, weights)


def predict_fm(model: FMModel, rows: DataFrame) -> DataFrame:
    """``rows`` ``(uid, iid, dense, ...)`` with ``prediction``; an id that the model doesn't know adds nothing."""
    n = model.cfg.factorSize + 1
    u, g = _names("u", n), _names("g", n)
    x = join_small(join_small(rows, model.users, "uid", "left"), model.items.select("iid", *g), "iid", "left").na.fill(0.0, u + g)
    score = sum((F.col(u[j]) * F.col(g[j]) for j in range(1, n)), _dense_part(model.dense) + F.col("u0") + F.col("g0"))
    return x.select(*rows.columns, score.alias("prediction"))


def fm_topn(model: FMModel, items: DataFrame, users: DataFrame, n: int, exclude: DataFrame | None = None) -> DataFrame:
    """``(uid, rank, iid, score)``: the exact top ``n`` of ``items`` ``(iid, dense)`` for each of ``users`` ``(uid)``.

    A user's order is that of ``[v_u, 1] . [g, g0 + <wd, xd>]``, an inner product; what all items of a
    user share is added to the score only.  ``exclude``: ``(uid, iid)`` pairs never recommended."""
    k = model.cfg.factorSize
    index = F.sequence(F.lit(0), F.lit(k)).cast("array<bigint>")
    everyone = users.join(model.users, "uid", "left").na.fill(0.0, _names("u", k + 1))
    known = items.join(model.items, "iid", "left").na.fill(0.0, _names("g", k + 1))
    own = F.col("g0") + _dense_part(np.r_[0.0, model.dense[1:]])
    targets = known.select(F.array("iid").alias("cids"), index.alias("fidx"), F.array(*_names("g", k + 1)[1:], own).alias("w"))
    queries = everyone.select(F.col("uid").alias("qid"), index.alias("fidx"), F.array(*_names("u", k + 1)[1:], F.lit(1.0)).alias("w"))
    seen = None if exclude is None else exclude.select(F.col("uid").alias("qid"), F.col("iid").alias("cid"))
    top = blocked.blocked_top_n(queries, targets, k + 1, n, exclude=seen)
    return top.join(everyone.select(F.col("uid").alias("qid"), "u0"), "qid").select(
        F.col("qid").alias("uid"), "rank", F.col("cid").alias("iid"), (F.col("score") + F.col("u0") + F.lit(float(model.dense[0]))).alias("score"))
