"""Bias baseline ``r ~ mu + b_u + b_i`` fitted by alternating least squares.

Per epoch, items first:
``b_i = sum_{u in R(i)} (r - mu - b_u) / (reg_i + |R(i)|)``, then
``b_u = sum_{i in R(u)} (r - mu - b_i) / (reg_u + |R(u)|)``.

Each half-step is one join of the ratings with a bias table plus one
partially-aggregated group-by, so a hot user or item costs one pre-aggregated
row per map task, never a task holding its whole group.  Bias tables are
written to the checkpoint folder after each half-step (lineage cut, real size
statistics for the planner's size-checked broadcast).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip_rating
from .common import BROADCAST_MAX_BYTES, ITERATED_BYTES, free_shuffles, join_small, materialize, release


@dataclass(frozen=True)
class BiasConfig:
    n_epochs: int = 10
    reg_u: float = 15.0
    reg_i: float = 10.0

    def with_params(self, **kw) -> "BiasConfig":
        unknown = set(kw) - set(self.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown bias parameters: {sorted(unknown)}")
        return replace(self, **kw)


@dataclass
class BiasModel:
    mu: float
    user_bias: DataFrame   # (uid, b_u)
    item_bias: DataFrame   # (iid, b_i)
    config: BiasConfig


def _step_bytes(n_epochs: int) -> int:
    """Bytes under which a half-step broadcasts its bias table: all of a fit's stay within ``ITERATED_BYTES``."""
    return min(BROADCAST_MAX_BYTES, ITERATED_BYTES // (2 * max(1, n_epochs)))


def _half_step(r: DataFrame, other: DataFrame | None, other_key: str, other_col: str,
               key: str, out: str, mu: float, reg: float, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    x = r if other is None else join_small(r, other, other_key, max_bytes=max_bytes)
    resid = F.col("stars") - F.lit(mu)
    if other is not None:
        resid = resid - F.col(other_col)
    agg = x.groupBy(key).agg(F.sum(resid).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return agg.select(key, (F.col("_s") / (F.lit(float(reg)) + F.col("_n"))).alias(out))


def fit_bias(triples: DataFrame, config: BiasConfig = BiasConfig(),
             user: str = "uid", item: str = "iid") -> BiasModel:
    """Fit the bias baseline on ``(uid, iid, stars)``; duplicate pairs count separately."""
    r = materialize(triples.select(F.col(user).alias("uid"), F.col(item).alias("iid"),
                                   F.col("stars").cast("double").alias("stars")), "bias-ratings")
    mu = r.agg(F.avg("stars")).first()[0]
    most = _step_bytes(config.n_epochs)
    bu = None
    bi = None
    for _ in range(config.n_epochs):
        old = [t for t in (bi, bu) if t is not None]
        bi = materialize(_half_step(r, bu, "uid", "b_u", "iid", "b_i", mu, config.reg_i, most), "bias-i")
        bu = materialize(_half_step(r, bi, "iid", "b_i", "uid", "b_u", mu, config.reg_u, most), "bias-u")
        for t in old:
            release(t)
    if bi is None:  # zero epochs: all biases zero
        bi = r.select("iid").distinct().withColumn("b_i", F.lit(0.0))
        bu = r.select("uid").distinct().withColumn("b_u", F.lit(0.0))
    return BiasModel(mu, bu, bi, config)


def predict_bias(model: BiasModel, pairs: DataFrame, clip: bool = True) -> DataFrame:
    """``pairs`` + ``prediction``; unknown users/items contribute a zero bias."""
    p = (pairs.join(model.user_bias, "uid", "left").join(model.item_bias, "iid", "left")
         .withColumn("_raw", F.lit(model.mu) + F.coalesce("b_u", F.lit(0.0))
                     + F.coalesce("b_i", F.lit(0.0))))
    pred = clip_rating("_raw") if clip else F.col("_raw")
    return p.withColumn("prediction", pred).drop("_raw", "b_u", "b_i")


def top_items_by_bias(model: BiasModel, n: int) -> DataFrame:
    """The n best items for *every* user: ``mu + b_u`` is constant per user, so
    the item order is global.  Ranked on the unclipped score (b_i desc,
    rounded to 9 places so engines agree on near-ties), then iid."""
    ranked = model.item_bias.orderBy(F.round("b_i", 9).desc(), F.col("iid").asc()).limit(n)
    from pyspark.sql import Window
    w = Window.orderBy(F.round("b_i", 9).desc(), F.col("iid").asc())
    # n rows only: the window runs over the limited set
    return ranked.withColumn("rank", F.row_number().over(w))


def top_items_unseen(model: BiasModel, n: int, seen: DataFrame,
                     users: DataFrame | None = None) -> DataFrame:
    """``(uid, rank, iid, b_i)``: each user's n best items among those it has
    not rated (``seen``: ``(uid, iid)`` pairs).

    Items are ranked once by a distributed ordered index (no single-task
    sort); a user with s seen items needs only ranks ``1 .. n + s``, so it
    expands just those ranks, joins them to the ranked items (broadcast only
    below a checked row count), drops its seen pairs and keeps the first n:
    O(users * n + rated pairs) rows, exact."""
    from .ids import ordered_index
    seen = seen.select("uid", "iid").distinct()
    users = (users if users is not None else model.user_bias).select("uid")
    per_user = seen.groupBy("uid").agg(F.count(F.lit(1)).alias("_s"))
    max_seen = int(per_user.agg(F.max("_s")).first()[0] or 0)
    ranked = ordered_index(model.item_bias.select("iid", "b_i"),
                           [F.round("b_i", 9).desc(), F.col("iid").asc()], "_pos")
    ranked = ranked.where(F.col("_pos") < n + max_seen).select(
        (F.col("_pos") + 1).alias("_r"), "iid", "b_i")
    want = users.join(per_user, "uid", "left").select(
        "uid", F.explode(F.sequence(F.lit(1), F.lit(n) + F.coalesce("_s", F.lit(0)).cast("int"))).alias("_r"))
    cand = join_small(want, ranked, "_r").join(seen, ["uid", "iid"], "left_anti")
    from .common import top_n_per_group
    return top_n_per_group(cand, "uid", [F.col("_r").asc()], n).select("uid", "rank", "iid", "b_i")


# ------------------------------------------------------------ folds x configs, all tracks at once

@dataclass
class FoldFits:
    """Bias models of every (held-out fold f, config c) track ``t = f * C + c``.

    ``snapshots[epoch] = (user_bias (uid, bu array[T]), item_bias (iid, bi array[T]))``;
    ``mu`` is the list of per-track global means."""
    k: int
    configs: list
    mu: list
    snapshots: dict


#: Tracks that one pass over the ratings carries.
TRACKS = 60
# Bounds on a chunk of ratings, which one task holds with a vector of all tracks for each of its users or items: rows, keys of a side.
CHUNK_ROWS, CHUNK_KEYS = 1 << 21, 1 << 19
# Chunks of a table that one would hold.  An item's vector goes to each chunk that rates it, so more of them move more bytes.
CHUNKS = 6
# Rows from which a user may be spread over all chunks, if it also has an eighth of a chunk.
SPREAD_ROWS = 1 << 14


def _track_step(r: DataFrame, other: DataFrame, other_key: str, other_rows: int, key: str, k: int,
                mu: list, regs: list, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``(key, b0 .. bT-1)``: one half-step of every track, for the few keys that are spread over chunks.

    A rating counts for the tracks that don't hold its fold out.  Residuals of all tracks are
    plain sums of columns, partial before the shuffle, so a key with a third of all ratings sends one
    row a task."""
    n_cfg = len(mu) // k
    x = join_small(r, other.withColumnsRenamed({f"b{t}": f"o{t}" for t in range(len(mu))}), other_key, rows=other_rows, max_bytes=max_bytes)

    def bias(t: int) -> str:
        f = t // n_cfg
        return f"sum(if(fold = {f}, 0D, stars - {float(mu[t])!r}D - o{t})) / ({float(regs[t])!r}D + sum(if(fold = {f}, 0, 1))) AS b{t}"

    return x.groupBy(key).agg(*[F.expr(bias(t)) for t in range(len(mu))])


@dataclass
class _Dealt:
    """Ratings as the fits read them: by chunk, a user whole in one unless it is spread."""
    chunks: DataFrame   # a row each: chunk, then arrays as bytes: uids, iids, and of its ratings u, i (places in those), stars, fold
    items: DataFrame    # iid, chunks that rate it, n0.. (ratings outside of fold f), h0.. (of them and of the fold: what a sum takes)
    spread: list        # users over several chunks, sorted
    spread_rows: DataFrame | None
    n_items: int


def _pack(rows: pa.Table) -> pa.Table:
    """A chunk's ratings as arrays; no stars: nan, no fold: -1."""
    fold = rows.column("fold").fill_null(-1).to_numpy().astype(np.int32)
    stars = rows.column("stars").to_numpy(zero_copy_only=False).astype(np.float64)
    uids, u = np.unique(rows.column("uid").to_numpy(), return_inverse=True)
    iids, i = np.unique(rows.column("iid").to_numpy(), return_inverse=True)
    blobs = [uids, iids, u.astype(np.int32), i.astype(np.int32), stars, fold]
    return pa.table({"chunk": pa.array(rows.column("chunk").slice(0, 1).to_numpy()),
                     **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("uids", "iids", "u", "i", "stars", "fold"), blobs)}})


def _deal(r: DataFrame, k: int, n: int, n_users: int, n_items: int) -> _Dealt:
    parts = max(CHUNKS, -(-n // (CHUNK_ROWS if n_items <= CHUNK_KEYS else CHUNK_KEYS)), -(-n_users // CHUNK_KEYS))
    heavy = max(SPREAD_ROWS, n // (8 * parts))  # so at most 8 a chunk
    spread = sorted(x["uid"] for x in r.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).where(f"n > {heavy}").select("uid").collect())
    place = F.when(F.col("uid").isin(spread), F.xxhash64("uid", "iid", "stars", "fold")).otherwise(F.xxhash64("uid")) if spread else F.xxhash64("uid")
    dealt = materialize(r.withColumn("chunk", F.pmod(place, F.lit(parts)).cast("int")), "bias-dealt")
    chunks = materialize(dealt.groupBy("chunk").applyInArrow(
        _pack, "chunk int, uids binary, iids binary, u binary, i binary, stars binary, fold binary"), "bias-chunks")
    out = [F.expr(f"coalesce(fold = {f}, false)") for f in range(k)]
    items = materialize(dealt.groupBy("iid").agg(
        F.collect_set("chunk").alias("chunks"), *[F.count_if(~x).alias(f"n{f}") for f, x in enumerate(out)],
        *[F.count_if(x | F.col("stars").isNotNull()).alias(f"h{f}") for f, x in enumerate(out)]), "bias-items")
    rows = materialize(dealt.where(F.col("uid").isin(spread)).drop("chunk"), "bias-spread") if spread else None
    release(dealt)
    return _Dealt(chunks, items, spread, rows, n_items)


def _chunk_step(k: int, mu: list, reg_u: list, spread: list, spread_bias: list | None, to: str):
    """Of a chunk and its items' biases (none yet: those of its users are zero): ``to`` "users", its users' biases, or "items",
    the sums over its ratings that its users' biases leave to each item.  Users that are spread have theirs given."""
    n_cfg, n = len(mu) // k, len(mu)

    def run(own: pa.Table, items: pa.Table | None) -> pa.Table:
        arrays = {c: np.frombuffer(own.column(c)[0].as_py(), t) for c, t in
                  (("uids", np.int64), ("iids", np.int64), ("u", np.int32), ("i", np.int32), ("stars", np.float64), ("fold", np.int32))}
        uids, iids, u, i, stars, fold = arrays.values()
        place = None if items is None else np.searchsorted(iids, items.column("iid").to_numpy())
        at = np.searchsorted(uids, spread)
        given = np.flatnonzero((at < len(uids)) & (uids[np.minimum(at, len(uids) - 1)] == spread)) if len(spread) else np.zeros(0, np.int64)
        known, made = ~np.isnan(stars), []
        for f in range(k):
            sums = known & (fold != f)
            su, si, left = u[sums], i[sums], stars[sums] - mu[f * n_cfg]
            count = np.bincount(u, fold != f, len(uids))
            none = np.bincount(u, known | (fold == f), len(uids)) == 0
            for t in range(f * n_cfg, (f + 1) * n_cfg):
                if items is not None:
                    bi = np.zeros(len(iids))
                    bi[place] = items.column(f"b{t}").to_numpy()
                    bu = np.bincount(su, left - bi[si], len(uids)) / (reg_u[t] + count)
                    bu[at[given]] = [spread_bias[g][t] for g in given]
                if to == "users":
                    bu[none] = np.nan
                    made.append(bu)
                else:
                    made.append(np.bincount(si, left - (0.0 if items is None else bu[su]), len(iids)))
        if to == "items":
            return pa.table({"iid": iids, **{f"s{t}": made[t] for t in range(n)}})
        whole = np.ones(len(uids), bool)
        whole[at[given]] = False
        return pa.table({"uid": uids[whole], **{f"b{t}": pa.array(made[t][whole], from_pandas=True) for t in range(n)}})

    return run


def _fit_tracks(dealt: _Dealt, k: int, configs: list, n_epochs: int, snapshots: tuple, fold_mu: list) -> dict:
    """``epoch -> (user table, item table)`` of the configs' tracks, a column each.

    A chunk keeps its users: it turns its items' biases into those of its users and these into sums for its items, so
    an epoch moves a vector for each chunk and item there and back, and nothing that grows with ratings."""
    mu = [fold_mu[f] for f in range(k) for _ in configs]
    reg_u, reg_i = ([float(c[j]) for _ in range(k) for c in configs] for j in (0, 1))
    spark, tracks, most = dealt.chunks.sparkSession, range(len(mu)), _step_bytes(n_epochs)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = "iid long, " + ", ".join(f"s{t} double" for t in tracks)
    biases = ", ".join(f"b{t} double" for t in tracks)

    def to_items(parts: DataFrame) -> DataFrame:
        whole = parts.repartition(tasks, "iid").groupBy("iid").agg(*[F.sum(f"s{t}").alias(f"s{t}") for t in tracks])
        new = [F.expr(f"if(h{t // len(configs)} > 0, s{t} / ({reg_i[t]!r}D + n{t // len(configs)}), null) AS b{t}") for t in tracks]
        return materialize(whole.join(dealt.items, "iid").select("iid", "chunks", *new), "bias-fi")

    out = {}
    first = _chunk_step(k, mu, reg_u, [], None, "items")
    bi = to_items(dealt.chunks.groupBy("chunk").applyInArrow(lambda own: first(own, None), sums)) if n_epochs else None
    for e in range(1, n_epochs + 1):
        given = None
        if dealt.spread:
            rows = {x["uid"]: [x[f"b{t}"] if x[f"b{t}"] is not None else float("nan") for t in tracks] for x in
                    _track_step(dealt.spread_rows, bi, "iid", dealt.n_items, "uid", k, mu, reg_u, most).collect()}
            given = [rows[x] for x in dealt.spread]
        met = dealt.chunks.groupBy("chunk").cogroup(bi.withColumn("chunk", F.explode("chunks")).drop("chunks").groupBy("chunk"))
        kept = e in snapshots or e == n_epochs
        if kept:
            bu = met.applyInArrow(_chunk_step(k, mu, reg_u, dealt.spread, given, "users"), f"uid long, {biases}")
            if dealt.spread:
                bu = bu.unionByName(spark.createDataFrame([(x, *[None if v != v else v for v in b]) for x, b in zip(dealt.spread, given)], bu.schema))
            out[e] = (materialize(bu, "bias-fu"), bi)
        if e < n_epochs:
            new = to_items(met.applyInArrow(_chunk_step(k, mu, reg_u, dealt.spread, given, "items"), sums))
            if not kept:
                release(bi)
            bi = new
        free_shuffles(spark)  # wide rows: an epoch's files at most lie about
    return out


def fit_bias_folds(triples: DataFrame, fold: str, k: int, configs: list[tuple[float, float]],
                   n_epochs: int, snapshots: tuple[int, ...] = ()) -> FoldFits:
    """Fit the bias baseline for every (held-out fold, (reg_u, reg_i)) pair at once, on ``(uid long, iid long, stars)``.

    Ratings are packed once into chunks of users.  They are never replicated per track, nor moved in an epoch but as
    packed bytes: each chunk takes its items' vectors, a value for each track, and gives back sums
    (:func:`_fit_tracks`).  A user with many ratings is spread over all chunks and summed apart.
    Grids of more than ``TRACKS`` tracks go in several passes.  ``n_epochs`` is shared;
    ``snapshots`` keeps the tables after the listed epochs.  A rating without user or item only counts in the means.
    """
    n_cfg = len(configs)
    r = materialize(triples.select(F.col("uid").cast("long").alias("uid"), F.col("iid").cast("long").alias("iid"),
                                   F.col("stars").cast("double").alias("stars"), F.col(fold).cast("int").alias("fold")), "bias-ratings")
    g = r.agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("s"), F.count_distinct("uid").alias("users"), F.count_distinct("iid").alias("items"),
              *[F.count(F.when(F.col("fold") == f, 1)).alias(f"n{f}") for f in range(k)],
              *[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col("stars"))), F.lit(0.0)).alias(f"s{f}") for f in range(k)]).first()
    rest = [g["n"] - g[f"n{f}"] for f in range(k)]
    fold_mu = [(g["s"] - g[f"s{f}"]) / n if n else 0.0 for f, n in enumerate(rest)]
    dealt = _deal(r.where("uid IS NOT NULL AND iid IS NOT NULL"), k, g["n"], g["users"], g["items"])
    release(r)
    free_shuffles(r.sparkSession)
    step = max(1, TRACKS // k)
    parts = [(a, len(configs[a:a + step]), _fit_tracks(dealt, k, configs[a:a + step], n_epochs, tuple(snapshots), fold_mu))
             for a in range(0, n_cfg, step)]
    snaps = {}
    for e in parts[0][2] if parts else ():
        both = []
        for side, (key, out) in enumerate((("uid", "bu"), ("iid", "bi"))):
            table, columns = None, [None] * (k * n_cfg)
            for a, n, fit in parts:
                names = {f * n + c: f * n_cfg + a + c for f in range(k) for c in range(n)}  # its track -> track of all
                own = fit[e][side].select(key, *[F.col(f"b{t}").alias(f"t{all_t}") for t, all_t in names.items()])
                table = own if table is None else table.join(own, key)
                for all_t in names.values():
                    columns[all_t] = F.col(f"t{all_t}")
            both.append(table.select(key, F.array(*columns).alias(out)))
        snaps[e] = tuple(both)
    mu = [fold_mu[t // n_cfg] for t in range(k * n_cfg)]
    return FoldFits(k, list(configs), mu, snaps)


def fold_rmse(test: DataFrame, fold: str, fits: FoldFits, epochs: list[int] | tuple[int, ...]) -> DataFrame:
    """``(epoch, fold, cfg, n, rmse)``: clipped-prediction RMSE of each track on its
    held-out fold after each of ``epochs`` (snapshots of the fits).

    A snapshot at a time: each test row meets its user's row and keeps the biases of the C configs of
    its own fold alone, so it stays narrow until it meets its item's (no row replication); one
    aggregation by fold, then the small (fold x C) result is unpivoted."""
    n_cfg, spark = len(fits.configs), test.sparkSession
    rows = materialize(test.select("uid", "iid", "stars", F.col(fold).cast("int").alias("fold")), "bias-test")
    mu_a = F.array(*[F.lit(float(m)) for m in fits.mu])

    def of(biases: str, c: int):
        return F.coalesce(F.element_at(biases, F.col("fold") * n_cfg + F.lit(c + 1)), F.lit(0.0))

    done = None
    for e in epochs:
        bu, bi = fits.snapshots[e]
        x = rows.join(bu, "uid", "left").select("iid", "stars", "fold", *[of("bu", c).alias(f"u{c}") for c in range(n_cfg)]).join(bi, "iid", "left")
        aggs = [F.count(F.lit(1)).alias("n")]
        for c in range(n_cfg):
            pred = clip_rating(F.element_at(mu_a, F.col("fold") * n_cfg + F.lit(c + 1)) + F.col(f"u{c}") + of("bi", c))
            aggs.append(F.sqrt(F.avg(F.pow(F.col("stars") - pred, 2))).alias(str(c)))
        long = x.groupBy("fold").agg(*aggs).unpivot(["fold", "n"], [str(c) for c in range(n_cfg)], "cfg", "rmse")
        own = materialize(long.select(F.lit(e).cast("int").alias("epoch"), "fold", F.col("cfg").cast("int").alias("cfg"), "n", "rmse"), "bias-rmse")
        done = own if done is None else done.unionByName(own)
        free_shuffles(spark)
    return done
