"""DeepFM rating regression (factorisation machine plus a deep tower) trained
data-parallel on Spark.

Model (Guo et al. 2017): fields user, item and category (mean of the item's
known categories), plus the dense columns.  Every sparse id ``j`` of a field
has a parameter vector ``[w_j, e_j]`` (linear weight and embedding)::

    y = w0 + sum_f w_f + <wd, xd>                      (linear)
      + 1/2 sum_k ((sum_f e_fk)^2 - sum_f e_fk^2)      (pairwise, FM)
      + mlp([e_user, e_item, e_cat, xd])               (deep tower, relu layers)

With ``deep=False`` the tower is dropped and this is a factorisation machine
whose parameters stay distributed (unlike MLlib's, which live on the driver).

Training (parameter averaging, Zinkevich et al. 2010), one Spark job per
epoch:

* rows are hash-partitioned by user, so a user's parameters are updated by
  one task only (a user with more rows than one task's share is salted over
  several tasks and its copies averaged like an item's).  They are packed once
  into chunks of mini-batches with task-local ids; an epoch moves a chunk's
  bytes and each task's parameters, never rows with parameter arrays;
* each task runs one pass of mini-batch Adam (lazy on sparse rows) over its
  chunks with numpy and sends the parameters it touched, with their row
  counts, to their owners (a hash of the id), a record per owner;
* an owner merges the task copies by a weighted mean and sends each task the
  parameters it needs next.  The owners' input is written to the checkpoint
  folder, cutting lineage.

The dense part (``w0``, dense weights, MLP) is a fixed-size vector whatever
the data size; one owner averages it for all tasks.
"""

from __future__ import annotations

import itertools
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_small, materialize, release


@dataclass(frozen=True)
class DeepFMConfig:
    embedding: int = 4
    hidden: tuple[int, ...] = (128, 128)
    l2_reg: float = 1e-5          # on linear weights and embeddings
    learning_rate: float = 1e-3
    batch_size: int = 256
    epochs: int = 10
    init_std: float = 1e-2
    seed: int = 1024
    partitions: int | None = None  # training tasks; default: shuffle partitions, at most
    min_rows_per_task: int = 2048  # one task per this many rows (small inputs use fewer tasks)
    n_dense: int = 2
    deep: bool = True              # False: the factorisation machine alone (no deep tower)
    extra: dict = field(default_factory=dict)


# ------------------------------------------------------------------ dense parameters

def _dense_shapes(cfg: DeepFMConfig) -> list[tuple[str, tuple[int, ...]]]:
    k, nd = cfg.embedding, cfg.n_dense
    shapes = [("w0", (1,)), ("wd", (nd,))]
    if not cfg.deep:
        return shapes
    width = 3 * k + nd
    for li, h in enumerate(cfg.hidden):
        shapes += [(f"W{li}", (width, h)), (f"b{li}", (h,))]
        width = h
    shapes += [("Wout", (width,)), ("bout", (1,))]
    return shapes


def _unpack(vec: np.ndarray, cfg: DeepFMConfig) -> dict[str, np.ndarray]:
    out, o = {}, 0
    for name, shape in _dense_shapes(cfg):
        size = int(np.prod(shape))
        out[name] = vec[o:o + size].reshape(shape)
        o += size
    return out


def init_dense(cfg: DeepFMConfig, mu: float) -> np.ndarray:
    """Glorot-uniform MLP weights, zero biases; ``w0`` starts at the mean rating."""
    rnd = np.random.default_rng(cfg.seed)
    parts = []
    for name, shape in _dense_shapes(cfg):
        if name.startswith("W"):
            fan_in = shape[0]
            fan_out = shape[1] if len(shape) > 1 else 1
            lim = np.sqrt(6.0 / (fan_in + fan_out))
            parts.append(rnd.uniform(-lim, lim, shape).ravel())
        elif name == "w0":
            parts.append(np.array([mu]))
        else:
            parts.append(np.zeros(int(np.prod(shape))))
    return np.concatenate(parts)


def init_sparse(keys: DataFrame, key: str, block: str, cfg: DeepFMConfig) -> DataFrame:
    """``(key, vec)``: zero linear weight and small embeddings, drawn from a hash
    of (block, key, dim) so they do not depend on partitioning."""
    k = cfg.embedding
    u = [((F.xxhash64(F.lit(block), F.lit(cfg.seed), F.col(key), F.lit(d)) % 1_000_003) / 1_000_003.0)
         for d in range(k)]
    # uniform on [-a, a] with the standard deviation init_std
    a = cfg.init_std * np.sqrt(3.0)
    emb = [(F.abs(x) * 2.0 - 1.0) * a for x in u]
    return keys.select(key, F.array(F.lit(0.0), *emb).alias("vec"))


# ------------------------------------------------------------------ numpy model

def _forward(P, eu, ei, ec, wsum, xd, cfg):
    """Prediction and cached activations for a batch."""
    k = cfg.embedding
    lin = P["w0"][0] + wsum + xd @ P["wd"]
    s = eu + ei + ec
    fm = 0.5 * ((s * s).sum(1) - (eu * eu + ei * ei + ec * ec).sum(1))
    assert eu.shape[1] == k
    if not cfg.deep:
        return lin + fm, (s, None)
    h = np.concatenate([eu, ei, ec, xd], axis=1)
    acts = [h]
    for li in range(len(cfg.hidden)):
        z = acts[-1] @ P[f"W{li}"]
        z += P[f"b{li}"]
        acts.append(np.maximum(z, 0.0, out=z))
    deep = acts[-1] @ P["Wout"] + P["bout"][0]
    return lin + fm + deep, (s, acts)


def _backward(P, g, eu, ei, ec, xd, cache, cfg, G=None):
    """Gradients of the summed loss w.r.t. the dense parameters (written into ``G`` if given)
    and the three field inputs (``[w, e]`` per field)."""
    s, acts = cache
    k = cfg.embedding
    if G is None:
        G = {name: np.zeros_like(v) for name, v in P.items()}
    G["w0"][0] = g.sum()
    np.matmul(xd.T, g, out=G["wd"])
    gf = g[:, None]
    if not cfg.deep:
        return G, gf * (s - eu), gf * (s - ei), gf * (s - ec)
    G["bout"][0] = g.sum()
    np.matmul(acts[-1].T, g, out=G["Wout"])
    d = np.outer(g, P["Wout"])
    for li in reversed(range(len(cfg.hidden))):
        np.putmask(d, acts[li + 1] <= 0, 0.0)
        np.matmul(acts[li].T, d, out=G[f"W{li}"])
        np.sum(d, axis=0, out=G[f"b{li}"])
        d = d @ P[f"W{li}"].T
    dh = d                                         # wrt [eu, ei, ec, xd]
    de_u = gf * (s - eu) + dh[:, 0:k]
    de_i = gf * (s - ei) + dh[:, k:2 * k]
    de_c = gf * (s - ec) + dh[:, 2 * k:3 * k]
    return G, de_u, de_i, de_c


B1, B2, EPS = 0.9, 0.999, 1e-7


class _Adam:
    """Adam for the dense parameter vector (sparse rows: :meth:`_Table.adam`)."""

    def __init__(self, lr: float, size: int):
        self.lr, self.t = lr, 0
        self.m, self.v, self.x, self.y = (np.zeros(size) for _ in range(4))

    def step(self, param: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        x, y = self.x, self.y              # scratch
        self.m *= B1
        self.m += np.multiply(grad, 1 - B1, out=x)
        self.v *= B2
        self.v += np.multiply(np.multiply(grad, grad, out=x), 1 - B2, out=x)
        np.sqrt(self.v, out=x)
        x += EPS
        np.multiply(self.m, self.lr * np.sqrt(1 - B2 ** self.t) / (1 - B1 ** self.t), out=y)
        y /= x
        param -= y


def _pooled(n: int, lens: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Mean of each row's vectors, ``lens`` of them a row; zeros for a row without any."""
    r_of = np.repeat(np.arange(n), lens)
    sums = np.stack([np.bincount(r_of, vecs[:, d], n) for d in range(vecs.shape[1])], axis=1)
    return sums / np.maximum(lens, 1)[:, None]


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """A list column whose lists are all ``width`` long."""
    return pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def _cat_columns(b: pa.RecordBatch, k1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Category count of each row, and the indices and parameters of them all in order."""
    lens = pc.list_value_length(b.column("cidx")).to_numpy(zero_copy_only=False).astype(np.int64)
    return lens, pc.list_flatten(b.column("cidx")).to_numpy(zero_copy_only=False), _matrix(pc.list_flatten(b.column("cvecs")), k1)


def _predict_batch(b: pa.RecordBatch, dense_vec: np.ndarray, cfg: DeepFMConfig) -> np.ndarray:
    k1 = cfg.embedding + 1
    U, I = _matrix(b.column("uvec"), k1), _matrix(b.column("ivec"), k1)
    lens, _, cvecs = _cat_columns(b, k1)
    C = _pooled(b.num_rows, lens, cvecs)
    y, _ = _forward(_unpack(dense_vec, cfg), U[:, 1:], I[:, 1:], C[:, 1:], U[:, 0] + I[:, 0] + C[:, 0],
                    _matrix(b.column("dense"), cfg.n_dense), cfg)
    return y


# ------------------------------------------------------------------ packed parts

BLOCKS = ("u", "i", "c")
CHUNK_BATCHES = 64      # mini-batches a chunk
SEQ_DENSE, SEQ_PARAMS, SEQ_CATS = -2, -1, 0     # records of a part before its chunks 1, 2, ...


class _Numbers:
    """Local numbers of the ids of a block, in order of arrival, with their start parameters."""

    def __init__(self):
        self.pos: dict[int, int] = {}
        self.ids: list[np.ndarray] = []
        self.vecs: list[np.ndarray] = []
        self.n = np.zeros(0, dtype=np.int64)      # training rows of each

    def of(self, ids: np.ndarray, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Local numbers of ``ids``, and where the ids met for the first time first occur."""
        uniq, first, inv = np.unique(ids, return_index=True, return_inverse=True)
        at = np.fromiter((self.pos.get(k, -1) for k in uniq.tolist()), np.int64, len(uniq))
        new = np.flatnonzero(at < 0)
        at[new] = len(self.pos) + np.arange(len(new))
        self.pos.update(zip(uniq[new].tolist(), at[new].tolist()))
        self.ids.append(uniq[new])
        self.vecs.append(vecs[first[new]])
        self.n = np.concatenate([self.n, np.zeros(len(new), dtype=np.int64)])
        return at[inv], first[new]

    def params(self) -> tuple[np.ndarray, ...]:
        return np.concatenate(self.ids), np.arange(len(self.pos), dtype=np.int32), self.n, np.concatenate(self.vecs)


def _pack_parts(cfg: DeepFMConfig):
    """mapInArrow over rows sorted by part and ``h``: chunks ``(users, items, rating, dense)`` of whole
    mini-batches with local ids, the categories of each local item, and the start parameters.  Arrow batches
    are consumed one at a time; a task holds one chunk and the ids it meets."""
    k1, size = cfg.embedding + 1, CHUNK_BATCHES * cfg.batch_size

    def part_records(part, batches):
        U, I, C = _Numbers(), _Numbers(), _Numbers()
        cat_lens, cats, pend, seq = [], [], None, 0
        for b in batches:
            ur, _ = U.of(b.column("uid").to_numpy(), _matrix(b.column("uvec"), k1))
            ir, fresh = I.of(b.column("iid").to_numpy(), _matrix(b.column("ivec"), k1))
            lens, cidx, cvecs = _cat_columns(b, k1)
            take = lens[fresh]
            at = np.repeat(np.cumsum(lens)[fresh] - np.cumsum(take), take) + np.arange(take.sum())
            cat_lens.append(take)
            cats.append(C.of(cidx[at], cvecs[at])[0])
            U.n += np.bincount(ur, minlength=len(U.n))
            I.n += np.bincount(ir, minlength=len(I.n))
            cur = [ur.astype(np.int32), ir.astype(np.int32), b.column("rating").to_numpy(zero_copy_only=False).astype(np.float64),
                   _matrix(b.column("dense"), cfg.n_dense)]
            pend = cur if pend is None else [np.concatenate(x) for x in zip(pend, cur)]
            while len(pend[0]) >= size:
                seq += 1
                yield part, seq, pickle.dumps([np.ascontiguousarray(x[:size]) for x in pend]), None
                pend = [x[size:] for x in pend]
        if len(pend[0]):
            yield part, seq + 1, pickle.dumps([np.ascontiguousarray(x) for x in pend]), None
        cat_lens, cats = np.concatenate(cat_lens), np.concatenate(cats)
        C.n += np.bincount(cats, np.repeat(I.n, cat_lens), len(C.n)).astype(np.int64)
        yield part, SEQ_CATS, pickle.dumps((cat_lens.astype(np.int32), cats.astype(np.int32))), None
        yield part, SEQ_PARAMS, None, pickle.dumps({name: t.params() for name, t in zip(BLOCKS, (U, I, C))})

    def fn(batches):
        for part, own in _runs(batches, "part"):
            for r in part_records(part, own):
                yield _records(PACKED, [r])
    return fn


def _runs(batches, key: str):
    """``(value, batches)`` of each run of ``key`` in batches that are sorted by it."""
    def cut():
        for b in batches:
            if b.num_rows:
                k = b.column(key).to_numpy()
                at = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
                for x, y in zip(at, at[1:]):
                    yield int(k[x]), b.slice(x, y - x)
    import itertools
    for value, run in itertools.groupby(cut(), key=lambda x: x[0]):
        yield value, (b for _, b in run)


def _rows_of(batches, *names: str):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in names))


PACKED = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("rows", pa.binary()), ("params", pa.binary())])
STATE = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("data", pa.binary())])
UPDATE = pa.schema([("owner", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])
PARAM = pa.schema([("block", pa.string()), ("idx", pa.int64()), ("vec", pa.list_(pa.float64()))])


def _records(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ------------------------------------------------------------------ training tasks

class _Table:
    """A task's parameters of one block with lazy Adam state: ``[parameters, m, v]`` a row, which a
    mini-batch reads and writes once."""

    def __init__(self, params: list[tuple[np.ndarray, ...]], lr: float):
        self.idx, self.pos, self.n, vec = (np.concatenate(x) for x in zip(*params))
        self.k1, self.lr = vec.shape[1], lr
        self.S = np.zeros((len(vec), 3 * self.k1))
        self.S[self.pos, :self.k1] = vec
        self.t = np.zeros(len(vec), dtype=np.int64)
        self.rate = np.zeros((1, self.k1))

    def take(self, rows: np.ndarray) -> np.ndarray:
        """The parameters of ``rows``, which :meth:`adam` then steps."""
        self.order = np.argsort(rows, kind="stable")
        rows = rows[self.order]
        new = np.empty(len(rows), dtype=bool)
        new[:1] = True
        np.not_equal(rows[1:], rows[:-1], out=new[1:])
        self.first = np.flatnonzero(new)
        self.rows = rows[self.first]
        own = self.S.take(self.rows, axis=0)
        self.own = [np.ascontiguousarray(own[:, x * self.k1:(x + 1) * self.k1]) for x in range(3)]
        at = np.empty(len(rows), dtype=np.int64)
        at[self.order] = np.cumsum(new) - 1
        return self.own[0].take(at, axis=0)

    def adam(self, grad: np.ndarray, lam: float) -> None:
        """A step with the gradients of each taken row summed, plus l2 on it."""
        if not len(grad):
            return
        P, m, v = self.own
        G = np.add.reduceat(grad.take(self.order, axis=0), self.first, axis=0)
        G += 2 * lam * P
        t = self.t[self.rows] + 1
        self.t[self.rows] = t
        top = int(t.max())
        if top >= len(self.rate):
            e = np.arange(1, 2 * top + 1)
            self.rate = np.repeat(np.r_[0.0, self.lr * np.sqrt(1 - B2 ** e) / (1 - B1 ** e)][:, None], self.k1, axis=1)
        m *= B1
        m += (1 - B1) * G
        v *= B2
        G *= G
        G *= 1 - B2
        v += G
        np.sqrt(v, out=G)
        G += EPS
        P -= self.rate.take(t, axis=0) * m / G
        self.S[self.rows] = np.concatenate(self.own, axis=1)

    def params(self) -> tuple[np.ndarray, ...]:
        return self.idx, self.pos, self.n, self.S[self.pos, :self.k1]


def _split(keys: np.ndarray, cols: tuple[np.ndarray, ...]):
    """``(key, cols)`` of the rows of each key."""
    order = np.argsort(keys, kind="stable")
    keys, cols = keys[order], [c[order] for c in cols]
    at = [*np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist(), len(keys)] if len(keys) else []
    for x, y in zip(at, at[1:]):
        yield int(keys[x]), tuple(np.ascontiguousarray(c[x:y]) for c in cols)


def _owner(idx: np.ndarray, parts: int) -> np.ndarray:
    mixed = idx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _train_parts(start: np.ndarray, cfg: DeepFMConfig, parts: int):
    """mapInArrow over the records of each part in order of ``seq``: one pass of mini-batch Adam over
    its chunks, which come one at a time; the parameters go to their owners, the dense ones to owner 0."""
    lam = cfg.l2_reg
    l2_mask = np.r_[0.0, np.ones(cfg.n_dense)]

    def part_updates(part, records):
        dense, given = start.copy(), []
        gdense = np.zeros_like(dense)
        P, G = _unpack(dense, cfg), _unpack(gdense, cfg)      # views
        opt = _Adam(cfg.learning_rate, len(dense))
        n_rows = 0
        for seq, data in records:
            data = pickle.loads(data)
            if seq == SEQ_DENSE:
                dense[:] = data
            elif seq == SEQ_PARAMS:
                given.append(data)
            elif seq == SEQ_CATS:
                U, I, C = (_Table([g[b] for g in given if b in g], cfg.learning_rate) for b in BLOCKS)
                cat_lens, cats = data
                cat_at = np.cumsum(cat_lens) - cat_lens
            else:
                n_rows += len(data[0])
                for s in range(0, len(data[0]), cfg.batch_size):
                    train(*(x[s:s + cfg.batch_size] for x in data), U, I, C, cat_lens, cat_at, cats, P, G, dense, gdense, opt)
        out: dict[int, dict] = {}
        for b, t in zip(BLOCKS, (U, I, C)):
            for owner, cols in _split(_owner(t.idx, parts), t.params()):
                out.setdefault(owner, {})[b] = cols
        rows = [(owner, part, pickle.dumps(cols)) for owner, cols in out.items()]
        yield _records(UPDATE, [*rows, (0, part, pickle.dumps((n_rows, dense)))])

    def train(ur, ir, y, xd, U, I, C, cat_lens, cat_at, cats, P, G, dense, gdense, opt):
        B = len(y)
        u, i = U.take(ur), I.take(ir)
        lens = cat_lens[ir]
        of = np.repeat(np.arange(B), lens)               # the row and the category of each entry
        ends = np.cumsum(lens)
        cs = cats[np.repeat(cat_at[ir] - ends + lens, lens) + np.arange(len(of))]
        c = _pooled(B, lens, C.take(cs))
        pred, cache = _forward(P, u[:, 1:], i[:, 1:], c[:, 1:], u[:, 0] + i[:, 0] + c[:, 0], xd, cfg)
        g = 2.0 * (pred - y) / B                         # d mean squared error / d pred
        _, de_u, de_i, de_c = _backward(P, g, u[:, 1:], i[:, 1:], c[:, 1:], xd, cache, cfg, G)
        gdense[:1 + cfg.n_dense] += 2 * lam * dense[:1 + cfg.n_dense] * l2_mask
        opt.step(dense, gdense)
        g = g[:, None]
        U.adam(np.concatenate([g, de_u], axis=1), lam)
        I.adam(np.concatenate([g, de_i], axis=1), lam)
        C.adam((np.concatenate([g, de_c], axis=1) / np.maximum(lens, 1)[:, None]).take(of, axis=0), lam)

    def fn(batches):
        for part, own in _runs(batches, "part"):
            yield from part_updates(part, _rows_of(own, "seq", "data"))
    return fn


def _merge_parts(flat: bool):
    """mapInArrow over the updates of each owner: the weighted mean of the task copies of every
    parameter row, as the next state of each part (``flat``: as rows of a parameter table)."""
    def merged(records):
        of: dict[str, list] = {b: [] for b in BLOCKS}
        dense, n_rows, told = 0.0, 0, []
        for part, data in records:
            data = pickle.loads(data)
            if isinstance(data, dict):
                for b, cols in data.items():
                    of[b].append((np.full(len(cols[0]), part), *cols))
            else:
                told.append(part)
                n_rows += data[0]
                dense = dense + data[0] * data[1]
        means = {}
        for b in BLOCKS:
            if of[b]:
                part, idx, pos, n, vec = (np.concatenate(x) for x in zip(*of[b]))
                uniq, inv = np.unique(idx, return_inverse=True)
                total = np.bincount(inv, n, len(uniq))
                mean = np.stack([np.bincount(inv, vec[:, d] * n, len(uniq)) / total for d in range(vec.shape[1])], axis=1)
                means[b] = uniq, mean, part, (idx, pos, n, mean[inv])
        return means, told, dense / n_rows if told else None

    def fn(batches):
        for _, own in _runs(batches, "owner"):
            means, told, dense = merged(_rows_of(own, "part", "data"))
            if flat:
                for b, (uniq, mean, _, _) in means.items():
                    for x in range(0, len(uniq), 8192):
                        ids, vec = uniq[x:x + 8192], mean[x:x + 8192]
                        lists = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * vec.shape[1], vec.ravel())
                        yield pa.RecordBatch.from_arrays([pa.array([b] * len(ids)), pa.array(ids, pa.int64()), lists], schema=PARAM)
                if told:
                    yield _records(PARAM, [("g", 0, dense.tolist())])
                continue
            out: dict[int, dict] = {}
            for b, (_, _, part, cols) in means.items():
                for p, own_cols in _split(part, cols):
                    out.setdefault(p, {})[b] = own_cols
            if out:
                yield _records(STATE, [(p, SEQ_PARAMS, pickle.dumps(cols)) for p, cols in out.items()])
            for p in told:
                yield _records(STATE, [(p, SEQ_DENSE, pickle.dumps(dense))])
    return fn


# ------------------------------------------------------------------ Spark plan

PACKED_SCHEMA = "part int, seq int, rows binary, params binary"
STATE_SCHEMA = "part int, seq int, data binary"
UPDATE_SCHEMA = "owner int, part int, data binary"
PARAM_SCHEMA = "block string, idx long, vec array<double>"


@dataclass
class DeepFMModel:
    cfg: DeepFMConfig
    users: DataFrame        # (uid, vec)
    items: DataFrame        # (iid, vec)
    cats: DataFrame         # (idx, vec)
    item_cats: DataFrame    # (iid, pos, idx): known categories of each item
    dense: np.ndarray       # fixed-size dense/MLP parameters
    history: list = field(default_factory=list)


def _item_side(items: DataFrame, cats: DataFrame, item_cats: DataFrame) -> DataFrame:
    """``(iid, ivec, cidx, cvecs)``: each item's parameters with its categories'
    parameters (grouped per item: a handful of categories each)."""
    ic = join_small(item_cats, cats.withColumnRenamed("vec", "cvec"), "idx")
    g = ic.groupBy("iid").agg(F.sort_array(F.collect_list(F.struct("pos", "idx", "cvec"))).alias("_c"))
    return (items.withColumnRenamed("vec", "ivec").join(g, "iid", "left")
            .select("iid", "ivec",
                    F.coalesce(F.transform("_c", lambda s: s["idx"]), F.array().cast("array<bigint>"))
                    .alias("cidx"),
                    F.coalesce(F.transform("_c", lambda s: s["cvec"]),
                               F.array().cast("array<array<double>>")).alias("cvecs")))


def _with_params(rows: DataFrame, users: DataFrame, item_side: DataFrame) -> DataFrame:
    r = rows.join(users.withColumnRenamed("vec", "uvec"), "uid")
    return join_small(r, item_side, "iid")


def _block(params: DataFrame, block: str, key: str) -> DataFrame:
    return params.where(F.col("block") == block).select(F.col("idx").alias(key), "vec")


def salted_rows(rows: DataFrame, parts: int, seed: int) -> DataFrame:
    """Training rows with a row hash ``h`` and a ``salt``: a user with more rows
    than one task's share (rows / parts) is split over ``ceil(n / share)``
    training tasks by row hash; the weighted merge averages its copies."""
    r = rows.select("row_key", "uid", "iid", F.col("rating").cast("double").alias("rating"),
                    "dense", F.xxhash64("row_key", F.lit(seed)).alias("h"))
    share = max(1, -(-rows.count() // parts))
    # fewer users than parts are that heavy
    salts = r.groupBy("uid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share).select(
        "uid", F.ceil(F.col("_n") / F.lit(share)).cast("long").alias("_s"))
    return r.where("uid IS NOT NULL").join(F.broadcast(salts), "uid", "left").select(
        *r.columns, F.pmod(F.col("h"), F.coalesce("_s", F.lit(1).cast("long"))).alias("salt"))


def fit_deepfm(rows: DataFrame, users: DataFrame, items: DataFrame, item_cats: DataFrame,
               n_cats: int, cfg: DeepFMConfig = DeepFMConfig()) -> DeepFMModel:
    """Train on ``rows`` ``(row_key, uid, iid, rating, dense array<double>)``.

    ``users`` / ``items``: the id domains ``(uid)`` / ``(iid)``; ``item_cats``:
    ``(iid, pos, idx)`` with category indices ``1..n_cats``."""
    spark = rows.sparkSession
    if cfg.partitions:
        parts = cfg.partitions
    else:
        n_rows = rows.count()
        parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-n_rows // cfg.min_rows_per_task)))
    mu = float(rows.where("uid IS NOT NULL").agg(F.avg("rating")).first()[0] or 0.0)
    cat_ids = spark.range(1, n_cats + 1).select(F.col("id").alias("idx"))
    item_cats = materialize(item_cats.select("iid", "pos", "idx"), "deepfm-item-cats")
    dense = init_dense(cfg, mu)
    # one parameter table: user, item and category rows plus the dense vector
    params = (init_sparse(users.select(F.col("uid").alias("idx")), "idx", "u", cfg).select(F.lit("u").alias("block"), "*")
              .unionByName(init_sparse(items.select(F.col("iid").alias("idx")), "idx", "i", cfg)
                           .select(F.lit("i").alias("block"), "*"))
              .unionByName(init_sparse(cat_ids, "idx", "c", cfg).select(F.lit("c").alias("block"), "*"))
              .unionByName(spark.createDataFrame([("g", 0, dense.tolist())], PARAM_SCHEMA)))
    params = materialize(params, "deepfm-params")
    if cfg.epochs:
        items_side = _item_side(_block(params, "i", "iid"), _block(params, "c", "idx"), item_cats)
        x = _with_params(salted_rows(rows, parts, cfg.seed), _block(params, "u", "uid"), items_side)
        # a fixed row order inside each part: hash of the row key
        x = (x.select(F.pmod(F.hash("uid", "salt"), F.lit(parts)).alias("part"), F.col("uid").cast("long").alias("uid"),
                      F.col("iid").cast("long").alias("iid"), "rating", "dense", "h", "uvec", "ivec", "cidx", "cvecs")
             .repartitionById(parts, "part").sortWithinPartitions("part", "h"))
        packed = materialize(x.mapInArrow(_pack_parts(cfg), PACKED_SCHEMA), "deepfm-packed")
        state, old = packed.select("part", "seq", F.coalesce("rows", "params").alias("data")), None
        for _ in range(cfg.epochs):
            told = state.repartitionById(parts, "part").sortWithinPartitions("part", "seq")
            upd = materialize(told.mapInArrow(_train_parts(dense, cfg, parts), UPDATE_SCHEMA), "deepfm-upd")
            if old is not None:
                release(old)
            old = upd
            by_owner = upd.repartitionById(parts, "owner").sortWithinPartitions("owner", "part")
            state = packed.where(F.col("seq") >= SEQ_CATS).select("part", "seq", F.col("rows").alias("data")).unionByName(
                by_owner.mapInArrow(_merge_parts(False), STATE_SCHEMA))
        new = by_owner.mapInArrow(_merge_parts(True), PARAM_SCHEMA).withColumnRenamed("vec", "_new")
        # rows that no training row touches keep their value
        params = materialize(params.join(new, ["block", "idx"], "left").select(
            "block", "idx", F.coalesce("_new", "vec").alias("vec")), "deepfm-params")
        release(packed)
        release(upd)
        # len(dense) values, independent of the data size
        dense = np.asarray(params.where("block = 'g'").select("vec").first()[0], dtype=np.float64)
    return DeepFMModel(cfg, _block(params, "u", "uid"), _block(params, "i", "iid"),
                       _block(params, "c", "idx"), item_cats, dense)


def predict_deepfm(model: DeepFMModel, rows: DataFrame) -> DataFrame:
    """``(row_key, uid, iid, rating, prediction)``, one row per input row of
    ``(row_key, uid, iid, rating, dense)`` (row keys need not be unique: the
    rows are passed through, never joined back); ids unseen in training use
    their initial parameters."""
    spark = rows.sparkSession
    cfg = model.cfg
    bc = spark.sparkContext.broadcast(model.dense)     # fixed size
    r = rows.select("row_key", F.col("uid").cast("long").alias("uid"), F.col("iid").cast("long").alias("iid"), "dense",
                    F.col("rating").cast("double").alias("rating"))
    x = _with_params(r, model.users, _item_side(model.items, model.cats, model.item_cats))

    def fn(batches):
        for b in batches:
            if b.num_rows:
                y = pa.array(_predict_batch(b, bc.value, cfg))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row_key", "uid", "iid", "rating")), y],
                                                 names=["row_key", "uid", "iid", "rating", "prediction"])
    return x.mapInArrow(fn, "row_key string, uid long, iid long, rating double, prediction double")
