"""Embedding near-dedup by product quantisation.

An index of coarse cells (k-means) holds every vector as the code of its residual
in ``SUBSPACES`` subspaces with the norm of what the code misses.  A vector of cell
a lies on a's side of the plane half-way to the query's own cell c, and the query's
distance to that plane is ``(|q-a|^2 - |q-c|^2) / (2 |a-c|)``.  A query probes every
cell whose plane is within a reach; there is no fixed count of probes.  With the
largest linked distance R as reach nothing can be lost.  How much less will do is
measured on the data and not assumed of it: ``PILOT`` vectors are held against all
others, and the reach is what all but ``LOSS`` of their links need (and all links of
all but ``LOSS`` of them); with too few linked pilots to tell, it is R.  In a cell, table look-ups give the distance ``d`` from the query to each
decoded vector, which is at most the miss away from the true one; all with
``d - miss <= R`` are reranked by the exact cosine in double precision, so that
step loses nothing.  Recall is measured against brute force in the tests.

Vectors of one cell are dealt to packs of bounded size, queries likewise, and packs
of queries meet packs of vectors by a join on (label, cell): a crowded cell is many
tasks.  Copies of a vector are one representative with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize
from .components import connected_components

#: Vectors (by hash order) that the cells and code books are fitted on, at most.
SAMPLE = 40_000
CELLS = 2_048
SUBSPACES = 8
CODES = 64
#: Vectors of a pack, on average.
PACK = 512
#: Vectors (by another hash order) whose links, found by brute force, give the reach of probes.
PILOT = 2_048
#: Share of the pilots' links, and of the linked pilots, that the reach may leave out.
LOSS = 0.01
#: Steps that a reach is measured in, of the largest linked distance.
STEPS = 256


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x``; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[a:a + 4096], c).argmin(1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class ProductQuantizer:
    """Cells and residual code books of unit vectors."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.cells = kmeans(sample, cells)
        residual = sample - self.cells[nearest(sample, self.cells)]
        edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        self.books = [kmeans(residual[:, a:b], CODES) for a, b in self.parts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes and the norm of what they miss, of every row."""
        cell = nearest(x, self.cells)
        rest = x - self.cells[cell]
        codes = np.stack([nearest(rest[:, a:b], book) for (a, b), book in zip(self.parts, self.books)], 1).astype(np.uint8)
        for s, ((a, b), book) in enumerate(zip(self.parts, self.books)):
            rest[:, a:b] -= book[codes[:, s]]
        return cell, codes, np.sqrt((rest * rest).sum(1))

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs: the row's own cell and those whose plane is within ``reach`` of the row."""
        rows, cells = [], []
        gap = np.sqrt(squared(self.cells, self.cells))
        for at in range(0, len(x), 4096):
            d = squared(x[at:at + 4096], self.cells)
            own = d.argmin(1)
            plane = d - d[np.arange(len(d)), own][:, None]
            r, c = np.nonzero(plane <= 2 * reach * gap[own] + 1e-9)
            rows.append(r + at)
            cells.append(c)
        return np.concatenate(rows), np.concatenate(cells)

    def needs(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For each pair of rows, the reach with which a probe for ``q`` meets ``x``."""
        own, other = self.cells[nearest(q, self.cells)], self.cells[nearest(x, self.cells)]
        gap = np.sqrt(((own - other) ** 2).sum(1))
        plane = ((q - other) ** 2).sum(1) - ((q - own) ** 2).sum(1)
        return np.divide(plane, 2 * gap, out=np.zeros(len(q)), where=gap > 0)

    def distances(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distance of every query to every decoded vector of the cell, by table look-up."""
        rest = q - self.cells[cell]
        total = np.zeros((len(q), len(codes)))
        for s, ((a, b), book) in enumerate(zip(self.parts, self.books)):
            total += squared(rest[:, a:b], book)[:, codes[:, s]]
        return np.sqrt(total)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def spanning(mask: np.ndarray, q: np.ndarray, x: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``mask`` (queries by vectors) connects, at most one for each
    query and vector."""
    free_q, free_x, edges = mask.any(1), mask.any(0), []
    for i in np.flatnonzero(free_q):
        if not free_q[i]:
            continue
        free_q[i], front = False, np.array([i])
        while len(front):
            near = mask[front].any(0) & free_x
            free_x &= ~near
            edges += [(int(q[i]), int(v)) for v in x[near]]
            back = mask[:, near].any(1) & free_q
            free_q &= ~back
            edges += [(int(q[i]), int(v)) for v in q[back]]
            front = np.flatnonzero(back)
    return [(a, b) for a, b in edges if a != b]


def covering(steps: np.ndarray, weight: np.ndarray, unseen: float) -> int:
    """The least step that is enough for all but ``LOSS`` of the weight, of which ``unseen``
    would need the largest one."""
    steps, weight = np.append(steps, STEPS), np.append(weight, unseen)
    order = np.argsort(steps, kind="stable")
    upto = np.cumsum(weight[order])
    return int(steps[order][np.searchsorted(upto, (1 - LOSS) * upto[-1])])


def probe_reach(reps: DataFrame, dim: int, cosine: float, pq: ProductQuantizer, reach: float) -> float:
    """The reach of probes that links within ``reach`` need, measured on pilots against all of ``reps``."""
    pilot = reps.select("rep", "label", "copies", "embedding").orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(PILOT).toArrow().combine_chunks()
    q = _unit(_matrix(pilot.column("embedding").combine_chunks(), dim))
    ids, labels, copies = (pilot.column(k).to_numpy() for k in ("rep", "label", "copies"))

    def run(batches):
        for batch in batches:
            found = np.zeros((len(q), STEPS + 1), np.int64)
            for a in range(0, batch.num_rows, 1024):
                b = batch.slice(a, 1024)
                x = _unit(_matrix(b.column("embedding"), dim))
                near = (q @ x.T >= cosine) & (labels[:, None] == b.column("label").to_numpy()[None, :]) & (ids[:, None] != b.column("rep").to_numpy()[None, :])
                for r, c in (np.stack(np.nonzero(near))[:, k:k + 4096] for k in range(0, max(1, int(near.sum())), 4096)):
                    step = np.clip(np.ceil(pq.needs(q[r], x[c]) / reach * STEPS), 0, STEPS).astype(int)
                    np.add.at(found, (r, step), b.column("copies").to_numpy()[c])
            r, step = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(step.astype(np.int32)), pa.array(found[r, step])], ["pilot", "step", "n"])

    rows = (arrow_map(reps.select("rep", "label", "copies", "embedding"), run, "pilot int, step int, n long")
            .groupBy("pilot", "step").agg(F.sum("n").alias("n")).toArrow())
    row, step, n = (rows.column(k).to_numpy() for k in ("pilot", "step", "n"))
    worst = np.full(len(q), -1)
    np.maximum.at(worst, row, step)
    worst = worst[worst >= 0]
    # links of one pilot stand or fall together: what wasn't seen is one pilot more, not one link
    return reach * max(covering(worst, np.ones(len(worst)), 1.0), covering(step, n * copies[row], 0.0)) / STEPS


def _links(reps: DataFrame, dim: int, cosine: float) -> DataFrame:
    """``a, b, n`` of representatives of one width: link counts of ``a`` (``b`` null) and edges (``n`` null)."""
    n = reps.count()
    sample = reps.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toArrow().column(0).combine_chunks()
    pq = ProductQuantizer(_unit(_matrix(sample, dim)), int(np.clip(np.sqrt(n), 1, CELLS)))
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-6
    near = probe_reach(reps, dim, cosine, pq, reach)

    def encode(batches):
        for b in batches:
            x = _unit(_matrix(b.column("embedding"), dim))
            cell, codes, miss = pq.encode(x)
            row, probe = pq.probes(x, near)
            blobs = [c.tobytes() for c in codes]
            take = np.concatenate([np.arange(len(x)), row])
            kind = np.repeat([False, True], [len(x), len(row)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), b.column("label").take(pa.array(take)), pa.array(np.concatenate([cell, probe]).astype(np.int32)),
                 b.column("rep").take(pa.array(take)), b.column("copies").take(pa.array(take)), b.column("embedding").take(pa.array(take)),
                 pa.array([blobs[i] for i in range(len(x))] + [b""] * len(row), pa.binary()), pa.array(np.concatenate([miss, np.zeros(len(row))]))],
                ["query", "label", "cell", "id", "copies", "embedding", "code", "miss"])

    schema = "query boolean, label long, cell int, id long, copies long, embedding array<float>, code binary, miss double"
    rows = materialize(arrow_map(reps, encode, schema), "pq_rows")
    key = ["query", "label", "cell"]
    sizes = rows.groupBy(*key).count().withColumn("packs", F.ceil(F.col("count") / PACK).cast("int")).drop("count")
    packs = (rows.join(sizes, key).withColumn("pack", F.pmod(F.xxhash64("id"), "packs"))
             .groupBy(*key, "pack").agg(F.collect_list(F.struct("id", "copies", "embedding", "code", "miss")).alias("own")))
    left = packs.where("query").select("label", "cell", F.col("own").alias("q"))
    right = packs.where("not query").select("label", "cell", F.col("own").alias("x"))

    def search(batches):
        for batch in batches:
            a, b, m = [], [], []
            for i in range(batch.num_rows):
                q, x = batch.column("q")[i].values, batch.column("x")[i].values
                qid, xid = (np.asarray(s.field("id")) for s in (q, x))
                qv, xv = (_unit(_matrix(s.field("embedding"), dim)) for s in (q, x))
                codes = np.frombuffer(b"".join(x.field("code").to_pylist()), np.uint8).reshape(len(xid), -1)
                far = pq.distances(qv, batch.column("cell")[i].as_py(), codes) - np.asarray(x.field("miss"))[None, :]
                r, c = np.nonzero((far <= reach) & (qid[:, None] != xid[None, :]))
                good = np.einsum("ij,ij->i", qv[r], xv[c]) >= cosine
                r, c = r[good], c[good]
                if not len(r):
                    continue
                links = np.bincount(r, np.asarray(x.field("copies"))[c], len(qid)).astype(np.int64)
                a += qid[links > 0].tolist()
                b += [None] * int((links > 0).sum())
                m += links[links > 0].tolist()
                mask = np.zeros((len(qid), len(xid)), bool)
                mask[r, c] = True
                edges = spanning(mask, qid, xid)
                a += [e[0] for e in edges]
                b += [e[1] for e in edges]
                m += [None] * len(edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(m, pa.int64())], ["a", "b", "n"])

    return arrow_map(left.join(right, ["label", "cell"]), search, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row (``vec_id, embedding, label``).

    Vectors link if their labels and widths are equal, the label is not null and the
    cosine is at least ``cosine``.  A vector that is null, empty, zero or holds a null
    or a non-finite component links with nothing, nor does one without a label.
    Copies link with each other; rows that share a ``vec_id`` are rows of their own
    in the counts and share the component of that id.  ``kept``: the row's id is the smallest one of its component."""
    v = materialize(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                   F.col("embedding").cast("array<float>").alias("embedding")), "vectors")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
              & F.col("vec_id").isNotNull())
    good = v.where(F.coalesce(usable, F.lit(False)))
    reps = materialize(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector_reps")
    found = None
    for (dim,) in sorted(map(tuple, reps.select(F.size("embedding")).distinct().collect())):
        own = _links(reps.where(F.size("embedding") == dim), dim, cosine)
        found = own if found is None else found.unionByName(own)
    member = good.join(reps, ["label", "embedding"]).select("vec_id", "rep", "copies")
    if found is None:
        per_row = member.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        found = materialize(found, "vector_links")
        links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
        # an id that several texts share joins them, so ids are what is linked
        copies = member.where("vec_id != rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
        root = connected_components(found.where("b is not null").select("a", "b").unionByName(copies))
        per_row = (member.join(links, "rep", "left").join(root, member["vec_id"] == root["node"], "left")
                   .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                           F.coalesce("root", "vec_id").alias("component_id")))
    alone = v.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return per_row.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
