"""Centroid clustering of integer vectors in exact arithmetic on bit planes.

A vector's components become two's complement integers; bit k of all 64 of them is
one 64-bit word, its plane k.  The dot product of two vectors is the sum over planes
j, k of ``weight_j * weight_k * popcount(plane_j & plane_k)`` (the last plane's weight is
negative), and distances follow from three of those.  Only planes are kept between
rounds: one written table, read once a round.  A task gives each cluster's count and
componentwise sum of its rows, Spark adds them up, and the driver keeps the centroids
alone, whose number is a parameter.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize

#: Components of a vector, bits of a word.
WIDTH = 64
#: Planes up to which distances fit 64-bit arithmetic; more are added up as Python integers.
NARROW = 28
_LONG = 2 ** 63 - 1
#: Sums leave a task in digits of so many bits.
DIGIT = 40


def bits_of(values: np.ndarray) -> int:
    """Planes for two's complement of all values."""
    if not values.size:
        return 1
    lo, hi = int(values.min()), int(values.max())
    return max((~lo if lo < 0 else lo).bit_length(), hi.bit_length() if hi >= 0 else 0) + 1


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``(n, bits)`` words of ``(n, 64)`` integers; component c is bit c."""
    out = np.empty((len(values), bits), np.uint64)
    for k in range(bits):
        plane = ((values >> k) & 1).astype(np.uint8)
        out[:, k] = np.packbits(plane, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(bits: int) -> list[int]:
    return [1 << k for k in range(bits - 1)] + [-(1 << (bits - 1))]


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers of ``(n, bits)`` words."""
    n, bits = planes.shape
    wide = np.int64 if bits <= 40 else object  # rows of a batch are added up
    out = np.zeros((n, WIDTH), wide)
    for k, w in enumerate(weights(bits)):
        plane = np.unpackbits(np.ascontiguousarray(planes[:, k:k + 1]).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        out += plane.astype(wide) * w
    return out


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot products of vectors with as many vectors, or one, by weighted AND-popcounts."""
    bits, more = planes.shape[1], other.shape[1]
    kind = np.int64 if max(bits, more) <= NARROW else object
    out = np.zeros(len(planes), kind)
    for j, wj in enumerate(weights(bits)):
        for k, wk in enumerate(weights(more)):
            out += np.bitwise_count(planes[:, j] & other[:, k]).astype(kind) * (wj * wk)
    return out


def nearest(planes: np.ndarray, centroids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (planes of one vector each; ties: the first) and squared distance."""
    own = dots(planes, planes)
    if any(len(q) > NARROW for q in centroids):
        own = own.astype(object)
    best = cluster = None
    for c, q in enumerate(centroids):
        q = q.reshape(1, -1)
        d = own + dots(q, q)[0] - 2 * dots(planes, q)
        if best is None:
            best, cluster = d, np.zeros(len(d), np.int32)
        else:
            less = (d < best).astype(bool)
            best, cluster = np.where(less, d, best), np.where(less, np.int32(c), cluster)
    return cluster, best


def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of exactly 64 finite components, and their ``floor(scale * x)``, of a list column."""
    lens = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lens == WIDTH)
    flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, WIDTH)  # null: nan
    with np.errstate(over="ignore"):
        x = np.floor(flat * scale)
    good = np.isfinite(flat).all(axis=1) & np.isfinite(x).all(axis=1)
    rows, x = rows[good], x[good]
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        return rows, np.array([[int(v) for v in r] for r in x], object).reshape(-1, WIDTH)
    return rows, x.astype(np.int64)


def planes_table(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, planes binary`` of the kept vectors, written."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = integers(batch.column("v"), scale)
            if not len(rows):
                continue
            words = pack(values, bits := bits_of(values))
            raw = pa.Array.from_buffers(pa.binary(8 * bits), len(rows), [None, pa.py_buffer(np.ascontiguousarray(words, "<u8").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), raw.cast(pa.binary())], ["vec_id", "planes"])

    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return materialize(arrow_map(given, run, "vec_id long, planes binary"), "planes")


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their planes, by number of planes."""
    raw = batch.column("planes")
    size = np.fromiter(map(len, raw.to_pylist()), np.int64, len(raw))
    for s in np.unique(size).tolist():
        rows = np.flatnonzero(size == s)
        yield rows, np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), "<u8").reshape(-1, s // 8)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    at = 0
    while value not in (0, -1) and at < 64:
        yield at, value & ((1 << DIGIT) - 1)
        value, at = value >> DIGIT, at + 1
    yield at, value


def _sums(centroids: list[np.ndarray]):
    """Of each task's rows: each cluster's count (component -1) and sums, in digits."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = defaultdict(int), defaultdict(lambda: [0] * WIDTH)
        for batch in batches:
            for _, planes in _groups(batch):
                cluster, _ = nearest(planes, centroids)
                values = unpack(planes)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    count[c] += int(own.sum())
                    total[c] = [a + int(b) for a, b in zip(total[c], values[own].sum(axis=0).tolist())]
        out = [(c, -1, d, v) for c in count for d, v in _digits(count[c])]
        out += [(c, i, d, v) for c in total for i, t in enumerate(total[c]) for d, v in _digits(t)]
        columns = [pa.array(x, k) for x, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))]
        if columns:
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "component", "digit", "value"])
    return run


def _integer_planes(values: list[int]) -> np.ndarray:
    row = np.array([values], object)
    return pack(row, bits_of(row))[0]


def seeds(planes: DataFrame, k: int, prefix: str) -> list[np.ndarray]:
    """Planes of the k vectors of least sha256 of prefix and id, in that order.  Rows of one id are in order
    of their planes; a null id comes after all others."""
    order = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    rows = planes.orderBy(order.asc_nulls_last(), F.octet_length("planes"), "planes").limit(k).select("planes").collect()
    return [np.frombuffer(bytes(r["planes"]), "<u8") for r in rows]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10,
            scale: int = 1024, prefix: str = "3:") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors of exactly 64 components, none null or non-finite (nor infinite when
    scaled); the others have no row.  Component x counts as ``floor(scale * x)``.  The first centroids are
    :func:`seeds` (fewer if there are fewer vectors); each round assigns every vector to the
    nearest (ties: smaller number) and replaces every non-empty centroid by the floor of its vectors'
    mean.  Repeated rows count each, null ids are kept, an empty table gives no rows.  Assignments are
    exact for any finite input; a distance or inertia beyond 2^63 - 1 is given as that."""
    planes = planes_table(vectors, id_col, vec_col, scale)
    centroids = seeds(planes, k, prefix)
    for _ in range(rounds if centroids else 0):
        got = (arrow_map(planes, _sums(centroids), "cluster int, component int, digit int, value long")
               .groupBy("cluster", "component", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))
        total: dict = defaultdict(int)
        for r in got.collect():  # at most k * 65 sums, in a few digits each
            total[r["cluster"], r["component"]] += int(r["value"]) << (DIGIT * r["digit"])
        for c in range(len(centroids)):
            if n := total.get((c, -1)):
                centroids[c] = _integer_planes([total[c, i] // n for i in range(WIDTH)])

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words in _groups(batch):
                own, far = nearest(words, centroids)
                far = pa.array([min(int(x), _LONG) for x in far.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(own, pa.int32()), far], ["vec_id", "cluster", "distance"])

    assigned = materialize(arrow_map(planes, last, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = min(sum(sums.values()), _LONG)
    text = [",".join(str(int(x)) for x in unpack(c.reshape(1, -1))[0]) for c in centroids]
    facts = [(c, min(sums.get(c, 0), _LONG), whole, hashlib.sha256(t.encode()).hexdigest()) for c, t in enumerate(text)]
    table = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
