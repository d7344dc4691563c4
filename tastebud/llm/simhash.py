"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked within a Hamming
distance by the generalised pigeonhole principle.

The bits are grouped into partitions, correlated bits together, and partition i
gets a threshold ``t_i`` of its own (-1: not probed) with
``sum(t_i) = distance - partitions + 1``: two fingerprints within ``distance`` then
differ in at most ``t_i`` bits of some probed partition.  The thresholds come from a
dynamic programme over estimated candidate counts.  Fingerprints are probed with
their partition's variants and verified with one XOR.

A partition value that many fingerprints share would give candidates by the square.
Fingerprints that meet such a crowded value are linked through Hamming balls
instead: two of them are within 2r exactly if their balls of radius r share a
word, and a word lies in at most as many balls as a ball has words.  No link is lost
and no crowd is paired.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_KEY, arrow_map, documents, fresh, materialize
from .components import connected_components

SEED = 42
#: Fingerprints that may share a partition value before balls take over.
CROWD = 64


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned fingerprint: bit set if set in over half of the shingles' XXH64, repeats
    included.  A-Z count as a-z; words end at ASCII white space; fewer words than
    ``shingle`` make one shingle, none the fingerprint zero."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    k = min(shingle, len(words))
    starts, stops = (ends - lens)[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    h64 = xxhash.xxh64_intdigest
    h = np.fromiter([h64(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, len(starts))
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        part = h[a:a + (1 << 16)]
        total += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, digest`` (Spark's hash of the text) ``, fp`` (the fingerprint's bits as a signed
    long) of every row."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint((t or "").encode(), shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                                             ["doc_id", "digest", "fp"])
    return arrow_map(documents(docs).withColumn("digest", F.xxhash64("text")), run, "doc_id long, digest long, fp long")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Fingerprint count and the 64 x 64 counts of bits set together."""
    def run(batches):
        both, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            for a in range(0, len(x), 1 << 16):
                bits = np.unpackbits(x[a:a + (1 << 16)], axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([both.ravel().tolist()])], ["n", "both"])
    part = arrow_map(fps.select("fp"), run, "n long, both array<long>")
    rows = (part.select("n", F.posexplode("both").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))).collect()
    both = np.zeros(64 * 64)
    for r in rows:
        both[r["i"]] = r["c"]
    return (rows[0]["n"] if rows else 0), both.reshape(64, 64)


def partition_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of near-equal size, each grown from the bit most
    correlated with the rest by the bit most correlated with the group."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for i in range(parts):
        size = 64 // parts + (i < 64 % parts)
        group = [max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: Sequence[Sequence[float]], distance: int) -> list[int]:
    """Thresholds of least total cost: ``costs[i][t + 1]`` is partition i's at threshold t
    (-1 .. distance); they add up to ``distance - partitions + 1``.  Dynamic programme
    over partitions and the sum so far."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, ts) in best.items():
            for t in range(-1, distance + 1):
                new = (cost + own[t + 1], [*ts, t])
                if total + t not in step or new < step[total + t]:
                    step[total + t] = new
        best = step
    return best[distance - len(costs) + 1][1]


def _masks(bits: Sequence[int], flips: int) -> list[int]:
    """Signed longs with at most ``flips`` of ``bits`` set."""
    out = [sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(bits, k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def _long(bits: Sequence[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def links(fps: DataFrame, distance: int, parts: int = 3, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``, a written table) that
    connect exactly those that links of ``distance`` or fewer differing bits connect."""
    n, both = bit_moments(fps)
    groups = partition_bits(n, both, parts)
    p = np.diag(both) / max(n, 1)
    ratio = 2 * p * (1 - p) / np.maximum(p * p + (1 - p) ** 2, 1e-12)  # pairs that differ in a bit to those that agree
    squares = [fps.groupBy(F.col("fp").bitwiseAND(F.lit(_long(g)))).count()
               .agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("s")).first()["s"] or 0.0 for g in groups]
    costs = []
    for g, s in zip(groups, squares):
        e = np.zeros(distance + 1)
        e[0] = 1
        for r in ratio[g]:
            e[1:] = e[1:] + r * e[:-1]  # elementary symmetric sums: expected pairs at 0, 1, .. bits
        upto = np.cumsum(e)
        costs.append([0.0] + [s * upto[t] + n * len(_masks(g, t)) for t in range(distance + 1)])
    thresholds = allocate(costs, distance)
    index = probe = None
    for i, (g, t) in enumerate(zip(groups, thresholds)):
        if t < 0:
            continue
        key = F.col("fp").bitwiseAND(F.lit(_long(g)))
        own = fps.select(F.lit(i).alias("part"), key.alias("key"), "fp")
        flips = F.explode(F.array(*[F.lit(m) for m in _masks(g, t)]))
        far = own.select("part", "key", "fp", flips.alias("flip")).select("part", F.col("key").bitwiseXOR(F.col("flip")).alias("key"), "fp") if t else own
        index, probe = (own, far) if index is None else (index.unionByName(own), probe.unionByName(far))
    crowded = index.groupBy("part", "key").count().where(F.col("count") > crowd).select("part", "key")
    calm_index = index.join(crowded, ["part", "key"], "left_anti").withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = (probe.withColumnRenamed("fp", "a").join(calm_index, ["part", "key"]).where(F.col("a") < F.col("b")).where(close)
             .select("a", "b"))
    ball = F.explode(F.array(*[F.lit(m) for m in _masks(range(64), (distance + 1) // 2)]))
    inside = (probe.join(crowded, ["part", "key"], "left_semi").select("fp").distinct()
              .select("fp", ball.alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), "fp")
              .groupBy("word").agg(F.collect_list("fp").alias("own")).where(F.size("own") > 1))
    if distance % 2 == 0:
        stars = inside.select(F.array_min("own").alias("a"), F.explode("own").alias("b")).where("a != b")
    else:  # a ball of this radius also holds fingerprints one bit too far apart
        stars = inside.select("own", F.explode("own").alias("a")).select("a", F.explode("own").alias("b")).where(F.col("a") < F.col("b")).where(close)
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, shingle: int, distance: int, parts: int = 3) -> DataFrame:
    """``doc_id, digest, fp, root, component_id`` of every row; ``root`` is a fingerprint that names the component.

    Rows of equal fingerprints link (so do all texts without words, null ones too);
    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``distance`` differing bits; null keys are ignored unless there is no other."""
    fp = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fp")
    root = connected_components(links(distinct.select("fp"), distance, parts)).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fp.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "digest", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """Rows of ``docs``, with all columns: of each component the row of its smallest
    ``doc_id`` (of several texts with that key the one of least hash, of repeated rows one).
    Components that share a ``doc_id`` each keep their own row.  Rows without a key stay only where a
    component has no other; null texts and texts without words are one component."""
    key, digest = fresh(docs, "simhash_key"), fresh(docs, "simhash_digest")
    found = near_duplicates(docs, shingle, distance)
    # of a component: rows with a key before those without, by key, then by digest
    first = F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("digest").alias("c")))
    kept = (found.groupBy("root").agg(first.alias("m"))
            .select(F.coalesce("m.b", F.lit(NULL_KEY)).alias(key), F.col("m.c").alias(digest)))
    return (docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)), digest: F.xxhash64(F.col("text").cast("string"))})
            .join(kept, [key, digest], "left_semi").dropDuplicates([key, digest]).select(*docs.columns))
