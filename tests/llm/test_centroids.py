"""Bit planes and exact clustering against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tastebud.llm import bitplanes


def brute(vectors, k, rounds):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and math.isfinite(1024 * float(x)) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else ""))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        cs = [[sum(x) // len(x) for x in zip(*(v for (_, v), o in zip(kept, own) if o == j))] if j in own else c for j, c in enumerate(cs)]
    got = [(i, *near(v)) for i, v in kept]
    top = 2 ** 63 - 1
    sums = {j: sum(d for _, d, o in got if o == j) for j in range(len(cs))}
    return sorted((i if i is not None else -9, o, min(d, top), min(sums[o], top), min(sum(sums.values()), top),
                   hashlib.sha256(",".join(map(str, cs[o])).encode()).hexdigest()) for i, d, o in got)


def result(df):
    return sorted((r["vec_id"] if r["vec_id"] is not None else -9, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("low,high", [(-1, 1), (0, 0), (-1024, 1024), (-5, 1 << 27), (-(1 << 40), 1 << 13)])
def test_planes_give_exact_dot_products(low, high):
    rng = np.random.default_rng(5)
    a, b = (rng.integers(low, high, (40, 64), endpoint=True) for _ in range(2))
    pa, pb = bitplanes.pack(a, bitplanes.bits_of(a)), bitplanes.pack(b, bitplanes.bits_of(b))
    assert (bitplanes.unpack(pa) == a).all()
    want = [sum(int(x) * int(y) for x, y in zip(r, s)) for r, s in zip(a, b)]
    assert [int(x) for x in bitplanes.dots(pa, pb)] == want


def vectors(n=300):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 5, 0.4) / 3 for _ in range(64)]) for i in range(n)]
    rows += [(7, rows[7][1]), (8, rows[9][1]), (500, rows[3][1]), (None, rows[11][1])]  # repeated rows and ids, ties, no id
    rows += [(600, None), (601, []), (602, [0.5] * 63), (603, [0.5] * 65), (604, [0.1] * 63 + [None]),
             (605, [0.1] * 63 + [float("nan")]), (606, [0.1] * 63 + [float("inf")]), (607, [0.0] * 64), (608, [-0.0001] * 64)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def given(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(4)


def floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_clusters_equal_brute_force(spark):
    rows = vectors()
    clashing = given(spark, rows).selectExpr("*", "1 as cluster", "'p' as planes", "2 as v", "3 as distance")
    assert result(bitplanes.cluster(clashing, k=8, rounds=10)) == brute(floats(rows), 8, 10)


def test_vectors_beyond_64_bit_arithmetic(spark):
    rows = vectors(30) + [(900 + i, [(-1) ** i * 1e6 * (j + i + 1) for j in range(64)]) for i in range(5)] + [(950, [3e38] * 64), (951, [-3e38] * 64)]
    assert result(bitplanes.cluster(given(spark, rows), k=6, rounds=4)) == brute(floats(rows), 6, 4)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(20)[:3]
    assert result(bitplanes.cluster(given(spark, rows), k=8, rounds=2)) == brute(floats(rows), 8, 2)
    assert bitplanes.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert bitplanes.cluster(given(spark, [(1, [0.5])])).count() == 0
