"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from array passes over a batch's bytes.  The trees are grown on a
bounded, hash-ordered sample of labelled rows (at most ``SAMPLE``), level by level
from gradient histograms over quantile bins, and are complete binary trees of one
depth, flattened into arrays: a row's child is ``2 i + 1 + (x > threshold)``, so a
batch goes down a tree in ``depth`` array steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan
from .common import arrow_map
from .units import by_size

#: Labelled rows the trees are fitted on, at most: those of least hash.
SAMPLE = 20_000

_CLASS = np.zeros(256, np.int64)  # classes of bytes
for _k, _chars in enumerate(["", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "|", "#$%&*+=<>@^~_`\\/{}[]", "\"'()-"]):
    _CLASS[list(_chars.encode())] = _k
_CLASS[[0x20]] = 9
_CLASS[list(range(0x09, 0x0E))] = 10
_CLASS[0x80:] = 11
_N_CLASS = 12


def statistics(texts: list[str]) -> np.ndarray:
    """One row of statistics for each text; an empty text has zeros."""
    n = len(texts)
    buffer, edges = textscan.join([t.encode() for t in texts])
    size = np.diff(edges) - 1
    doc = np.repeat(np.arange(n), size + 1)
    kind = np.bincount(doc * _N_CLASS + _CLASS[buffer], minlength=n * _N_CLASS).reshape(n, _N_CLASS).astype(float)
    kind[:, 10] -= 1  # the separator
    starts, ends = textscan.words(buffer)
    owner, h = doc[starts], textscan.hashes(buffer, starts, ends)
    count = np.bincount(owner, minlength=n)
    length = (ends - starts).astype(float)

    def per_doc(x: np.ndarray) -> np.ndarray:
        return np.bincount(owner, x, n)

    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    again2 = np.zeros(len(h))
    again2[2:] = (h[2:] == h[:-2]) & (owner[2:] == owner[:-2])
    order = np.lexsort((h, owner))
    first = np.ones(len(h), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    runs = np.diff(np.append(np.flatnonzero(first), len(h)))
    most = np.zeros(n)
    np.maximum.at(most, owner[order][first], runs)
    last, upper = _CLASS[buffer[ends - 1]], (_CLASS[buffer[starts]] == 2).astype(float)
    distinct = np.bincount(owner[order][first], minlength=n)
    lines = kind[:, 10] + 1
    w, c = np.maximum(count, 1), np.maximum(size, 1)
    mean = per_doc(length) / w
    cols = [np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(per_doc(length * length) / w - mean * mean, 0)),
            per_doc(again) / w, per_doc(again2) / w, distinct / w, distinct / np.sqrt(w), most / w, per_doc(upper) / w,
            per_doc((last == 4).astype(float)) / w, per_doc((last == 5).astype(float)) / w, per_doc((last == 7).astype(float)) / w,
            per_doc((length == 1).astype(float)) / w, per_doc((length <= 3).astype(float)) / w, per_doc((length > 20).astype(float)) / w, count / lines, lines / w]
    out = np.column_stack([*cols, *(kind[:, k] / c for k in range(_N_CLASS))])
    out[count == 0] = 0
    return out


class BoostedTrees:
    """Binary classifier; ``fit`` on at most some ten thousand rows, ``score`` in array steps."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 2.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least
        self.base = 0.0
        self.feature = np.zeros((0, 2 ** depth - 1), np.int64)
        self.threshold = np.zeros((0, 2 ** depth - 1))
        self.leaf = np.zeros((0, 2 ** depth))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Without rows the score is 0.5; with one label it is near that label."""
        n = len(y)
        self.base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
        if n == 0 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)  # bin > b exactly if value > cuts[b]
        f, b = x.shape[1], self.bins
        where = binned + np.arange(f) * b
        raw = np.full(n, self.base)
        features, thresholds, leaves = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, threshold = np.zeros(2 ** self.depth - 1, np.int64), np.full(2 ** self.depth - 1, np.inf)
            for level in range(self.depth):
                k, at = 2 ** level, 2 ** level - 1
                slot = (node[:, None] * (f * b) + where).ravel()
                sg, sh = (np.bincount(slot, np.repeat(v, f), k * f * b).reshape(k, f, b).cumsum(2) for v in (g, h))
                tg, th = sg[:, :, -1:], sh[:, :, -1:]
                gain = sg ** 2 / (sh + self.ridge) + (tg - sg) ** 2 / (th - sh + self.ridge) - tg ** 2 / (th + self.ridge)
                gain[(sh < self.least) | (th - sh < self.least)] = 0
                best = gain.reshape(k, -1).argmax(1)
                split = gain.reshape(k, -1)[np.arange(k), best] > 1e-9
                feat, cut = best // b, best % b
                right = binned[np.arange(n), feat[node]] > cut[node]
                right &= split[node]
                for i in np.flatnonzero(split):
                    feature[at + i], threshold[at + i] = feat[i], cuts[feat[i]][cut[i]]
                node = 2 * node + right
            sums = [np.bincount(node, v, 2 ** self.depth) for v in (g, h)]
            leaf = self.rate * sums[0] / (sums[1] + self.ridge)
            raw += leaf[node]
            features.append(feature)
            thresholds.append(threshold)
            leaves.append(leaf)
        self.feature, self.threshold, self.leaf = np.stack(features), np.stack(thresholds), np.stack(leaves)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            raw += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-raw))


def held_out(doc_id: Column) -> Column:
    """Every fifth record by a checksum of its key; null keys are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> BoostedTrees:
    """Trees fitted on labelled documents that aren't held out.  A document with several
    labels counts as its lowest; null labels and keys are ignored."""
    known = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").cast("int").alias("quality")).where(~held_out(F.col("doc_id")))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in by_size(texts):
                x = statistics(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("quality").slice(a, b - a), pa.array(list(x))], ["doc_id", "quality", "x"])

    got = arrow_map(rows, run, "doc_id long, quality int, x array<double>").toArrow().sort_by("doc_id")
    y = got.column("quality").to_numpy().astype(float)
    x = np.array(got.column("x").to_pylist(), float).reshape(len(y), -1) if len(y) else np.zeros((0, 1))
    keep = np.sort(np.unique(got.column("doc_id").to_numpy(), return_index=True)[1]) if len(y) else np.zeros(0, int)
    return BoostedTrees().fit(x[keep], y[keep])


def with_scores(docs: DataFrame, model: BoostedTrees, column: str) -> DataFrame:
    """All columns of ``docs`` and the score of each row's text (a null text is empty)."""
    if column in docs.columns:
        raise ValueError(f"column {column!r} exists")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            s = [model.score(statistics(texts[a:b])) for a, b in by_size(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*s, np.zeros(0)]))], [*batch.schema.names, column])

    schema = type(docs.schema)([*docs.schema.fields]).add(column, "double")
    return arrow_map(docs, run, schema)
