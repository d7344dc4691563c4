"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document is contaminated by an item of n words if some window of n consecutive
words (the whole document if it has fewer) is within ``floor(0.2 n)`` word edits of
the item.  Words are lower-cased runs of letters and digits.

1. A window within e edits shares a run of ``ceil((n - e) / (e + 1))`` words with
   the item (pigeonhole), so only windows around such a run are looked at.  Nothing
   that could match is lost here.
2. The CGK random walk (Chakraborty, Goldenberg, Koucky) copies a word sequence to a
   longer one, standing still or moving on by a random function of step and word, so
   that edit distance becomes Hamming distance.  One repetition samples
   ``SAMPLED`` positions of one walk; windows are candidates of the items they
   agree with there.  Repetitions are added until the collision rate measured on
   the items themselves, edited as far as is allowed, gives the target recall for
   each item length.
3. Candidates are verified by exact edit distance.

Items are broadcast in blocks of bounded size; with more blocks the documents are
passed over again, with nothing shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan
from .common import arrow_map, ragged
from .units import by_size

#: Share of an item's words that may be edited.
EDITS = 0.2
RECALL = 0.999
#: Positions of the embedding that one repetition samples.
SAMPLED = 2
#: Bytes of items that are broadcast at once, on average.
BLOCK_BYTES = 8 << 20

_SEPARATOR = np.ones(256, bool)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _SEPARATOR[_c] = False
_SEPARATOR[0x80:] = False


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the first word of each text and the end."""
    buffer, edges = textscan.join([t.lower().encode() for t in texts])
    edge = np.diff(_SEPARATOR[buffer].astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return textscan.hashes(buffer, starts, ends), np.searchsorted(starts, edges)


def allowed(n: int) -> int:
    return int(EDITS * n + 1e-9)


def shared_run(n: int) -> int:
    """Words in a row that a window shares with an item of ``n`` words, at least."""
    e = allowed(n)
    return -(-(n - e) // (e + 1))


def distances(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Edit distance of the first ``n`` words of each row of ``a`` and the first ``m`` of the
    row of ``b``."""
    cols, rows = np.arange(b.shape[1] + 1), np.arange(len(a))
    d = np.broadcast_to(cols, (len(a), len(cols))).copy()
    out = d[rows, m]
    for i in range(int(n.max(initial=0))):
        new = d + 1
        np.minimum(new[:, 1:], d[:, :-1] + (a[:, [i]] != b), out=new[:, 1:])
        d = np.minimum.accumulate(new - cols, axis=1) + cols
        out = np.where(n > i, d[rows, m], out)
    return out


def embed(x: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    """A key of the first ``n`` words of each row: ``SAMPLED`` words of repetition ``seed``'s
    walk and n, hashed together.  Positions are fixed shares of 2n, where the walk still is
    in the text; past the end it is on word 0.  ``x`` has a column of zeros at the end."""
    rng = np.random.default_rng(seed)
    positions = [(u * 2 * n).astype(np.int64) for u in rng.random(SAMPLED)]
    odd = rng.integers(0, 1 << 63, 2 * x.shape[1], np.uint64) * np.uint64(2) + np.uint64(1)
    at, key, flat = np.arange(len(x)) * x.shape[1], textscan.mix(n.astype(np.uint64)), x.ravel()
    end = at + n
    for t in range(int(max(p.max(initial=-1) for p in positions)) + 1):
        word = flat[at]
        for k, p in enumerate(positions):
            now = p == t
            if now.any():
                key[now] ^= textscan.mix(word[now] + np.uint64(k + 1))
        # multiply-shift: one random bit of the step for each word
        at = np.minimum(at + ((word * odd[t]) >> np.uint64(63)).astype(np.int64), end)
    return key


def padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.uint64)
    for o, r in zip(out, rows):
        o[:len(r)] = r
    return out


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``words`` after random edits, cut or filled up to its length again as a window would be."""
    out = words.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out) + 1))
        new = int(rng.integers(1, 1 << 62))
        if kind == 0 and at < len(out):
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif at < len(out):
            del out[at]
    out += rng.integers(1, 1 << 62, max(0, len(words) - len(out))).tolist()
    return np.array(out[:len(words)], np.uint64)


class Band:
    """LSH tables over items of about one length (within a factor of two)."""

    def __init__(self, ids: list[int], words: list[np.ndarray]):
        self.ids = np.array(ids, np.int64)
        self.n = np.array([len(w) for w in words], np.int64)
        self.width = int(self.n.max()) + 1
        self.words = padded(words, self.width)
        lengths, rng = np.unique(self.n), np.random.default_rng(0)
        trial = np.concatenate([rng.choice(np.flatnonzero(self.n == n), 200) for n in lengths])
        of, tn = np.repeat(np.arange(len(lengths)), 200), self.n[trial]
        near = padded([edited(self.words[i, :n], allowed(int(n)), rng) for i, n in zip(trial, tn)], self.width)
        missed, need = np.ones(len(trial), bool), np.zeros(self.width, np.int64)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        while True:  # need: repetitions of each length
            short = (np.bincount(of, missed, len(lengths)) > 200 * (1 - RECALL)) | (len(self.tables) < 4)
            if not short.any():
                break
            need[lengths[short]] += 1
            seed = len(self.tables)
            keys = embed(self.words, self.n, seed)
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))
            missed &= embed(self.words[trial], tn, seed) != embed(near, tn, seed)
        self.need = need

    def match(self, windows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of windows (padded rows of n words) and items of n words."""
        pairs = []
        for seed, (keys, order) in enumerate(self.tables):
            row = np.flatnonzero(self.need[n] > seed)
            key = embed(windows[row], n[row], seed)
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            pairs.append(np.repeat(row, hi - lo) * len(self.n) + order[ragged(lo, hi - lo)])
        pair = np.unique(np.concatenate(pairs))
        row, item = pair // len(self.n), pair % len(self.n)
        same = self.n[item] == n[row]
        return self.verify(windows, n, row[same], item[same])

    def verify(self, windows: np.ndarray, n: np.ndarray, row: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = [distances(self.words[item[k], :-1], self.n[item[k]], windows[row[k]], n[row[k]])
             for k in np.array_split(np.arange(len(row)), len(row) * self.width // 1_000_000 + 1)]
        d = np.concatenate(d)
        good = d <= (EDITS * self.n[item] + 1e-9).astype(np.int64)
        return row[good], item[good], d[good]


class Runs:
    """Runs of ``q`` words in items."""

    def __init__(self, q: int, items: list[np.ndarray]):
        self.q = q
        grams = [self.grams(w) for w in items]
        gram = np.concatenate(grams)
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.owner = np.concatenate([np.full(len(g), len(w)) for g, w in zip(grams, items)])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.gram >> np.uint64(44)).astype(np.int64)] = True

    def grams(self, words: np.ndarray) -> np.ndarray:
        n = len(words) - self.q + 1
        out = np.zeros(max(n, 0), np.uint64)
        for k in range(self.q if n > 0 else 0):
            out = textscan.mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
        return out

    def find(self, words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, item length, word in the item) of every run that an item has too."""
        g = self.grams(words)
        hit = np.flatnonzero(self.known[(g >> np.uint64(44)).astype(np.int64)])
        hit = hit[text_of[hit] == text_of[hit + self.q - 1]]
        lo, hi = np.searchsorted(self.gram, g[hit], "left"), np.searchsorted(self.gram, g[hit], "right")
        slot = ragged(lo, hi - lo)
        return np.repeat(hit, hi - lo), self.owner[slot], self.at[slot]


class Index:
    """The items of one block, by length, and their word runs."""

    def __init__(self, ids: list[int], texts: list[str]):
        h, first = word_hashes(texts)
        items = [(i, h[a:b]) for i, a, b in zip(ids, first[:-1], first[1:]) if b > a]
        sizes = sorted({len(w).bit_length() for _, w in items})
        self.bands = {k: Band(*zip(*[(i, w) for i, w in items if len(w).bit_length() == k])) for k in sizes}
        self.runs = {q: Runs(q, [w for _, w in items if shared_run(len(w)) == q]) for q in sorted({shared_run(len(w)) for _, w in items})}

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item id, first word of the window, distance) of every matching window."""
        found = [(np.zeros(0, np.int64),) * 4]
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        place, n, at = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 3, *(r.find(words, text_of) for r in self.runs.values())))
        # windows that could hold the run where the item has it, give or take the edits
        e = (EDITS * n + 1e-9).astype(np.int64)
        shift = ragged(-e, 2 * e + 1)
        place, n, at = (np.repeat(x, 2 * e + 1) for x in (place, n, at))
        text = text_of[place]
        last = np.maximum(first[text + 1] - n, first[text])
        start = np.where(last == first[text], last, place - at + shift)  # a text no longer than the item has one window
        ok = (start >= first[text]) & (start <= last)
        window = np.unique(np.stack([n[ok], start[ok], text[ok]]), axis=1)
        n, start, text = window
        short = start + n > first[text + 1]
        size = np.where(short, first[text + 1] - start, n)
        for k, band in self.bands.items():
            own = np.flatnonzero((n >> (k - 1)) == 1)
            for rows in np.array_split(own, len(own) * band.width // 4_000_000 + 1):
                if not len(rows):
                    continue
                cols = np.arange(band.width)[None, :]
                x = np.where(cols < size[rows][:, None], words[np.minimum(start[rows][:, None] + cols, len(words) - 1)], np.uint64(0))
                full = np.flatnonzero(~short[rows])
                row, item, d = band.match(x[full], n[rows][full])
                found.append((text[rows][full][row], band.ids[item], start[rows][full][row], d))
                few = np.flatnonzero(short[rows])  # texts with fewer words than the item, against all items of that length
                for i in few:
                    item = np.flatnonzero(band.n == n[rows[i]])
                    row, item, d = band.verify(x, size[rows], np.full(len(item), i), item)
                    found.append((text[rows][row], band.ids[item], start[rows][row], d))
        return tuple(np.concatenate(c) for c in zip(*found))


def indexes(benchmark: DataFrame) -> list[Index]:
    """One index for each block of items.  Items without an id or without words are left
    out; items of equal text are items of their own."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    out = []
    for k in range(blocks):
        rows = b.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        if rows.num_rows:
            out.append(Index(rows.column("item_id").to_pylist(), rows.column("text").to_pylist()))
    return out


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, distance, n_windows`` of every row of ``docs`` and item
    that contaminates it: the closest window (the first of them), in words, and how many windows match.
    Null and empty texts match nothing; repeated rows give repeated rows."""
    schema = "doc_id long, item_id long, start long, distance int, n_windows int"
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in indexes(benchmark):
        own = arrow_map(d, _rows(index), schema)
        out = own if out is None else out.unionByName(own)
    return d.sparkSession.createDataFrame([], schema) if out is None else out


def _rows(index: Index):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in by_size(texts):
                words, first = word_hashes(texts[a:b])
                text, item, start, dist = index.search(words, first)
                order = np.lexsort((start, dist, item, text))
                text, item, start, dist = text[order], item[order], start[order], dist[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
                at = np.flatnonzero(new)
                many = np.diff(np.append(at, len(text)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).take(pa.array(text[at])), pa.array(item[at]), pa.array(start[at] - first[text[at]]),
                     pa.array(dist[at].astype(np.int32)), pa.array(many.astype(np.int32))], ["doc_id", "item_id", "start", "distance", "n_windows"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all columns, that no item contaminates."""
    for index in indexes(benchmark):
        docs = arrow_map(docs, _keep(index), docs.schema)
    return docs


def _keep(index: Index):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keep = np.ones(len(texts), bool)
            for a, b in by_size(texts):
                keep[a + index.search(*word_hashes(texts[a:b]))[0]] = False
            yield batch.filter(pa.array(keep))
    return run
