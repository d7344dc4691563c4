"""A cache from text units to token ids, bounded in bytes, and the assembly of whole texts from it.

Natural text repeats its words, so a task encodes each distinct unit once and a
text becomes a gather from a flat id array.  Units are spans of one byte buffer:
they are hashed, looked up and compared byte by byte as arrays, without an object
for any of them.  A cache lives as long as its Python worker and is emptied
when it outgrows ``limit`` bytes, which only costs encoding again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np

from . import textscan
from .common import ragged
from .hashtable import HashTable

#: Longer units (in bytes) are encoded each time.
LONGEST_KEPT = 256
#: Bytes of text that are encoded at a time, one text at least.
STRETCH = 1 << 20


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a) // 2), a.dtype)])


class UnitCache:
    """``encode`` maps a list of distinct units (UTF-8) to a list of id lists."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[list[int]]], limit: int = 48 << 20):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.table = HashTable()
        self.flat, self.text = np.zeros(1 << 14, np.uint32), np.zeros(1 << 14, np.uint8)
        self.id_end, self.text_end = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)  # entry 0: where the first begins

    @property
    def nbytes(self) -> int:
        return self.table.nbytes + sum(a.nbytes for a in (self.flat, self.text, self.id_end, self.text_end))

    def _add(self, hashes: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        n, k = self.table.n, len(starts)
        got = list(self.encode([buffer[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]))
        counts, lens = np.fromiter(map(len, got), np.int64, k), ends - starts
        self.id_end, self.text_end = _room(self.id_end, n + k + 1), _room(self.text_end, n + k + 1)
        self.id_end[n + 1:n + k + 1] = self.id_end[n] + np.cumsum(counts)
        self.text_end[n + 1:n + k + 1] = self.text_end[n] + np.cumsum(lens)
        used, upto = int(self.id_end[n]), int(self.id_end[n + k])
        self.flat = _room(self.flat, upto)
        self.flat[used:upto] = np.fromiter(chain.from_iterable(got), np.uint32, upto - used)
        used, upto = int(self.text_end[n]), int(self.text_end[n + k])
        self.text = _room(self.text, upto)
        self.text[used:upto] = buffer[ragged(starts, lens)]
        self.table.add(hashes, np.arange(n, n + k, dtype=np.int32))

    def ids(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, concatenated, and the count of each."""
        if self.nbytes > self.limit:
            self.clear()
        lens = ends - starts
        h = textscan.hashes(buffer, starts, ends)
        h[h == 0] = 1
        slot = self.table.find(h)
        new = np.flatnonzero((slot < 0) & (lens <= LONGEST_KEPT))
        if len(new):
            own, first = np.unique(h[new], return_index=True)
            self._add(own, buffer, starts[new[first]], ends[new[first]])
            slot[new] = self.table.find(h[new])
        # the bytes decide, not the hash
        known = np.flatnonzero(slot >= 0)
        at = slot[known]
        good = self.text_end[at + 1] - self.text_end[at] == lens[known]
        known, at = known[good], at[good]
        same = buffer[ragged(starts[known], lens[known])] == self.text[ragged(self.text_end[at], lens[known])]
        if not same.all():
            good = np.ones(len(known), bool)
            good[np.repeat(np.arange(len(known)), lens[known])[~same]] = False
            known, at = known[good], at[good]
        start, count, flat = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), self.flat
        start[known], count[known] = self.id_end[at], self.id_end[at + 1] - self.id_end[at]
        if len(known) < len(starts):
            rest = np.ones(len(starts), bool)
            rest[known] = False
            rest = np.flatnonzero(rest)
            got = list(self.encode([buffer[a:b].tobytes() for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]))
            count[rest] = np.fromiter(map(len, got), np.int64, len(got))
            used = int(self.id_end[self.table.n])
            start[rest] = used + np.cumsum(count[rest]) - count[rest]
            flat = np.concatenate([flat[:used], np.fromiter(chain.from_iterable(got), np.uint32, int(count[rest].sum()))])
        return flat[ragged(start, count)], count

    def texts(self, buffer: np.ndarray, edges: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the count of each.  Text i is
        ``buffer[edges[i]:edges[i + 1]]``; units begin at ``starts`` (ascending) and end at ``ends``,
        by default where the next one begins (each text's beginning must then be among the starts)."""
        ids, count = self.ids(buffer, starts, np.append(starts[1:], edges[-1])[:len(starts)] if ends is None else ends)
        return ids, np.diff(np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, edges)])


def stretches(edges: np.ndarray, most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``most`` bytes together, one text at least."""
    a = 0
    while a < len(edges) - 1:
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + most, "right")) - 1)
        yield a, b
        a = b


def by_size(texts: list[str], most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` characters together, one text at least."""
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > most:
            yield a, b
            a, size = b, 0
        size += len(t)
    if texts:
        yield a, len(texts)
