"""An open-addressed hash table from mixed 64-bit keys to numbers, probed and filled with arrays."""

from __future__ import annotations

import numpy as np


class HashTable:
    """Keys are hashed already (their low bits choose the place) and not zero."""

    def __init__(self, bits: int = 12):
        self.keys, self.values, self.n = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.values.nbytes

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of every key, -1 where there is none."""
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(keys), -1, np.int64)
        todo, k, at = np.arange(len(keys)), keys, keys & mask
        while len(todo):
            got = self.keys[at]
            hit = got == k
            out[todo[hit]] = self.values[at[hit]]
            go = np.flatnonzero(~hit & (got != 0))
            todo, k, at = todo[go], k[go], (at[go] + np.uint64(1)) & mask
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New, distinct keys."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            old = np.flatnonzero(self.keys)
            k, v = self.keys[old], self.values[old]
            bits = (2 * (self.n + len(keys))).bit_length()
            self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
            self._put(k, v)
        self._put(keys, values)
        self.n += len(keys)

    def _put(self, k: np.ndarray, v: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at = k & mask
        while len(k):
            free = np.flatnonzero(self.keys[at] == 0)
            self.keys[at[free]] = k[free]  # of several keys for one place the last stays
            won = self.keys[at] == k
            self.values[at[won]] = v[won]
            go = np.flatnonzero(~won)
            k, v, at = k[go], v[go], (at[go] + np.uint64(1)) & mask
