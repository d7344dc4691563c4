"""Simple-8b: word-aligned coding of unsigned integers.

A 64-bit word holds a 4-bit selector and up to 60 data bits: as many equal-width
values as the selector says.  A stream is cut into blocks of ``BLOCK`` values;
the header holds each block's first word and first escape, so any block can be
decoded alone and all blocks together in a few array operations.  Values of 30
bits and more are written as the escape code (30 one bits) and kept whole, in
order, in the escape list.

Layout, little endian: ``b"S8B1"``, u32 block size, u64 values, u32 blocks, u32 0,
then u32 first word and u32 first escape of each block and of the end, padded to
8 bytes, u64 words, u64 escapes.
"""

from __future__ import annotations

import struct

import numpy as np

# Values in a word and their width, by selector.
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

BLOCK = 1 << 12
ESCAPE = (1 << 30) - 1
MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sIQII")


def encode(values: np.ndarray) -> bytes:
    """The stream of ``values`` (any unsigned integers)."""
    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    blocks = -(-n // BLOCK)
    over = v >= ESCAPE
    escapes, code = v[over], np.where(over, np.uint64(ESCAPE), v)
    bits = np.zeros(n + 240, np.int8)  # as if zeros followed: the last word may be part empty
    bits[:n] = np.frexp(code.astype(np.float64))[1]  # bits of a whole number below 2^53; 0 for 0
    best = {1: bits}  # maximum of the p bits from each position
    for p in (2, 4, 8, 16, 32, 64, 128):
        best[p] = np.maximum(best[p // 2], np.append(best[p // 2][p // 2:], np.zeros(p // 2, np.int8)))
    sel = np.full(n, 15, np.int8)
    for s in range(14, -1, -1):
        c = int(COUNT[s])
        p = 1 << (c.bit_length() - 1)
        sel[np.maximum(best[p][:n], best[p][c - p:c - p + n]) <= WIDTH[s]] = s
    at = np.arange(n)
    step = np.minimum(at + COUNT[sel], (at // BLOCK + 1) * BLOCK).tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i = step[i]
    start = np.array(starts, np.int64)
    used = sel[start]
    words = np.empty(len(start), np.uint64)
    padded = np.concatenate([code, np.zeros(240, np.uint64)])
    block_end = np.minimum((start // BLOCK + 1) * BLOCK, n)
    for s in np.unique(used):
        own = np.flatnonzero(used == s)
        c, w = int(COUNT[s]), int(WIDTH[s])
        word = np.full(len(own), np.uint64(int(s) << 60))
        if w:
            for k in range(c):
                at = start[own] + k
                word |= np.where(at < block_end[own], padded[at], np.uint64(0)) << np.uint64(w * k)
        words[own] = word
    edges = np.arange(blocks + 1) * BLOCK
    first_word = np.searchsorted(start, edges).astype(np.uint32)
    first_escape = np.searchsorted(np.flatnonzero(over), edges).astype(np.uint32)
    head = _HEAD.pack(MAGIC, BLOCK, n, blocks, 0) + first_word.tobytes() + first_escape.tobytes()
    return head + b"\0" * (-len(head) % 8) + words.tobytes() + escapes.tobytes()


def _header(data: bytes):
    magic, size, n, blocks, _ = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b stream")
    at = _HEAD.size
    word = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
    escape = np.frombuffer(data, "<u4", blocks + 1, at + 4 * (blocks + 1)).astype(np.int64)
    at += 8 * (blocks + 1)
    return size, n, word, escape, at + -at % 8


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Values (uint64) of blocks ``first`` to ``last - 1``, by default all."""
    size, n, word, escape, at = _header(data)
    last = len(word) - 1 if last is None else last
    words = np.frombuffer(data, "<u8", word[last] - word[first], at + 8 * word[first])
    escapes = np.frombuffer(data, "<u8", escape[last] - escape[first], at + 8 * (word[-1] + escape[first]))
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[sel]
    ends = word[first + 1:last + 1] - word[first] - 1  # each block's last word may hold less
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    if len(ends):
        block_of = np.zeros(len(words), np.int64)
        block_of[(word[first:last] - word[first])[1:]] = 1
        block_of = np.cumsum(block_of)
        begin = begin - begin[(word[first:last] - word[first])][block_of]
        lengths = np.minimum(size, n - np.arange(first, last) * size)
        counts = counts.copy()
        counts[ends] = lengths - begin[ends]
        begin = begin + (np.arange(last - first) * size)[block_of]
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(sel):
        w = int(WIDTH[s])
        if not w:
            continue
        own = np.flatnonzero(sel == s)
        mask = np.uint64((1 << w) - 1)
        for k in range(int(COUNT[s])):
            has = own[counts[own] > k]
            out[begin[has] + k] = (words[has] >> np.uint64(w * k)) & mask
    if len(escapes):
        out[out == ESCAPE] = escapes
    return out
