"""Words of many texts at once, as arrays over one byte buffer."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

# Fixed value: white space in ASCII, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Fixed value: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of uint64."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer with a line feed after each; where each begins, and the end."""
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), edges


def column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and where each text begins, and the end; nothing is copied."""
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), edges


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int8)  # 0: beyond ASCII, or a control character
    kind[0x21:0x7F] = _PUNCTUATION
    for first, last, k in (("a", "z", _LETTER), ("A", "Z", _LETTER), ("0", "9", _DIGIT), ("'", "'", _APOSTROPHE)):
        kind[ord(first):ord(last) + 1] = k
    return kind


_LETTER, _DIGIT, _PUNCTUATION, _APOSTROPHE = 1, 2, 3, 4
_KIND = _kinds()
_CHANGE = np.zeros((5, 5), bool)
_CHANGE[[_LETTER, _LETTER, _LETTER, _DIGIT, _DIGIT, _DIGIT, _PUNCTUATION, _PUNCTUATION],
        [_DIGIT, _PUNCTUATION, _APOSTROPHE, _LETTER, _PUNCTUATION, _APOSTROPHE, _LETTER, _DIGIT]] = True


def changes(buffer: np.ndarray) -> np.ndarray:
    """Whether a run of ASCII letters, digits or marks ends before the byte and another begins: a
    piece of BPE ends there (an apostrophe may belong to the letters after it)."""
    out = np.zeros(len(buffer), bool)
    kind = _KIND[buffer]
    out[1:] = _CHANGE.ravel()[kind[:-1] * 5 + kind[1:]]
    return out


def piece_starts(buffer: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where texts begin, and where inside them no piece of byte-level BPE reaches across: at
    :func:`changes` and where white space follows something else.  Unsure cases (after what
    may be wide white space) are left out."""
    maybe = SPACE[buffer] | ((buffer >= 0x1C) & (buffer <= 0x1F))
    cut = SPACE[buffer]
    cut[1:] &= ~maybe[:-1]
    after = np.flatnonzero(cut)
    after = after[after >= 3]
    prev = buffer[after - 1]
    wide = (prev >= 0x80) & ((buffer[after - 2] == 0xC2) & ((prev == 0x85) | (prev == 0xA0))
                             | np.isin(buffer[after - 3], (0xE1, 0xE2, 0xE3)))
    cut[after[wide]] = False
    cut[:3] = False
    cut |= changes(buffer)
    cut[edges[:-1][edges[:-1] < edges[1:]]] = True
    return np.flatnonzero(cut)


def spans(buffer: np.ndarray, edges: np.ndarray, pattern: re.Pattern) -> np.ndarray:
    """Start and end of every match inside one text, as rows."""
    found = np.array([m.span() for m in pattern.finditer(buffer.data)], np.int64).reshape(-1, 2)
    if not len(found):
        return found
    found = [(a + i, a + j) for a, b in zip(edges.tolist(), edges[1:].tolist()) for i, j in (m.span() for m in pattern.finditer(buffer[a:b].data))]
    return np.array(found, np.int64).reshape(-1, 2)


def keep_whole(starts: np.ndarray, found: np.ndarray, end: int) -> np.ndarray:
    """``starts`` with both sides of every span (but the end of the last text) and nothing inside one."""
    if not len(found):
        return starts
    k = np.searchsorted(found[:, 0], starts, "left") - 1
    inside = (k >= 0) & (starts < found[k, 1])
    sides = found.ravel()
    return np.union1d(starts[~inside], sides[sides < end])


def words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (a maximal run without ASCII white space)."""
    space = SPACE[buffer]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: equal words have equal hashes."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):  # in stretches of bounded length, or one word
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + (1 << 20), "right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        n = hi - lo
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_BASE))]))
        total = np.concatenate([[np.uint64(0)], np.cumsum((buffer[lo:hi].astype(np.uint64) + np.uint64(1)) * power[:n])])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_INVERSE))]))
        out[a:b] = mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))
        a = b
    return out
