"""Exact substring removal over bytes by a collection Burrows-Wheeler transform.

The contents of a bucket (see ``repeats``) are a collection of short texts.  Its
transform is built column-wise: round t inserts, for every text longer than t, the
suffix of length t + 1 into the sorted list of all suffixes so far.  Where it goes
follows from the transform itself (the number of smaller symbols and of equal ones
before it), and the common prefix with its new neighbours is updated, here as far
as it matters: whether it reaches the window.  Suffixes that share a window are
then neighbours, and the smallest key of each such stretch decides.

A bucket's contents are parted by minimizer into collections of about ``TOGETHER``
bytes, since equal windows have equal minimizers.  A round's lists are arrays that
one sequential pass each replaces, and not files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .repeats import Chunk, Spec, covered, null_keys

WINDOW = 50
#: Bytes of a collection, about: its lists stay in a processor's cache.
TOGETHER = 1 << 18


def collection(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, suffix length, shares ``window`` bytes with the one before) of all non-empty
    suffixes in sorted order; a text's end is smaller than any byte, ends of equal suffixes
    are in order of their texts."""
    k = len(texts)
    size = np.fromiter(map(len, texts), np.int64, k)
    end = np.cumsum(size)
    total = int(size.sum())
    raw = b"".join(texts) + b"\0" * (window + 8)
    buffer = np.frombuffer(raw, np.uint8)
    words = np.ndarray(len(buffer) - 7, "<u8", raw, 0, (1,))  # eight bytes from any place
    steps = [*range(0, window - 7, 8), window - 8] if window >= 8 else []
    roomy = np.repeat(end, size) - np.arange(total) >= window  # a window fits between here and the text's end
    opens = np.zeros(total + 1, bool)
    opens[(end - size)[size > 0]] = True
    # bytes as dense codes, so that one byte has room for "no byte before" as the largest code
    dense = np.cumsum(np.bincount(buffer[:total], minlength=256) > 0) - 1
    ended = int(dense[-1]) + 1
    coded = dense.astype(np.uint8 if ended < 256 else np.uint16)[buffer]

    def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        if not steps:
            for i in range(window):
                same &= buffer[a + i] == buffer[b + i]
        for i in steps:
            same[same] = words[a[same] + i] == words[b[same] + i]
        return same

    # the list starts with the k empty suffixes; of each suffix: where it starts, the symbol before it
    place = end.astype(np.int32 if total < 1 << 31 else np.int64)
    before = np.where(size > 0, coded[np.maximum(end - 1, 0)], ended).astype(coded.dtype)
    fresh = before != ended  # suffixes of the last round that the next one makes longer
    shares = np.zeros(k, bool)
    for t in range(int(size.max(initial=0))):
        order = pc.array_sort_indices(pa.array(before)).to_numpy().view(np.int64)  # stable, by counting
        rank = np.flatnonzero(fresh[order])
        new = place[order[rank]] - 1
        goes = k + rank  # place in the list that has the new suffixes too
        n = len(before) + len(new)
        old = np.ones(n, bool)
        old[goes] = False
        more = np.where(opens[new], ended, coded[new - 1])
        merged = []
        for was, put in ((place, new), (before, more), (shares, False)):
            both = np.empty(n, was.dtype)
            both[old], both[goes] = was, put
            merged.append(both)
        place, before, shares = merged
        fresh = np.zeros(n, bool)
        fresh[goes] = more != ended
        if t + 1 >= window:
            for p in (goes, goes[goes + 1 < n] + 1):
                p = p[p > k]
                p = p[roomy[place[p]] & roomy[place[p - 1]]]
                shares[p] = alike(place[p - 1], place[p])
    place = place[k:]
    text = np.searchsorted(end, place, "right")
    return text, end[text] - place, shares[k:]


def solve(contents: list[bytes], windows: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """Of each window: does it occur in a content of a smaller key?"""
    text, length, shares = collection(contents, WINDOW)
    keep = length >= WINDOW
    group = np.cumsum(~shares)[keep]
    text, length = text[keep], length[keep]
    out = np.zeros(int(windows.sum()), bool)
    if len(text):
        edge = np.flatnonzero(np.diff(group, prepend=-1))
        least = np.minimum.reduceat(doc[text], edge)
        place = (np.cumsum(windows) - windows)[text] + windows[text] + WINDOW - 1 - length
        out[place] = np.repeat(least, np.diff(np.append(edge, len(text)))) < doc[text]
    return np.split(out, np.cumsum(windows)[:-1])


SPEC = Spec(window=WINDOW, log_gram=5, words=False, by_position=False, together=TOGETHER)


def _finish(chunk: Chunk, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    edges = chunk.first
    size = np.diff(edges)
    total = np.concatenate([[0], np.cumsum(gone)])
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[edges[:-1][size > 0]] = gone[edges[:-1][size > 0]]
    spans = np.concatenate([[0], np.cumsum(opens)])
    kept = chunk.buffer[~gone].tobytes()
    cut = edges - total[edges]
    yield pa.RecordBatch.from_arrays(
        [null_keys(chunk.docs), pa.array(size, pa.int64()), pa.array(np.diff(total[edges]), pa.int64()), pa.array(np.diff(spans[edges]), pa.int64()),
         pa.array([kept[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) of every row: the text without
    each byte covered by a 50-byte string that also starts in a document of a smaller key.

    Texts are their UTF-8 bytes, so ``kept`` may break a character.  A null text is
    empty.  A null key is smaller than any other; rows of equal keys are one document's
    and don't remove from each other."""
    return covered(docs, SPEC, solve, _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
