"""Exact substring removal over words by suffix automata.

Each bucket of contents (see ``repeats``), parted by minimizer if it is large, is a
reference shard.  Its suffix automaton takes in the contents in order of document and
place; what a content has in common with all that came before it (the matching
statistics: for every word the longest stretch ending there that occurred earlier)
comes from the automaton as the content streams through.  A statistic of at least the
window's length marks the window that ends there, and maximal stretches of marked
words go.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import Chunk, Spec, covered, null_keys

WINDOW = 20
#: Bytes of the contents of one automaton, about: its states take some sixty times that.
TOGETHER = 1 << 21


class SuffixAutomaton:
    """Generalised suffix automaton over any hashable symbols."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.len = [0]

    def feed(self, symbols: Iterable) -> list[int]:
        """Add a text; of each of its symbols the length of the longest stretch ending there
        that ended somewhere earlier, in the text itself or in one before."""
        nexts, link, length = self.next, self.link, self.len
        last, out = 0, []
        for c in symbols:
            at = nexts[last].get(c)
            if at is not None and length[at] == length[last] + 1:  # the whole text so far was seen
                last = at
                out.append(length[at])
                continue
            if at is not None:  # seen, but only inside longer stretches
                last = self._split(last, c, at)
                out.append(length[last])
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new
            out.append(length[link[new]])
        return out

    def _split(self, p: int, c, q: int) -> int:
        """Part the state ``q`` at the length that ``p`` gives it."""
        nexts, link, length = self.next, self.link, self.len
        clone = len(nexts)
        nexts.append(nexts[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def match(self, symbols: Iterable) -> list[int]:
        """Matching statistics of a text that is not added."""
        at = n = 0
        out = []
        for c in symbols:
            while at and c not in self.next[at]:
                at = self.link[at]
                n = self.len[at]
            if c in self.next[at]:
                at, n = self.next[at][c], n + 1
            out.append(n)
        return out


def solve(contents: list[bytes], windows: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """Of each window: does it occur earlier, in order of (doc, pos)?"""
    automaton, out, known = SuffixAutomaton(), [], {}
    for c, d, p in zip(contents, doc.tolist(), pos.tolist()):
        if (c, d, p) not in known:  # else a repeated row's: neither is earlier
            known = {k: v for k, v in known.items() if k[1:] == (d, p)}
            known[c, d, p] = np.array(automaton.feed(c.split())[WINDOW - 1:]) >= WINDOW
        out.append(known[c, d, p])
    return out


SPEC = Spec(window=WINDOW, log_gram=3, words=True, by_position=True, together=TOGETHER)


def _finish(chunk: Chunk, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    edges = chunk.first
    total = np.concatenate([[0], np.cumsum(gone)])
    raw, kept = chunk.raw, []
    starts, ends = chunk.starts.tolist(), chunk.ends.tolist()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if total[b] == total[a]:
            words = raw[starts[a]:ends[b - 1]].split() if b > a else []
        else:
            words = [raw[starts[i]:ends[i]] for i in (np.flatnonzero(~gone[a:b]) + a).tolist()]
        kept.append(b" ".join(words).decode())
    yield pa.RecordBatch.from_arrays(
        [null_keys(chunk.docs), pa.array(np.diff(edges), pa.int64()), pa.array(np.diff(total[edges]), pa.int64()), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row: the words, joined by single
    spaces, without each word covered by a 20-word window that also starts earlier (in a document
    of a smaller key, or before in the same one).

    Null texts have no words.  A null key is smaller than any other; rows of equal keys
    are one document's, and of windows at the same place none is earlier."""
    return covered(docs, SPEC, solve, _finish, "doc_id long, n_words long, n_removed long, kept string")
