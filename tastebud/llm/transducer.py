"""Minimal acyclic transducers: a sorted list of terms as an automaton that gives a term's position.

Terms are added in byte order; the states that no later term can change are replaced by
equal ones seen before, so the automaton is minimal when the last is in.  Each
state knows how many terms pass from it, each edge how many come before it, and the edge
numbers along a term add up to its ordinal.  Edges are kept in an open-addressed table,
and many terms walk at once, a byte of each in a step.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Sequence

import numpy as np

from .hashtable import HashTable
from .textscan import mix

_HEAD = struct.Struct("<4sIQQ")
MAGIC = b"MAT1"


class _State:
    __slots__ = ("edges", "final", "number")

    def __init__(self):
        self.edges: list[list] = []  # [byte, state], ascending
        self.final, self.number = False, -1


def build(terms: Iterable[bytes]) -> bytes:
    """The transducer of distinct, non-empty terms in ascending byte order."""
    register: dict[tuple, _State] = {}
    states: list[_State] = []  # those replaced or kept, children before parents
    path = [_State()]
    last, n = b"", 0

    def settle(depth: int) -> None:
        """Replace what hangs below the state at ``depth`` of the last term's path, deepest first."""
        while len(path) - 1 > depth:
            child = path.pop()
            key = (child.final, *((b, s.number) for b, s in child.edges))
            same = register.get(key)
            if same is None:
                child.number = len(states)
                states.append(child)
                register[key] = child
            else:
                path[-1].edges[-1][1] = same

    for term in terms:
        if term <= last:
            raise ValueError("terms are not in ascending order")
        shared = 0
        for x, y in zip(term, last):
            if x != y:
                break
            shared += 1
        settle(shared)
        for b in term[shared:]:
            state = _State()
            path[-1].edges.append([b, state])
            path.append(state)
        path[-1].final = True
        last, n = term, n + 1
    settle(0)
    root = path[0]
    root.number = len(states)
    states.append(root)
    below = np.zeros(len(states), np.int64)  # terms from the state on
    source, byte, target, before = [], [], [], []
    for s in states:
        seen = int(s.final)
        for b, t in s.edges:
            source.append(s.number)
            byte.append(b)
            target.append(t.number)
            before.append(seen)
            seen += int(below[t.number])
        below[s.number] = seen
    final = np.packbits(np.fromiter((s.final for s in states), bool, len(states)))
    arrays = [np.array(source, "<u4"), np.array(byte, "u1"), np.array(target, "<u4"), np.array(before, "<u4"), final]
    return _HEAD.pack(MAGIC, len(states), len(source), n) + b"".join(a.tobytes() for a in arrays)


class Transducers:
    """Several transducers side by side, for walking terms through each's own."""

    def __init__(self, blobs: Sequence[bytes]):
        source, byte, target, before, final, roots, self.sizes = [], [], [], [], [], [], []
        base = 0
        for blob in blobs:
            magic, states, edges, n = _HEAD.unpack_from(blob)
            if magic != MAGIC:
                raise ValueError("not a transducer")
            at = _HEAD.size
            for out, kind, shift in ((source, "<u4", base), (byte, "u1", 0), (target, "<u4", base), (before, "<u4", 0)):
                part = np.frombuffer(blob, kind, edges, at)
                out.append(part.astype(np.int64) + shift)
                at += part.nbytes
            final.append(np.unpackbits(np.frombuffer(blob, "u1", -(-states // 8), at), count=states).astype(bool))
            base += states
            roots.append(base - 1)
            self.sizes.append(n)
        join = lambda x, kind: np.concatenate([np.zeros(0, kind), *x]).astype(kind)
        self.source, self.byte, self.target, self.before = join(source, np.int64), join(byte, np.int64), join(target, np.int64), join(before, np.int64)
        self.final, self.roots = join(final, bool), np.array(roots, np.int64)
        self.edges = HashTable()
        self.edges.add(self._key(self.source, self.byte), np.arange(len(self.source), dtype=np.int32))
        self.first = np.searchsorted(self.source, np.arange(base + 1))  # sources ascend: a state's edges

    @staticmethod
    def _key(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return mix(((state << 8) | byte).astype(np.uint64) + np.uint64(1))  # mixing is one to one; zero only for zero

    def ordinals(self, which: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of every span of ``buffer`` in transducer ``which``, -1 if it is no term of it or that is negative."""
        out = np.full(len(starts), -1, np.int64)
        todo = np.flatnonzero(which >= 0)
        state, number, at, end = self.roots[which[todo]], np.zeros(len(todo), np.int64), starts[todo], ends[todo]
        while len(todo):
            done = np.flatnonzero(at == end)
            good = done[self.final[state[done]]]
            out[todo[good]] = number[good]
            go = np.flatnonzero(at < end)
            edge = self.edges.find(self._key(state[go], buffer[at[go]].astype(np.int64)))
            go, edge = go[edge >= 0], edge[edge >= 0]
            todo, state, number, at, end = todo[go], self.target[edge], number[go] + self.before[edge], at[go] + 1, end[go]
        return out

    def term(self, which: int, ordinal: int) -> bytes:
        """The term of an ordinal."""
        state, out = int(self.roots[which]), bytearray()
        while not (self.final[state] and ordinal == 0):
            a, b = int(self.first[state]), int(self.first[state + 1])
            edge = a + int(np.searchsorted(self.before[a:b], ordinal, "right")) - 1
            out.append(int(self.byte[edge]))
            ordinal -= int(self.before[edge])
            state = int(self.target[edge])
        return bytes(out)
