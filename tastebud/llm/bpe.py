"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a piece the last token of its BPE encoding is unique.  An
automaton over the vocabulary gives the tokens that end at each position (the
suffixes of the prefix that are tokens); of these the one is right that may
stand after the last token of the prefix it leaves.  Two tokens may stand side
by side if no merge rule ever joins across their border while the rules run in
rank order.  Following the stored last tokens backwards gives the exact ids, in
time linear in the piece, without a merge queue.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, documents, ragged
from .textscan import column, keep_whole, piece_starts, spans
from .units import UnitCache, stretches

# Fixed value: the piece pattern of byte-level BPE.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NEVER = 1 << 40
#: Pair tests that a worker remembers.
PAIRS = 200_000


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the printable alphabet vocabulary files use for bytes:
    printable Latin-1 stands for itself, other bytes for 256, 257, ... in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Tables of a byte-level BPE file of the ``tokenizers`` library (JSON)."""

    def __init__(self, path: str, pattern: str = PIECES):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab, model = spec["model"]["vocab"], spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain byte-level BPE file")
        raw = {t: bytes(map(alphabet.__getitem__, t)) for t in vocab}
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes[i] = raw[t]
        for t, i in self.added.items():
            self.bytes[i] = t.encode()
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        made = {i for t, i in vocab.items() if len(raw[t]) == 1}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b, t = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((a, b), rank)
            if t not in made:
                made.add(t)
                self.rank[t], self.left[t], self.right[t] = rank, a, b
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            if i in made:
                self.automaton.add_word(raw[t].decode("latin-1"), (i, len(raw[t])))
        self.automaton.make_automaton()
        self.ok: dict[tuple[int, int], bool] = {}
        self.pieces = regex.compile(pattern)
        raw_added = sorted((a.encode() for a in self.added), key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, raw_added))) if raw_added else None
        self.cache = UnitCache(self._encode_units)
        self.decimal = list(map(str, range(size)))
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.flat_len = np.fromiter(map(len, self.bytes), np.int64, size)
        self.flat_start = np.cumsum(self.flat_len) - self.flat_len

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` can stand side by side in an encoding.

        The tokens at the border are taken apart from the latest merge to the
        earliest.  A rule that joins the two edges breaks the border if it comes
        before the merges that used up either edge; of two merges of one rank
        the left one comes first."""
        rank, merge = self.rank, self.merge
        used_a = used_b = _NEVER
        while True:
            r = merge.get((a, b), _NEVER)
            if r < used_a and r <= used_b and r != _NEVER:
                return False
            if rank[a] > rank[b]:
                used_a, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                used_b, b = rank[b], self.left[b]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        s = piece.encode().decode("latin-1")
        n, ok = len(s), self.ok
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for end, (t, k) in self.automaton.iter(s):
            end += 1
            if last[end] >= 0:
                continue
            if k < end:
                pair = (last[end - k], t)
                good = ok.get(pair)
                if good is None:
                    if len(ok) > PAIRS:
                        ok.clear()
                    good = ok[pair] = self.compatible(*pair)
                if not good:
                    continue
            last[end], size[end] = t, k
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _encode_units(self, units: list[bytes]) -> Iterator[list[int]]:
        find, added = self.pieces.findall, self.added
        for u in map(bytes.decode, units):
            yield [added[u]] if u in added else [i for p in find(u) for i in self.encode_piece(p)]

    def starts(self, buffer: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where units begin: at gaps, and on both sides of added tokens, which match anywhere in a text."""
        starts = piece_starts(buffer, edges)
        if self.find_added is None:
            return starts
        return keep_whole(starts, spans(buffer, edges, self.find_added), len(buffer))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the count of each."""
        return self.encode_bytes(*column(pa.array(texts, pa.large_string())))

    def encode_bytes(self, buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.cache.texts(buffer, edges, self.starts(buffer, edges))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.flat_start[ids], self.flat_len[ids])].tobytes()


_loaded: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """Tables of ``path``, kept for the life of the Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def _batches(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, ByteBPE]]:
    bpe = load(path)
    for batch in batches:
        buffer, edges = column(batch.column("text"))
        for a, b in stretches(edges):
            ids, counts = bpe.encode_bytes(buffer[edges[a]:edges[b]], edges[a:b + 1] - edges[a])
            yield batch.column("doc_id").slice(a, b - a), ids, counts, bpe


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every document, the ids that the tokenizers
    library gives with ``add_special_tokens=False``.  A null or empty text has no
    ids; repeated rows give repeated rows."""
    def run(batches):
        for doc, ids, counts, _ in _batches(batches, path):
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(offsets, ids.astype(np.int32))], ["doc_id", "ids"])
    return arrow_map(documents(docs), run, "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text.  Bytes that
    are no UTF-8 become U+FFFD, as in the library."""
    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(np.asarray(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return arrow_map(tokens.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every document, decode its ids again: ``doc_id, n_tokens, ids array<int>, ids_sha256``
    (decimal ids joined by commas) ``, decoded_sha256`` (UTF-8 of the decoded text)."""
    names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]

    def run(batches):
        for doc, ids, counts, bpe in _batches(batches, path):
            ends = np.cumsum(counts)
            flat, a = list(map(bpe.decimal.__getitem__, ids.tolist())), 0
            shas, texts = [], []
            for b in ends.tolist():
                shas.append(hashlib.sha256(",".join(flat[a:b]).encode()).hexdigest())
                text = bpe.decode(ids[a:b]).decode("utf-8", "replace")
                texts.append(hashlib.sha256(text.encode()).hexdigest())
                a = b
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([doc, pa.array(counts, pa.int64()), lists, pa.array(shas, pa.string()), pa.array(texts, pa.string())], names)
    return arrow_map(documents(docs), run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
