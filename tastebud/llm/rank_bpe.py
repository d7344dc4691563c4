"""Byte-level BPE from a file of ranks, run by the tokenizers library, with byte offsets, and decoding.

A rank file names byte strings only.  Every pair of them that makes a third is a
merge whose turn is the rank of what it makes, so the library's model is built from the
ranks: bytes become the printable characters of :func:`.bpe.byte_alphabet`, one a
byte, and offsets in such a text are byte offsets.  Pieces are cut by the pattern, as bytes
mapped and handed to the library as words of their own; a piece that has a rank itself is
that token.  Decoding gathers each id's bytes from a table made by the reversed
mapping; a character that is split over tokens belongs to the token that ends it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import PIECES, byte_alphabet
from .common import arrow_map, documents, ragged
from .textscan import column, piece_starts
from .units import UnitCache, stretches


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> rank, of a file with a base64 string and a rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merges(ranks: dict[bytes, int]) -> Iterator[tuple[bytes, bytes]]:
    """All pairs in the order they merge: by the rank of what they make.

    Of two overlapping places that make the same string the left one comes first.
    They overlap in a string that ends the one and begins the other, ``x y z`` with
    ``xy = yz``: there the cut behind ``x`` must come before the cut behind ``y``."""
    for t in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
        cuts = [i for i in range(len(t) - 1, 0, -1) if t[:i] in ranks and t[i:] in ranks]
        own = set(cuts)
        # a cut at i (before a border of that length) goes after the cut at len - i
        late = {i for i in own if len(t) - i in own and 2 * i != len(t) and t[:i] == t[-i:]}
        late -= {i for i in late if len(t) - i in late}  # both are borders: a power of one string, longer left part first
        for i in [i for i in cuts if i not in late] + [i for i in cuts if i in late]:
            yield t[:i], t[i:]


class RankBPE:
    def __init__(self, path: str, pattern: str = PIECES):
        import regex
        from tokenizers import Tokenizer, models

        ranks = read_ranks(path)
        letter = {b: c for c, b in byte_alphabet().items()}
        self.table = {b: ord(c) for b, c in letter.items()}  # for str.translate of Latin-1
        spell = lambda t: t.decode("latin-1").translate(self.table)
        self.lib = Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=[(spell(a), spell(b)) for a, b in merges(ranks)],
                                        cache_capacity=0, ignore_merges=True))
        self.pieces = regex.compile(pattern)
        self.cache = UnitCache(self._encode_units)
        size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        back = byte_alphabet()
        for t, i in self.lib.get_vocab().items():
            self.bytes[i] = bytes(map(back.__getitem__, t))
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.flat_len = np.fromiter(map(len, self.bytes), np.int64, size)
        self.flat_start = np.cumsum(self.flat_len) - self.flat_len

    def _encode_units(self, units: list[bytes]) -> Iterator[list[int]]:
        find, table = self.pieces.findall, self.table
        for a in range(0, len(units), 1024):
            cut = [find(u.decode()) for u in units[a:a + 1024]]
            words = [p.encode().decode("latin-1").translate(table) for c in cut for p in c]
            got = self.lib.encode(words, is_pretokenized=True, add_special_tokens=False)
            ids, word = got.ids, np.array(got.word_ids, np.int64)
            edges = np.searchsorted(word, np.cumsum([0, *map(len, cut)])).tolist()
            for x, y in zip(edges, edges[1:]):
                yield ids[x:y]

    def encode_bytes(self, buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (``buffer[edges[i]:edges[i + 1]]``), concatenated, and the count of each."""
        return self.cache.texts(buffer, edges, piece_starts(buffer, edges))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_bytes(*column(pa.array(texts, pa.large_string())))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.flat_start[ids], self.flat_len[ids])].tobytes()

    def decode_tokens(self, ids: np.ndarray) -> list[str]:
        """A string for each token; joined they are the text.  A token that ends inside a
        character leaves its bytes to the next; what is no UTF-8 becomes U+FFFD."""
        import codecs
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        out = [decoder.decode(self.bytes[i]) for i in ids]
        rest = decoder.decode(b"", True)
        return out[:-1] + [out[-1] + rest] if out else out


_loaded: dict[str, RankBPE] = {}


def load(path: str) -> RankBPE:
    """The model of ``path``, kept for the life of the Python worker."""
    if path not in _loaded:
        _loaded[path] = RankBPE(path)
    return _loaded[path]


def _batches(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, RankBPE]]:
    model = load(path)
    for batch in batches:
        buffer, edges = column(batch.column("text"))
        for a, b in stretches(edges):
            ids, counts = model.encode_bytes(buffer[edges[a]:edges[b]], edges[a:b + 1] - edges[a])
            yield batch.column("doc_id").slice(a, b - a), ids, counts, model


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), values.astype(np.int32))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>, starts array<int>``: the ids of every text, and the byte of
    the text's UTF-8 that each token begins with.  A null or empty text has none; strings that look like
    special tokens are ordinary text; repeated rows give repeated rows, null keys stay."""
    def run(batches):
        for doc, ids, counts, model in _batches(batches, path):
            ends = np.cumsum(counts)
            upto = np.concatenate([[0], np.cumsum(model.flat_len[ids])])
            starts = upto[:-1] - np.repeat(upto[ends - counts], counts)
            yield pa.RecordBatch.from_arrays([doc, _lists(ends, ids), _lists(ends, starts)], ["doc_id", "ids", "starts"])
    return arrow_map(documents(docs), run, "doc_id long, ids array<int>, starts array<int>")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text, bytes that are no UTF-8 U+FFFD."""
    def run(batches):
        model = load(path)
        for batch in batches:
            texts = [model.decode(np.asarray(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return arrow_map(tokens.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every document and decode its ids again: ``doc_id, n_tokens, ids_sha256`` (of the ids
    as little-endian u32) ``, decoded_sha256`` (of the decoded bytes).  Rows as in :func:`encode_documents`."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        for doc, ids, counts, model in _batches(batches, path):
            ends = np.cumsum(counts)
            upto = np.concatenate([[0], np.cumsum(model.flat_len[ids])])
            raw, text = memoryview(ids.astype("<u4").tobytes()), memoryview(model.decode(ids))
            shas, texts = [], []
            for n, b in zip(counts.tolist(), ends.tolist()):
                shas.append(hashlib.sha256(raw[4 * (b - n):4 * b]).hexdigest())
                texts.append(hashlib.sha256(text[upto[b - n]:upto[b]]).hexdigest())
            yield pa.RecordBatch.from_arrays([doc, pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], names)
    return arrow_map(documents(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
