"""BPE, Simple-8b and token files against the tokenizers library and exact round trips."""

import hashlib
import zlib

import numpy as np
import pytest

from tastebud.llm import bpe, queries, rank_bpe, simple8b, textscan, token_output, units
from tests.llm.conftest import rows

BYTE, WORD = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("word_bpe_49k.json")


def library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def test_byte_bpe_equals_library(nasty):
    t = library(BYTE)
    want = sorted(((i if i is not None else -99), len(e := t.encode(x or "", add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(),
                   hashlib.sha256(t.decode(e, skip_special_tokens=False).encode()).hexdigest()) for i, x, *_ in rows())
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -99), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(nasty, BYTE).collect())
    assert got == want


def test_every_vocabulary_entry_encodes_as_in_the_library():
    tables, t = bpe.load(BYTE), library(BYTE)
    texts = [b.decode() for b in tables.bytes if b.decode("utf-8", "ignore").encode() == b]
    ids, n = tables.encode(texts)
    ends = np.cumsum(n)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_decode_inverts_encode(nasty):
    got = bpe.decode_documents(bpe.encode_documents(nasty, BYTE), BYTE).collect()
    assert sorted((r["doc_id"] or -99, r["text"]) for r in got) == sorted((i or -99, x or "") for i, x, *_ in rows())


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 239, 240, 241, 4095, 4096, 4097, 9000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2 ** 30 + 5, 2 ** 63])
def test_simple8b_round_trip(n, high):
    v = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    v[::7] = 0
    data = simple8b.encode(v)
    assert (simple8b.decode(data) == v).all()
    if n > 8192:
        assert (simple8b.decode(data, 1, 2) == v[4096:8192]).all()


def test_token_files(spark, nasty, tmp_path):
    path = f"{tmp_path}/tokens"
    tied = "text = 'another text of the same key' or (doc_id is null and text is not null)"  # of a key with two texts
    token_output.write_tokens(nasty.where(f"not coalesce({tied}, false)"), path, WORD, 2, segment=500)
    t = library(WORD)
    data = sorted(((i is not None, i or 0), x or "") for i, x, *_ in rows() if x != "another text of the same key" and (i is not None or x is None))
    want, at = [], 0
    for (has, i), x in data:
        ids = [*t.encode(x, add_special_tokens=False).ids, 2]
        want.append((i if has else None, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r) for r in token_output.read_digests(spark, path).orderBy("start").collect()]
    assert got == want
    assert sum(len(r["ids"]) for r in token_output.read_documents(spark, path).collect()) == at


RANKS = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")


def tiktoken_library():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=bpe.PIECES, mergeable_ranks=rank_bpe.read_ranks(RANKS), special_tokens={})


def test_rank_bpe_equals_library(nasty):
    t = tiktoken_library()
    want = sorted(((i if i is not None else -99), len(e := t.encode_ordinary(x or "")), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.decode_bytes(e)).hexdigest()) for i, x, *_ in rows())
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -99), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                  for r in rank_bpe.round_trip(nasty, RANKS).collect()) == want


def test_rank_bpe_offsets_and_decoding(nasty):
    t, model = tiktoken_library(), rank_bpe.load(RANKS)
    tokens = rank_bpe.encode_documents(nasty, RANKS)
    text = {(i, x or "") for i, x, *_ in rows()}
    for r in tokens.collect():
        at = np.cumsum([0, *(len(t.decode_single_token_bytes(i)) for i in r["ids"])])[:-1].tolist()
        assert r["starts"] == at
        parts = model.decode_tokens(r["ids"])
        assert len(parts) == len(r["ids"]) and (r["doc_id"], "".join(parts)) in text  # also of characters split over tokens
    assert {(r["doc_id"], r["text"]) for r in rank_bpe.decode_documents(tokens, RANKS).collect()} == text


def odd_texts():
    import random
    r = random.Random(0)
    out = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))) for _ in range(500)]
    out += [r.choice("aeotx=-*é日' ") * r.randint(1, 80) for _ in range(500)]
    out += ["".join(r.choice(["the", "he", "th", "e", "t", "in", " ", "'s", "'", "<|endoftext|>", "<|", "ENDOFTEXT", "|>", "1", ","]) for _ in range(30)) for _ in range(800)]
    out += ["".join(chr(r.choice([r.randint(32, 126), r.randint(0x80, 0x7FF), r.randint(0x4E00, 0x9FFF), r.randint(0x1F300, 0x1F9FF),
                                  0x20, 0x85, 0xA0, 0x2003, 0x3000, 0x1C, 10, 9, 39])) for _ in range(60)) for _ in range(800)]
    return out


def test_units_are_cut_where_pieces_end():
    texts = odd_texts()
    ids, n = rank_bpe.load(RANKS).encode(texts)
    ends, t = np.cumsum(n), tiktoken_library()
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [t.encode_ordinary(x) for x in texts]
    for path, model, encode in ((BYTE, bpe.load(BYTE), bpe.load(BYTE).encode_bytes), (WORD, token_output.load(WORD), token_output.load(WORD).encode)):
        import pyarrow as pa
        ids, n = encode(*textscan.column(pa.array(texts)))
        ends = np.cumsum(n)
        assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)], model


def test_cache_is_bounded_and_bytes_decide(monkeypatch):
    seen = []
    cache = units.UnitCache(lambda u: seen.append(len(u)) or [[len(x), x[0]] for x in u], limit=1 << 18)
    rng = np.random.default_rng(1)
    for _ in range(30):
        words = [bytes(rng.integers(97, 123, rng.integers(1, 9)).astype(np.uint8)) for _ in range(3000)]
        edges = np.cumsum([0, *map(len, words)])
        ids, n = cache.ids(np.frombuffer(b"".join(words), np.uint8), edges[:-1], edges[1:])
        assert ids.tolist() == [v for w in words for v in (len(w), w[0])] and (n == 2).all()
        assert cache.nbytes < 1 << 20
    monkeypatch.setattr(textscan, "hashes", lambda buffer, starts, ends: np.full(len(starts), 5, np.uint64))
    cache.clear()
    edges = np.array([0, 2, 4, 6])
    for _ in range(2):  # one hash for all: what the first unit doesn't equal is encoded by itself
        assert cache.ids(np.frombuffer(b"abcdab", np.uint8), edges[:-1], edges[1:])[0].tolist() == [2, 97, 2, 99, 2, 97]


def test_empty_tables(spark, empty, tmp_path):
    assert bpe.round_trip(empty, BYTE).count() == 0
    assert rank_bpe.round_trip(empty, RANKS).count() == 0
    token_output.write_tokens(empty, f"{tmp_path}/t", WORD, 2)
    assert token_output.read_digests(spark, f"{tmp_path}/t").count() == 0
