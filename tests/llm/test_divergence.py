"""Transducers and the divergence audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tastebud.llm import divergence, textscan, transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def brute(docs, least, top):
    docs = [tuple(x or "" for x in d) for d in docs]
    words = [(a, s, [t.translate(LOWER) for t in TERM.findall(x)]) for a, s, x in docs]
    df = Counter((a, t) for a, _, w in words for t in set(w))
    out = []
    for lang in {a for a, _, _ in words}:
        kept = sorted((t for (a, t), n in df.items() if a == lang and n >= least), key=str.encode)
        count = defaultdict(Counter)
        for a, s, w in words:
            if a == lang:
                count[s].update(t for t in w if t in set(kept))
        v = len(kept)

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * v) for t in kept}
        whole = shares(sum(count.values(), Counter()))
        p = {s: shares(c) for s, c in count.items()}
        for s in count:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in count if o != s), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -d, r) for r, (d, o) in enumerate(pair, 1)]
            over = sorted(((whole[t] - p[s][t], t) for t in kept if count[s][t] and p[s][t] > whole[t]), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "term", t, -d, r) for r, (d, t) in enumerate(over[:top], 1)]
    return sorted(out)


def corpus(n=400, sources=7):
    rng = random.Random(8)
    vocab = [a + b for a in ("ka", "Lo", "mi", "né", "zu", "日本", "ẞ") for b in ("ra", "Ti", "so", "", "é", "X")]
    docs = []
    for i in range(n):
        source = rng.choice([f"s{rng.randrange(sources)}", "hot", None, ""])
        weights = [1 + (hash((source, w)) % 5) for w in range(len(vocab))]
        text = "".join(rng.choices(vocab, weights)[0] + rng.choice([" ", ", ", "\n", "-", "7", "_", "\x00", "\x7f"]) for _ in range(rng.randint(0, 60)))
        docs.append((rng.choice(["en", "de", None, "fr"]), source, text))
    docs += [("en", "empty", None), ("en", "empty", ""), ("xx", "rare", "only once"), ("xx", "other", None), ("en", "long", "Kara lora " * 20000),
             ("en", "long", "x" * 30000), ("de", "s1", None)] + [("en", "copies", "kara Lora mira zzz aaa")] * 40
    return docs


def result(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def frame(spark, docs):
    return spark.createDataFrame([(i, t, a, s, 1, 2, "k") for i, (a, s, t) in enumerate(docs)],
                                 "doc_id long, text string, lang string, source string, n long, ordinal int, term string").repartition(5)


@pytest.mark.parametrize("chunk,tray", [(1 << 17, 16 << 20), (3, 200)])
def test_audit_equals_brute_force(spark, chunk, tray):
    docs = corpus()
    assert result(divergence.audit(frame(spark, docs), least_documents=10, top=6, chunk=chunk, tray=tray)) == brute(docs, 10, 6)


def test_pair_sums_over_several_tiles_and_blocks(spark):
    docs = corpus(900, 300)
    assert result(divergence.audit(frame(spark, docs), least_documents=5, top=3)) == brute(docs, 5, 3)


def test_no_vocabulary_and_no_rows(spark):
    docs = [("a", "x", "one two"), ("a", "y", None), ("b", "z", "!")]
    assert result(divergence.audit(frame(spark, docs))) == [("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)]
    assert divergence.audit(frame(spark, docs).limit(0)).count() == 0


def test_terms_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(textscan, "hashes", lambda buffer, starts, ends: np.zeros(len(starts), np.uint64))
    buffer = np.frombuffer(b"ab cd ab", np.uint8)
    code, first = divergence.codes(buffer, np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert code.tolist() == [0, 1, 0] and first.tolist() == [0, 1]


def test_transducer_is_minimal_and_numbers_terms():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 7))).encode() for _ in range(3000)})
    walk = transducer.Transducers([transducer.build(words[:1000]), transducer.build(words[1000:]), transducer.build([])])
    probe = [*words, b"", *(w + b"q" for w in words)]
    which = np.array([0] * 1000 + [1] * (len(words) - 1000) + [0] * (len(words) + 1))
    edges = np.cumsum([0, *map(len, probe)])
    got = walk.ordinals(which, np.frombuffer(b"".join(probe), np.uint8), edges[:-1], edges[1:])
    assert got.tolist() == [*range(1000), *range(len(words) - 1000), *[-1] * (len(words) + 1)]
    assert [walk.term(1, i) for i in range(0, len(words) - 1000, 50)] == words[1000::50]
    # as many states as there are different sets of endings
    ends = defaultdict(set)
    for w in words[:1000]:
        for i in range(len(w) + 1):
            ends[w[:i]].add(w[i:])
    assert walk.roots[0] + 1 == len(set(map(frozenset, ends.values())))
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])
