"""Near and exact duplicates and decontamination against brute force."""

import random

import numpy as np
import pytest

from tastebud.llm import components, decontaminate, embeddings, simhash, substrings, suffix_array
from tests.llm.conftest import rows

LEAST = -(2 ** 63)


def key(i):
    return LEAST if i is None else i


def test_bytes_equal_brute_force(nasty):
    docs = [(key(i), (t or "").encode()) for i, t, *_ in rows()]
    first = {}
    for i, b in docs:
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], i), i)
    want = []
    for i, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        want.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), bytes(c for c, g in zip(b, gone) if not g)))
    got = [(key(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_array.remove_repeats(nasty).collect()]
    assert sorted(got) == sorted(want)


def test_words_equal_brute_force(spark):
    docs = [(i, t) for i, t, *_ in {r[0]: r for r in rows()}.values() if i is not None]
    docs += [(200 + k, " ".join("ab"[(j * j + k) % 7 % 2] for j in range(150))) for k in range(4)]
    first, want = set(), []
    for i, t in sorted(docs, key=lambda x: x[0]):
        w, gone = (t or "").encode().split(), set()
        for k in range(len(w) - 19):
            s = tuple(w[k:k + 20])
            gone |= set(range(k, k + 20)) if s in first else set()
            first.add(s)
        want.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    got = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, got.collect())) == want


def test_frequent_minimizers_are_split(nasty, monkeypatch):
    from tastebud.llm import repeats
    want = sorted(map(str, suffix_array.remove_repeats(nasty).collect()))
    monkeypatch.setattr(repeats, "CHUNK", 4_000)
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    assert sorted(map(str, suffix_array.remove_repeats(nasty).collect())) == want


def test_hot_minimizer_in_few_chunks_is_split(spark, monkeypatch):
    from tastebud.llm import repeats
    line = " ".join(f"licence{k}" for k in range(24))
    docs = spark.createDataFrame([(i, " ".join([*(f"a{i}x{k}" for k in range(22)), line, *(f"b{i}x{k}" for k in range(22))])) for i in range(3_000)],
                                 "doc_id long, text string").repartition(2)
    whole = sorted(map(str, suffix_array.remove_repeats(docs).collect()))
    monkeypatch.setattr(repeats, "CROWDED", 1 << 15)

    def bounded(solve):
        def run(contents, *of):
            if sum(map(len, contents)) > 1 << 17:
                raise MemoryError(f"{sum(map(len, contents))} bytes of contents in one structure")
            return solve(contents, *of)
        return run

    got = repeats.covered(docs, substrings.SPEC, bounded(substrings.solve), substrings._finish, "doc_id long, n_words long, n_removed long, kept string").collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(i, 24 if i else 0) for i in range(3_000)]
    got = repeats.covered(docs, suffix_array.SPEC, bounded(suffix_array.solve), suffix_array._finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    assert sorted(map(str, got.collect())) == whole


def test_frequent_word_minimizers_are_split(spark, monkeypatch):
    from tastebud.llm import repeats
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows()], "doc_id long, text string").repartition(3)
    want = sorted(map(str, substrings.remove_repeats(docs).collect()))
    monkeypatch.setattr(repeats, "CROWDED", 300)
    assert sorted(map(str, substrings.remove_repeats(docs).collect())) == want


def test_automaton_statistics():
    rng = random.Random(0)
    for _ in range(100):
        a, seen = substrings.SuffixAutomaton(), set()
        for _ in range(5):
            t = [rng.choice("ab") for _ in range(rng.randrange(1, 14))]
            got, want = a.feed(t), []
            for i in range(len(t)):
                want.append(max([n for n in range(1, i + 2) if tuple(t[i + 1 - n:i + 1]) in seen], default=0))
                seen |= {tuple(t[k:i + 1]) for k in range(i + 1)}
            assert got == want
            assert a.match(t) == list(range(1, len(t) + 1))


def test_collection_is_sorted():
    texts = [b"banana", b"", b"ban", b"anana", b"banana"]
    text, length, shares = suffix_array.collection(texts, 3)
    got = [texts[t][len(texts[t]) - n:] for t, n in zip(text, length)]
    assert got == sorted(got) and len(got) == sum(map(len, texts))
    assert shares.tolist() == [k > 0 and len(x) > 2 and x[:3] == got[k - 1][:3] for k, x in enumerate(got)]


def test_simhash_equals_brute_force(spark, nasty):
    docs = [(i, simhash.fingerprint((t or "").encode(), 3)) for i, t, *_ in rows()]
    assert {r["doc_id"]: r["fp"] % 2 ** 64 for r in simhash.fingerprints(nasty, 3).where("doc_id > 6").collect()} == {i: f for i, f in docs if i and i > 6}
    rng, fps = random.Random(1), set()
    for _ in range(60):
        c = rng.getrandbits(64)
        fps |= {c} | {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(6)}
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}  # a crowd
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    x = np.array(fps, np.int64).view(np.uint64)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for k, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[k]) <= 2).tolist():
            a, b = find(f), find(fps[j])
            root[max(a, b)] = min(a, b)
    want = {f: find(f) for f in fps}
    for crowd in (2, 64):
        table = simhash.materialize(spark.createDataFrame([(f,) for f in fps], "fp long"), "t")
        got = {r["node"]: r["root"] for r in components.connected_components(simhash.links(table, 2, crowd=crowd)).collect()}
        assert {f: got.get(f, f) for f in fps} == want


def test_simhash_allocation():
    assert sum(simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 3], [0, 50, 90, 99]], 2)) == 0
    assert simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 3], [0, 50, 90, 99]], 2) == [-1, 2, -1]


def test_one_of_each_group_stays(nasty, empty):
    kept = simhash.one_of_each(nasty, 3, 2)
    assert kept.columns == nasty.columns
    got = kept.collect()
    ids = [r["doc_id"] for r in got]
    # key 4 has two texts that are nothing alike: both stay
    assert sorted(i for i in ids if ids.count(i) > 1) == [4, 4] and len({r["text"] for r in got if r["doc_id"] == 4}) == 2
    assert {5, 6, 16} <= set(ids) and not {100, 101} & set(ids)
    assert simhash.one_of_each(empty, 3, 2).count() == 0


def test_embedding_recall_and_precision(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    near = base[:120] + rng.normal(size=(120, 32)) * 0.06 * rng.random((120, 1)) * 8
    x = np.concatenate([base, near, base[:10], base[:10] * 2])
    data = [(i, v.astype(np.float32).tolist(), int(i % 3 == 0)) for i, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] + [1.0] * 31, 1), (903, data[0][1], None), (904, [], 1), (905, [1.0, None], 1), (906, [1.0, 0.0], 1),
           (907, [1.0, 0.01], 1), (908, [float("inf")] * 32, 1)]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, label int"), 0.93).collect()}
    v = np.array([d[1] for d in data])
    v /= np.linalg.norm(v, axis=1)[:, None]
    lab = np.array([d[2] for d in data])
    link = (v @ v.T >= 0.93) & (lab[:, None] == lab[None, :]) & ~np.eye(len(v), dtype=bool)
    assert sum(got[i]["n_links"] for i in range(len(v))) >= 0.9 * link.sum() > 50
    assert all(got[i]["n_links"] <= link[i].sum() for i in range(len(v)))
    assert [got[i]["n_links"] for i in (900, 901, 902, 903, 904, 905, 906, 907, 908)] == [0, 0, 0, 0, 0, 0, 1, 1, 0]
    assert got[907]["component_id"] == 906 and not got[907]["kept"]
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), 0.93).count() == 0


def edits(a, b):
    d = list(range(len(b) + 1))
    for x in a:
        e = [d[0] + 1]
        for j, y in enumerate(b):
            e.append(min(d[j + 1] + 1, e[j] + 1, d[j] + (x != y)))
        d = e
    return d[-1]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 8, 15, 33, 59])))) for i in range(40)]
    docs = []
    for i in range(80):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 2, 40]))]
        for _ in range(rng.choice([0, 1, 2])):
            own = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, int(0.2 * len(own)) + 2)):
                at = rng.randrange(len(own))
                own[at:at + rng.randrange(2)] = [rng.choice(vocab)] * rng.randrange(2)
                own = own or ["w0"]
            w += own + [rng.choice(vocab) for _ in range(rng.choice([0, 3, 20]))]
        docs.append((i, " ".join(w).title()))
    return docs, items


def test_decontamination_equals_brute_force(spark, nasty, empty, planted):
    docs, items = planted
    want = set()
    for i, t in docs:
        w = t.lower().split()
        for k, x in items:
            x = x.split()
            windows = [w[s:s + len(x)] for s in range(len(w) - len(x) + 1)] if len(w) >= len(x) else [w] if w else []
            best = min((edits(x, y) for y in windows), default=99)
            if best <= int(0.2 * len(x)):
                want.add((i, k, best))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([*items, (None, "x"), (77, None), (78, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.matches(d, b).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) > 50
    assert {r["doc_id"] for r in decontaminate.clean(d, b).collect()} == {i for i, _ in docs} - {g[0] for g in got}
    assert decontaminate.clean(nasty, spark.createDataFrame([], "item_id long, text string")).count() == nasty.count()
    assert decontaminate.matches(empty, b).count() == 0 and decontaminate.clean(nasty, b).columns == nasty.columns


def uneven_vectors(n: int, kind: str) -> np.ndarray:
    rng = np.random.default_rng(n)
    if kind == "rank 4":
        return rng.normal(size=(n, 4)) @ rng.normal(size=(4, 64))
    spectrum = 1 / np.arange(1, 257)
    base = np.repeat(rng.normal(size=(n // 3, 256)) * spectrum, 3, axis=0)
    return base + rng.normal(size=base.shape) * spectrum * 0.25


@pytest.mark.parametrize("n, kind", [(1_500, "rank 4"), (9_000, "rank 4"), (1_500, "triples"), (9_000, "triples")])
def test_embedding_recall_of_uneven_vectors(spark, n, kind):
    x = uneven_vectors(n, kind).astype(np.float32)
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(
        spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(8), 0.93).collect()}
    v = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = (v @ v.T >= 0.93).sum(1) - 1
    print("recall", kind, n, sum(got.values()) / links.sum(), links.sum())
    assert sum(got.values()) >= 0.97 * links.sum() > n / 2
    assert all(got[i] <= links[i] for i in range(n))


def test_embedding_reach_without_linked_pilots_is_whole():
    assert embeddings.covering(np.array([3] * 98), np.ones(98), 1.0) == embeddings.STEPS
    assert embeddings.covering(np.array([3] * 99), np.ones(99), 1.0) == 3
    assert embeddings.covering(np.zeros(0, int), np.zeros(0), 1.0) == embeddings.STEPS


def test_components_that_share_a_key_each_keep_a_row(spark):
    a, b = "one two three four five six seven", "quite another text with other words in it"
    docs = spark.createDataFrame([(5, a), (5, b), (9, b), (None, b), (None, "a third text, all of it unlike the rest"), (None, None), (3, "")], "doc_id long, text string")
    assert sorted(map(str, simhash.one_of_each(docs, 3, 2).collect())) == sorted(map(str, spark.createDataFrame(
        [(5, a), (5, b), (None, "a third text, all of it unlike the rest"), (3, "")], docs.schema).collect()))


def test_clashing_names_come_back_as_they_were(spark):
    from tastebud.llm import pii
    names = ["_key", "_digest", "simhash_key", "SIMHASH_DIGEST", "simhash_key_", "_pii_runs", "pii_runs", "pii_digest", "quality_score", "root", "fp", "start", "end", "kind", "a"]
    rows = [(1, "write to a.b@c.dd about it", *range(len(names))), (2, "write to a.b@c.dd about it", *range(len(names))), (3, None, *range(len(names)))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    assert sorted(map(tuple, simhash.one_of_each(docs, 3, 2).collect())) == [rows[0], rows[2]]
    assert sorted(map(tuple, pii.mask(docs).collect())) == [(i, t and "write to <EMAIL> about it", *x) for i, t, *x in rows]
