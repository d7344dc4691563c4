import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, score double, fp long, chunk long, kind string, digest string"


def rows() -> list[tuple]:
    """Small nasty corpus: nulls, empty and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in ("ka", "Lo", "mi", "né", "zu") for b in ("ra", "ti", "so", "", "x,", "!!")]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, near = say(60), say(120).split()
    texts = [None, "", " \n\t ", "a", say(15), say(3000), passage, say(30) + "\n" + passage, passage + " " + say(25), "kara " * 400, "x" * 5000,
             "mail bo.b@ex-a.mple.org_x@y.zz or 1.2.3.4, 300.1.1.1 +1 (269) 555-3296", "card 4799 1346 8104 4206 4111-1111-1111-1111 1234567890123",
             "<|endoftext|>  two  spaces  nbsp\x85 \x1c 日本語 🙂 é İ", "a\x00b \x00 c", " sep 1.2.3.4.5 a@b a@b.c+++", say(40) + " " + say(40)]
    texts += [" ".join(near[:k] + ["changed"] + near[k + 1:]) for k in (3, 50, 51, 119)] + [" ".join(near)]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(6, passage), (6, passage), (4, "another text of the same key"), (None, passage), (None, None), (100, texts[5]), (101, texts[5]), (-3, texts[7])]
    return [(i, t, "en", "s", len(t or ""), 1, 2, 0.5, 3, 4, "k", "d") for i, t in out]


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
