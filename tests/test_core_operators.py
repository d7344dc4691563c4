"""Ids, aggregates, check-ins, JSON flattening, IO, features."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tastebud.operators import aggregates, etl, features, filters, ids, text
from tastebud.sources import csv_scan, io


def test_dense_index_contiguous_and_partition_independent(spark):
    keys = spark.createDataFrame([(f"k{i:04d}",) for i in range(500)] * 2, "k string")
    for parts in (1, 3, 7):
        m = ids.ordered_index(keys.select("k").distinct(), [F.col("k").asc()], "id", num_partitions=parts)
        rows = sorted((r.k, r.id) for r in m.collect())
        assert [r[1] for r in rows] == list(range(500))
        assert rows[0][0] == "k0000" and rows[-1][0] == "k0499"


def test_string_index_frequency_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), ("d",)], "v string")
    m = {r.v: r.idx for r in ids.string_index(df, "v", "idx").collect()}
    assert m == {"a": 0, "b": 1, "c": 2, "d": 3}   # ties alphabetical


def test_rating_matrix_mean_of_duplicates(spark):
    t = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (2, 1, 1.0)], "uid long, iid long, stars double")
    m = {(r.uid, r.iid): r.rating for r in aggregates.rating_matrix(t).collect()}
    assert m == {(1, 1): 4.0, (2, 1): 1.0}
    s = aggregates.matrix_sparsity(t).first()
    assert (s.n_users, s.n_items, s.n_cells) == (2, 1, 2) and s.sparsity == 0.0


def test_pivot_matrix_bounded(spark):
    t = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0)], "uid long, iid long, stars double")
    assert aggregates.pivot_matrix(t, [1, 2]).columns == ["uid", "1", "2"]
    with pytest.raises(ValueError):
        aggregates.pivot_matrix(t, range(aggregates.MAX_PIVOT_COLUMNS + 1))


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    p = {r.column_name: (r.n_null, r.n_nonnull) for r in aggregates.null_profile(df).collect()}
    assert p == {"a": (1, 2), "b": (2, 1)}


def test_checkin_summary_raw_and_events_agree(spark):
    ev = spark.createDataFrame(
        [("b1", 1, "2020-01-01 10:00:00"), ("b1", 2, "2020-01-02 10:00:00"), ("b1", 3, "2020-01-03 09:00:00"),
         ("b2", 4, "2021-05-05 00:00:00")], "business_id string, event_id long, date string"
    ).withColumn("ts", F.to_timestamp("date"))
    biz = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "business_id string")
    raw = ev.groupBy("business_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("ts", "date"))), lambda s: s["date"]), ", ").alias("date"))
    a = {r.business_id: tuple(r[1:]) for r in etl.checkin_summary(raw, biz).collect()}
    b = {r.business_id: tuple(r[1:]) for r in etl.checkin_summary_from_events(ev, biz).collect()}
    assert a == b
    assert a["b2"] == (1, "2021-05-05 00:00:00", "2021-05-05 00:00:00")   # first = last
    assert a["b3"] == (None, None, None)                                   # right join keeps it


def test_json_leaf_paths_and_flatten(spark):
    lines = spark.createDataFrame(
        [('{"a":{"b":2,"c":null},"l":[1,2]}',), ('{"a":null,"d":true}',), ('{"e":{}}',),
         ('{"x":{"y":{"z":3.0}}}',)], "value string")
    paths = sorted(r.path for r in etl.json_leaf_paths(lines).collect())
    assert paths == ["a", "a.b", "a.c", "d", "l", "x.y.z"]
    flat = etl.json_flatten(lines, ["a.b", "d", "l", "x.y.z"]).collect()
    assert [tuple(r) for r in flat] == [("2", "", "[1,2]", ""), ("", "True", "", ""),
                                        ("", "", "", ""), ("", "", "", "3.0")]


def test_json_repeated_keys_quotes_and_dots(spark):
    """The last value of a repeated key counts; keys of any characters find their values."""
    records = ['{"a":1,"a":2,"b":{"c":3}}', '{"b":{"c":4},"b":{"c":5,"d":null}}', '{"k\'x":"q","p.q":1.50,"br[0]\']":"z"}',
               '{"big":123456789012345678901234567890,"e":1e3,"s":"true","t":true,"f":false}',
               '{"b":7,"u":"\\ud800","o":[{"x":1.0,"y":"\\u00e9"},null,false]}', "{broken", None, ""]
    lines = spark.createDataFrame([(r,) for r in records], "value string")
    paths = sorted(r.path for r in etl.json_leaf_paths(lines).collect())
    assert paths == sorted(["a", "b", "b.c", "b.d", "big", "br[0]']", "e", "f", "k'x", "o", "p.q", "s", "t", "u"])
    rows = [dict(zip(paths, r)) for r in etl.json_flatten(lines, paths).collect()]
    assert len(rows) == len(records)
    assert (rows[0]["a"], rows[0]["b"], rows[0]["b.c"]) == ("2", '{"c":3}', "3")
    assert (rows[1]["b.c"], rows[1]["b.d"]) == ("5", "")
    assert (rows[2]["k'x"], rows[2]["p.q"], rows[2]["br[0]']"]) == ("q", "1.50", "z")
    assert [rows[3][k] for k in ("big", "e", "s", "t", "f")] == ["123456789012345678901234567890", "1e3", "true", "True", "False"]
    assert (rows[4]["b"], rows[4]["u"], rows[4]["o"]) == ("7", "?", '[{"x":1.0,"y":"\u00e9"},null,false]')
    assert all(set(r.values()) == {""} for r in rows[5:])


def test_json_to_csv_reads_back_equal(spark):
    """Quotes, line breaks, commas and backslashes in values and names survive; each line is a row."""
    lines = spark.createDataFrame([('{"id":1,"t":"say \\"hi\\",\\nthere","k\'x":{"a,b":"\\\\"}}',), ('{"id":2,"t":""}',), ("[1]",)], "value string")
    path, schema = etl.json_to_csv(lines, tempfile.mkdtemp(prefix="tb-json-csv-"))
    assert schema.names == ["id", "k'x.a,b", "t"]
    got = sorted(map(tuple, io.read_csv(spark, path, schema).collect()))
    assert got == [("", "", ""), ("1", "\\", 'say "hi",\nthere'), ("2", "", "")]
    plan = etl.json_flatten(lines, schema.names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "get_json_object" not in plan


@pytest.mark.parametrize("split", [333, 4096])
def test_csv_scan_in_ranges_equals_whole_files(spark, split, monkeypatch):
    """Records that cross byte ranges, one or several, come whole; ranges of a few bytes, two files,
    with and without a last line break."""
    import csv
    import random
    rnd = random.Random(split)
    d = tempfile.mkdtemp(prefix="tb-csv-ranges-")
    rows = [(i, rnd.choice(["", "x,y", 'say "hi"', "a\nb\n\nc", "\n\"\n" * 60, "é\n" * rnd.randrange(90), "plain"]), rnd.choice([None, "t", "z" * 70]))
            for i in range(400)]
    for part in range(2):
        with open(os.path.join(d, f"f{part}.csv"), "w", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if part else "\n")
            w.writerow(["id", "head\nline", "t"])
            w.writerows(rows[part::2])
            if part:
                f.write("\r\n400,last,")
    schema = "id int, s string, t string"
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        typed = spark.createDataFrame([], schema).schema
        got = sorted(map(tuple, io.read_csv(spark, d, typed).collect()))
        assert csv_scan._lines(spark, d).rdd.getNumPartitions() > 3
        if split == 333:
            monkeypatch.setattr(csv_scan, "BROADCAST_MAX_BYTES", 0)
            assert sorted(map(tuple, io.read_csv(spark, d, typed).collect()), key=str) == sorted(got, key=str)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted([(i, s or None, t) for i, s, t in rows] + [(400, "last", None)])
    one = os.path.join(d, "f0.csv")
    whole = spark.read.schema(schema).options(**io.CSV_READ_OPTIONS).csv(one)
    assert sorted(map(str, io.read_csv(spark, one, typed).collect())) == sorted(map(str, whole.collect()))


def test_keyword_groups_by_name(spark):
    b = spark.createDataFrame([("Restaurants, Bars", 9), ("Food", 2), ("Shopping", 7), (None, 8)], "categories string, review_count int")
    assert filters.category_filter(b, "restaurants").count() == 1
    assert filters.category_filter(b, "restaurants", None).count() == 2
    with pytest.raises(ValueError, match="automotive"):
        filters.category_filter(b, "hotels")
    got = {r.group_name: (r.n_category, r.n_selected) for r in filters.group_report(b, filters.KEYWORD_GROUPS, 5).collect()}
    assert got == {"restaurants": (2, 1), "automotive": (0, 0), "shopping": (1, 1)}


def test_counts_come_in_order(spark):
    df = spark.createDataFrame([("x, y", None), ("y", None), (None, 1)], "categories string, n int")
    assert [tuple(r) for r in aggregates.category_counts(df).collect()] == [("y", 2), ("x", 1)]
    assert [r.column_name for r in aggregates.null_profile(df).collect()] == ["n", "categories"]


def test_document_means(spark):
    """Unknown tokens count as zeros; null components as 0; a text without known tokens has no row."""
    texts = spark.createDataFrame([(1, "a a b zzz"), (2, "zzz"), (3, "c"), (4, None), (5, "")], "review_id long, text string")
    wv = spark.createDataFrame([("", 0, [9.0, 9.0]), ("a", 2, [1.0, 2.0]), ("b", 3, [4.0, None]), ("c", 4, [7.0])],
                               "token string, idx long, vec array<float>")
    means = text.doc_means(texts, wv)
    assert {r.review_id: r.vec for r in means.collect()} == {1: pytest.approx([1.5, 1.0]), 3: [7.0]}
    long = {(r.review_id, r["dim"]): r.value for r in text.doc_vectors(texts, wv).collect()}
    assert long == {(1, 0): pytest.approx(1.5), (1, 1): pytest.approx(1.0), (3, 0): 7.0}
    assert "posexplode" not in means._jdf.queryExecution().optimizedPlan().toString()
    assert text.doc_means(texts, wv.where("false")).count() == 0


def test_csv_roundtrip_with_row_cap(spark):
    df = spark.createDataFrame([(1, 'say "hi"', "a\nb"), (2, "x,y", None)], "id int, s string, t string")
    root = tempfile.mkdtemp(prefix="tb-csv-")
    p = io.write_csv(df, root)
    back = io.read_csv(spark, p, df.schema).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, 'say "hi"', "a\nb"), (2, "x,y", None)]


def test_word_vector_text_reader(spark):
    d = tempfile.mkdtemp(prefix="tb-wv-")
    with open(os.path.join(d, "vec.txt"), "w") as f:
        f.write("the 0.1 0.2\ncat 1.5 -2\nzebra 3 3\n")
    vocab = spark.createDataFrame([("the",), ("cat",)], "token string")
    got = {r.token: r.vec for r in io.read_word_vectors(spark, d, vocab).collect()}
    assert set(got) == {"the", "cat"}
    assert got["cat"] == pytest.approx([1.5, -2.0])


def test_scaling_constant_column_is_zero(spark):
    df = spark.createDataFrame([(7, 1.0), (7, 3.0)], "review_count long, stars double")
    s = features.standard_scale(features.minmax_scale(df, ["review_count", "stars"]),
                                ["review_count", "stars"]).collect()
    assert [r.review_count_minmax for r in s] == [0.0, 0.0]
    assert [r.review_count_std for r in s] == [0.0, 0.0]
    assert [r.stars_minmax for r in s] == [0.0, 1.0]
    assert [r.stars_std for r in s] == [-1.0, 1.0]


def test_category_vocab_and_padding(spark):
    frame = spark.createDataFrame([("A, B",), ("A, C",), ("A",), (None,), ("B, X, A",)], "categories string")
    v = features.category_vocab(frame, drop=["C"], min_count=1)
    got = {r.category: (r.idx, r.n) for r in v.collect()}
    assert got == {"A": (1, 4), "B": (2, 2)}           # C dropped, X below min
    rows = frame.withColumn("k", F.monotonically_increasing_id())
    idx = features.category_indices(rows, v, "k")
    pad = features.padded_sequences(rows.select("k"), idx, "k", features.max_category_len(rows))
    seqs = {}
    for r in pad.collect():
        seqs.setdefault(r.k, []).append((r.pos, r.idx))
    as_lists = sorted([i for _, i in sorted(s)] for s in seqs.values())
    assert as_lists == sorted([[1, 2, 0], [1, 0, 0], [1, 0, 0], [0, 0, 0], [2, 0, 1]])


def test_category_vocab_counts_over_ratings_or_business(spark):
    # business b1 rated three times, b2 once
    frame = spark.createDataFrame([("b1", "A, B"), ("b1", "A, B"), ("b1", "A, B"), ("b2", "A, C")],
                                  "business_id string, categories string")
    r = {x.category: x.n for x in features.category_vocab(frame, [], 0).collect()}
    b = {x.category: x.n for x in features.category_vocab(frame, [], 0, count_over="business").collect()}
    assert r == {"A": 4, "B": 3, "C": 1} and b == {"A": 2, "B": 1, "C": 1}
    with pytest.raises(ValueError):
        features.category_vocab(frame, [], 0, count_over="users")


def test_scratch_tables_live_under_checkpoint_dir_and_are_cleared(spark):
    from tastebud.operators.common import clear_scratch, materialize, scratch_dir
    from tastebud.session import ensure_checkpoint_dir
    root = scratch_dir(spark)
    assert root.startswith(ensure_checkpoint_dir(spark).rstrip("/"))
    assert spark.sparkContext.applicationId in root
    t = materialize(spark.range(10), "probe")
    assert t.count() == 10
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(path)
    clear_scratch(spark)
    assert not fs.exists(path)


def test_json_names_follow_types_at_any_depth(spark):
    """Objects are followed to the last level; a string is a leaf whatever it looks like."""
    import json
    deep = {"leaf": 1}
    for i in range(12, 0, -1):
        deep = {f"k{i}": deep}
    records = [json.dumps(deep), json.dumps({"attributes": {"Ambience": "{'romantic': False}", "b": "{not json", "c": "{\"x\": 1}"}}),
               json.dumps({"e": {}, "list": [{"z": 1}], "quoted": "}}{{\" {", "n": None}), "not json", "[1]", None]
    lines = spark.createDataFrame([(r,) for r in records], "value string")
    paths = {r.path for r in etl.json_leaf_paths(lines).collect()}
    assert paths == {".".join(f"k{i}" for i in range(1, 13)) + ".leaf", "attributes.Ambience", "attributes.b", "attributes.c",
                     "list", "quoted", "n"}
    assert etl.json_leaf_paths(lines.where("false")).count() == 0


def test_rating_frame_keeps_every_rating(spark):
    """Ratings that share an order line stay rows of their own, with one user and one item bit
    each; businesses without a rating stay once; no outer join keeps a hot business whole."""
    from tastebud.operators import features as FE
    from tastebud.plans import dnn
    r = spark.createDataFrame([("u1", "b1", 5.0, "1-1"), ("u1", "b1", 5.0, "1-1"), ("u2", "b1", 3.0, "1-1"), ("u2", "b9", 3.0, "2-1")],
                              "user_id string, business_id string, stars double, review_id string")
    b = spark.createDataFrame([("b1", 4.0, 3, "A, B"), ("b2", 2.0, 0, None)],
                              "business_id string, stars double, review_count long, categories string")
    frame = dnn.keyed_rows(FE.rating_frame(r, b))
    assert "RightOuter" not in frame._jdf.queryExecution().toString()
    got = frame.collect()
    assert sorted(x.row_key for x in got) == ["1-1", "1-1#2", "1-1#3", "b:b2"]
    vocab = spark.createDataFrame([("A", 1, 3)], "category string, idx long, n long")
    f = dnn.fm_input(dnn.DnnInputs(frame, vocab, 2, 2, 2)).where("feature < 4").collect()
    for key in ("1-1", "1-1#2", "1-1#3"):
        assert sorted(x.feature >= 2 for x in f if x.row_key == key) == [False, True]
        assert {x.value for x in f if x.row_key == key} == {1.0}


def test_blocked_top_n_sends_targets_in_trays_of_bounded_size(spark, monkeypatch):
    """Several blocks and rounds give the same lists as one; what is collected of the targets at a time is bounded."""
    import numpy as np
    from tastebud.operators import blocked
    rng = np.random.default_rng(3)
    q, t = rng.normal(size=(50, 4)).round(3), rng.normal(size=(30, 4)).round(3)
    queries = spark.createDataFrame([(i, list(range(4)), v.tolist()) for i, v in enumerate(q)], "qid long, fidx array<long>, w array<double>")
    targets = spark.createDataFrame([([i], list(range(4)), v.tolist()) for i, v in enumerate(t)], "cids array<long>, fidx array<long>, w array<double>")
    monkeypatch.setattr(blocked, "BLOCK_CELLS", 12)
    monkeypatch.setattr(blocked, "FIRST_TRAY", 300)
    monkeypatch.setattr(blocked, "TRAY", 400)
    sent, send = [], blocked._send

    def watched(blocks, tray):
        out = send(blocks, tray)
        sent.append(sum(len(b) for row in out.value for b in row[2:]))
        return out
    monkeypatch.setattr(blocked, "_send", watched)
    top = blocked.blocked_top_n(queries, targets, 4, 3)
    score = (q @ t.T).round(6)
    want = {(i, r + 1, int(c)) for i in range(50) for r, c in enumerate(np.lexsort((np.arange(30), -score[i]))[:3])}
    assert {(x.qid, x.rank, x.cid) for x in top.collect()} == want
    assert len(sent) > 2 and max(sent) <= 400


def test_document_means_shuffle_one_row_a_text(spark, monkeypatch):
    """Sums are made where a text lies; texts that share a key, tokens that come twice and a join
    beyond the broadcast bound give the same means."""
    texts = spark.createDataFrame([(1, "a a b zzz"), (1, "zzz b"), (2, "zzz"), (3, "c"), (None, "a")], "review_id long, text string")
    wv = spark.createDataFrame([("a", 2, [1.0, 2.0]), ("b", 3, [4.0, None]), ("b", 3, [2.0, 6.0]), ("c", 4, [7.0])],
                               "token string, idx long, vec array<float>")
    means = text.doc_means(texts, wv)
    # 1: a a b b zzz zzz b b, since b has two vectors
    want = {1: pytest.approx([14 / 8, 16 / 8]), 3: [7.0], None: pytest.approx([1.0, 2.0])}
    assert {r.review_id: r.vec for r in means.collect()} == want
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Join" not in plan
    monkeypatch.setattr(text, "TOKENS_AT_ONCE", 2)
    assert {r.review_id: r.vec for r in text.doc_means(texts, wv).collect()} == want
    monkeypatch.setattr(text, "BROADCAST_MAX_BYTES", 0)
    assert {r.review_id: r.vec for r in text.doc_means(texts, wv).collect()} == want


def test_ordered_marks_equal_the_ordered_split_without_a_sort_of_the_rows(spark):
    from tastebud.operators import validation
    rows = spark.createDataFrame([(i * 7 % 50, f"t{i}") for i in range(50)], "id long, text string").repartition(5)
    marked = validation.ordered_marks(rows, "id", 0.8)
    assert {r.id for r in marked.where("split = 'train'").collect()} == set(range(40))
    assert "Exchange" not in marked._jdf.queryExecution().executedPlan().toString()
    same = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "id long, text string")
    split = {r.text: r.split for r in validation.ordered_marks(same, "id", 0.6).collect()}
    assert split["e"] == "train" and split["d"] == "test" and sorted(split[t] for t in "abc") == ["test", "train", "train"]
    assert validation.ordered_marks(same, "id", 0.0).where("split = 'train'").count() == 0


def test_rating_frame_is_joined_once(spark, monkeypatch):
    """Both id maps read the written frame and don't join ratings and businesses again."""
    from tastebud.operators import features as FE
    r = spark.createDataFrame([("u1", "b1", 5.0, "1-1"), (None, "b1", 4.0, "1-2"), ("u2", "b9", 3.0, "2-1")],
                              "user_id string, business_id string, stars double, review_id string")
    b = spark.createDataFrame([("b1", 4.0, 3, "A, B"), ("b2", 2.0, 0, None)],
                              "business_id string, stars double, review_count long, categories string")
    plans, index = [], FE.dense_index

    def seen(keys, key, out="id"):
        plans.append(keys._jdf.queryExecution().optimizedPlan().toString())
        return index(keys, key, out)
    monkeypatch.setattr(FE, "dense_index", seen)
    got = FE.rating_frame(r, b).collect()
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert sorted((x.business_id, x.uid, x.iid, x.rating) for x in got if x.user_id) == [("b1", 0, 0, 5.0)]
    assert sorted((x.business_id, x.rating or 0) for x in got if not x.user_id) == [("b1", 4.0), ("b2", 0)]
