"""Literal normalisers, byte wrappers, category splitting, text cleaning."""

from pyspark.sql import functions as F

from tastebud.functions import literals, text
from tastebud.functions.scalars import has_any_category, split_categories


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_literal_scalar(spark):
    got = _col(spark, ["u'casual'", "'casual'", '"quiet"', "True", "None", None, "u'it''s'"],
               literals.literal_scalar)
    assert got == ["casual", "casual", "quiet", "True", "None", None, "it''s"]


def test_literal_dict(spark):
    vals = ["{'romantic': False, u'casual': True, 'x': None}", "{\"kid's\": True}",
            "{'a': 'True story'}", "{}", "None", None]
    got = _col(spark, vals, literals.literal_dict)
    assert got[0] == {"romantic": "False", "casual": "True", "x": "None"}
    assert got[1] == {"kid's": "True"}
    assert got[2] == {"a": "True story"}
    assert got[3] == {} and got[4] == {} and got[5] == {}


def test_literal_dict_quoted_flag(spark):
    df = spark.createDataFrame([("{'a': 'True', 'b': True}",)], "v string")
    e = df.select(F.explode(literals.literal_dict_entries("v")).alias("e")).select("e.*").collect()
    assert [(r.key, r.value, r.quoted) for r in e] == [("a", "True", True), ("b", "True", False)]


def test_byte_unwrap_and_wrap(spark):
    assert _col(spark, ["b'abc'", "abc", "b\"x'y\""], literals.unwrap_bytes) == ["abc", "abc", "x'y"]
    assert _col(spark, ["abc"], literals.wrap_bytes) == ["b'abc'"]


def test_category_split_and_filter(spark):
    vals = ["Food, Bars", "Food,Bars", None, ""]
    assert _col(spark, vals, split_categories) == [["Food", "Bars"], ["Food,Bars"], None, [""]]
    got = _col(spark, vals, lambda c: has_any_category(c, ["Food", "Restaurants"]))
    assert got == [True, False, False, False]


def test_clean_text_literal_newline_and_stopwords(spark):
    raw = "It's great!\\nI'll be back. The FOOD"
    got = _col(spark, [raw], text.clean_text)[0]
    # "\n" (two characters) becomes a blank; punctuation deleted; "Its", "Ill",
    # "be" and "The" are stop words once punctuation is stripped; case kept.
    assert got == "great back FOOD"


def test_stopword_list_is_fixed():
    assert len(text.SPARK_ENGLISH_STOPWORDS) == 181
    sw = text.default_stopwords()
    assert "ill" in sw and "dont" in sw and "i'll" not in sw


def test_wordpunct_tokens(spark):
    got = _col(spark, ["Éa, b-c!! 42_x"], text.wordpunct_tokens)[0]
    assert got == ["éa", ",", "b", "-", "c", "!!", "42_x"]


def test_vectorizer_tokens(spark):
    got = _col(spark, ["Wow, the  Restaurant\\nis AMAZING!"], text.vectorizer_tokens)[0]
    assert got == ["wow", "the", "restaurant", "is", "amazing"]


def test_literal_dict_repeated_key_keeps_the_last(spark):
    from tastebud.functions.literals import literal_dict
    row = spark.createDataFrame([("{'a': 1, 'b': 'x', 'a': 2}",)], "c string").select(literal_dict("c").alias("m")).first()
    assert row["m"] == {"a": "2", "b": "x"}


def test_long_keys_stay_whole(spark):
    from tastebud.sources.catalog import padded_key
    got = spark.createDataFrame([(k,) for k in (5, 1234567, 12345670, 12345678)], "k long").select(padded_key("b", "k").alias("b"))
    assert [r["b"] for r in got.collect()] == ["b0000005", "b1234567", "b12345670", "b12345678"]
