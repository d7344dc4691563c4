"""Registered queries: review-text cleaning, TF-IDF, similarity, encoders, vectors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..functions.text import clean_text, wordpunct_tokens
from ..operators import text as T
from ..operators import validation
from ..operators.common import materialize, scratch_dir
from ..sources import catalog, io
from .tables import labelled_reviews

TFIDF_MAX_FEATURES, TFIDF_MAX_DF, TFIDF_MIN_DF = 100, 0.8, 1
KEYWORDS_PER_ITEM = 10
SIMILAR_ITEMS = 5
MAX_VOCAB = 5000


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = catalog.reviews(spark, sf_dir)
    return r.select("review_id", clean_text("text").alias("text"))


def q_wordpunct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = catalog.reviews(spark, sf_dir)
    t = r.select("business_id", F.explode(wordpunct_tokens("text")).alias("token"))
    return t.groupBy("business_id", "token").agg(F.count(F.lit(1)).alias("n"))


def q_item_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.item_documents(catalog.reviews(spark, sf_dir))


def _tfidf(spark: SparkSession, sf_dir: str):
    r = catalog.reviews(spark, sf_dir)
    n_docs = r.select("business_id").distinct().count()
    # (item, token) counts are far smaller than the texts and are read three times
    tf = materialize(T.item_term_counts(r), "term-counts")
    return T.tfidf(tf, "business_id", n_docs,
                   TFIDF_MAX_FEATURES, TFIDF_MAX_DF, TFIDF_MIN_DF)


def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, _ = _tfidf(spark, sf_dir)
    return w.select("business_id", "token", r6("tfidf").alias("tfidf"))


def q_tfidf_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, _ = _tfidf(spark, sf_dir)
    return T.top_keywords(w, "business_id", KEYWORDS_PER_ITEM).select(
        "business_id", "rank", "token", r6("tfidf").alias("tfidf"))


def q_item_item_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, v = _tfidf(spark, sf_dir)
    s = T.item_item_topk(w, v, "business_id", SIMILAR_ITEMS)
    return s.select("business_id", "rank", "other_business_id", r6("sim").alias("sim"))


def q_item_item_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, v = _tfidf(spark, sf_dir)
    s = T.item_item_cosine(w, v, "business_id")
    return s.select("business_id", "other_business_id", r6("sim").alias("sim"))


def train_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = labelled_reviews(spark, sf_dir).select("review_id", "text", "stars")
    return validation.ordered_marks(r, "review_id", 0.8).where("split = 'train'").drop("split")


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.text_vocab(train_texts(spark, sf_dir), "text", MAX_VOCAB)


def q_text_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocab(spark, sf_dir)


def q_text_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.encode_texts(catalog.reviews(spark, sf_dir), _vocab(spark, sf_dir))


def q_text_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vocab(spark, sf_dir)
    enc = T.encode_texts(catalog.reviews(spark, sf_dir), v)
    return T.decode_texts(enc, v)


def _word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.word_vectors(_vocab(spark, sf_dir), catalog.table(spark, sf_dir, "embeddings"))


def q_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary-aligned vectors through the word-vector text format: the
    vectors are written as ``word f1 ... fd`` lines and read back with the
    vocabulary-filtered text scan; padding and unknown get zero vectors."""
    vocab = _vocab(spark, sf_dir)
    wv = T.word_vectors(vocab, catalog.table(spark, sf_dir, "embeddings"))
    lines = wv.where("idx >= 2").select(F.concat_ws(" ", "token", F.array_join(
        F.transform("vec", lambda x: x.cast("string")), " ")).alias("value"))
    path = f"{scratch_dir(spark)}/word-vectors-{uuid.uuid4().hex}"
    lines.write.mode("overwrite").text(path)
    scanned = io.read_word_vectors(spark, path, vocab.where("idx >= 2"))
    wv = wv.where("idx < 2").unionByName(
        scanned.join(vocab.select("token", "idx"), "token").select("token", "idx", "vec"))
    return wv.select("token", "idx", F.posexplode("vec").alias("dim", "value")).select(
        "token", "idx", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


def q_doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.doc_vectors(catalog.reviews(spark, sf_dir), _word_vectors(spark, sf_dir))
    return d.select("review_id", "dim", r6("value").alias("value"))
