"""Registered queries: content-based recommendation from business attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import literals
from ..functions.scalars import r6
from ..operators import content
from ..operators.common import materialize
from . import base


@dataclass
class ContentInputs:
    b: base.Base
    features: DataFrame    # (iid, feature, value) all features
    idf: DataFrame         # (feature, df, kept, idf)
    kfeatures: DataFrame   # kept features with idf
    profiles: DataFrame    # (uid, feature, weight)


def build(spark: SparkSession, sf_dir: str) -> ContentInputs:
    b = base.build(spark, sf_dir)
    feats = content.item_features(b.items)
    idf = content.feature_idf(feats, items=b.items, min_df=content.DEFAULT_MIN_DF)
    # item-sized, read by every later step: written once
    kf = materialize(content.kept_features(feats, idf), "kept-features")
    prof = content.user_profiles(b.triples, kf)
    return ContentInputs(b, feats, idf, kf, prof)


def _with_bid(b: base.Base, df: DataFrame) -> DataFrame:
    return df.join(b.imap, "iid")


def q_attr_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return _with_bid(b, content.onehot_features(b.items)).select("business_id", "feature")


def q_attr_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    names = F.array(*[F.lit(a) for a in content.ATTRIBUTES])
    kv = b.items.select(F.explode(F.map_filter("attributes", lambda k, v: F.array_contains(names, k)))
                        .alias("variable", "raw"))
    return (kv.groupBy("variable", literals.literal_scalar("raw").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_attr_dict_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return _with_bid(b, content.dict_features(b.items)).select("business_id", "feature", "value")


def q_item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return _with_bid(b, content.item_features(b.items)).select("business_id", "feature", "value")


def q_feature_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = build(spark, sf_dir)
    return c.idf.select("feature", "df", F.col("kept").cast("int").alias("kept"),
                        r6("idf").alias("idf"))


def q_content_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = build(spark, sf_dir)
    return content.profile_top_features(c.profiles, 5).select(
        "uid", "rank", "feature", r6("weight").alias("weight"))


def q_content_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every rated (user, item) pair."""
    c = build(spark, sf_dir)
    s = content.scores_for_pairs(c.b.triples, c.profiles, c.kfeatures)
    return s.select("uid", "iid", r6("score").alias("score"))


def _topn(c: ContentInputs) -> DataFrame:
    return content.content_topn_all(c.b.triples, c.b.items, c.kfeatures, c.profiles, base.TOP_N)


def q_content_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = build(spark, sf_dir)
    t = _topn(c).join(base.decoration(c.b.items), "iid")
    return t.select("uid", "rank", "iid", "business_id", "name", r6("score").alias("score"))


def q_content_topn_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = build(spark, sf_dir)
    top3 = content.item_top_features(c.kfeatures, 3)
    return _topn(c).join(top3, "iid").select("uid", "rank", "iid", "feature_rank", "feature")
