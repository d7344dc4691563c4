"""Registered queries: collaborative filtering and table operators.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables.  Output columns are aliased to match the DuckDB oracles
in :mod:`tastebud.plans.oracle`; doubles are rounded to 6 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clip_rating, r6
from ..operators import bias
from . import base

BIAS_CONFIG = bias.BiasConfig()  # reference defaults: 10 epochs, reg_u 15, reg_i 10


def q_rating_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.build(spark, sf_dir).triples


def q_category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    return b.selected.select("business_id", "name", "categories", "review_count",
                             r6("stars").alias("stars"))


def q_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.user_rated_counts(base.build(spark, sf_dir).triples)


def _bias_model(spark: SparkSession, sf_dir: str) -> tuple[base.Base, bias.BiasModel]:
    b = base.build(spark, sf_dir)
    return b, bias.fit_bias(b.triples, BIAS_CONFIG)


def q_bias_fit_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m = _bias_model(spark, sf_dir)
    return m.item_bias.select("iid", r6("b_i").alias("b_i"))


def q_bias_fit_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m = _bias_model(spark, sf_dir)
    return m.user_bias.select("uid", r6("b_u").alias("b_u"))


def bias_topn(b: base.Base, m: bias.BiasModel, n: int = base.TOP_N,
              exclude_seen: bool = False) -> DataFrame:
    """Top-n recommendations with decoration for every user with a bias.

    The n best items are the same for all users, so they are ranked once
    (n rows), decorated, and attached to each user as a scalar subquery:
    O(users * n) output, no user x item product and no join fan-out.
    ``exclude_seen`` drops each user's rated items (then the lists differ per
    user: :func:`bias.top_items_unseen`).
    """
    if exclude_seen:
        users = m.user_bias.join(base.user_rated_counts(b.triples), "uid")
        t = bias.top_items_unseen(m, n, b.triples).join(base.decoration(b.items), "iid")
        return t.join(users, "uid").select(
            "uid", "rank", "iid", "business_id", "name", "categories",
            r6(clip_rating(F.lit(m.mu) + F.col("b_u") + F.col("b_i"))).alias("pred"),
            "avg_stars", "review_count", "n_rated")
    top = bias.top_items_by_bias(m, n).join(base.decoration(b.items), "iid")
    packed = top.agg(F.sort_array(F.collect_list(F.struct(
        "rank", "iid", "b_i", "business_id", "name", "categories", "avg_stars",
        "review_count"))).alias("top"))
    users = m.user_bias.join(base.user_rated_counts(b.triples), "uid")
    rec = users.select("uid", "b_u", "n_rated", F.explode(packed.scalar()).alias("t"))
    return rec.select(
        "uid", F.col("t.rank").alias("rank"), F.col("t.iid").alias("iid"),
        F.col("t.business_id").alias("business_id"), F.col("t.name").alias("name"),
        F.col("t.categories").alias("categories"),
        r6(clip_rating(F.lit(m.mu) + F.col("b_u") + F.col("t.b_i"))).alias("pred"),
        F.col("t.avg_stars").alias("avg_stars"), F.col("t.review_count").alias("review_count"),
        "n_rated")


def q_bias_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, m = _bias_model(spark, sf_dir)
    return bias_topn(b, m)
