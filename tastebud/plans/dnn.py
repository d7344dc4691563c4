"""Registered queries: the factorisation-machine / deep model input features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import features as FE
from ..operators.common import materialize
from . import base

DENSE = ["stars", "review_count"]


@dataclass
class DnnInputs:
    frame: DataFrame       # rating frame with uid/iid/rating/stars/review_count/categories
    vocab: DataFrame       # (category, idx, n)
    n_users: int
    n_items: int
    maxlen: int


def keyed_rows(frame: DataFrame) -> DataFrame:
    """Give every row its own ``row_key``: the review id (or the business of a row without
    a rating), and a number from the second row on where several share it."""
    base_key = F.coalesce("review_id", F.concat(F.lit("b:"), F.col("business_id")))
    w = Window.partitionBy("_key").orderBy("user_id", "business_id", "rating")
    return (frame.withColumn("_key", base_key).withColumn("_n", F.row_number().over(w))
            .withColumn("row_key", F.when(F.col("_n") == 1, F.col("_key"))
                        .otherwise(F.concat_ws("#", "_key", F.col("_n").cast("string")))).drop("_key", "_n"))


def build(spark: SparkSession, sf_dir: str) -> DnnInputs:
    b = base.build(spark, sf_dir)
    frame = FE.rating_frame(b.rating_rows, b.selected)
    frame = keyed_rows(frame)
    # read by the scaling statistics, the vocabulary and every feature block: written once
    frame = materialize(frame, "dnn-frame")
    vocab = FE.category_vocab(frame, base.KEYWORDS, FE.DEFAULT_MIN_CATEGORY)
    counts = frame.agg(F.max("uid"), F.max("iid")).first()
    return DnnInputs(frame, vocab, int((counts[0] or -1) + 1), int((counts[1] or -1) + 1),
                     FE.max_category_len(frame))


def q_dnn_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = build(spark, sf_dir)
    return d.frame.select("row_key", "uid", "iid", "rating", r6("stars").alias("stars"),
                          "review_count", "categories")


def q_dense_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = build(spark, sf_dir)
    stats = FE.column_stats(d.frame, DENSE)
    s = FE.standard_scale(FE.minmax_scale(d.frame, DENSE, stats), DENSE, stats)
    return s.select("row_key", *[r6(c + sfx).alias(c + sfx) for c in DENSE for sfx in ("_minmax", "_std")])


def q_category_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).vocab


def q_category_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = build(spark, sf_dir)
    items = d.frame.select("business_id", "categories").dropDuplicates(["business_id"])
    idx = FE.category_indices(items, d.vocab, "business_id")
    return FE.padded_sequences(items.select("business_id"), idx, "business_id", d.maxlen)


def model_tables(d: DnnInputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the rating models train on: ``rows`` (row_key, uid, iid, rating, dense: the min-max columns),
    ``items`` (iid, dense) and ``item_cats`` (iid, idx, weight: 1 / number of known categories, summed
    over repeats; index 0, unknown or padding, is masked)."""
    stats = FE.column_stats(d.frame, DENSE)
    f = FE.minmax_scale(d.frame, DENSE, stats).withColumn("dense", F.array(*[F.col(c + "_minmax").cast("double") for c in DENSE]))
    items = f.select("iid", "dense", "categories").dropDuplicates(["iid"])  # an item's columns are alike in all its rows
    cats = FE.category_indices(items, d.vocab, "iid").where("idx > 0").groupBy("iid", "idx").agg(F.count(F.lit(1)).alias("_n"))
    known = cats.groupBy("iid").agg(F.sum("_n").alias("_k"))
    return (f.select("row_key", "uid", "iid", "rating", "dense"), items.drop("categories"),
            cats.join(known, "iid").select("iid", "idx", (F.col("_n") / F.col("_k")).alias("weight")))


def fm_input(d: DnnInputs) -> DataFrame:
    """:func:`model_tables` as long sparse rows ``(row_key, feature, value)``: one-hot user and
    item blocks, the dense columns, then the category block."""
    rows, _, item_cats = model_tables(d)
    off_i, off_d = d.n_users, d.n_users + d.n_items
    off_c = off_d + len(DENSE)
    own = [F.struct(F.col("uid").alias("feature"), F.lit(1.0).alias("value")),
           F.struct((F.col("iid") + off_i).alias("feature"), F.lit(1.0).alias("value"))]
    own += [F.struct(F.lit(off_d + j).cast("long").alias("feature"), F.col("dense")[j].alias("value")) for j in range(len(DENSE))]
    one = rows.select("row_key", F.inline(F.array(*own)))
    cats = rows.join(item_cats, "iid").select("row_key", (F.col("idx") + off_c).alias("feature"), F.col("weight").alias("value"))
    return one.unionByName(cats).where("feature IS NOT NULL AND value <> 0")


def q_fm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fm_input(build(spark, sf_dir))
    return f.select("row_key", F.col("feature").cast("long").alias("feature"), r6("value").alias("value"))
