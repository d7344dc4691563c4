"""Registered queries: model fitting, evaluation and recommendation."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_rating, md5_bucket, r6
from ..functions.text import vectorizer_tokens
from ..operators import bias, features as FE, fm, models, validation
from ..operators.common import join_small, materialize
from ..operators import text as T
from ..sources import catalog
from . import base, dnn
from .recsys import BIAS_CONFIG
from .tables import _keyed_triples, labelled_reviews
from .text import MAX_VOCAB

N_FOLDS = 5
# The reference's grid.
GRID_EPOCHS = (5, 10, 15, 20, 25)
GRID_REG_U = (5, 10, 15, 20)
GRID_REG_I = (5, 10, 15)
# The reference's ad-hoc sentiment texts.
ADHOC_TEXTS = [
    "Amazing!",
    "The food is amazing!",
    "The restaurant is amazing!",
    "Wow the restaurant is amazing!",
    "Wow wow wow the restaurant is amazing!",
    "Oh oh oh the restaurant is amazing!",
    "The restaurant is amazing! I really like it. Definitely recommend it.",
]


# ------------------------------------------------------------------ bias baseline evaluation

def _bias_holdout(spark: SparkSession, sf_dir: str):
    t = validation.holdout_split(_keyed_triples(spark, sf_dir), "review_id", 80)
    m = bias.fit_bias(t.where("split = 'train'"), BIAS_CONFIG)
    pred = bias.predict_bias(m, t.where("split = 'test'"))
    return pred


def q_bias_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _bias_holdout(spark, sf_dir)
    return p.select("review_id", "uid", "iid", "stars", r6("prediction").alias("prediction"))


def q_bias_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = validation.rmse(_bias_holdout(spark, sf_dir))
    return r.select("n", r6("rmse").alias("rmse"))


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _keyed_triples(spark, sf_dir)
    return t.withColumn("fold", md5_bucket("review_id", N_FOLDS))


def q_bias_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold cross-validated RMSE of the default bias model (one row per fold)."""
    t = _folded(spark, sf_dir)
    c = BIAS_CONFIG
    fits = bias.fit_bias_folds(t, "fold", N_FOLDS, [(c.reg_u, c.reg_i)], c.n_epochs)
    r = bias.fold_rmse(t, "fold", fits, [c.n_epochs])
    return r.select("fold", "n", r6("rmse").alias("rmse"))


def q_bias_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean 5-fold RMSE of every (n_epochs, reg_u, reg_i) in the grid; all 60
    (fold, reg_u, reg_i) fits run together, and the epoch values are snapshots
    of one 25-epoch run."""
    t = _folded(spark, sf_dir)
    regs = [(float(ru), float(ri)) for ru, ri in itertools.product(GRID_REG_U, GRID_REG_I)]
    fits = bias.fit_bias_folds(t, "fold", N_FOLDS, regs, max(GRID_EPOCHS), GRID_EPOCHS)
    spark_cfg = spark.createDataFrame([(i, ru, ri) for i, (ru, ri) in enumerate(regs)],
                                      "cfg int, reg_u double, reg_i double")
    rows = bias.fold_rmse(t, "fold", fits, GRID_EPOCHS).withColumnRenamed("epoch", "n_epochs")
    g = rows.join(F.broadcast(spark_cfg), "cfg").groupBy("n_epochs", "reg_u", "reg_i").agg(
        F.avg("rmse").alias("rmse"))
    w = Window.orderBy(F.round("rmse", 9), "n_epochs", "reg_u", "reg_i")  # 60 rows
    return g.select(F.col("n_epochs").cast("int").alias("n_epochs"), "reg_u", "reg_i",
                    r6("rmse").alias("rmse"),
                    (F.row_number().over(w) == 1).cast("int").alias("is_best"))


# ------------------------------------------------------------------ ALS

def _als(spark: SparkSession, sf_dir: str):
    t = validation.holdout_split(_keyed_triples(spark, sf_dir), "review_id", 80)
    m = models.fit_als(t.where("split = 'train'"))
    return t, m


def q_als_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base.build(spark, sf_dir)
    m = models.fit_als(b.triples)
    top = models.als_topn(m, base.TOP_N).withColumn("score", F.round("score", 4))
    return base.decorate(top, base.decoration(b.items), base.user_rated_counts(b.triples))


def _list_shapes(top: DataFrame) -> DataFrame:
    """Of each user's recommendations: how many, over which ranks, of how many items."""
    return top.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").cast("long").alias("first_rank"),
        F.max("rank").cast("long").alias("last_rank"), F.count_distinct("iid").alias("n_items"))


ALS_GRID = {"rank": (10, 20), "regParam": (0.05, 0.1)}
ALS_FOLDS = 3


def q_als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean cross-validated RMSE of ALS for every combination of the grid, the best marked."""
    t = validation.assign_folds(_keyed_triples(spark, sf_dir), "review_id", ALS_FOLDS)
    _, scores = models.als_grid(t, "fold", ALS_FOLDS, ALS_GRID)
    best = min(range(len(scores)), key=lambda i: (round(scores[i][1], 9), i))
    return spark.createDataFrame([(c.rank, c.regParam, round(s, 4), int(i == best)) for i, (c, s) in enumerate(scores)],
                                 "rank int, reg_param double, rmse double, is_best int")


def q_als_grid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of the grid has an RMSE within the span of the ratings, and one is best."""
    g = q_als_grid(spark, sf_dir)
    span, n = base.build(spark, sf_dir).triples.agg(F.max("stars") - F.min("stars"), F.count(F.lit(1))).first()
    n_best = F.sum("is_best").over(Window.partitionBy()).cast("int")  # a row for each combination
    return g.select("rank", "reg_param", F.col("rmse").between(0, span).cast("int").alias("rmse_in_span"),
                    n_best.alias("n_best"), F.lit(n).cast("long").alias("n_ratings"))


def q_als_topn_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's number of ratings and of recommended items that come with name and mean rating."""
    top = q_als_topn(spark, sf_dir)
    return top.groupBy("uid", "n_rated").agg(
        F.count_if(F.col("name").isNotNull() & F.col("avg_stars").between(1, 5)).alias("n_decorated"))


def q_als_topn_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rated user has a whole list of different items."""
    return _list_shapes(q_als_topn(spark, sf_dir))


def q_fm_topn_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rated user has a whole list of different items; predictions are ratings."""
    top = q_fm_topn(spark, sf_dir)
    return _list_shapes(top.where("pred BETWEEN 1 AND 5"))


def q_als_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, m = _als(spark, sf_dir)
    test = t.where("split = 'test'").select("review_id", F.col("uid").cast("int").alias("uid"),
                                            F.col("iid").cast("int").alias("iid"), "stars")
    return m.transform(test).select("review_id", "uid", "iid", "stars",
                                    F.round("prediction", 4).alias("prediction"))


def q_als_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, m = _als(spark, sf_dir)
    test = t.where("split = 'test'").select(F.col("uid").cast("int").alias("uid"),
                                            F.col("iid").cast("int").alias("iid"), "stars")
    r = validation.rmse(m.transform(test))
    return r.select("n", F.round("rmse", 4).alias("rmse"))


# ------------------------------------------------------------------ factorisation machine

def _fm(spark: SparkSession, sf_dir: str):
    d = dnn.build(spark, sf_dir)
    rows, items, item_cats = dnn.model_tables(d)
    rows = rows.where(F.col("uid").isNotNull()).withColumn(
        "split", F.when(md5_bucket("row_key", 100) < 80, "train").otherwise("test"))
    m = fm.fit_fm(rows.where("split = 'train'"), items, item_cats, len(dnn.DENSE))
    return d, rows, items, m


def q_fm_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows, _, m = _fm(spark, sf_dir)
    p = fm.predict_fm(m, rows.where("split = 'test'"))
    return p.select("row_key", "uid", "iid", "rating",
                    F.round(clip_rating("prediction"), 4).alias("prediction"))


def q_fm_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, rows, items, m = _fm(spark, sf_dir)
    top = fm.fm_topn(m, items, rows.select("uid").distinct(), base.TOP_N)
    top = top.select("uid", "rank", "iid", F.round(clip_rating("score"), 4).alias("pred"))
    shown = d.frame.where("uid IS NOT NULL")
    items = d.frame.groupBy("iid").agg(  # an item's columns are alike in all its rows
        F.first("business_id").alias("business_id"), F.first("categories").alias("categories"),
        F.round(F.first("stars"), 6).alias("avg_stars"), F.first("review_count").alias("review_count"))
    return base.decorate(top, items, base.user_rated_counts(shown))


# ------------------------------------------------------------------ text regression

def _sentiment(spark: SparkSession, sf_dir: str):
    lab = validation.ordered_marks(labelled_reviews(spark, sf_dir).select("review_id", "text", "stars"), "review_id", 0.8)
    table = catalog.table(spark, sf_dir, "embeddings")
    wv = materialize(T.word_vectors(T.text_vocab(lab.where("split = 'train'"), "text", MAX_VOCAB), table), "word-vectors")
    dim = int(table.agg(F.max(F.size("embedding"))).first()[0] or 0)
    dv = T.doc_means(lab, wv)
    # a review id that several rows share: each of its rows meets the split of each
    twice = materialize(lab.groupBy("review_id").agg(
        F.count_if(F.col("split") == "train").cast("int").alias("_a"), F.count_if(F.col("split") == "test").cast("int").alias("_b")
    ).where("_a + _b > 1"), "shared-ids")
    own = join_small(lab.withColumn("tokens", vectorizer_tokens("text")).drop("text"), twice, "review_id", "left").withColumn(
        "split", F.explode(F.when(F.col("_a").isNull(), F.array("split")).otherwise(
            F.concat(F.array_repeat(F.lit("train"), F.col("_a")), F.array_repeat(F.lit("test"), F.col("_b")))))).drop("_a", "_b")
    rows = materialize(models.docvec_column(own, dv, dim), "sentiment-rows")
    model = models.text_regression_pipeline().fit(rows.where("split = 'train'"))
    return rows, model, wv, dim


def q_sentiment_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, _, _ = _sentiment(spark, sf_dir)
    p = model.transform(rows.where("split = 'test'"))
    return p.select("review_id", "stars", F.round("prediction", 4).alias("prediction"))


def q_sentiment_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, _, _ = _sentiment(spark, sf_dir)
    test = model.transform(rows.where("split = 'test'"))
    mean_train = rows.where("split = 'train'").agg(F.avg("stars")).first()[0]
    e = F.pow(F.col("stars") - F.col("prediction"), 2)
    b = F.pow(F.col("stars") - F.lit(mean_train), 2)
    return test.agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(e)), 4).alias("rmse"),
                    F.round(F.sqrt(F.avg(b)), 4).alias("baseline_rmse"))


def q_sentiment_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, wv, dim = _sentiment(spark, sf_dir)
    adhoc = spark.createDataFrame([(-(i + 1), t) for i, t in enumerate(ADHOC_TEXTS)],
                                  "review_id long, text string")
    dv = T.doc_means(adhoc, wv)
    x = models.docvec_column(adhoc.withColumn("tokens", vectorizer_tokens("text")), dv, dim)
    return model.transform(x).select("text", F.round("prediction", 4).alias("prediction"))


def q_worst_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, _, _ = _sentiment(spark, sf_dir)
    p = model.transform(rows.where("split = 'train'")).withColumn(
        "abs_residual", F.abs(F.col("stars") - F.col("prediction")))
    top = p.orderBy(F.round("abs_residual", 9).desc(), F.col("review_id").asc()).limit(5)
    return top.select("review_id", "stars", F.round("prediction", 4).alias("prediction"),
                      F.round("abs_residual", 4).alias("abs_residual"))


# ------------------------------------------------------------------ DeepFM

def _deepfm(spark: SparkSession, sf_dir: str):
    from ..operators import deepfm
    d = dnn.build(spark, sf_dir)
    stats = FE.column_stats(d.frame, dnn.DENSE)
    f = FE.minmax_scale(d.frame, dnn.DENSE, stats)
    rows = f.where(F.col("uid").isNotNull()).select(
        "row_key", "uid", "iid", "rating",
        F.array(*[F.col(c + "_minmax").cast("double") for c in dnn.DENSE]).alias("dense"),
        F.when(md5_bucket("row_key", 100) < 80, "train").otherwise("test").alias("split"))
    items = f.select("iid", "categories").dropDuplicates(["iid"])
    item_cats = FE.category_indices(items, d.vocab, "iid").where("idx > 0")
    n_cats = int(d.vocab.agg(F.max("idx")).first()[0] or 0)
    m = deepfm.fit_deepfm(rows.where("split = 'train'"), f.select("uid").where("uid IS NOT NULL").distinct(),
                          items.select("iid"), item_cats, n_cats,
                          deepfm.DeepFMConfig(n_dense=len(dnn.DENSE)))
    return deepfm.predict_deepfm(m, rows.where("split = 'test'"))


def q_deepfm_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _deepfm(spark, sf_dir)
    return p.select("row_key", "uid", "iid", "rating", F.round(clip_rating("prediction"), 4).alias("prediction"))
