"""Content-based recommendation from business attributes.

Item features (long form ``(iid, feature, value)``):
  * one-hot of scalar attributes, named ``var_value``; absent -> no bit;
  * dict attributes (``Ambience``, ``BusinessParking``): bare ``True`` -> 1 under
    the key, ``False``/``None`` -> nothing, numbers -> their value, quoted
    strings -> ``key=value`` 1.  Keys are prefixed ``Ambience.`` unless
    ``prefix=False``.
Document frequency ``df_f = sum_i F_if``; features with ``df_f < min_df`` are
dropped; ``idf_f = ln(m / df_f)`` with ``m`` the number of items.
Profile ``p_uf = idf_f * sum_{ratings of u} max(stars - 2.9, 0) * F_if``.
Score ``s_ui = sum_f F_if p_uf / max(||F_i||, 0.01)``.
Ranking everywhere: ``round(score, 6)`` desc, then ``iid`` asc.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literals
from ..functions.scalars import NORM_FLOOR, like_weight
from . import blocked
from .common import materialize, top_n_per_group
from .ids import ordered_index

# Attribute names used as features.
ATTRIBUTES_BOOLEAN = ["Open24Hours", "HappyHour", "DogsAllowed", "WheelchairAccessible",
                      "GoodForKids", "OutdoorSeating", "GoodForDancing", "GoodForGroups"]
ATTRIBUTES_CAT = ["RestaurantsAttire", "NoiseLevel", "Wifi", "Alcohol", "Smoking",
                  "RestaurantsPriceRange2"]
ATTRIBUTES_DICT = ["Ambience", "BusinessParking"]
ATTRIBUTES = ATTRIBUTES_BOOLEAN + ATTRIBUTES_CAT
DEFAULT_MIN_DF = 10



def onehot_features(items: DataFrame, attributes: Sequence[str] = ATTRIBUTES,
                    map_col: str = "attributes") -> DataFrame:
    """``(iid, feature, value=1)`` for every present scalar attribute."""
    names = F.array(*[F.lit(a) for a in attributes])
    kv = items.select("iid", F.explode(F.map_filter(map_col, lambda k, v: F.array_contains(names, k)))
                      .alias("var", "raw"))
    return kv.select("iid", F.concat("var", F.lit("_"), literals.literal_scalar("raw")).alias("feature"),
                     F.lit(1.0).alias("value"))


def dict_features(items: DataFrame, attributes: Sequence[str] = ATTRIBUTES_DICT,
                  map_col: str = "attributes", prefix: bool = True) -> DataFrame:
    """``(iid, feature, value)`` from dict-literal attributes (non-zero entries only)."""
    out = None
    for a in attributes:
        e = items.select("iid", F.explode(literals.literal_dict_entries(
            F.element_at(F.col(map_col), F.lit(a)))).alias("e"))
        key = F.concat(F.lit(f"{a}."), F.col("e.key")) if prefix else F.col("e.key")
        bare = F.col("e.value")
        val = (F.when(F.col("e.quoted"), F.lit(1.0))
               .when(bare == "True", F.lit(1.0))
               .when(bare.isin("False", "None"), F.lit(0.0))
               .otherwise(bare.cast("double")))
        name = F.when(F.col("e.quoted"), F.concat(key, F.lit("="), F.col("e.value"))).otherwise(key)
        f = e.select("iid", name.alias("feature"), val.alias("value")).where(
            F.col("value").isNotNull() & (F.col("value") != 0))
        out = f if out is None else out.unionByName(f)
    return out


def item_features(items: DataFrame, prefix: bool = True) -> DataFrame:
    """All item features: scalar one-hot plus dict features."""
    return onehot_features(items).unionByName(dict_features(items, prefix=prefix))


def feature_idf(features: DataFrame, n_items: int | None = None,
                min_df: int = DEFAULT_MIN_DF, items: DataFrame | None = None) -> DataFrame:
    """``(feature, df, kept, idf)``; dropped features keep their df and a null idf."""
    if n_items is None:
        n_items = items.count()
    df = features.groupBy("feature").agg(F.sum("value").alias("df"))
    kept = F.col("df") >= F.lit(min_df)
    return df.select("feature", "df", kept.alias("kept"),
                     F.when(kept, F.log(F.lit(float(n_items)) / F.col("df"))).alias("idf"))


def kept_features(features: DataFrame, idf: DataFrame) -> DataFrame:
    """Feature rows of the kept features, with their idf."""
    return features.join(idf.where("kept").select("feature", "idf"), "feature")


def user_profiles(triples: DataFrame, kfeatures: DataFrame) -> DataFrame:
    """``(uid, feature, weight)`` for features with positive weight.

    Ratings aggregate per (iid, uid) first, so a hot item or user is
    pre-aggregated before the join with the item features."""
    w = (triples.select("uid", "iid", like_weight("stars").alias("w")).where("w > 0")
         .groupBy("uid", "iid").agg(F.sum("w").alias("w")))
    j = w.join(kfeatures, "iid")
    return (j.groupBy("uid", "feature")
            .agg((F.sum(F.col("w") * F.col("value")) * F.first("idf")).alias("weight"))
            .where("weight > 0"))


def item_norms(kfeatures: DataFrame) -> DataFrame:
    return kfeatures.groupBy("iid").agg(
        F.greatest(F.sqrt(F.sum(F.col("value") * F.col("value"))), F.lit(NORM_FLOOR)).alias("norm"))


def scores_for_pairs(pairs: DataFrame, profiles: DataFrame, kfeatures: DataFrame) -> DataFrame:
    """Scores of given ``(uid, iid)`` pairs: equi-joins on (iid) and (uid, feature);
    rows grow with pairs x features per item, not with users x items."""
    pf = pairs.select("uid", "iid").distinct().join(kfeatures.select("iid", "feature", "value"), "iid")
    contrib = pf.join(profiles, ["uid", "feature"], "left").groupBy("uid", "iid").agg(
        F.sum(F.col("value") * F.coalesce("weight", F.lit(0.0))).alias("dot"))
    full = pairs.select("uid", "iid").distinct().join(contrib, ["uid", "iid"], "left")
    return (full.join(item_norms(kfeatures), "iid", "left")
            .select("uid", "iid", (F.coalesce("dot", F.lit(0.0))
                                   / F.coalesce("norm", F.lit(NORM_FLOOR))).alias("score")))


# ------------------------------------------------------------------ top-n for all users

def item_signatures(items: DataFrame, kfeatures: DataFrame) -> DataFrame:
    """``sig, iid, fv``: items with identical kept-feature vectors share a ``sig``; ``fv`` is the
    vector, ``feature, value`` by feature.  Items without kept features share the empty
    signature (score 0 for everyone).  The per-item feature list is bounded by
    the number of attributes.
    """
    per_item = kfeatures.groupBy("iid").agg(F.sort_array(F.collect_list(
        F.struct("feature", "value"))).alias("fv"))
    all_items = items.select("iid").join(per_item, "iid", "left").select(
        "iid", F.coalesce("fv", F.array().cast("array<struct<feature:string,value:double>>")).alias("fv"))
    return all_items.select(F.sha2(F.to_json("fv"), 256).alias("sig"), "iid", "fv")


def content_topn_all(triples: DataFrame, items: DataFrame, kfeatures: DataFrame,
                     profiles: DataFrame, n: int = 5, users: DataFrame | None = None,
                     exclude_seen: bool = False) -> DataFrame:
    """Top-n items for every user with ratings, or for the ``users`` subset:
    ``(uid, rank, iid, score)``; ``exclude_seen`` drops each user's rated items.

    Items collapse to signatures; signature vectors scaled by ``1/max(norm, 0.01)``
    are scored against all user profiles with :func:`blocked.blocked_top_n`,
    so no user x item rows are materialised.  The empty signature scores 0, which
    fills users with few liked features up to n (lowest iids first).
    """
    feats = materialize(ordered_index(kfeatures.select("feature").distinct(), [F.col("feature").asc()], "fidx"), "features")
    n_feat = feats.count()
    sig_items = item_signatures(items, kfeatures)
    seen = None
    per_sig = n
    if exclude_seen:
        # a signature must offer n ids beyond any user's rated ones
        seen = triples.select(F.col("uid").alias("qid"), F.col("iid").alias("cid")).distinct()
        per_sig = n + int(seen.groupBy("qid").count().agg(F.max("count")).first()[0] or 0)
    # a signature's first ids only: at most per_sig of them
    cands = (top_n_per_group(sig_items, "sig", [F.col("iid").asc()], per_sig, "pos")
             .groupBy("sig").agg(F.sort_array(F.collect_list("iid")).alias("cids"), F.first("fv").alias("fv")))
    norm = F.greatest(F.sqrt(F.aggregate("fv", F.lit(0.0), lambda s, x: s + x["value"] * x["value"])), F.lit(NORM_FLOOR))
    cells = (cands.select("sig", norm.alias("norm"), F.explode("fv").alias("x")).join(feats, F.col("x.feature") == F.col("feature"))
             .groupBy("sig").agg(F.collect_list("fidx").alias("fidx"), F.collect_list(F.col("x.value") / F.col("norm")).alias("w")))
    no_fidx, no_w = F.array().cast("array<bigint>"), F.array().cast("array<double>")
    targets = cands.select("sig", "cids").join(cells, "sig", "left").select(
        "cids", F.coalesce("fidx", no_fidx).alias("fidx"), F.coalesce("w", no_w).alias("w"))
    # every user with ratings, or the given subset ``(uid)`` (semi join)
    rated = triples.select("uid").distinct()
    users = rated if users is None else rated.join(users.select("uid"), "uid", "left_semi")
    prof = (profiles.join(feats, "feature")
            .groupBy("uid").agg(F.collect_list("fidx").alias("fidx"), F.collect_list("weight").alias("w")))
    queries = users.join(prof, "uid", "left").select(
        F.col("uid").alias("qid"), F.coalesce("fidx", no_fidx).alias("fidx"), F.coalesce("w", no_w).alias("w"))
    top = blocked.blocked_top_n(queries, targets, n_feat, n, exclude=seen)
    return top.select(F.col("qid").alias("uid"), "rank", F.col("cid").alias("iid"), "score")


def profile_top_features(profiles: DataFrame, k: int = 5) -> DataFrame:
    return top_n_per_group(profiles, "uid", [F.round("weight", 6).desc(), F.col("feature").asc()], k)


def item_top_features(kfeatures: DataFrame, k: int = 3) -> DataFrame:
    """Present features of each item ranked by idf desc, then name."""
    return top_n_per_group(kfeatures.select("iid", "feature", "idf"), "iid",
                           [F.round("idf", 9).desc(), F.col("feature").asc()], k, "feature_rank")
