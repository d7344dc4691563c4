"""Model-input features: the rating frame with business columns, dense
scaling, the category vocabulary, padded category sequences and the sparse
factorisation-machine input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import split_categories
from .common import materialize
from .ids import dense_index, ordered_index

DEFAULT_MIN_CATEGORY = 50


def rating_frame(rating_rows: DataFrame, business: DataFrame, keep: Sequence[str] = ("review_id",)) -> DataFrame:
    """Ratings right-joined to the selected businesses (unrated businesses kept
    with null user/rating); ``stars`` renamed ``rating`` first.  Users and items
    get label-encoded dense ids over the rows present (sorted raw key).

    The right join is an inner join, whose business side can be broadcast or whose
    hot businesses AQE can split, and the businesses that no rating has.  It is written once: both id
    maps read it before it meets them."""
    r = rating_rows.select("user_id", "business_id", F.col("stars").alias("rating"), *keep)
    b = business.select("business_id", "stars", "review_count", "categories")
    unrated = b.join(r.select("business_id").distinct(), "business_id", "left_anti")
    frame = materialize(r.join(b, "business_id").unionByName(unrated, allowMissingColumns=True), "rating-frame")
    umap = dense_index(frame.select("user_id"), "user_id", "uid")
    imap = dense_index(frame.select("business_id"), "business_id", "iid")
    return frame.join(umap, "user_id", "left").join(imap, "business_id")


def column_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, float, float]]:
    """min, max, mean, population std of each column (one aggregation, scalars only)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c), F.max(c), F.avg(c), F.stddev_pop(c)]
    row = df.agg(*aggs).first()
    return {c: tuple(float(row[4 * i + j]) if row[4 * i + j] is not None else 0.0 for j in range(4))
            for i, c in enumerate(cols)}


def minmax_scale(df: DataFrame, cols: Sequence[str], stats=None, suffix: str = "_minmax") -> DataFrame:
    """``(x - min) / (max - min)``; a constant column scales to 0."""
    stats = stats or column_stats(df, cols)
    for c in cols:
        lo, hi, _, _ = stats[c]
        span = hi - lo
        df = df.withColumn(c + suffix, (F.col(c) - F.lit(lo)) / F.lit(span) if span != 0 else F.lit(0.0))
    return df


def standard_scale(df: DataFrame, cols: Sequence[str], stats=None, suffix: str = "_std") -> DataFrame:
    """``(x - mean) / std_pop``; a constant column scales to 0."""
    stats = stats or column_stats(df, cols)
    for c in cols:
        _, _, mu, sd = stats[c]
        df = df.withColumn(c + suffix, (F.col(c) - F.lit(mu)) / F.lit(sd) if sd != 0 else F.lit(0.0))
    return df


def category_vocab(frame: DataFrame, drop: Sequence[str], min_count: int = DEFAULT_MIN_CATEGORY,
                   col: str = "categories", count_over: str = "ratings",
                   item: str = "business_id") -> DataFrame:
    """``(category, idx, n)``: categories counted over the frame's rows
    (``count_over='ratings'``) or over its distinct items (``'business'``),
    kept when ``n > min_count``, minus ``drop``; ``idx`` from 1 by count desc
    (ties: name).  Index 0 is shared by unknown categories and padding."""
    if count_over == "business":
        frame = frame.select(item, col).dropDuplicates([item])
    elif count_over != "ratings":
        raise ValueError("count_over must be 'ratings' or 'business'")
    cnt = (frame.select(F.explode(split_categories(col)).alias("category"))
           .groupBy("category").agg(F.count(F.lit(1)).alias("n")))
    kept = cnt.where(F.col("n") > F.lit(min_count)).where(~F.col("category").isin(list(drop)))
    idx = ordered_index(kept, [F.col("n").desc(), F.col("category").asc()], "_i")
    return idx.select("category", (F.col("_i") + 1).alias("idx"), "n")


def category_indices(df: DataFrame, vocab: DataFrame, key: str, col: str = "categories") -> DataFrame:
    """``(key, pos, idx)``: category list of each row as vocabulary indices
    (unknown -> 0); null categories give no rows."""
    ex = df.select(key, F.posexplode(split_categories(col)).alias("pos", "category"))
    return ex.join(vocab.select("category", "idx"), "category", "left").select(
        key, F.col("pos").cast("long").alias("pos"), F.coalesce("idx", F.lit(0)).cast("long").alias("idx"))


def max_category_len(df: DataFrame, col: str = "categories") -> int:
    v = df.agg(F.max(F.coalesce(F.size(split_categories(col)), F.lit(0)))).first()[0]
    return int(v or 0)


def padded_sequences(keys: DataFrame, indices: DataFrame, key: str, maxlen: int) -> DataFrame:
    """``(key, pos, idx)`` for ``pos`` in ``[0, maxlen)``: post-padding with 0."""
    grid = keys.select(key, F.explode(F.sequence(F.lit(0), F.lit(max(maxlen, 1) - 1))).alias("pos"))
    grid = grid.where(F.col("pos") < maxlen).select(key, F.col("pos").cast("long").alias("pos"))
    return grid.join(indices, [key, "pos"], "left").select(
        key, "pos", F.coalesce("idx", F.lit(0)).cast("long").alias("idx"))
