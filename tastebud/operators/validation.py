"""Train/test splits, k folds, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import md5_bucket
from .common import materialize
from .ids import ordered_index


def holdout_split(df: DataFrame, key: str, train_pct: int = 80) -> DataFrame:
    """Adds ``split`` = train/test from a hash bucket of ``key`` (deterministic,
    partition-independent, no shuffle)."""
    return df.withColumn("split", F.when(md5_bucket(key, 100) < train_pct, "train")
                         .otherwise("test"))


def assign_folds(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Adds ``fold`` in ``[0, k)`` from a hash bucket of ``key``."""
    return df.withColumn("fold", md5_bucket(key, k))


def ordered_split(df: DataFrame, order: list[Column], train_fraction: float = 0.8) -> DataFrame:
    """Positional split: the first ``floor(n * train_fraction)`` rows in ``order``
    are train, the rest test.  Positions come from a distributed ordered index."""
    n = df.count()
    cut = int(n * train_fraction)
    pos = ordered_index(df, order, "pos")
    return pos.withColumn("split", F.when(F.col("pos") < cut, "train").otherwise("test"))


def ordered_marks(rows: DataFrame, key: str, train_fraction: float = 0.8) -> DataFrame:
    """``rows``, written once, with the ``split`` of :func:`ordered_split` by ``key`` (rows that share
    the key at the cut are told apart by their place in the written table).

    Only the keys are put in order: the last train row says on which side every row lies, so wide
    rows are never shuffled."""
    kept = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "ordered-marks")
    cut = int(kept.count() * train_fraction)
    last = ordered_index(kept.select(key, "_row"), [F.col(key).asc(), F.col("_row").asc()], "pos").where(F.col("pos") == cut - 1).first()
    if last is None:
        train = F.lit(False)
    elif last[key] is None:  # nulls come first
        train = F.col(key).isNull() & (F.col("_row") <= last["_row"])
    else:
        at = F.lit(last[key])
        train = F.col(key).isNull() | (F.col(key) < at) | ((F.col(key) == at) & (F.col("_row") <= last["_row"]))
    return kept.withColumn("split", F.when(train, "train").otherwise("test")).drop("_row")


def rmse(pred: DataFrame, label: str = "stars", prediction: str = "prediction") -> DataFrame:
    """One-row ``(n, mse, rmse)`` over rows with both values present."""
    d = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    e = F.pow(F.col(label) - F.col(prediction), 2)
    return d.agg(F.count(F.lit(1)).alias("n"), F.avg(e).alias("mse"),
                 F.sqrt(F.avg(e)).alias("rmse"))
