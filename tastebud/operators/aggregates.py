"""Profiling and matrix statistics over ratings and businesses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import split_categories

MAX_PIVOT_COLUMNS = 1000


def rating_matrix(triples: DataFrame) -> DataFrame:
    """Long user x item matrix: mean rating per (uid, iid) (duplicates averaged)."""
    return triples.groupBy("uid", "iid").agg(F.avg("stars").alias("rating"))


def pivot_matrix(triples: DataFrame, items: Sequence[int]) -> DataFrame:
    """Wide matrix for an explicit, bounded item list (one column per item)."""
    items = list(items)
    if len(items) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"pivot limited to {MAX_PIVOT_COLUMNS} item columns; use rating_matrix")
    return triples.groupBy("uid").pivot("iid", items).agg(F.avg("stars"))


def matrix_sparsity(triples: DataFrame) -> DataFrame:
    """Users, items, filled cells and ``1 - cells / (users * items)`` in one job.

    Distinct counts use a shuffle keyed by the value (no single task holds a
    whole group); the three counts come from one aggregation over the
    distinct (uid, iid) cells.
    """
    cells = triples.select("uid", "iid").distinct()
    s = cells.agg(F.count_distinct("uid").alias("n_users"), F.count_distinct("iid").alias("n_items"),
                  F.count(F.lit(1)).alias("n_cells"))
    return s.select("n_users", "n_items", "n_cells",
                    (F.lit(1.0) - F.col("n_cells") / (F.col("n_users") * F.col("n_items")))
                    .alias("sparsity"))


def category_counts(df: DataFrame, col: str = "categories") -> DataFrame:
    """``(category, n)``: occurrences of each ``", "``-separated category (null skipped), most frequent first."""
    return (df.select(F.explode(split_categories(col)).alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "category"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, non-nulls and the null fraction, from one aggregation pass; most nulls first."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_nn_{i}")
                                                 for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', _nn_{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column_name, n_nonnull)")
    return long.select("column_name", (F.col("_rows") - F.col("n_nonnull")).alias("n_null"),
                       "n_nonnull",
                       ((F.col("_rows") - F.col("n_nonnull")) / F.col("_rows")).alias("frac_null")).orderBy(F.col("n_null").desc(), "column_name")


def stars_by_open(business: DataFrame) -> DataFrame:
    """Half-star bins x open flag: business count and mean review count."""
    return (business.groupBy((F.floor(F.col("stars") * 2) / 2).alias("stars_bin"), "is_open")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("review_count").alias("avg_review_count")))


def geo_grid(business: DataFrame, cell: float = 0.05) -> DataFrame:
    """Average stars and business count per latitude/longitude cell."""
    return (business.groupBy(F.floor(F.col("latitude") / cell).alias("lat_cell"),
                             F.floor(F.col("longitude") / cell).alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("stars").alias("avg_stars")))


def attribute_counts(df: DataFrame, map_col: str = "attributes") -> DataFrame:
    """``(variable, value, n)``: value counts of every attribute key."""
    return (df.select(F.explode(map_col).alias("variable", "value"))
            .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
