"""Dense integer ids, id maps and the canonical rating triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def ordered_index(rows: DataFrame, order: list[Column], out: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based contiguous position ``out`` in ``order`` to every row of ``rows``.

    Range-partitions the rows, numbers them inside each partition and adds
    the row count of all earlier partitions (a table with one row per
    partition, so its broadcast is bounded by the partition count).  There is
    no single-partition window over the rows themselves.  ``order`` must be a
    total order for the ids to be deterministic.
    """
    spark = rows.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = rows.columns
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = materialize(ordered.select(
        *cols, F.spark_partition_id().alias("_p"),
        F.monotonically_increasing_id().alias("_m")), "ordered-index")
    counts = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", "_m0",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_p")
            .select(*cols, (F.col("_off") + F.col("_m") - F.col("_m0")).cast("long").alias(out)))


def dense_index(keys: DataFrame, key: str, out: str = "id") -> DataFrame:
    """``(key, out)``: 0-based ids of the distinct non-null keys in sorted key order."""
    # the sort reads its rows twice
    distinct = materialize(keys.select(key).where(F.col(key).isNotNull()).distinct(), "distinct-keys")
    return ordered_index(distinct, [F.col(key).asc()], out)


def id_maps(rating_rows: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User map over all ratings and item map over the selected businesses."""
    umap = dense_index(rating_rows.select("user_id"), "user_id", "uid")
    imap = dense_index(items.select("business_id"), "business_id", "iid")
    return umap, imap


def rating_triples(rating_rows: DataFrame, umap: DataFrame, imap: DataFrame,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``(uid, iid, stars, *keep)`` with dense ids; ratings of unselected items
    dropped (inner join), before the others meet the larger user map."""
    r = rating_rows.select("user_id", "business_id", "stars", *keep)
    return (r.join(imap, "business_id").join(umap, "user_id")
            .select("uid", "iid", F.col("stars").cast("double").alias("stars"), *keep))


def string_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Frequency-ordered index map ``(col, out)``: most frequent value = 0, ties
    alphabetical (the ``StringIndexer`` order), computed distributed."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    return ordered_index(counts, [F.col("_c").desc(), F.col(col).asc()], out).drop("_c")
