"""Sharding by weighted rendezvous (highest-random-weight) hashing.

Every (record key, shard) pair gets a pseudo-random number ``u`` in (0, 1) from
a hash of both; the record goes to the shard with the smallest ``-ln(u) / weight``.
A shard's score for a key doesn't depend on the other shards, so adding a shard
only moves the records that the new shard wins, a fraction ``w_new / sum(w)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard index (int) of ``key``.  ``weights[j]`` is the weight of shard j;
    shards of weight 0 get nothing.  Equal scores go to the lower index.  A null
    key hashes like the constant it is skipped for, so all nulls share a shard."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a positive weight")
    shards = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(w)).alias("w")) for j, w in enumerate(weights) if w > 0])

    def score(s: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(s["j"], key), 11).cast("double") + 0.5) * F.lit(2.0 ** -53)
        return F.struct((-F.log(u) / s["w"]).alias("score"), s["j"].alias("shard"))

    return F.array_min(F.transform(shards, score))["shard"]


def with_slots(df: DataFrame, shard: str, key: Column, rows_per_bucket: int = 5_000,
               rows: int | None = None) -> DataFrame:
    """Add ``slot``: each shard's rows numbered 0, 1, 2 ... without gaps.

    A shard may hold any share of the rows, so it is numbered in buckets (a hash
    of ``key``): rows per bucket are counted, a running sum over a shard's few
    buckets gives each bucket its first slot, and only rows of one bucket are
    ordered together.  Rows that share a key share a bucket; ``df`` must be a
    written table, because it is read twice."""
    n = df.count() if rows is None else rows
    shards = max(1, df.select(shard).distinct().count())
    buckets = max(1, -(-n // (shards * rows_per_bucket)))
    d = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit("slot"), key), F.lit(buckets)).cast("int"))
    first = (d.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", F.sum("_n").over(
                 Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
             .select(F.col(shard).alias("_s"), F.col("_bucket").alias("_b"),
                     F.coalesce("_first", F.lit(0)).alias("_first")))
    w = Window.partitionBy(shard, "_bucket").orderBy(*[F.col(c) for c in df.columns])
    return (d.withColumn("_i", F.row_number().over(w) - 1)
            .join(first, F.col(shard).eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
            .withColumn("slot", (F.col("_i") + F.col("_first")).cast("long"))
            .drop("_bucket", "_i", "_s", "_b", "_first"))


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """Shard rows of ``documents`` by ``doc_id``.

    Returns ``doc_id, size, text_crc32, shard, slot`` and, with ``grown`` (the
    weights after a change), ``grown_shard``.  ``size``: UTF-8 bytes of the text
    plus 8 for the key; a null text has no bytes.  Rows with a null ``doc_id``
    share a shard; repeated rows share a shard and have slots of their own.
    Only keys, sizes and checksums are shuffled, never texts."""
    key = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cols = [key.alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), rendezvous(key, weights).alias("shard")]
    if grown is not None:
        cols.append(rendezvous(key, grown).alias("grown_shard"))
    return with_slots(materialize(docs.select(*cols), "shards"), "shard", F.col("doc_id"))
