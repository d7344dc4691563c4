"""Registered queries of this subpackage: thin derivations of the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitplanes, bpe, decontaminate, divergence, embeddings, pii, quality, rank_bpe, sharding, simhash, substrings, suffix_array, token_output
from .common import scratch_dir, table

TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """A public vocabulary file: the installed package's, else the folder's."""
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def q_op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage within 20 % word edits of a benchmark item."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")).drop("ids")


def q_op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings of earlier documents."""
    d = suffix_array.remove_repeats(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def q_op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendezvous sharding of every document over 24 shards, and over 25."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 24, [1.0] * 25)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def q_op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as Simple-8b files and read back."""
    import uuid
    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_output.read_digests(spark, path)


#: Documents with a lower score are predicted to be of low quality.
QUALITY_LEAST = 0.3


def q_op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by trees fitted on its labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_scores(docs, model, "score").select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def q_op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components over all documents: 3-word shingles, at most 2 differing bits."""
    d = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding links and components at cosine 0.93 within a label."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def q_op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by rules and learnt contexts."""
    d = pii.per_document(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def q_op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier."""
    d = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def q_op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight centroids over all embeddings, ten rounds, exact integers."""
    return bitplanes.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024, prefix="3:")


def q_op12_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of every document by a rank file."""
    return rank_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


def q_op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language differ, and the terms each of them favours."""
    return divergence.audit(table(spark, sf_dir, "documents"), least_documents=30, top=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
