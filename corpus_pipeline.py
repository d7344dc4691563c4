"""The corpus pipeline: documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``, whatever other columns those have and whatever their names.

A null text counts as empty: the quality classifier scores it as such, SimHash puts it into the
component of texts without words, of which one row stays; decontamination and PII leave it as it is, BPE
gives no ids.  Rows without a key are treated as any other, but stay after SimHash only where
their component has no row with one.  Repeated rows are judged alike; SimHash keeps one of them.
An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tastebud.llm import bpe, decontaminate, pii, quality, simhash
from tastebud.llm.common import fresh, scratch_dir, table
from tastebud.llm.queries import QUALITY_LEAST, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "quality_score")
    return quality.with_scores(docs, model, score).where(f"{score} >= {QUALITY_LEAST}").drop(score)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest ``doc_id``."""
    return simhash.one_of_each(docs, shingle=3, distance=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.mask(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of ids and of the decoded text."""
    return bpe.round_trip(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality_stage), ("SimHash near-dedup", simhash_stage), ("benchmark decontamination", decontamination_stage),
          ("PII", pii_stage), ("BPE encoding and decoding", bpe_stage)]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{scratch_dir(spark)}/pipeline-{i}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
