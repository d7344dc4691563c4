"""File sources and sinks: CSV, JSON lines, whitespace-separated word vectors.

Readers always take an explicit schema (no inference pass over the data).
Sinks write partitioned directories; a unique sub-folder per call keeps
retries idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .csv_scan import scan_csv

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
# Read only: an unquoted empty cell is a null and a quoted one an empty string, as they are written.
CSV_READ_OPTIONS = CSV_OPTIONS | {"nullValue": "\0", "emptyValue": ""}


def schema_of(df: DataFrame) -> StructType:
    return df.schema


def write_csv(df: DataFrame, root: str, name: str | None = None) -> str:
    path = f"{root.rstrip('/')}/{name or uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV scan with header/quote handling, a large file in many tasks; nulls and empty strings stay apart."""
    return scan_csv(spark, path, schema, CSV_READ_OPTIONS)


def write_json_lines(df: DataFrame, root: str, name: str | None = None) -> str:
    path = f"{root.rstrip('/')}/{name or uuid.uuid4().hex}"
    df.write.mode("overwrite").json(path)
    return path


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON-lines scan; with no schema the raw lines come back as ``value``
    (for dynamic-schema flattening)."""
    if schema is None:
        return spark.read.text(path)
    return spark.read.schema(schema).json(path)


def read_word_vectors(spark: SparkSession, path: str, vocab: DataFrame | None = None,
                      token: str = "token") -> DataFrame:
    """``word f1 ... fd`` text lines -> ``(token, vec array<float>)``, optionally
    kept only for tokens in ``vocab`` (semi join)."""
    parts = spark.read.text(path).select(F.split(F.trim("value"), " +").alias("p"))
    vecs = parts.select(F.element_at("p", 1).alias(token),
                        F.transform(F.slice("p", 2, F.size("p") - 1),
                                    lambda x: x.cast("float")).alias("vec"))
    return vecs.join(vocab.select(token), token, "left_semi") if vocab is not None else vecs
