"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import materialize, scratch_dir  # noqa: F401  (re-exported helpers)
from ..session import ship_package

#: Order of a null record key: before every other.
NULL_KEY = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, other columns dropped (so that
    none of them can clash with a column an operator makes)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores if ``df`` has such a column (Spark doesn't tell upper from lower case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def input_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one narrow aggregate, used to size buckets."""
    return docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i]+lens[i]-1`` of all rows, concatenated."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total, dtype=np.int64)
