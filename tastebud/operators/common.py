"""Small helpers shared by operators: lineage cuts and top-n per group."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_dir(spark) -> str:
    """This application's folder for intermediate tables, under the session's
    checkpoint directory (shared storage on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tastebud/{spark.sparkContext.applicationId}"


def clear_scratch(spark) -> None:
    """Delete this application's intermediate tables (through the Hadoop
    FileSystem of the checkpoint directory).  Call once results are consumed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint directory and read it back.

    Used by iterative operators to cut lineage.  The table lives in the shared
    folder named by ``spark.checkpoint.dir``, so a lost executor costs a
    re-read, not a recomputation of all earlier iterations, and the file size
    gives the planner a real statistic for its (size-checked) broadcast choice.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known: no job to read it off the files
    out._scratch_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table that :func:`materialize` wrote and nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark) -> None:
    """Let Spark delete the files of shuffles that no query holds any more: it does so when the driver's
    heap is collected, which an iteration with little driver work doesn't bring about."""
    spark.sparkContext._jvm.System.gc()


# Bytes under which a table is broadcast to a join.
BROADCAST_MAX_BYTES = 64 << 20
# Bytes that all broadcasts of an iterative fit may come to: each passes the driver.
ITERATED_BYTES = 256 << 20


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row of fixed-width columns; others count as 64."""
    return sum(64 if f.dataType.typeName() in ("string", "binary", "array", "map", "struct", "vectorudt") else 8 for f in df.schema)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES, rows: int | None = None) -> DataFrame:
    """Join ``big`` with a table that is usually small (a model's parameter table).

    The small side is broadcast only after its rows are counted and their width is within
    ``max_bytes``; beyond it the planner's shuffle join (with AQE skew
    splitting) is used.  Meant for materialised inputs, whose count is read
    from file metadata; pass ``rows`` when the count is already known."""
    if (rows if rows is not None else small.count()) * row_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def top_n_per_group(df: DataFrame, group: str | list[str], order: list[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``1..n`` within each group by ``order`` (planned as a
    window group limit, so each task keeps only n rows per group before
    the final ranking)."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def update_config(cfg, params: dict, prefix: str | None = None, strict: bool = True):
    """A copy of the (frozen dataclass) model config ``cfg`` with ``params`` applied.

    With ``prefix``, only keys ``"<prefix>__<name>"`` are applied (stripped) and
    other keys are left to other configs, so one parameter dict can be routed
    to several models.  An unknown name raises ``ValueError`` (``strict``) or
    is reported with a warning and skipped.
    """
    import dataclasses
    import warnings

    names = {f.name for f in dataclasses.fields(cfg)}
    upd = {}
    for key, value in params.items():
        if prefix is not None:
            head, sep, rest = key.partition("__")
            if not sep or head != prefix:
                continue
            key = rest
        if key in names:
            upd[key] = value
        elif strict:
            raise ValueError(f"unknown parameter {key!r} for {type(cfg).__name__}")
        else:
            warnings.warn(f"ignoring unknown parameter {key!r} for {type(cfg).__name__}", stacklevel=2)
    return dataclasses.replace(cfg, **upd)
