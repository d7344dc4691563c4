"""Session helpers.

The library never owns the session on a cluster: callers pass one in.  The
helpers here only build a local session for tests and benchmarks, and make
sure a reliable checkpoint directory exists before an iterative operator cuts
lineage.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tastebud", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (never used by the operators)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when it is unset on a local master (tests, bench) do we
    create one; a cluster without the setting is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: iterative "
                               "operators write their intermediate tables there")
        configured = tempfile.mkdtemp(prefix="tastebud-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    The driver finds the package on its own path; executors on other machines
    (and local workers started from another folder) don't.  The sources are
    zipped and handed to ``addPyFile``, which Spark serves to every executor."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tastebud-"), "tastebud.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tastebud", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")

