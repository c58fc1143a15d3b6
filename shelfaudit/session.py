"""Session helpers: a local session for tests, and staging of intermediates.

Staging writes an intermediate once as Parquet under the cluster's shared
``spark.checkpoint.dir`` and reads it back. That cuts the lineage (a lost
executor re-reads files instead of recomputing the join), lets the report
reuse one fact extract in many branches without rescanning the base
tables, and gives the optimizer real file sizes for its join choices.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (the cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfaudit")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans name their files in full
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a scratch one only if unset.

    Works for classic sessions (``SparkContext.getCheckpointDir``) and for
    sessions without a context (the ``spark.checkpoint.dir`` setting).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # a folder of this machine serves only where all tasks run on it
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = application_id(spark)
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="shelfaudit-ckpt-")
        configured = _SCRATCH[app]
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "session")


def staged_root(spark: SparkSession) -> str:
    """Folder of this application's staged intermediates (drop it after the run)."""
    return os.path.join(checkpoint_dir(spark), "staged", application_id(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    The write goes through Spark's commit protocol, so a task lost with its
    executor is simply redone; readers of the result never recompute the
    lineage behind it.
    """
    spark = df.sparkSession
    path = os.path.join(staged_root(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: reading it back needs no footer pass
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[str]:
    """Remove, at the end of the block, what was staged in it (results must be written by then)."""
    root = staged_root(spark)
    names = _listed(spark, root)
    try:
        yield root
    finally:
        fs, path = _folder(spark, root)
        for name in _listed(spark, root) - names:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path, name), True)


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _listed(spark: SparkSession, root: str) -> set[str]:
    fs, path = _folder(spark, root)
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def scale_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Runtime SQL settings for a report run on a cluster.

    ``shuffle_bytes`` is the largest volume one exchange moves. For the daily
    report that is one day of order lines after the id-range filter, not the
    table size. Shuffle partitions are an upper bound sized to
    ``partition_bytes`` each (at least two waves of the cores); AQE coalesces
    small ones and splits skewed ones. File splits stay at ``partition_bytes``
    so scan tasks fit executor memory.
    """
    parts = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for key, value in conf.items():
        spark.conf.set(key, value)
