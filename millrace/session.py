"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Open windows of a stream are kept on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Where a local session without spark.checkpoint.dir keeps its scratch tables.
_local_root: str | None = None


def get_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; the cluster's own settings stay otherwise.

    Extra settings go in ``conf`` with ``__`` in place of dots. ``size_shuffles`` fits the number
    of shuffle partitions to the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession, *paths: str, partition_bytes: int = 128 << 20, growth: float = 1.0
) -> int:
    """Set the number of shuffle partitions from the size of the inputs; returns it.

    Adaptive execution merges partitions that turn out small but never makes more than it started
    with, so the start has to fit the data. ``growth`` is the size of shuffled rows relative to the
    stored files (compression, or windows that copy rows).
    """
    total = 0
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    wanted = math.ceil(total * growth / partition_bytes)
    number = max(wanted, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by all executors for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) may fall back to a temporary folder.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="millrace-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "cut"):
    """Write ``df`` to the shared folder and read it back, so later work does not recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
