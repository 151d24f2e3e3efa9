"""Session construction and shared-storage locations.

Jobs never pick a machine-local folder on their own: anything that must
survive an executor loss (stream checkpoints, lineage cuts, scratch
tables) lives under the shared folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (a laptop or a
test run) do we create one and record it on the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # round-robin repartition stays deterministic when a task is re-run
    "spark.sql.execution.sortBeforeRepartition": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "roadpulse",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Most shuffle partitions: map outputs x reduce partitions must stay trackable.
MAX_SHUFFLE_PARTITIONS = 20_000


def sizing(input_bytes: int, total_cores: int, shuffle_bytes: int | None = None,
           target_bytes: int = 256 << 20) -> dict:
    """Scan-split and shuffle sizing for a job reading ``input_bytes``.

    The shuffle width follows the bytes that are shuffled (a tenth of the input
    unless given: jobs here shuffle partial aggregates and few columns), at least
    two waves of the cluster and at most ``MAX_SHUFFLE_PARTITIONS``; AQE merges
    small partitions to the advisory size and splits skewed ones.
    """
    moved = input_bytes // 10 if shuffle_bytes is None else shuffle_bytes
    width = min(MAX_SHUFFLE_PARTITIONS, max(2 * total_cores, moved // target_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_bytes),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir``); set one only when the
    cluster did not name any, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local-cluster")) \
                and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="roadpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return root


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh location under the shared checkpoint folder."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(checkpoint_root(spark), "roadpulse", *leaf)


def spread(df, partitions: int | None = None):
    """Deal rows evenly over the cores, for costly work per row after a scan with few splits.

    A round-robin exchange, deterministic under retries (see ``DEFAULT_CONF``).
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def even(df, *by: str):
    """Deal rows over tasks of a size that does not grow with the input, for sorts and aggregates after a scan.

    A scan's splits are cut by compressed bytes, and ``spread`` makes as many partitions as
    there are cores: either way a task's rows grow with the table. Rows are hashed by the
    given columns (all without any); AQE splits and merges the partitions to its advisory size.
    """
    return df.hint("rebalance", *(by or df.columns))


def shuffle_width(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions for ``rows`` at about ``rows_per_task`` each, at least the session's width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that are gone.

    Its cleaner acts when the driver's heap is collected, which a driver with room
    seldom does: the files of all earlier steps stay on the executors' disks till then.
    """
    spark._jvm.System.gc()


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch location that its caller is done with."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
