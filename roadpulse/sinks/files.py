"""Lake sinks (S5-S7, S11) and replay-safe writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import semi_join

BATCH_PARTITIONS = ("city", "date", "batch_ts")


def _spread(df: DataFrame, partition_by: Sequence[str], files_per_partition: int | None):
    """Shape the write tasks for the output partitions.

    * ``None`` (default): ``REBALANCE`` by the partition columns -- rows of one
      output partition go together, and AQE splits a skewed one (a city with a
      third of the rows) over several tasks and merges small ones.
    * ``n >= 1``: exactly ``n`` hash buckets per output partition. The bucket is
      a hash of the row itself (not ``rand``), so a task re-run after an
      executor loss sends every row to the same place again.
    * ``0``: write as the data is partitioned, no exchange.
    """
    if files_per_partition is None:
        return df.hint("rebalance", *partition_by)
    if files_per_partition == 0:
        return df
    cols = [F.col(c) for c in partition_by]
    if files_per_partition > 1:
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        cols.append(bucket)
    return df.repartition(*cols)


def write_batch(df: DataFrame, path: str, partition_by: Sequence[str] = BATCH_PARTITIONS,
                files_per_partition: int | None = None, fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite).

    With ``batch_ts`` as a partition level a retried batch overwrites its own
    files instead of appending a second copy.
    """
    (_spread(df, partition_by, files_per_partition).write
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd" if fmt == "parquet" else "none")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path))


overwrite_batches = write_batch


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ("city",),
                   files_per_partition: int | None = None) -> None:
    """Replace the whole table."""
    (_spread(df, partition_by, files_per_partition).write
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path))


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ("city",),
                 files_per_partition: int | None = None) -> None:
    """Append (not replay safe on its own; see ``append_missing``)."""
    (_spread(df, partition_by, files_per_partition).write
        .mode("append")
        .partitionBy(*partition_by)
        .parquet(path))


def write_raw(df: DataFrame, path: str, partition_by: Sequence[str] = ("city", "batch_ts"),
              files_per_partition: int | None = None, compression: str = "none") -> None:
    """Raw JSON lines, one file set per (city, batch), replaced on retry.

    Partition values live in directory names; read back with the declared
    schema and ``basePath`` to get them as columns again.
    """
    (_spread(df, partition_by, files_per_partition).write
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partition_by)
        .json(path))


def append_missing(df: DataFrame, existing: DataFrame, keys: Sequence[str],
                   prune_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not yet in ``existing`` (replay-safe append).

    ``prune_by`` (e.g. partition columns of ``existing``) first restricts
    ``existing`` to the partitions the batch touches, via a semi join on the
    batch's few distinct values, so the anti join never reads the full table.
    """
    keys = list(keys)
    if prune_by:
        touched = df.select(*prune_by).distinct()
        existing = semi_join(existing, touched, list(prune_by), null_safe=False)
    return semi_join(df, existing.select(*keys), keys, null_safe=True, anti=True)
