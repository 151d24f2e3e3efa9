"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, shuffle_width  # noqa: F401  shared by the operators


def known_to_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies.

    On a cluster it is installed on the executors like any other package, and
    this path, absent there, does nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    known_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` materialised once in the shared checkpoint folder, its lineage cut.

    The files outlive any executor, so a lost one costs only its running tasks.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own.

    Other columns, whatever their names, cannot clash with what is added later.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
