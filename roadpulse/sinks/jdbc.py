"""JDBC serving sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import REJECT_COL, conform
from ..schemas import SERVING_CONTRACTS, SERVING_WIDTHS


def write_serving(df: DataFrame, table: str, url: str, properties: dict | None = None,
                  contract: str | None = None, mode: str = "append",
                  num_partitions: int | None = None, batch_size: int = 1000) -> DataFrame:
    """Append rows that fit the serving contract; return the rejected rows.

    Connection options are arguments only. ``num_partitions`` caps the
    concurrent connections (Spark coalesces before writing).
    """
    name = contract or table
    rows = df
    rejected = df.limit(0).withColumn(REJECT_COL, F.lit(None).cast("string"))
    if name in SERVING_CONTRACTS:
        tagged = conform(df, SERVING_CONTRACTS[name], SERVING_WIDTHS.get(name))
        rows = tagged.filter(F.col(REJECT_COL).isNull()).drop(REJECT_COL)
        rejected = tagged.filter(F.col(REJECT_COL).isNotNull())
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    widths = SERVING_WIDTHS.get(name)
    if widths:
        # if Spark has to create the table, give text columns the DDL widths
        props.setdefault("createTableColumnTypes",
                         ", ".join(f"{c} VARCHAR({n})" for c, n in widths.items()))
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    rows.write.jdbc(url, table, mode=mode, properties=props)
    return rejected


def write_metrics(metrics: DataFrame, path: str | None = None, url: str | None = None,
                  properties: dict | None = None, table: str = "pipeline_metrics") -> None:
    """Append metrics rows to Parquet and/or the serving database, as one write."""
    if path is not None:
        metrics.write.mode("append").parquet(path)
    if url is not None:
        metrics.write.jdbc(url, table, mode="append", properties=dict(properties or {}))
