"""Mergeable quantiles of durations: log-bucketed histograms.

A bucket holds the values between two powers of ``gamma`` = (1 + a) / (1 - a); its
middle is within the share ``a`` of each of them. Histograms of days add up to one of
any period by adding counts, so old runs are never read again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._cols import as_col

ACCURACY = 0.01
KEYS = ("dag_id", "task_id")


def _gamma(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def duration_histogram(metrics: DataFrame, keys: Sequence[str] = KEYS, value: str | Column = "total_execution_time",
                       time: str | Column = "measured_at", accuracy: float = ACCURACY) -> DataFrame:
    """(keys, day, bucket, n): counts per bucket and day.

    Durations of zero and less share a bucket of their own (null). Null durations are
    no durations. Values beyond any bucket (not finite) are left out.
    """
    x = as_col(value).cast("double")
    rows = metrics.select(*keys, F.to_date(as_col(time)).alias("day"), x.alias("x")) \
        .where("x is not null and not isnan(x) and abs(x) < double('infinity')")
    bucket = F.when(F.col("x") > 0, F.ceil(F.log(F.col("x")) / math.log(_gamma(accuracy))).cast("int"))
    return rows.groupBy(*keys, "day", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(histograms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One histogram per key: (keys, bucket, n), of whatever days the rows hold."""
    return histograms.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def quantiles(histograms: DataFrame, at: dict[str, float], keys: Sequence[str] = KEYS,
              accuracy: float = ACCURACY) -> DataFrame:
    """keys, n and for each name in ``at`` the value of that rank, within ``accuracy`` of itself.

    The quantile q of n values is the one of rank ceil(q * n), the first for q = 0. A
    key has as many buckets as its values span powers of gamma (about 115 per power of
    ten at 1%), which bounds the window.
    """
    rows = merged(histograms, keys)
    order = Window.partitionBy(*keys).orderBy(F.col("bucket").asc_nulls_first())
    rows = rows.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    gamma = _gamma(accuracy)
    middle = F.coalesce(F.pow(F.lit(gamma), F.col("bucket")) * (2 / (gamma + 1)), F.lit(0.0))
    found = []
    for name, q in at.items():
        rank = F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("all")))
        holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
        found.append(F.max(F.when(holds, middle)).alias(name))
    return rows.groupBy(*keys).agg(F.max("all").alias("n"), *found)
