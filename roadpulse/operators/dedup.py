"""Deterministic keep-one deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._cols import as_col


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
             tie_breakers: Sequence[str | Column] | None = None,
             rank_col: str = "__rn", hash_lead: bool = True) -> DataFrame:
    """One row per ``keys``: the first under ``order`` then ``tie_breakers``.

    Without explicit tie-breakers every remaining column (ascending, nulls
    first) completes the order, so the winner never depends on arrival order.
    Spark plans ``row_number() ... = 1`` with a partial ``WindowGroupLimit``
    before the shuffle, so a key holding a third of all rows ships only one
    row per map task.
    """
    keys = list(keys)
    order_cols = [as_col(c) for c in order]
    if tie_breakers is None:
        named = {c for c in order if isinstance(c, str)}
        tie_breakers = [c for c in df.columns if c not in keys and c not in named]
    order_cols += [as_col(c).asc_nulls_first() if isinstance(c, str) else c
                   for c in tie_breakers]
    if not order_cols:
        order_cols = [F.lit(1)]
    # a 64-bit hash of the keys leads the partition spec: the same groups, but the
    # sorts before and after the shuffle compare one long (radix-sortable) first
    # instead of long text keys
    part = ([F.xxhash64(*[F.col(k) for k in keys])] if hash_lead and keys else []) + \
        [F.col(k) for k in keys]
    w = Window.partitionBy(*part).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))
