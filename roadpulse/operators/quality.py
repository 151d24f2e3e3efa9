"""Data-quality gates with inspectable reject reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns that must be present at each layer.
BRONZE_REQUIRED = ("city", "lat", "lon")
SILVER_REQUIRED = ("city", "lat", "lon", "current_speed", "free_flow_speed")

REJECT_COL = "reject_reason"


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def not_null_rules(cols: Sequence[str]) -> list[tuple[str, Column]]:
    return [(f"null {c}", F.col(c).isNotNull()) for c in cols]


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                name: str = REJECT_COL) -> DataFrame:
    """Add ``name``: the reason of the first failed rule, null when all pass.

    A rule is a (reason, predicate) pair; a predicate that evaluates to null
    counts as failed.
    """
    if not rules:
        return df.withColumn(name, F.lit(None).cast("string"))
    reason = None
    for why, ok in rules:
        failed = ~F.coalesce(ok, F.lit(False))
        reason = F.when(failed, F.lit(why)) if reason is None else reason.when(failed, F.lit(why))
    return df.withColumn(name, reason)


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                  name: str = REJECT_COL) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the tag column, rejected rows with their reason)."""
    tagged = tag_rejects(df, rules, name)
    return (tagged.filter(F.col(name).isNull()).drop(name),
            tagged.filter(F.col(name).isNotNull()))


def conform(df: DataFrame, contract: StructType, widths: dict[str, int] | None = None,
            name: str = REJECT_COL) -> DataFrame:
    """Project to a serving contract (order + types) and tag violations.

    Returns the contract columns plus ``name``. A value that cannot be read as
    its contract type becomes null and a reason; so does text beyond the column
    width. Tagged rows belong in the reject set.
    """
    kept = df.select(F.struct("*").alias("__row"), *[
        F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields])
    rules = [(f"{f.name} is not {f.dataType.simpleString()}",
              F.col("__row")[f.name].isNull() | F.col(f.name).isNotNull()) for f in contract.fields]
    rules += [(f"{c} longer than {n}", F.col(c).isNull() | (F.length(c) <= n))
              for c, n in (widths or {}).items() if c in contract.fieldNames()]
    return tag_rejects(kept, rules, name).drop("__row")
