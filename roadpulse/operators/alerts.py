"""Worst incident per group and alert rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import (ALERT_CATEGORIES, CATEGORY_NAMES, category_name,
                                delay_text, location_text)
from .batches import max_key
from .dedup import keep_one

ALERT_COLUMNS = ["city", "incident_type", "category", "delay_seconds",
                 "from_road", "to_road", "observed_at"]

# Total order after the delay so that ties have one winner.
DEFAULT_TIE_BREAKERS = ("start_time", "from_road", "to_road", "lat", "lon")


def worst_incidents(incidents: DataFrame, categories: Sequence[str] = ALERT_CATEGORIES,
                    group: Sequence[str] = ("city", "category"),
                    delay: str = "delay_seconds", observed: str = "observed_at",
                    tie_breakers: Sequence[str] = DEFAULT_TIE_BREAKERS,
                    columns: Sequence[str] = ALERT_COLUMNS,
                    within: str | None = None) -> DataFrame:
    """Largest-delay incident per group in the latest observation.

    The latest observation is taken over the whole table *before* the
    category filter (as the alert query does), as a scalar subquery. The
    keep-one is a ``row_number`` top-1 that Spark limits per map task before
    the shuffle, so few large groups stay cheap. ``within`` names a partition
    column that grows with the observation (e.g. ``batch_ts``): only its
    latest value is read.
    """
    if within is not None:
        incidents = incidents.filter(F.col(within) == max_key(incidents, within))
    latest = incidents.filter(F.col(observed) == max_key(incidents, observed))
    wanted = latest.filter(F.col("category").isin(*categories))
    order = [F.col(delay).desc_nulls_last()]
    ties = [F.col(c).asc_nulls_last() for c in tie_breakers]
    top = keep_one(wanted, group, order, ties)
    return top.select(*columns).orderBy(*group)


def alert_rows(alerts: DataFrame, mapping: dict[str, str] = CATEGORY_NAMES) -> DataFrame:
    """Readable alert lines: category name, location and delay text."""
    return alerts.select(
        "city",
        category_name("category", mapping).alias("category_name"),
        location_text("from_road", "to_road").alias("location"),
        delay_text("delay_seconds").alias("delay"),
        "observed_at",
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Number of alert rows (one row, zero on empty input)."""
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts"))


ALERT_KEYS = ("city", "category")
OPENED, WORSENED, EASED, CHANGED, CLOSED = "opened", "worsened", "eased", "changed", "closed"


def alert_changes(state: DataFrame, alerts: DataFrame, keys: Sequence[str] = ALERT_KEYS, delay: str = "delay_seconds",
                  columns: Sequence[str] = ALERT_COLUMNS) -> DataFrame:
    """What a batch's alerts change: one row per key whose alert is new, different or gone.

    ``state`` holds the open alerts, one row per key, as ``alert_state`` leaves them;
    ``alerts`` those of the batch. An alert is ``opened`` or ``closed``; one that stays
    is ``worsened`` or ``eased`` by its delay (a known delay is worse than none) or, at
    the same delay, ``changed`` if it is another incident. An alert that is as it was
    gives no row, so nothing is sent twice. Null keys are keys. The columns are those
    of the batch, or of the state for a closed alert, with ``before_delay``.
    """
    keys, columns = list(keys), list(columns)
    known = "observed_at"
    old = state.select(F.struct(*columns).alias("old"), *[F.col(k).alias(f"__{k}") for k in keys])
    new = alerts.select(F.struct(*columns).alias("new"), *keys)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    both = new.join(old, same, "full")
    a, b = F.col("old")[delay], F.col("new")[delay]
    other = F.lit(False)
    for c in columns:
        if c not in (*keys, delay, known):
            other = other | ~F.col("old")[c].eqNullSafe(F.col("new")[c])
    change = (F.when(F.col("old").isNull(), OPENED).when(F.col("new").isNull(), CLOSED)
              .when((b > a) | (a.isNull() & b.isNotNull()), WORSENED)
              .when((b < a) | (b.isNull() & a.isNotNull()), EASED).when(other, CHANGED))
    row = F.coalesce("new", "old")
    return (both.select(change.alias("change"), *[row[c].alias(c) for c in columns], a.alias("before_delay"))
            .where("change is not null"))


def alert_state(state: DataFrame, changes: DataFrame, keys: Sequence[str] = ALERT_KEYS,
                columns: Sequence[str] = ALERT_COLUMNS) -> DataFrame:
    """The open alerts after ``changes``: one row per key; a key without a change keeps its row."""
    keys, columns = list(keys), list(columns)
    touched = changes.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    kept = state.select(*columns).join(touched, same, "left_anti")
    return kept.unionByName(changes.where(F.col("change") != CLOSED).select(*columns))
