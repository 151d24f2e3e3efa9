"""Incident episodes: how long an incident stayed as it was.

Every batch republishes the incidents that still stand. An episode is a maximal run
of a city's consecutive batches in which one incident appears with equal attributes:
a changed attribute begins a new one, a batch without the incident ends it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import keep_one

#: what makes two rows the same incident, and what may change while it lasts
IDENTITY = ("city", "incident_type", "category", "lat", "lon", "from_road", "to_road", "start_time")
ATTRIBUTES = ("delay_seconds", "end_time", "road_numbers")


def _numbered(batches: DataFrame) -> DataFrame:
    """(city, batch_ts, place): the place of each batch among its city's; one row per batch."""
    order = Window.partitionBy("city").orderBy("batch_ts")
    return batches.select("city", "batch_ts").distinct().withColumn("place", F.row_number().over(order).cast("long"))


def _places(rows: DataFrame, numbered: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with columns of the first and the last batch's place, as first_<column>, last_<column>."""
    for side in ("first", "last"):
        at = numbered.select(F.col("city").alias("__c"), F.col("batch_ts").alias("__b"),
                             *[F.col(c).alias(f"{side}_{c}") for c in columns])
        same = F.col("city").eqNullSafe(F.col("__c")) & (F.col(f"{side}_batch") == F.col("__b"))
        rows = rows.join(at, same).drop("__c", "__b")
    return rows


def incident_episodes(observations: DataFrame, delivered: DataFrame | None = None, history: DataFrame | None = None,
                      known: DataFrame | None = None, identity: Sequence[str] = IDENTITY,
                      attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """identity, attributes, first_batch, last_batch, n_batches, open.

    ``observations`` are incidents with their ``batch_ts``; of several rows of one
    incident in a batch the one with the smallest attributes (nulls last) counts.
    ``delivered`` (city, batch_ts) names the batches they stand for, those without any
    incident included; by default the batches of the observations. ``open`` tells that
    the episode reaches its city's newest batch. ``identity`` holds ``city``.

    ``history`` is an earlier result over the batches ``known``, to which this delivery
    is added: the result is that of all deliveries at once, in whatever order they
    come, and of a batch that is delivered again the newer delivery counts. Only
    episodes that a delivered batch falls into are taken apart into batches; all others
    stay one row each.
    """
    identity, attributes = list(identity), list(attributes)
    names = identity + attributes
    if delivered is None:
        delivered = observations
    delivered = delivered.select("city", "batch_ts").where("batch_ts is not null").distinct()
    batches = delivered if known is None else delivered.union(known.select("city", "batch_ts"))
    in_order = Window.partitionBy("city").orderBy("batch_ts")
    mark = delivered.select(F.col("city").alias("__c"), F.col("batch_ts").alias("__b"))
    same_batch = F.col("city").eqNullSafe(F.col("__c")) & (F.col("batch_ts") == F.col("__b"))
    numbered = (_numbered(batches).join(mark, same_batch, "left")
                .withColumn("new", F.sum(F.when(F.col("__b").isNotNull(), 1).otherwise(0)).over(in_order))
                .drop("__c", "__b"))
    units = keep_one(observations.select(*names, "batch_ts"), [*identity, "batch_ts"],
                     [F.col(c).asc_nulls_last() for c in attributes], [])
    units = units.select(*names, F.col("batch_ts").alias("first_batch"), F.col("batch_ts").alias("last_batch"))
    if history is not None:
        units = units.unionByName(_intervals(history, known, numbered, mark, names))
    units = _places(units, numbered, "place")
    order = Window.partitionBy(*identity).orderBy("first_place")
    last = F.lag(F.struct("last_place", *attributes)).over(order)
    goes_on = F.col("first_place") == last["last_place"] + 1
    for c in attributes:
        goes_on = goes_on & last[c].eqNullSafe(F.col(c))
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    units = units.withColumn("__begins", begins).withColumn(
        "__episode", F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = units.groupBy(*identity, "__episode").agg(
        *[F.first(c).alias(c) for c in attributes], F.min("first_batch").alias("first_batch"),
        F.max("last_batch").alias("last_batch"), F.min("first_place").alias("__from"), F.max("last_place").alias("__to"))
    newest = numbered.groupBy(F.col("city").alias("__c")).agg(F.max("place").alias("__newest"))
    return (out.join(newest, F.col("city").eqNullSafe(F.col("__c")))
            .select(*names, "first_batch", "last_batch", (F.col("__to") - F.col("__from") + 1).alias("n_batches"),
                    (F.col("__to") == F.col("__newest")).alias("open")))


def _intervals(history: DataFrame, known: DataFrame, numbered: DataFrame, mark: DataFrame, names: list[str]) -> DataFrame:
    """Earlier episodes as intervals; where a delivered batch falls into one, its other batches one by one."""
    kept = [*names, "first_batch", "last_batch"]
    was = _numbered(known).withColumnRenamed("place", "was")
    at = numbered.join(mark, F.col("city").eqNullSafe(F.col("__c")) & (F.col("batch_ts") == F.col("__b")), "left") \
        .withColumn("here", F.when(F.col("__b").isNotNull(), 1).otherwise(0)).drop("__c", "__b")
    rows = _places(_places(history.select(*kept), at, "new", "here"), was, "was")
    apart = F.col("last_new") - F.col("first_new") + F.col("first_here") > 0
    single = (rows.where(apart).select(*names, F.explode(F.sequence("first_was", "last_was")).alias("was"))
              .join(was.select(F.col("city").alias("__c"), F.col("was").alias("__w"), "batch_ts"),
                    F.col("city").eqNullSafe(F.col("__c")) & (F.col("was") == F.col("__w"))).drop("__c", "__w"))
    single = single.join(mark, F.col("city").eqNullSafe(F.col("__c")) & (F.col("batch_ts") == F.col("__b")), "left_anti")
    return rows.where(~apart).select(*kept).unionByName(single.select(
        *names, F.col("batch_ts").alias("first_batch"), F.col("batch_ts").alias("last_batch")))
