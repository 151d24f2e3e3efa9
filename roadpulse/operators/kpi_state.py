"""KPIs kept as mergeable state (A3, R2): exact partial sums that deliveries add to.

One row of state per (keys, hour) holds what the hourly figures need: sums in two
long halves, counts, the newest observation. States add up, so a delivery is reduced
once, written beside the others and never read as samples again; any coarser grain
(day, month, a city, everything) comes from the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._cols import as_col
from ..functions.measures import finish_means, mean_state
from ..functions.times import batch_timestamp
from ..session import release
from ..sinks.files import write_batch
from ..sources.files import path_exists
from .kpi import finish_kpis, kpi_counts, kpi_means

KEYS = ("city", "road_id", "frc")
COUNTS = ("road_closure", "congested_segments", "road_segments")


def kpi_state(samples: DataFrame, keys: Sequence[str] = KEYS, observed: str | Column | None = None,
              unit: str = "hour", closure: str = "road_closure", ratio: str = "speed_ratio", **columns: str) -> DataFrame:
    """One row per (keys, ``unit``): the state of its samples. Samples without a time are left out."""
    obs = batch_timestamp("batch_ts") if observed is None else as_col(observed)
    state, _ = mean_state(kpi_means(ratio=ratio, **columns))
    # brought together as samples: states are several times as wide, and in a scan's tasks keys hardly repeat
    timed = samples.withColumns({"__obs": obs, "hour": F.date_trunc(unit, obs)}).repartition(*keys, "hour")
    return (timed.groupBy(*keys, "hour")
            .agg(F.max("__obs").alias("observation_ts"), *kpi_counts(closure, ratio), *state).where("hour is not null"))


def merge_states(states: DataFrame, keys: Sequence[str] = KEYS, unit: str | None = None) -> DataFrame:
    """States added up per (keys, ``unit``); over all time for ``unit`` None."""
    sums = [c for c in states.columns if c in COUNTS or c.startswith(("__high_", "__low_", "__n_"))]
    by = [] if unit is None else ["hour"]
    if unit is not None:
        states = states.withColumn("hour", F.date_trunc(unit, "hour")).repartition(*keys, "hour")
    return states.groupBy(*keys, *by).agg(F.max("observation_ts").alias("observation_ts"),
                                          *[F.sum(c).alias(c) for c in sums])


def kpis_of(states: DataFrame, keys: Sequence[str] = KEYS, unit: str | None = "hour",
            estimate_free_flow: bool = False) -> DataFrame:
    """The gold KPIs at a grain; equal to averaging the samples themselves."""
    _, places = mean_state(kpi_means())
    return finish_kpis(finish_means(merge_states(states, keys, unit), places), estimate_free_flow=estimate_free_flow)


class KpiTable:
    """State rows at ``path``: one folder per delivery, and bases that deliveries were merged into.

    ``delivery`` numbers grow. Writing one again replaces it (a retry is safe); a
    delivery must not repeat samples of another. ``compact`` merges everything into a
    new base; the mark that names it is written last and decides what readers take.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, samples: DataFrame, delivery: int, **how) -> None:
        """Reduce one delivery and keep its state; nothing of earlier ones is read."""
        keys = how.get("keys", KEYS)
        # in key order the long road keys repeat side by side, and a file packs them to almost nothing
        state = kpi_state(samples, **how).sortWithinPartitions(*keys, "hour").withColumn("delivery", F.lit(delivery))
        write_batch(state, f"{self.path}/deliveries", partition_by=("delivery",), files_per_partition=0)

    def _base(self) -> int:
        """The newest delivery that a base holds, -1 without one."""
        marks = f"{self.path}/marks"
        if not path_exists(self.spark, marks):
            return -1
        return self.spark.read.schema("upto int").parquet(marks).agg(F.max("upto")).first()[0]

    def states(self) -> DataFrame:
        """All state rows: the newest base, and the deliveries after it."""
        base = self._base()
        rows = self.spark.read.parquet(f"{self.path}/deliveries").where(F.col("delivery") > base).drop("delivery")
        if base >= 0:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/bases/upto={base}").select(*rows.columns))
        return rows

    def kpis(self, unit: str | None = "hour", keys: Sequence[str] = KEYS, estimate_free_flow: bool = False) -> DataFrame:
        return kpis_of(self.states(), keys, unit, estimate_free_flow)

    def compact(self, keys: Sequence[str] = KEYS, unit: str = "hour") -> None:
        """Merge all states into one row per (keys, unit); the base before the last one is deleted."""
        old = self._base()
        newest = self.spark.read.parquet(f"{self.path}/deliveries").agg(F.max("delivery")).first()[0]
        if newest is None or newest <= old:
            return
        (merge_states(self.states(), keys, unit).sortWithinPartitions(*keys, "hour")
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/bases/upto={newest}"))
        (self.spark.createDataFrame([(newest,)], "upto int").coalesce(1)
         .write.mode("append").parquet(f"{self.path}/marks"))
        if old >= 0:
            release(self.spark, f"{self.path}/bases/upto={old}")
