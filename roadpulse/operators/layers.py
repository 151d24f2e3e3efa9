"""Bronze / silver / gold row transformations for flow and incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import stable_key
from ..functions.measures import safe_ratio
from ..functions.times import batch_date, batch_timestamp, iso_timestamp, stamp
from ..schemas import TRAFFIC_INCIDENTS
from .dedup import keep_one
from .quality import BRONZE_REQUIRED, SILVER_REQUIRED, not_null_rules, tag_rejects

BAD_BATCH_KEY = "unparseable batch_ts"


def bronze_rules(required=BRONZE_REQUIRED, date_col: str | None = None):
    """Not-null keys plus a parseable batch key (checked on ``date_col`` if given)."""
    parsed = F.col(date_col) if date_col else batch_timestamp("batch_ts")
    return not_null_rules(required) + [(BAD_BATCH_KEY, parsed.isNotNull())]


def flow_bronze(raw: DataFrame, run_ts=None) -> DataFrame:
    """Tag raw flow rows (null keys, bad batch key) and add ingest stamp + date.

    The batch key is parsed once (into ``date``) and the rule reads that.
    """
    dated = stamp(raw, "ingested_at", run_ts).withColumn("date", batch_date("batch_ts"))
    return tag_rejects(dated, bronze_rules(date_col="date"))


def silver_features(bronze: DataFrame, run_ts=None) -> DataFrame:
    """Gate (5 required columns), road key, speed ratio, process stamp; rows tagged."""
    tagged = tag_rejects(bronze, not_null_rules(SILVER_REQUIRED))
    out = (tagged
           .withColumn("road_id", stable_key("city", "lat", "lon", "frc"))
           .withColumn("speed_ratio", safe_ratio("current_speed", "free_flow_speed", 3)))
    out = stamp(out, "processed_at", run_ts)
    if "date" not in out.columns:
        out = out.withColumn("date", batch_date("batch_ts"))
    return out


# Columns that decide between two copies of one (city, batch, road) sample.
# lat, lon and frc are inside road_id, date follows from batch_ts and the
# ratio from the speeds, so they cannot differ within a key.
SILVER_TIE_BREAKERS = ("current_speed", "free_flow_speed", "travel_time", "confidence",
                       "road_closure")


#: rows that one task sorts and one file of a batch holds, roughly
CELL_ROWS = 250_000
CELL = "__cell"


def deal_silver(bronze: DataFrame, rows: int, largest: int) -> DataFrame:
    """Bronze rows brought together by batch and, in a large one, by a hash of their road.

    ``rows`` is their number, ``largest`` that of the largest batch. All copies of a sample
    share a cell, so ``dedup_silver`` with ``within=(CELL,)`` and a write by batch need no
    further shuffle; the road key, longer than a row, is worked out again behind this one.
    """
    cell = F.pmod(F.xxhash64(stable_key("city", "lat", "lon", "frc")), F.lit(max(1, -(-largest // CELL_ROWS))))
    tasks = max(bronze.sparkSession.sparkContext.defaultParallelism, -(-rows // CELL_ROWS))
    return bronze.withColumn(CELL, cell).repartition(tasks, "city", "batch_ts", CELL)


def deal_hours(samples: DataFrame, rows: int, largest: int) -> DataFrame:
    """Silver rows with their ``hour`` brought together by city, hour and, in a large one, a hash of their road.

    ``rows`` is their number, ``largest`` that of the largest hour. With ``CELL`` among the keys of
    the KPIs neither these nor a write by city and hour need a further shuffle.
    """
    cell = F.pmod(F.xxhash64("road_id"), F.lit(max(1, -(-largest // CELL_ROWS))))
    tasks = max(samples.sparkSession.sparkContext.defaultParallelism, -(-rows // CELL_ROWS))
    return samples.withColumn(CELL, cell).repartition(tasks, "city", "hour", CELL)


ROAD = "__road"


def deal_roads(bronze: DataFrame, rows: int) -> DataFrame:
    """Bronze rows brought together by a hash of their road, for a job that goes on to the KPIs of a road.

    Copies of a sample and all samples of a segment share ``ROAD``: with ``within=(ROAD,)`` for
    ``flow_silver`` and ``ROAD`` among the keys of the KPIs neither needs a further shuffle, and
    rows travel once, without their road key and as samples, which are narrower than the sums of means.
    """
    tasks = max(bronze.sparkSession.sparkContext.defaultParallelism, -(-rows // CELL_ROWS))
    road = F.xxhash64(stable_key("city", "lat", "lon", "frc"))
    return bronze.withColumn(ROAD, road).repartition(tasks, ROAD)


def dedup_silver(features: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """One row per (city, batch, road): the most recently ingested copy.

    ``within`` names columns that are equal for copies and that the rows are dealt by.

    The value columns break remaining ties (ascending, nulls first), so the
    survivor does not depend on arrival order.
    """
    keys = [*within, "city", "batch_ts", "road_id"]
    return keep_one(features, keys, [F.col("ingested_at").desc_nulls_last()],
                    [c for c in SILVER_TIE_BREAKERS if c in features.columns])


def flow_silver(bronze: DataFrame, run_ts=None, dedup: bool = True, within: tuple[str, ...] = ()) -> DataFrame:
    """Accepted silver rows (gate + key + ratio + stamp), deduplicated.

    ``within``: as for ``dedup_silver``.
    Rejected rows are ``silver_features(...)`` with a non-null reason; the
    accepted side is returned alone so the input is scanned once.
    """
    feats = silver_features(bronze, run_ts)
    ok = feats.filter(F.col("reject_reason").isNull())
    return dedup_silver(ok, within) if dedup else ok


def incident_silver(bronze: DataFrame, run_ts=None, dedup: bool = False) -> DataFrame:
    """Gate (city, lat, lon), parse times, add observed / processed stamps."""
    tagged = tag_rejects(bronze, bronze_rules())
    out = tagged.withColumns({
        "start_time": iso_timestamp("start_time"),
        "end_time": iso_timestamp("end_time"),
        "observed_at": batch_timestamp("batch_ts"),
    })
    out = stamp(out, "processed_at", run_ts).withColumn("date", batch_date("batch_ts"))
    if dedup:
        business = [f.name for f in TRAFFIC_INCIDENTS.fields]
        out = out.dropDuplicates(business + ["reject_reason"])
    return out


def incident_gold(silver: DataFrame) -> DataFrame:
    """The 13 serving columns."""
    return silver.select(*[f.name for f in TRAFFIC_INCIDENTS.fields])
