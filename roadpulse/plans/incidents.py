"""Incident jobs: raw -> bronze -> silver -> gold, and the alert query."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import batch_date
from ..operators.alerts import alert_rows, alert_summary, worst_incidents
from ..operators.batches import latest_batch
from ..operators.layers import bronze_rules, incident_gold, incident_silver
from ..operators.metrics import batch_metrics
from ..operators.payloads import flatten_incidents
from ..operators.quality import REJECT_COL, tag_rejects
from ..schemas import INCIDENT_BRONZE, INCIDENT_SILVER, TRAFFIC_INCIDENTS
from ..sinks.files import append_missing, write_batch, write_raw
from ..sinks.jdbc import write_serving
from ..sources.jdbc import read_serving_or_empty
from ..sources.files import CORRUPT_COL, read_incident_raw, read_layer
from .flow import MALFORMED, JobResult, current_rows, ledger, next_load, no_metrics, recorded, refresh, take_load


def ingest_payloads(payloads: DataFrame, raw_path: str) -> DataFrame:
    """API payload rows (city, batch_ts, payload) -> raw incident files.

    An empty incident list is legal (no rows, no error). Returns, per (city,
    batch), the incidents written and the problems: payloads that could not be
    read and incidents without a position.
    """
    flat = flatten_incidents(payloads, problem="problem").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_raw(flat.filter("problem is null").drop("problem"), raw_path)
        counts = flat.groupBy("city", "batch_ts").agg(
            F.count_if(F.col("problem").isNull()).alias("incidents"),
            F.count("problem").alias("problems"))
        counts = counts.cache()
        counts.count()
    finally:
        flat.unpersist()
    return counts


def run_bronze(spark: SparkSession, raw_path: str, bronze_path: str, run_ts=None,
               reject_path: str | None = None, metrics_path: str | None = None,
               dag_id: str = "incidents", run_id: str = "") -> JobResult:
    """Every raw file that bronze has not taken yet -> bronze.

    As in the original, bronze keeps rows with null keys (silver gates them);
    malformed lines and batch keys that cannot be parsed are rejected here.
    """
    t0 = time.time()
    with recorded(spark, metrics_path, dag_id, "bronze", run_id, run_ts) as save:
        load = next_load(spark, raw_path, bronze_path, read_incident_raw)
        if load is None:
            metrics, rejects = no_metrics(spark), ledger(spark, reject_path)
        else:
            tagged = tag_rejects(load.rows.withColumn("date", batch_date("batch_ts")),
                                 [(MALFORMED, F.col(CORRUPT_COL).isNull()),
                                  *bronze_rules(required=(), date_col="date")])
            metrics, rejects = take_load(load, tagged, bronze_path, INCIDENT_BRONZE, reject_path,
                                         dag_id, run_id, run_ts, t0)
            save(metrics)
    rows = current_rows(spark, bronze_path, INCIDENT_BRONZE).select(*INCIDENT_BRONZE.fieldNames())
    return JobResult(rows, metrics, rejects, load.written if load else 0)


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, run_ts=None,
               dedup: bool = False, reject_path: str | None = None, metrics_path: str | None = None,
               dag_id: str = "incidents", run_id: str = "") -> JobResult:
    """Every batch with a newer bronze version -> silver; copies left out by ``dedup`` count as dropped."""
    business = [f.name for f in TRAFFIC_INCIDENTS.fields]
    return refresh(
        spark, bronze_path, silver_path, INCIDENT_BRONZE, INCIDENT_SILVER, incident_silver,
        lambda good: good.dropDuplicates(business) if dedup else good,
        "silver", run_ts, reject_path, metrics_path, dag_id, run_id)


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, run_ts=None,
             jdbc_url: str | None = None, jdbc_properties: dict | None = None,
             metrics_path: str | None = None,
             dag_id: str = "incidents", run_id: str = "") -> JobResult:
    """Latest silver batch -> 13 serving columns, partitioned by (city, batch_ts).

    The batch level makes the gold append replay safe; the JDBC append skips
    rows already present for that batch.
    """
    t0 = time.time()
    silver = read_layer(spark, silver_path, INCIDENT_SILVER)
    gold = incident_gold(latest_batch(silver, "batch_ts", within="date"))
    write_batch(gold, gold_path, partition_by=("city", "batch_ts"))
    back = spark.read.parquet(gold_path).select(*TRAFFIC_INCIDENTS.fieldNames())
    latest = latest_batch(back, "batch_ts")
    rejected = None
    if jdbc_url:
        props = dict(jdbc_properties or {})
        existing = read_serving_or_empty(spark, "traffic_incidents", jdbc_url, props,
                                         TRAFFIC_INCIDENTS)
        # the batch key as a literal is pushed into the JDBC query's WHERE clause
        batch = latest.agg(F.max("batch_ts")).first()[0]
        existing = existing.filter(F.col("batch_ts") == F.lit(batch))
        keys = [c for c in TRAFFIC_INCIDENTS.fieldNames()]
        fresh = append_missing(latest, existing.select(*keys), keys)
        rejected = write_serving(fresh, "traffic_incidents", jdbc_url, props)
    metrics = batch_metrics(latest.withColumn(REJECT_COL, F.lit(None).cast("string")),
                            dag_id=dag_id, task_id="gold", run_id=run_id, run_ts=run_ts,
                            elapsed=round(time.time() - t0, 3)).cache()
    metrics.count()
    with recorded(spark, metrics_path, dag_id, "gold", run_id, run_ts) as save:
        save(metrics)
    return JobResult(back, metrics, rejected)


def run_alert(incidents: DataFrame, within: str | None = "batch_ts", metrics_path: str | None = None,
              run_ts=None, dag_id: str = "incident_alert", run_id: str = ""
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(worst accident / closure per city and category, readable rows, count).

    With ``within`` only the latest partition of gold is read. The run leaves a
    metrics row: alerts found, per city.
    """
    worst = worst_incidents(incidents, within=within)
    with recorded(incidents.sparkSession, metrics_path, dag_id, "alert", run_id, run_ts) as save:
        tagged = worst.select("city", F.col("observed_at").cast("string").alias("batch_ts"),
                              F.lit(None).cast("string").alias(REJECT_COL))
        save(batch_metrics(tagged, dag_id=dag_id, task_id="alert", run_id=run_id, run_ts=run_ts))
    return worst, alert_rows(worst), alert_summary(worst)
