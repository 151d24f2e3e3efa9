"""Flow jobs: raw -> bronze -> silver -> gold, each a replay-safe Spark job.

Bronze takes every raw file once, found by a listing (``sources.loads``); silver
works anew every batch of which bronze has a newer version. Writes are dynamic
partition overwrites (a retry replaces its own output), and metrics come from the
frame that is written, persisted for the job's duration. A run counts once its
versions are recorded, its last step: what fails earlier is pending again.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.times import batch_date, batch_timestamp
from ..operators.batches import complete_hours, hour_progress, latest_hour_of_key
from ..operators.joins import semi_join
from ..operators.kpi import finish_kpis, heatmap_points, hourly_segment_kpis, segment_kpi
from ..operators.layers import CELL, deal_hours, deal_silver, dedup_silver, flow_bronze, silver_features
from ..operators.metrics import batch_counts, batch_metrics, counted, ingestion_tallies
from ..operators.payloads import flatten_flow
from ..operators.quality import REJECT_COL
from ..schemas import BATCH_FORMAT, FLOW_BRONZE, FLOW_SILVER, PIPELINE_METRICS, TRAFFIC_KPIS, TRAFFIC_POINTS
from ..sinks.files import BATCH_PARTITIONS, append_missing, write_batch, write_raw, write_snapshot
from ..sinks.jdbc import write_serving
from ..sources.jdbc import read_serving_or_empty
from ..session import checkpoint_root, drop_shuffles, release
from ..sources.files import CORRUPT_COL, layer_or_empty, path_exists, read_flow_raw, read_layer
from ..sources.loads import VERSIONS, LoadLog

MALFORMED = "malformed json line"


@dataclass
class JobResult:
    output: DataFrame      # what was written (re-readable)
    metrics: DataFrame     # pipeline_metrics rows
    rejected: DataFrame | None = None
    written: int = 0       # rows of this run, observed while they were written (bronze)


#: batch keys up to which a scan is pruned by their list; beyond, by the join with them alone
FEW_BATCHES = 2_000


def new_rows(raw: DataFrame, files: list[str]) -> DataFrame:
    """Rows of the given files, with ``source_file`` and the batch (``of_batch``) each belongs to.

    Only these files are opened. A malformed line, or a row without a batch, is
    listed under the newest batch of its file.
    """
    raw = raw.withColumn("source_file", F.col("_metadata.file_path")).filter(F.col("_metadata.file_path").isin(files))
    # JSON scans need a data column beside the corrupt one: city and batch may be folder names
    data = next(c for c in raw.columns if c not in ("city", "batch_ts", "source_file", CORRUPT_COL))
    newest = (raw.groupBy(F.col("source_file").alias("__file"))
              .agg(F.max("batch_ts").alias("__batch"), F.count(data).alias("__n")).where("__n >= 0").drop("__n"))
    # one row a file, of a list that the driver holds: the rows themselves are not shuffled
    return (raw.join(F.broadcast(newest), F.col("source_file") == F.col("__file"), "left")
            .withColumn("of_batch", F.coalesce("batch_ts", "__batch")).drop("__file", "__batch"))


def current_rows(spark: SparkSession, path: str, schema, batches: DataFrame | None = None) -> DataFrame:
    """Rows of a layer of loads that count: no load broken off, no file that was replaced since.

    With ``batches`` (city, batch_ts, ...) only theirs, with the further columns of that frame.
    """
    log = LoadLog(spark, path)
    rows = layer_or_empty(spark, path, with_load(schema))
    rows = rows.filter(F.col("load") <= log.last())
    old = log.superseded()
    if old is not None:
        rows = semi_join(rows, old, ["source_file", "load"], anti=True)
    return rows if batches is None else of_batches(rows, batches)


def of_batches(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of the given batches with the columns that ``batches`` adds; null cities are a city."""
    keys = batches.select("batch_ts").distinct().limit(FEW_BATCHES + 1).collect()
    few = len(keys) <= FEW_BATCHES
    if few and all(k[0] is not None for k in keys):
        rows = rows.filter(F.col("batch_ts").isin([k[0] for k in keys]))  # prunes the folders
    b = batches.withColumnsRenamed({"city": "__city", "batch_ts": "__batch"})
    if few:  # the layer's rows are not shuffled for it
        b = F.broadcast(b)
    same = F.col("city").eqNullSafe(F.col("__city")) & F.col("batch_ts").eqNullSafe(F.col("__batch"))
    return rows.join(b, same).drop("__city", "__batch")


def with_load(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField("source_file", StringType()), StructField("load", LongType())])


@dataclass
class Load:
    """A load of raw files into a first layer: its number, its rows, and how it ends."""
    log: LoadLog
    number: int
    files: DataFrame
    rows: DataFrame
    written: int = 0

    def finish(self, tagged: DataFrame, path: str, schema) -> None:
        """Write the accepted rows, one folder level per load, then record versions and files."""
        good = tagged.filter(F.col(REJECT_COL).isNull())
        out = good.select(*schema.fieldNames(), "source_file", F.lit(self.number).cast("long").alias("load"))
        if not good.isEmpty():  # nothing is observed where there is nothing to write
            observed, rows = counted(out, f"load-{self.number}")
            write_batch(observed, path, partition_by=(*BATCH_PARTITIONS, "load"))
            self.written = rows.get["rows"]
        changed = good.select("city", "batch_ts").distinct()
        replaced = self.log.superseded(self.files)
        if replaced is not None:  # batches that lose rows have changed as well
            gone = semi_join(read_layer(out.sparkSession, path, with_load(schema)), replaced, ["source_file", "load"])
            changed = changed.union(gone.select("city", "batch_ts")).distinct()
        self.log.commit(self.number, changed.withColumn("version", F.lit(self.number)), self.files)


def next_load(spark: SparkSession, raw_path: str, layer_path: str, read) -> Load | None:
    """The load of all files that the layer has not taken yet; None, and nothing parsed, without any.

    A file that lands after the listing waits for the next load.
    """
    log = LoadLog(spark, layer_path)
    pending = log.pending(raw_path)
    if not pending:
        return None
    files = spark.createDataFrame(pending, "path string, length long, modified long, again boolean")
    return Load(log, log.last() + 1, files,
                new_rows(read(spark, raw_path, keep_corrupt=True), [r.path for r in pending]))


def no_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PIPELINE_METRICS)


def replace_batches(rows: DataFrame, path: str, stale: DataFrame, kept: DataFrame,
                    files_per_partition: int | None = None) -> DataFrame:
    """Write all rows of the ``stale`` batches in place of what the layer held of them.

    Returns (city, batch_ts, n): rows written. Folders of batches that have no row any
    more, those not in ``kept`` (city, batch_ts), are deleted.
    """
    spark = rows.sparkSession
    write_batch(rows, path, files_per_partition=files_per_partition)
    before = stale.filter("before > 0")
    if not before.isEmpty():
        gone = semi_join(before.select("city", "batch_ts").withColumn("date", batch_date("batch_ts")), kept,
                         ["city", "batch_ts"], anti=True)
        for r in gone.toLocalIterator():
            release(spark, f"{path}/{partition_folder(spark, r, BATCH_PARTITIONS)}")
    left = of_batches(spark.read.schema(rows.schema).parquet(path), stale.select("city", "batch_ts"))
    return left.groupBy("city", "batch_ts").agg(F.count(F.lit(1)).alias("n"))


def partition_folder(spark: SparkSession, row, columns) -> str:
    """The folder, below a table's path, that holds the partition of a row."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else escape(str(row[c]))}" for c in columns)


def gate_bronze(rows: DataFrame, run_ts=None) -> DataFrame:
    """Bronze rows tagged with the first reason against them, malformed lines first."""
    return flow_bronze(rows, run_ts).withColumn(
        REJECT_COL,
        F.when(F.col(CORRUPT_COL).isNotNull(), F.lit(MALFORMED)).otherwise(F.col(REJECT_COL)))


def run_key(run_id: str, run_ts) -> str:
    return run_id or (str(run_ts) if run_ts is not None else "adhoc")


def write_rejects(tagged: DataFrame, path: str | None, key: str) -> DataFrame | None:
    """Write the tagged rows to the ledger, one partition per run: a retried run replaces its own.

    Returns the whole ledger; a run without rejects adds nothing, and a ledger that
    never held a row is empty.
    """
    if path is None:
        return None
    rejected = tagged.filter(F.col(REJECT_COL).isNotNull()).withColumn("run", F.lit(key))
    write_batch(rejected, path, partition_by=("run",))
    return ledger(tagged.sparkSession, path, rejected.schema)


def ledger(spark: SparkSession, path: str | None, schema: StructType | None = None) -> DataFrame | None:
    """The rejects kept at ``path``, read under a known schema: there may be no file yet."""
    if path is None:
        return None
    if schema is None:
        if path_exists(spark, f"{path}/run=*"):
            rows = spark.read.option("mergeSchema", True).parquet(path)
            return rows.withColumn("run", F.col("run").cast("string"))
        schema = StructType([StructField(REJECT_COL, StringType()), StructField("run", StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def recorded(spark: SparkSession, metrics_path: str | None, dag_id: str, task_id: str, run_id: str, run_ts):
    """Keep the metrics rows of a job: hand them to the function given; a failed run leaves one too.

    One partition per (dag, task, run), replaced when the run is repeated.
    """
    parts = ("dag_id", "task_id", "run_id")
    key = run_key(run_id, run_ts)

    def save(metrics: DataFrame) -> None:
        if metrics_path:
            write_batch(metrics.withColumn("run_id", F.lit(key)), metrics_path, partition_by=parts)

    drop_shuffles(spark)
    try:
        yield save
    except Exception as e:
        stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
        row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in PIPELINE_METRICS.fields])
        row = row.withColumns({"dag_id": F.lit(dag_id), "task_id": F.lit(task_id), "status": F.lit("failed"),
                               "error_message": F.lit(str(e)[:500]), "ingestion_timestamp": stamp,
                               "measured_at": stamp})
        save(row)
        raise


def ingest_payloads(payloads: DataFrame, raw_path: str) -> DataFrame:
    """Flatten API payload rows (city, batch_ts, lat, lon, payload) into raw files.

    Returns the per-(city, batch) requested / succeeded / failed tallies.
    """
    flat = flatten_flow(payloads).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_raw(flat.filter("ok").drop("ok"), raw_path)
        tallies = ingestion_tallies(flat).cache()
        tallies.count()
    finally:
        flat.unpersist()
    return tallies


def run_bronze(spark: SparkSession, raw_path: str, bronze_path: str, run_ts=None,
               reject_path: str | None = None, metrics_path: str | None = None,
               dag_id: str = "flow", run_id: str = "") -> JobResult:
    """Every raw file that bronze has not taken yet -> bronze (city/date/batch_ts/load partitions).

    A batch may come in any number of files over any number of runs. A run without
    new files parses nothing. A file that was written anew replaces its rows.
    """
    t0 = time.time()
    with recorded(spark, metrics_path, dag_id, "bronze", run_id, run_ts) as save:
        load = next_load(spark, raw_path, bronze_path, read_flow_raw)
        if load is None:
            metrics, rejects = no_metrics(spark), ledger(spark, reject_path)
        else:
            metrics, rejects = take_load(load, gate_bronze(load.rows, run_ts), bronze_path, FLOW_BRONZE, reject_path,
                                         dag_id, run_id, run_ts, t0)
            save(metrics)
    rows = current_rows(spark, bronze_path, FLOW_BRONZE).select(*FLOW_BRONZE.fieldNames())
    return JobResult(rows, metrics, rejects, load.written if load else 0)


def take_load(load: Load, tagged: DataFrame, path: str, schema: StructType, reject_path: str | None,
              dag_id: str, run_id: str, run_ts, t0: float) -> tuple[DataFrame, DataFrame | None]:
    """Rejects, metrics and rows of a load, from one reading of its files."""
    tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejects = write_rejects(tagged, reject_path, run_key(run_id, run_ts))
        metrics = batch_metrics(tagged.withColumn("batch_ts", F.coalesce("batch_ts", "of_batch")),
                                dag_id=dag_id, task_id="bronze", run_id=run_id, run_ts=run_ts,
                                elapsed=round(time.time() - t0, 3)).cache()
        metrics.count()
        load.finish(tagged, path, schema)
    finally:
        tagged.unpersist()
    return metrics, rejects


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, run_ts=None,
               reject_path: str | None = None, metrics_path: str | None = None,
               dag_id: str = "flow", run_id: str = "") -> JobResult:
    """Every batch of which bronze has a newer version than silver -> its silver rows, deduplicated.

    A batch is worked anew as a whole, so late rows meet the ones that came before.
    Read and written count the whole batch; a reject is kept by the run that first saw it.
    """
    return refresh(
        spark, bronze_path, silver_path, FLOW_BRONZE, FLOW_SILVER, silver_features,
        lambda good: dedup_silver(good, within=(CELL,)), "silver", run_ts, reject_path, metrics_path, dag_id, run_id,
        deal=deal_silver)


def refresh(spark: SparkSession, source_path: str, path: str, source_schema: StructType, schema: StructType,
            transform, choose, task_id: str, run_ts, reject_path, metrics_path, dag_id, run_id,
            deal=None) -> JobResult:
    """Work the stale batches of a layer anew: ``transform`` tags their rows, ``choose`` takes the ones to keep.

    ``transform`` is given the rows and the run's time, one for all that the run writes.
    ``choose`` leaves out copies only: a batch with accepted rows keeps one. ``deal``, given the
    rows, their number and that of the largest batch, brings them together for ``choose`` and the write.
    """
    t0 = time.time()
    log, upstream, parts = LoadLog(spark, path), LoadLog(spark, source_path), ["city", "batch_ts"]
    rejects = None
    stamp = F.timestamp_micros(F.lit(int(t0 * 1_000_000))) if run_ts is None else run_ts
    with recorded(spark, metrics_path, dag_id, task_id, run_id, run_ts) as save:
        checkpoint_root(spark)
        stale = log.stale(upstream).checkpoint()
        if stale.isEmpty():
            metrics, rejects = no_metrics(spark), ledger(spark, reject_path)
        else:
            # a few columns of the layer are read twice for rejects and counts: a copy of all
            # rows would fill the executors' memory, and their disks, while the rows are sorted
            rows = current_rows(spark, source_path, source_schema, stale)
            tagged = transform(rows, stamp)
            fresh = tagged.filter(F.col("load") > F.col("before")).drop("version", "before", "load")
            rejects = write_rejects(fresh, reject_path, run_key(run_id, run_ts))
            read = tagged.groupBy(*parts).agg(F.count(F.lit(1)).alias("read"),
                                              F.count_if(F.col(REJECT_COL).isNull()).alias("good")).cache()
            read.count()
            n, largest = read.agg(F.sum("read"), F.max("read")).first()
            dealt = rows if deal is None else deal(rows, n or 0, largest or 0)
            good = choose(transform(dealt, stamp).filter(F.col(REJECT_COL).isNull()))
            written = replace_batches(good.select(*schema.fieldNames()), path, stale, read.where("good > 0"),
                                      files_per_partition=None if deal is None else 0)
            w = written.withColumnsRenamed({"city": "__c", "batch_ts": "__b"})
            same = F.col("city").eqNullSafe(F.col("__c")) & F.col("batch_ts").eqNullSafe(F.col("__b"))
            counts = read.join(w, same, "left").select(
                *parts, "read", F.coalesce("n", F.lit(0)).alias("written"))
            metrics = batch_counts(counts, dag_id, task_id, run_id, run_ts, round(time.time() - t0, 3)).cache()
            metrics.count()
            log.commit(run_number(log), stale)
            save(metrics)
    return JobResult(layer_or_empty(spark, path, schema), metrics, rejects)


def run_number(log: LoadLog) -> int:
    """A new number for a run of a layer that takes no files of its own."""
    return (log._table("versions", VERSIONS).agg(F.max("load")).first()[0] or 0) + 1


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, run_ts=None,
             jdbc_url: str | None = None, jdbc_properties: dict | None = None,
             estimate_free_flow: bool = False, min_batches: int | None = None,
             reject_path: str | None = None, metrics_path: str | None = None,
             dag_id: str = "flow", run_id: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latest hour of silver -> (gold KPIs, heat-map points, metrics).

    ``min_batches`` lets a city through only once its hour holds so many batches.
    Rows that do not fit the serving contract go to the ledger at ``reject_path``.

    The hour slice is pruned to the latest ``date`` partition and persisted
    once for its two consumers. Points are appended to the serving table
    only if not already present (a rerun in the same hour adds nothing).
    """
    t0 = time.time()
    silver = read_layer(spark, silver_path, FLOW_SILVER)
    hour = latest_hour_of_key(silver, "batch_ts", within="date")
    if min_batches:
        full = complete_hours(hour, batch_timestamp("batch_ts"), group=["city"], min_batches=min_batches)
        hour = hour.join(full.select("city"), "city", "left_semi")
    latest = hour
    hour = hour.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gold = hourly_segment_kpis(hour, estimate_free_flow=estimate_free_flow)
        write_snapshot(gold, gold_path, partition_by=("city",))
        gold_back = spark.read.parquet(gold_path)
        points = heatmap_points(hour)
        if jdbc_url:
            props = dict(jdbc_properties or {})
            # one scalar (start of the hour) bounds the serving-table reads below;
            # as a literal it is pushed into the JDBC query's WHERE clause
            since = points.agg(F.min("observation_ts")).first()[0]
            existing = read_serving_or_empty(spark, "traffic_points", jdbc_url, props,
                                             TRAFFIC_POINTS)
            if since is not None:
                existing = existing.filter(F.col("observation_ts") >= F.lit(since))
            new_points = append_missing(points, existing,
                                        ["city", "lat", "lon", "observation_ts"])
            bad_points = write_serving(new_points.select(*TRAFFIC_POINTS.fieldNames()), "traffic_points",
                                       jdbc_url, props)
            write_rejects(bad_points, reject_path and f"{reject_path}/traffic_points", run_key(run_id, run_ts))
            kpis = gold_back.select(*TRAFFIC_KPIS.fieldNames())
            known = read_serving_or_empty(spark, "traffic_kpis", jdbc_url, props, TRAFFIC_KPIS)
            if since is not None:
                known = known.filter(F.col("observation_ts") >= F.lit(since))
            bad_kpis = write_serving(append_missing(kpis, known,
                                                    ["city", "road_id", "frc", "observation_ts"]),
                                     "traffic_kpis", jdbc_url, props)
            write_rejects(bad_kpis, reject_path and f"{reject_path}/traffic_kpis", run_key(run_id, run_ts))
        read = hour.groupBy("city").agg(F.count(F.lit(1)).alias("records_read"),
                                        F.max("batch_ts").alias("batch_id"))
        wrote = gold_back.groupBy("city").agg(F.count(F.lit(1)).alias("records_written"))
        stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
        elapsed = round(time.time() - t0, 3)
        metrics = (read.join(wrote, "city", "left")
                   .select(F.lit(dag_id).alias("dag_id"), F.lit(run_id).alias("run_id"),
                           F.lit("gold").alias("task_id"), "batch_id", "city",
                           stamp.alias("ingestion_timestamp"), "records_read",
                           F.coalesce("records_written", F.lit(0)).alias("records_written"),
                           # samples merged into segment averages are not dropped
                           F.lit(0).cast("bigint").alias("records_dropped"),
                           F.col("records_read").alias("rows_processed"),
                           F.lit(None).cast("double").alias("api_execution_time"),
                           F.lit(elapsed).alias("spark_execution_time"),
                           F.lit(elapsed).alias("total_execution_time"),
                           F.lit("success").alias("status"),
                           F.lit(None).cast("string").alias("error_message"),
                           stamp.alias("measured_at"),
                           (F.col("records_read") - F.coalesce("records_written", F.lit(0)))
                           .alias("records_aggregated"))).cache()
        metrics.count()
        with recorded(spark, metrics_path, dag_id, "gold", run_id, run_ts) as save:
            save(metrics.drop("records_aggregated"))
    finally:
        hour.unpersist()
    # points stay lazy: re-deriving them re-reads only the pruned hour slice
    return gold_back, heatmap_points(latest), metrics


def run_gold_backlog(spark: SparkSession, silver_path: str, gold_path: str, run_ts=None, unit: str = "hour",
                     min_batches: int = 4, close_after: str | None = None, estimate_free_flow: bool = False,
                     metrics_path: str | None = None, dag_id: str = "flow", run_id: str = "") -> JobResult:
    """Every complete hour of every city that gold does not hold as silver has it now -> gold KPIs.

    Which hours these are comes from the versions that silver recorded, without reading
    silver; of silver only their batches are read. Gold is partitioned by (city, hour),
    ``hour`` a batch key, and replaced hour by hour: an hour that a late batch changes
    is worked anew. See ``hour_progress`` for when an hour is complete.
    """
    t0 = time.time()
    log, silver_log = LoadLog(spark, gold_path), LoadLog(spark, silver_path)
    with recorded(spark, metrics_path, dag_id, "gold_backlog", run_id, run_ts) as save:
        checkpoint_root(spark)
        batches = silver_log.versions()
        hours = hour_progress(batches, unit, min_batches, close_after).where("complete") \
            .withColumn("key", F.date_format("hour", BATCH_FORMAT))
        held = log.versions().select(F.col("city").alias("__c"), F.col("batch_ts").alias("__h"),
                                     F.col("version").alias("before"))
        todo = (hours.join(held, F.col("city").eqNullSafe(F.col("__c")) & (F.col("key") == F.col("__h")), "left")
                .where("before is null or before < version").select("city", "hour", "key", "version").checkpoint())
        if todo.isEmpty():
            return JobResult(_gold_hours(spark, gold_path), no_metrics(spark))
        want = todo.select(F.col("city").alias("__c"), F.col("hour").alias("__hour"), "key")
        members = (batches.join(want, F.col("city").eqNullSafe(F.col("__c"))
                                & (F.date_trunc(unit, batch_timestamp("batch_ts")) == F.col("__hour")))
                   .select("city", "batch_ts", F.col("key").alias("hour")))
        rows = of_batches(layer_or_empty(spark, silver_path, FLOW_SILVER), members)
        n, largest = rows.groupBy("city", "hour").count().agg(F.sum("count"), F.max("count")).first()
        dealt = deal_hours(rows, n or 0, largest or 0)
        gold = finish_kpis(segment_kpi(dealt, (CELL, "city", "hour", "road_id", "frc")).drop(CELL),
                           estimate_free_flow=estimate_free_flow)
        write_batch(gold, gold_path, partition_by=("city", "hour"), files_per_partition=0)
        log.commit(run_number(log), todo.select("city", F.col("key").alias("batch_ts"), "version"))
        back = _gold_hours(spark, gold_path)
        fresh = back.join(want.select(F.col("__c"), F.col("key").alias("__key")),
                          F.col("city").eqNullSafe(F.col("__c")) & (F.col("hour") == F.col("__key")), "left_semi")
        counts = fresh.groupBy("city", F.col("hour").alias("batch_ts")).agg(
            F.sum("road_segments").alias("read"), F.sum("road_segments").alias("written"))
        metrics = batch_counts(counts, dag_id, "gold_backlog", run_id, run_ts, round(time.time() - t0, 3)).cache()
        metrics.count()
        save(metrics)
    return JobResult(back, metrics)


def _gold_hours(spark: SparkSession, path: str) -> DataFrame:
    """Gold by hour; ``hour`` stays a batch key. Empty, with the columns of a first run, before one."""
    if not path_exists(spark, path):
        samples = spark.createDataFrame([], FLOW_SILVER).withColumn("hour", F.lit(""))
        return finish_kpis(segment_kpi(samples, ("city", "hour", "road_id", "frc")))
    types = {"city": "string", "hour": "string"}
    plain = spark.read.parquet(path)
    schema = StructType([StructField(f.name, StringType()) if f.name in types else f for f in plain.schema.fields])
    return spark.read.schema(schema).parquet(path)


def bronze_batch_handler(bronze_path: str, metrics_path: str | None = None,
                         reject_path: str | None = None, dag_id: str = "flow"):
    """``foreachBatch`` function for ``streaming.ingest_available``.

    Each micro-batch of new raw rows is a load of its own, numbered by the micro-batch
    id: a replayed one replaces its own rows and nothing else, and ``run_silver`` works
    the batches it touched anew. Rejects and metrics are kept the same way.
    """
    def handle(df: DataFrame, batch_id: int) -> None:
        spark, number = df.sparkSession, batch_id + 1
        if CORRUPT_COL not in df.columns:
            df = df.withColumn(CORRUPT_COL, F.lit(None).cast("string"))
        # the stream's checkpoint is what tells its files apart
        tagged = (gate_bronze(df).withColumn("source_file", F.lit(None).cast("string"))
                  .persist(StorageLevel.MEMORY_AND_DISK))
        try:
            files = spark.createDataFrame([(f"micro-batch {batch_id}", 0)], "path string, length long") \
                .withColumns({"modified": F.lit(None).cast("long"), "again": F.lit(False)})
            Load(LoadLog(spark, bronze_path), number, files, tagged).finish(tagged, bronze_path, FLOW_BRONZE)
            write_rejects(tagged, reject_path, f"microbatch-{batch_id}")
            if metrics_path:
                m = batch_metrics(tagged, dag_id=dag_id, task_id="bronze", run_id=f"microbatch-{batch_id}")
                write_batch(m, metrics_path, partition_by=("dag_id", "task_id", "run_id"))
        finally:
            tagged.unpersist()
    return handle
