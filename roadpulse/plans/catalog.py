"""The operators applied to the driver's tables.

Each query maps the traffic roles (city, batch, road, speeds, incidents) onto
columns of the given tables and runs the library operator over the whole
table. ``ORACLE_SQL`` holds the same computation as DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as RF
from ..operators import (alerts, batches, dedup, drift, episodes, grid, kpi, layers, metrics, outages, payloads,
                         quality, quantiles)
from ..schemas import BATCH_FORMAT
from ..session import even, scratch_path
from ..sinks import files as sink_files
from ..sources import files as source_files

# Fixed run stamp so that stamped columns are reproducible in checks.
RUN_TS = "2026-01-01 00:00:00"


#: columns, read in any case, that a table is dealt by
SPREAD_BY = {"lineitem": ("l_partkey", "l_suppkey"), "orders": ("o_custkey",)}


def _load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read a driver table; ``spread`` deals its rows over tasks of a bounded size for costly work per row."""
    # Batch keys and stamps are read and written in UTC (decision D10).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return even(df, *SPREAD_BY.get(name, ())) if spread else df


# --------------------------------------------------------------------------- flow KPI

def _lineitem_flow(li: DataFrame) -> DataFrame:
    """lineitem as flow samples: one sample per line item."""
    return li.select(
        F.col("l_returnflag").alias("city"),
        RF.stable_key("l_returnflag", "l_suppkey").alias("road_id"),
        F.col("l_linestatus").alias("frc"),
        F.col("l_shipdate").alias("observed"),
        F.col("l_quantity").alias("current_speed"),
        F.lit(50.0).alias("free_flow_speed"),
        F.col("l_extendedprice").alias("travel_time"),
        F.col("l_discount").alias("confidence"),
        (F.col("l_tax") == 0).alias("road_closure"),
        RF.safe_ratio("l_quantity", F.lit(50.0), 3).alias("speed_ratio"),
    )


def q_hourly_kpi(spark, sf_dir):
    li = _load(spark, sf_dir, "lineitem")
    return kpi.hourly_segment_kpis(_lineitem_flow(li), observed="observed")


def q_speed_ratio(spark, sf_dir):
    li = _load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     RF.safe_ratio("l_quantity", F.col("l_linenumber") - 1, 3).alias("speed_ratio"))


def q_congestion_level(spark, sf_dir):
    li = _load(spark, sf_dir, "lineitem")
    r = RF.safe_ratio("l_quantity", (F.col("l_linenumber") - 1) * 10, 3)
    return li.select("l_orderkey", "l_linenumber", r.alias("speed_ratio"),
                     RF.level(r).alias("congestion_level"),
                     RF.level(r, null_label="unknown").alias("level_or_unknown"))


def q_road_id(spark, sf_dir):
    ev = _load(spark, sf_dir, "events")
    return ev.select("event_id", RF.stable_key(
        "event_type", "user_id", F.when(F.col("value") > 100, F.col("props"))).alias("road_id"))


def q_heatmap_points(spark, sf_dir):
    ev = _load(spark, sf_dir, "events")
    pts = ev.select(F.col("event_type").alias("city"), F.col("user_id").alias("lat"),
                    F.col("event_id").alias("lon"), "ts",
                    RF.safe_ratio("value", F.lit(25.0), 3).alias("speed_ratio"))
    hour = batches.latest_hour(pts, "ts")
    return kpi.heatmap_points(hour, observed="ts")


# --------------------------------------------------------------------------- batches

def _events_batched(spark, sf_dir, width="15 minutes"):
    ev = _load(spark, sf_dir, "events")
    return ev.withColumn("batch_ts", RF.batch_key("ts", width))


def q_latest_hour(spark, sf_dir):
    ev = _load(spark, sf_dir, "events")
    return batches.latest_hour(ev, "ts").select("event_id", "ts", "event_type")


def q_latest_batch(spark, sf_dir):
    ev = _events_batched(spark, sf_dir)
    return batches.latest_batch(ev, "batch_ts").select("event_id", "batch_ts")


def q_latest_batch_by_city(spark, sf_dir):
    ev = _events_batched(spark, sf_dir)
    return (batches.latest_batch(ev, "batch_ts", by=["event_type"])
            .select("event_id", "event_type", "batch_ts"))


def q_batch_date(spark, sf_dir):
    ev = _events_batched(spark, sf_dir)
    return ev.select("event_id", "batch_ts",
                     RF.batch_date("batch_ts").alias("date"),
                     RF.batch_timestamp_ntz("batch_ts").alias("observed_at"))


def q_complete_hours(spark, sf_dir):
    ev = _events_batched(spark, sf_dir)
    out = batches.complete_hours(ev, "ts", "batch_ts", group=["event_type"], min_batches=4)
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def q_dedup_latest(spark, sf_dir):
    ev = _load(spark, sf_dir, "events")
    return (dedup.keep_one(ev, ["event_type", "user_id"], [F.col("value").desc()], ["event_id"])
            .select("event_id", "event_type", "user_id", "value", "ts"))


# --------------------------------------------------------------------------- incidents

def _orders_incidents(spark, sf_dir) -> DataFrame:
    o = _load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderstatus").alias("city"),
        F.col("o_orderpriority").alias("incident_type"),
        F.pmod(F.col("o_custkey"), F.lit(10)).cast("string").alias("category"),
        F.col("o_totalprice").alias("delay_seconds"),
        F.col("o_custkey").cast("string").alias("from_road"),
        F.col("o_orderkey").cast("string").alias("to_road"),
        F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("observed_at"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_orderkey").cast("double").alias("lat"),
        F.col("o_custkey").cast("double").alias("lon"),
    )


def q_alert_top_incident(spark, sf_dir):
    return alerts.worst_incidents(_orders_incidents(spark, sf_dir))


def q_alert_text(spark, sf_dir):
    o = _load(spark, sf_dir, "orders")
    src = o.select(
        "o_orderkey",
        F.pmod(F.col("o_custkey"), F.lit(16)).cast("string").alias("category"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "P", F.lit(""))
         .otherwise(F.col("o_orderpriority")).alias("from_road"),
        F.col("o_orderstatus").alias("to_road"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(5)) == 0, F.lit(0.0))
         .otherwise(F.col("o_totalprice")).alias("delay_seconds"),
    )
    return src.select("o_orderkey",
                      RF.category_name("category").alias("category_name"),
                      RF.location_text("from_road", "to_road").alias("location"),
                      RF.delay_text("delay_seconds").alias("delay"))


def _orders_payloads(spark, sf_dir, batch: str = "day", extra=()) -> DataFrame:
    """One incidents payload (JSON text) per order, built by Spark.

    The batch key is the order date (``day``) or its year (``year``).
    """
    o = _load(spark, sf_dir, "orders", spread=True)
    lon = (F.col("o_custkey") + 0.5).cast("string")
    lat = (F.col("o_orderkey") + 0.25).cast("string")
    point = F.concat(F.lit("["), lon, F.lit(","), lat, F.lit("]"))
    line = F.concat(F.lit("[["), lon, F.lit(","), lat, F.lit("],["), (F.col("o_custkey") + 1.5)
                    .cast("string"), F.lit(","), lat, F.lit("]]"))
    # pending orders carry an empty coordinate list: the flattener drops them
    coords = (F.when(F.col("o_orderstatus") == "P", F.lit("[]"))
               .when(F.pmod("o_orderkey", F.lit(2)) == 0, line).otherwise(point))
    gtype = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit("LineString")).otherwise(F.lit("Point"))
    delay = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")) \
             .otherwise(F.lit("null"))
    roads = F.when(F.substring("o_orderpriority", 1, 1) == "1",
                   F.concat(F.lit(',"roadNumbers":["A'), F.col("o_custkey").cast("string"),
                            F.lit('","E'), F.col("o_orderkey").cast("string"), F.lit('"]'))
                   ).otherwise(F.lit(""))
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.when(F.col("o_orderstatus") == "O", F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                 F.lit('"')))
    body = F.concat(
        F.lit('{"incidents":[{"type":"Feature","geometry":{"type":"'), gtype,
        F.lit('","coordinates":'), coords, F.lit('},"properties":{"iconCategory":'),
        F.pmod("o_custkey", F.lit(15)).cast("string"),
        F.lit(',"delay":'), delay, roads,
        F.lit(',"from":"'), F.col("o_orderpriority"), F.lit('","to":"'), F.col("o_orderstatus"),
        F.lit('","startTime":"'), start, F.lit('","endTime":'), end, F.lit("}}]}"))
    when = F.col("o_orderdate") if batch == "day" else F.date_trunc(batch, "o_orderdate")
    return o.select(F.col("o_orderstatus").alias("city"),
                    F.date_format(when, BATCH_FORMAT).alias("batch_ts"),
                    body.alias("payload"), *extra)


def q_incident_flatten(spark, sf_dir):
    return payloads.flatten_incidents(_orders_payloads(spark, sf_dir))


def q_incident_gold(spark, sf_dir, batch: str = "day"):
    flat = payloads.flatten_incidents(_orders_payloads(spark, sf_dir, batch))
    bronze = flat.withColumn("date", RF.batch_date("batch_ts"))
    silver = layers.incident_silver(bronze, run_ts=RUN_TS)
    gold = layers.incident_gold(silver.filter(F.col("reject_reason").isNull()))
    return gold.withColumns({c: F.col(c).cast("timestamp_ntz")
                             for c in ("start_time", "end_time", "observed_at")})


def q_incident_alert(spark, sf_dir):
    """Payloads -> silver -> gold -> worst accident/closure per group -> alert text."""
    gold = q_incident_gold(spark, sf_dir, batch="year")
    return alerts.alert_rows(alerts.worst_incidents(gold, within="batch_ts"))


def q_serving_conform(spark, sf_dir):
    from ..schemas import SERVING_WIDTHS, TRAFFIC_INCIDENTS
    inc = _orders_incidents(spark, sf_dir).withColumns({
        "from_road": F.repeat(F.lit("r"), F.pmod(F.col("lon").cast("bigint"), F.lit(300))
                              .cast("int")),
        "road_numbers": F.lit("[]"),
        "end_time": F.lit(None).cast("timestamp_ntz"),
        "batch_ts": F.date_format("start_time", BATCH_FORMAT),
    })
    tagged = quality.conform(inc, TRAFFIC_INCIDENTS, SERVING_WIDTHS["traffic_incidents"])
    return tagged.select("to_road", F.length("from_road").alias("from_len"), "reject_reason")


# --------------------------------------------------------------------------- quality

def q_not_null_gate(spark, sf_dir):
    d = _load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = _load(spark, sf_dir, "labels")
    joined = d.join(lab, "doc_id", "left")
    return quality.require_not_null(joined, ["doc_id", "quality", "toxic"])


def _events_flow_payloads(spark, sf_dir) -> DataFrame:
    ev = _load(spark, sf_dir, "events", spread=True)
    k = F.get_json_object("props", "$.k")
    body = F.concat(
        F.lit('{"flowSegmentData":{"frc":"'), F.col("event_type"),
        F.lit('","currentSpeed":'), F.coalesce(k, F.lit("null")),
        F.lit(',"freeFlowSpeed":'), F.col("user_id").cast("string"),
        F.lit(',"currentTravelTime":'), F.col("event_id").cast("string"),
        F.lit(',"confidence":'), F.col("value").cast("string"), F.lit("}}"))
    payload = F.when(F.col("value") < 5, F.lit("{}")).otherwise(body)
    return ev.select("event_id", "event_type", "ts", payload.alias("payload"))


def q_payload_flatten(spark, sf_dir):
    return payloads.flatten_flow(_events_flow_payloads(spark, sf_dir), keep=["event_id"])


def q_ingest_tallies(spark, sf_dir):
    p = _events_flow_payloads(spark, sf_dir).withColumn(
        "batch_ts", F.date_format("ts", "yyyyMMdd"))
    flat = payloads.flatten_flow(p.withColumnRenamed("event_type", "city"),
                                 keep=["city", "batch_ts"])
    return metrics.ingestion_tallies(flat)


def _supplier_sites(spark, sf_dir) -> DataFrame:
    s = _load(spark, sf_dir, "supplier")
    min_lon = F.col("s_nationkey").cast("double")
    min_lat = F.col("s_nationkey") / 4.0
    steps = (F.when(F.pmod("s_suppkey", F.lit(3)) == 0, 2)
              .when(F.pmod("s_suppkey", F.lit(3)) == 1, 3).otherwise(5))
    return s.select(F.col("s_name").alias("city"),
                    F.array(min_lon, min_lat, min_lon + 2.0, min_lat + 1.0).alias("bbox"),
                    steps.cast("int").alias("grid_steps"), "s_suppkey")


def q_grid(spark, sf_dir):
    return grid.sampling_grid(_supplier_sites(spark, sf_dir))


def q_site_validation(spark, sf_dir):
    s = _supplier_sites(spark, sf_dir)
    k = F.col("s_suppkey")
    b = F.col("bbox")
    broken = s.select(
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit(" ")).otherwise(F.col("city")).alias("city"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.slice(b, 1, 3))
         .when(F.pmod(k, F.lit(11)) == 0, F.array(F.get(b, 0), F.lit(None).cast("double"),
                                                  F.get(b, 2), F.get(b, 3)))
         .when(F.pmod(k, F.lit(7)) == 0, F.array(F.get(b, 2), F.get(b, 1), F.get(b, 0),
                                                 F.get(b, 3)))
         .otherwise(b).alias("bbox"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(0)).otherwise(F.col("grid_steps"))
         .alias("grid_steps"),
        "s_suppkey",
    )
    v = grid.validate_sites(broken)
    return v.select("s_suppkey", "city", "grid_steps",
                    F.size("reject_reasons").alias("n_reasons"),
                    F.array_join("reject_reasons", "; ").alias("reasons"))


def q_grid_coverage(spark, sf_dir):
    """Hours of the run in which an event type sent nothing, edges included."""
    ev = _load(spark, sf_dir, "events").withColumn(
        "hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    run = ev.select(F.struct(F.min("hour").alias("lo"), F.max("hour").alias("hi"))).scalar()
    expected = ev.select("event_type").distinct().select("event_type", F.explode(
        F.sequence(run["lo"], run["hi"], F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return grid.coverage_gaps(expected, ev, ["event_type", "hour"])


def q_grid_coverage_summary(spark, sf_dir):
    """Per (site, batch): grid points expected, received and missing.

    Each line item is a sample at grid point ``l_linenumber - 1`` of its
    supplier's site, in batch ``l_returnflag``; indexes beyond the grid fall
    outside it and are not received points.
    """
    g = grid.sampling_grid(_supplier_sites(spark, sf_dir))
    li = _load(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag")
    sup = _load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    samples = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("s_name").alias("city"), (F.col("l_linenumber") - 1).alias("point_index"),
        F.col("l_returnflag").alias("batch_ts"))
    received = samples.join(g, ["city", "point_index"]).select("city", "lat", "lon", "batch_ts")
    # the batches of the run, whichever sites took part in them
    return grid.grid_coverage(g, received, batches=li.select(F.col("l_returnflag").alias("batch_ts")))


def q_batch_metrics(spark, sf_dir):
    ev = _events_batched(spark, sf_dir, "1 hour").withColumnRenamed("event_type", "city")
    rules = [("value below 1", F.col("value") >= 1.0),
             ("missing props", F.col("props").isNotNull())]
    tagged = quality.tag_rejects(ev, rules)
    m = metrics.batch_metrics(tagged, dag_id="events", task_id="bronze", run_ts=RUN_TS)
    return m.select("city", "batch_id", "records_read", "records_written", "records_dropped",
                    "rows_processed", "status")


def _orders_metrics(spark, sf_dir) -> DataFrame:
    o = _load(spark, sf_dir, "orders")
    read = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    dropped = F.pmod(F.col("o_custkey"), F.lit(10))
    return o.select(
        F.col("o_orderstatus").alias("dag_id"),
        F.col("o_orderpriority").alias("task_id"),
        F.when(F.col("o_totalprice") >= 100000, "success").otherwise("failed").alias("status"),
        read.alias("records_read"),
        (read - dropped).alias("records_written"),
        dropped.alias("records_dropped"),
        (F.col("o_totalprice") / 10000).alias("total_execution_time"),
        F.col("o_orderdate").alias("measured_at"),
    )


def q_metrics_health(spark, sf_dir):
    return metrics.metrics_health(_orders_metrics(spark, sf_dir))


# --------------------------------------------------------------------------- flow layers

def _lineitem_raw(spark, sf_dir, spread: bool = True) -> DataFrame:
    li = _load(spark, sf_dir, "lineitem", spread=spread)
    return li.select(
        F.col("l_returnflag").alias("city"),
        F.date_format("l_shipdate", BATCH_FORMAT).alias("batch_ts"),
        (F.col("l_suppkey") / 4.0).alias("lat"),
        (F.col("l_partkey") / 8.0).alias("lon"),
        F.concat(F.lit("FRC"), F.col("l_linestatus")).alias("frc"),
        F.col("l_quantity").cast("int").alias("current_speed"),
        F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(F.lit(40)).alias("free_flow_speed"),
        F.floor(F.col("l_extendedprice") / 100).cast("int").alias("travel_time"),
        F.col("l_discount").alias("confidence"),
        (F.col("l_tax") == 0).alias("road_closure"),
    )


def q_flow_silver(spark, sf_dir):
    bronze = layers.flow_bronze(_lineitem_raw(spark, sf_dir), run_ts=RUN_TS)
    silver = layers.flow_silver(bronze.filter(F.col("reject_reason").isNull())
                                .drop("reject_reason"), run_ts=RUN_TS)
    return silver.select("city", "batch_ts", "road_id", "lat", "lon", "frc", "current_speed",
                         "free_flow_speed", "travel_time", "speed_ratio", "date")


def q_flow_gold(spark, sf_dir):
    raw = _lineitem_raw(spark, sf_dir, spread=False)
    bronze = layers.flow_bronze(raw, run_ts=RUN_TS)
    dealt = layers.deal_roads(bronze.filter(F.col("reject_reason").isNull()).drop("reject_reason"), raw.count())
    silver = layers.flow_silver(dealt, run_ts=RUN_TS, within=(layers.ROAD,))
    gold = kpi.hourly_segment_kpis(silver, (layers.ROAD, "city", "road_id", "frc"), estimate_free_flow=True)
    return gold.withColumn("observation_ts", F.col("observation_ts").cast("timestamp_ntz"))


def q_flow_points(spark, sf_dir):
    """Heat-map points of the latest hour.

    The hour is cut before the dedup: dedup partitions by ``batch_ts`` and
    never drops a whole batch, so only the hour's rows need deduplicating.
    """
    bronze = layers.flow_bronze(_lineitem_raw(spark, sf_dir, spread=False), run_ts=RUN_TS)
    ok = layers.silver_features(bronze.filter(F.col("reject_reason").isNull())
                                .drop("reject_reason"), run_ts=RUN_TS)
    ok = ok.filter(F.col("reject_reason").isNull())
    # a range of the raw key: nothing is parsed to find the hour
    hour = batches.latest_hour_of_key(ok, "batch_ts")
    pts = kpi.heatmap_points(layers.dedup_silver(hour))
    return pts.withColumn("observation_ts", F.col("observation_ts").cast("timestamp_ntz"))


# --------------------------------------------------------------------------- sinks

def q_sink_roundtrip(spark, sf_dir):
    from ..schemas import FLOW_RAW
    # monthly batches: one raw file set per (city, month)
    raw = _lineitem_raw(spark, sf_dir).withColumn(
        "batch_ts", F.concat(F.substring("batch_ts", 1, 6), F.lit("01T000000")))
    path = scratch_path(spark, "raw_roundtrip")
    sink_files.write_raw(raw, path)
    back = source_files.read_flow_raw(spark, path, basePath=path)
    return back.select(*[f.name for f in FLOW_RAW.fields])


def q_idempotent_write(spark, sf_dir):
    o = _load(spark, sf_dir, "orders").withColumn(
        "date", F.to_date("o_orderdate")).withColumn("city", F.col("o_orderstatus"))
    path = scratch_path(spark, "orders_batches")
    parts = ("city", "o_orderpriority")
    # some orders are already there, written twice: the replay makes no copy
    known = o.filter(F.pmod("o_custkey", F.lit(2)) == 0)
    sink_files.write_batch(known, path, partition_by=parts)
    sink_files.write_batch(known, path, partition_by=parts)
    existing = spark.read.parquet(path)
    extra = sink_files.append_missing(o, existing, ["o_orderkey"], prune_by=list(parts))
    sink_files.write_append(extra, path, partition_by=parts)
    back = spark.read.parquet(path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       "o_orderdate", "o_orderpriority")


# --------------------------------------------------------------------------- streaming

def _events_stream(spark, sf_dir) -> DataFrame:
    """The events table as a file stream (only new files are read on each run)."""
    schema = _load(spark, sf_dir, "events").schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
         .parquet(sf_dir.rstrip("/")))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def q_stream_hourly(spark, sf_dir):
    """Hourly figures of the event stream, and of the hours still open when it ends."""
    from ..streaming import open_windows, run_available, stream_means
    means = {"total": (F.col("value"), 2), "speed_ratio": (F.col("speed_ratio"), 3)}

    def figures(rows):
        rows = rows.withColumn("speed_ratio", RF.safe_ratio("value", F.lit(50.0), 3))
        return stream_means(rows, "ts", "1 hour", ["event_type"], means, [F.count(F.lit(1)).alias("n")])

    root = scratch_path(spark, "stream_hourly")
    stream = _events_stream(spark, sf_dir).withWatermark("ts", "1 hour")
    emitted = spark.read.parquet(run_available(figures(stream), f"{root}/out", f"{root}/checkpoint"))
    rows = _load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = emitted.unionByName(figures(open_windows(rows, emitted, "ts")))
    return out.withColumns({
        "mean_value": F.col("total"), "congestion_level": RF.level("speed_ratio"),
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz")}).drop("total")


def q_stream_dedup(spark, sf_dir):
    from ..streaming import run_available, stream_dedup
    s = _events_stream(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    d = stream_dedup(s, ["event_type", "user_id", "hour"], "ts", watermark="1 hour")
    root = scratch_path(spark, "stream_dedup")
    out = run_available(d.select("event_type", "user_id", "hour"), f"{root}/out",
                        f"{root}/checkpoint")
    return spark.read.parquet(out).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


# --------------------------------------------------------------------------- jobs

def q_silver_job_metrics(spark, sf_dir):
    """Raw files -> bronze job -> silver job; the silver job's metrics rows.

    Yearly batches of lineitem samples are written as raw JSON, then the
    jobs process every batch that is not in their layer yet.
    """
    from . import flow
    raw_rows = _yearly(_lineitem_raw(spark, sf_dir, spread=False))
    root = scratch_path(spark, "silver_job")
    sink_files.write_raw(raw_rows, f"{root}/raw", compression="gzip")
    flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS)
    res = flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS)
    return res.metrics.select("city", "batch_id", "records_read", "records_written",
                              "records_dropped")


def q_incident_job_alert(spark, sf_dir):
    """Payloads -> raw files -> incident bronze / silver / gold jobs -> alert rows.

    Same answer as ``incident_alert`` (operators only), through the jobs.
    """
    from . import incidents
    root = scratch_path(spark, "incident_job")
    incidents.ingest_payloads(_orders_payloads(spark, sf_dir, batch="year"), f"{root}/raw")
    incidents.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS)
    incidents.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS)
    gold = incidents.run_gold(spark, f"{root}/silver", f"{root}/gold", run_ts=RUN_TS)
    _, text, _ = incidents.run_alert(gold.output)
    return text.withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))


def _yearly(raw: DataFrame) -> DataFrame:
    """Raw samples in yearly batches."""
    return raw.withColumn("batch_ts", F.concat(F.substring("batch_ts", 1, 4), F.lit("0101T000000")))


#: rows of a raw file, which is one micro-batch, at most
STREAM_FILE_ROWS = 5_000_000


def q_bronze_stream(spark, sf_dir):
    """Raw files that each hold a part of every batch, ingested one file at a time: four, or as many as hold their rows."""
    from ..schemas import FLOW_RAW
    from ..streaming import ingest_available
    from . import flow
    root = scratch_path(spark, "bronze_stream")
    files = max(4, -(-_load(spark, sf_dir, "lineitem").count() // STREAM_FILE_ROWS))
    _yearly(_lineitem_raw(spark, sf_dir)).repartition(files).write.json(f"{root}/raw")
    ingest_available(spark, f"{root}/raw", FLOW_RAW, f"{root}/checkpoint",
                     flow.bronze_batch_handler(f"{root}/bronze"), max_files_per_trigger=1).awaitTermination()
    back = source_files.read_layer(spark, f"{root}/bronze")
    return back.select("city", F.date_format("date", BATCH_FORMAT).alias("batch_ts"), "lat", "lon", "frc",
                       "current_speed", "free_flow_speed", "travel_time", "confidence", "road_closure")


def q_silver_backlog(spark, sf_dir):
    """Many batches land before one run, and one city's come a run later: silver holds them all."""
    from . import flow
    root = scratch_path(spark, "silver_backlog")
    raw = _yearly(_lineitem_raw(spark, sf_dir, spread=False))
    for delivery in (raw.filter("city <> 'R'"), raw.filter("city = 'R'")):
        sink_files.write_raw(delivery, f"{root}/raw", compression="gzip")
        flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS)
        silver = flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS).output
    return silver.select("city", "batch_ts", "road_id", "lat", "lon", "frc", "current_speed",
                         "free_flow_speed", "travel_time", "confidence", "road_closure", "speed_ratio",
                         F.col("processed_at").cast("timestamp_ntz").alias("processed_at"))


def q_reject_ledger(spark, sf_dir):
    """Incident payloads, broken ones among them: read = written + rejected, per batch and reason."""
    key = F.col("o_orderkey")
    rows = _orders_payloads(spark, sf_dir, "year", extra=["o_orderkey"]).withColumn(
        "payload", F.when(F.pmod(key, F.lit(7)) == 0, F.lit("{not json"))
        .when(F.pmod(key, F.lit(7)) == 1, F.lit('{"other": []}')).otherwise(F.col("payload")))
    flat = payloads.flatten_incidents(rows, problem="problem")
    return flat.groupBy("city", "batch_ts").agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col("problem").isNull()).alias("records_written"),
        *[F.count_if(F.col("problem") == why).alias(name) for name, why in (
            ("not_json", payloads.BAD_JSON), ("no_list", payloads.NO_INCIDENTS),
            ("no_position", payloads.NO_COORDINATES))])


def q_job_metrics(spark, sf_dir):
    """Metrics rows that the jobs keep: bronze and silver, and a run that fails."""
    from . import flow
    root = scratch_path(spark, "job_metrics")
    kept = f"{root}/metrics"
    sink_files.write_raw(_yearly(_lineitem_raw(spark, sf_dir, spread=False)), f"{root}/raw", compression="gzip")
    # clean input: the reject ledgers stay empty
    flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS, metrics_path=kept, run_id="one",
                    reject_path=f"{root}/rejects/bronze")
    flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS, metrics_path=kept, run_id="one",
                    reject_path=f"{root}/rejects/silver")
    try:
        flow.run_bronze(spark, f"{root}/missing", f"{root}/bronze", run_ts=RUN_TS, metrics_path=kept, run_id="two")
    except Exception:  # noqa: BLE001  the failed run is what is looked at
        pass
    rows = spark.read.parquet(kept)
    return rows.select("task_id", "run_id", "city", "batch_id", "records_read", "records_written",
                       "records_dropped", "status", F.col("measured_at").cast("timestamp_ntz").alias("measured_at"))


def q_snapshot_write(spark, sf_dir):
    """A snapshot replaces the whole table, cities that are gone included."""
    o = _load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("city"))
    path = scratch_path(spark, "snapshot")
    sink_files.write_snapshot(o, path)
    sink_files.write_snapshot(o.filter("city <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return spark.read.parquet(path).select("city", "o_orderkey", "o_totalprice")


def q_append_by_city(spark, sf_dir):
    """Two appends by city hold the rows of both."""
    o = _load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("city"))
    path = scratch_path(spark, "append")
    sink_files.write_append(o.filter("o_totalprice < 100000"), path)
    sink_files.write_append(o.filter("o_totalprice >= 100000"), path)
    return spark.read.parquet(path).select("city", "o_orderkey", "o_totalprice")


def q_json_documents(spark, sf_dir):
    """Multi-line JSON documents, one per block of customers, read back under a schema."""
    block = F.floor(F.col("c_custkey") / 500)
    docs = _load(spark, sf_dir, "customer").groupBy(block.alias("block")).agg(
        F.to_json(F.struct(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal")).alias("customers")),
                  {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "json_documents")
    docs.write.partitionBy("block").text(path)
    back = source_files.read_json_documents(
        spark, path, "customers array<struct<c_custkey: bigint, c_name: string, c_acctbal: double>>")
    return back.select(F.inline("customers"))


def q_alert_count(spark, sf_dir):
    return alerts.alert_summary(alerts.worst_incidents(_orders_incidents(spark, sf_dir)))


def q_stream_gold(spark, sf_dir):
    """The flow layers as a stream over raw files, the open hours closed at the end."""
    from ..streaming import close_flow_stream, run_flow_stream
    root = scratch_path(spark, "stream_gold")
    _lineitem_raw(spark, sf_dir).write.json(f"{root}/raw", compression="gzip")
    run_flow_stream(spark, f"{root}/raw", f"{root}/gold", f"{root}/checkpoint", estimate_free_flow=True)
    out = close_flow_stream(spark, f"{root}/raw", f"{root}/gold", estimate_free_flow=True)
    return out.drop("window_end").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "observation_ts")})


# --------------------------------------------------------------------------- deliveries over several runs

_SAMPLE = ("lat", "lon", "frc", "current_speed", "free_flow_speed", "travel_time", "confidence", "road_closure")


def _delivered(raw: DataFrame, parts: int, path: str):
    """Write the samples in so many deliveries, each holding a part of every batch; yields after each."""
    part = F.pmod(F.xxhash64("city", "batch_ts", *_SAMPLE), F.lit(parts))
    for i in range(parts):
        raw.filter(part == i).write.mode("append").partitionBy("city", "batch_ts").json(path, compression="gzip")
        yield i


def q_late_files(spark, sf_dir):
    """Every batch comes in two files, one run apart: bronze holds all rows, each file taken once."""
    from . import flow
    root = scratch_path(spark, "late_files")
    for _ in _delivered(_yearly(_lineitem_raw(spark, sf_dir)), 2, f"{root}/raw"):
        out = flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS).output
    return out.select("city", "batch_ts", *_SAMPLE)


def q_late_rows_refresh(spark, sf_dir):
    """Three deliveries of every batch, silver after each: late rows meet the ones that came before."""
    from . import flow
    root = scratch_path(spark, "late_rows")
    for _ in _delivered(_yearly(_lineitem_raw(spark, sf_dir)), 3, f"{root}/raw"):
        flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS)
        silver = flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS).output
    return silver.select("city", "batch_ts", "road_id", *_SAMPLE, "speed_ratio",
                         F.col("processed_at").cast("timestamp_ntz").alias("processed_at"))


def q_reject_job(spark, sf_dir):
    """Raw lines with faults through bronze and silver: what the reject ledgers hold, after a run without news too."""
    from . import flow
    root = scratch_path(spark, "reject_job")
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    li = _load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("0101T000000")).alias("batch_ts"),
        F.when(F.pmod(k, F.lit(89)) != 0, F.col("l_suppkey") / 4.0).alias("lat"), (F.col("l_partkey") / 8.0).alias("lon"),
        F.col("l_linestatus").alias("frc"),
        F.when(F.pmod(k, F.lit(83)) != 0, F.col("l_quantity").cast("int")).alias("current_speed"),
        F.lit(40).alias("free_flow_speed"), F.pmod(k, F.lit(97)).alias("__k"))
    line = F.when(F.col("__k") == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(*[c for c in li.columns if c != "__k"])))
    li.select(line.alias("value")).write.text(f"{root}/raw")
    for run in ("one", "two"):
        ledgers = [flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS, run_id=run,
                                   reject_path=f"{root}/bad/bronze").rejected,
                   flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS, run_id=run,
                                   reject_path=f"{root}/bad/silver").rejected]
    rows = None
    for task, rejected in zip(("bronze", "silver"), ledgers):
        n = rejected.groupBy(F.lit(task).alias("task_id"), "run", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
        rows = n if rows is None else rows.unionByName(n)
    return rows


def q_kpi_merge(spark, sf_dir):
    """Samples in three deliveries kept as mergeable state, merged into a base on the way; KPIs per year from it."""
    from ..operators.kpi_state import KpiTable
    li = _load(spark, sf_dir, "lineitem")
    table = KpiTable(spark, scratch_path(spark, "kpi_merge"))
    for i in range(3):
        samples = _lineitem_flow(li.filter(F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(3)) == i))
        table.add(samples, i, observed="observed", unit="month")
        if i == 1:
            table.compact(unit="month")
    return table.kpis("year").withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def _quarters(raw: DataFrame) -> DataFrame:
    """Raw samples in quarterly batches."""
    month = F.substring("batch_ts", 5, 2).cast("int")
    first = F.lpad((F.floor((month - 1) / 3) * 3 + 1).cast("string"), 2, "0")
    return raw.withColumn("batch_ts", F.concat(F.substring("batch_ts", 1, 4), first, F.lit("01T000000")))


def q_gold_backlog(spark, sf_dir):
    """Years of four quarterly batches, delivered in three parts with late rows: gold holds all complete ones."""
    from . import flow
    root = scratch_path(spark, "gold_backlog")
    raw = _quarters(_lineitem_raw(spark, sf_dir))
    late = F.pmod(F.xxhash64(*_SAMPLE), F.lit(50)) == 0     # rows of batches that were worked in before
    tail = (F.col("city") == "N") & (F.col("batch_ts") >= "1997")
    for delivery in (raw.filter(~late & ~tail), raw.filter(~late & tail), raw.filter(late)):
        delivery.write.mode("append").partitionBy("city", "batch_ts").json(f"{root}/raw", compression="gzip")
        flow.run_bronze(spark, f"{root}/raw", f"{root}/bronze", run_ts=RUN_TS)
        flow.run_silver(spark, f"{root}/bronze", f"{root}/silver", run_ts=RUN_TS)
        gold = flow.run_gold_backlog(spark, f"{root}/silver", f"{root}/gold", run_ts=RUN_TS, unit="year",
                                     min_batches=4, estimate_free_flow=True).output
    return gold.withColumn("observation_ts", F.col("observation_ts").cast("timestamp_ntz"))


def q_stream_update(spark, sf_dir):
    """The flow layers as a stream in update mode, in two runs: late and open hours come from its state."""
    from ..streaming import flow_kpis, run_flow_updates
    root = scratch_path(spark, "stream_update")
    raw = _lineitem_raw(spark, sf_dir)
    for i in range(2):
        raw.filter(F.pmod(F.xxhash64(*_SAMPLE), F.lit(2)) == i).write.mode("append").json(f"{root}/raw", compression="gzip")
        run_flow_updates(spark, f"{root}/raw", f"{root}/samples", f"{root}/checkpoint", watermark="3000 days")
    out = flow_kpis(spark, f"{root}/samples", estimate_free_flow=True)
    return out.drop("window_end").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "observation_ts")})


def q_coverage_bitmaps(spark, sf_dir):
    """Per (site, batch): which grid points are missing, from bitmaps of the samples' points."""
    sites = _supplier_sites(spark, sf_dir)
    sup = _load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("city"))
    li = _load(spark, sf_dir, "lineitem")
    samples = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        "city", (F.col("l_linenumber") - 1).alias("point_index"), F.col("l_returnflag").alias("batch_ts"))
    grids = sites.select("city", (F.col("grid_steps") * F.col("grid_steps")).alias("points"))
    return outages.coverage_bitmaps(samples, grids).withColumn("missing", F.concat_ws(",", F.col("missing").cast("array<string>")))


def q_outage_intervals(spark, sf_dir):
    """Runs of missing 15-minute batches per event type."""
    ev = _load(spark, sf_dir, "events")
    t = F.window(F.col("ts").cast("timestamp"), "15 minutes").start
    out = outages.outage_intervals(ev.select(F.col("event_type").alias("city"), t.alias("batch_time")), 900)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_missing", "last_missing")})


def q_incident_episodes(spark, sf_dir):
    """How long a supplier's worst load stayed in one band: every other quarter delivered first, then the rest."""
    obs = _quarters(_load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.date_format("l_shipdate", BATCH_FORMAT).alias("batch_ts"),
        F.col("l_suppkey").alias("road"), F.floor(F.col("l_quantity") / 10).cast("int").alias("band"))) \
        .groupBy("city", "batch_ts", "road").agg(F.max("band").alias("band"))
    root = scratch_path(spark, "episodes")
    obs.write.parquet(f"{root}/observations")
    obs = spark.read.parquet(f"{root}/observations")
    first = F.substring("batch_ts", 5, 2).isin("01", "07")
    names = {"identity": ("city", "road"), "attributes": ("band",)}
    episodes.incident_episodes(obs.filter(first), **names).write.parquet(f"{root}/history")
    return episodes.incident_episodes(obs.filter(~first), history=spark.read.parquet(f"{root}/history"),
                                      known=obs.filter(first).select("city", "batch_ts").distinct(), **names)


def q_alert_changes(spark, sf_dir):
    """The alerts of three batches, one after the other: only what opens, gets worse or better, or closes."""
    inc = _orders_incidents(spark, sf_dir).withColumn("year", F.year("observed_at"))
    years = sorted(r.year for r in inc.select("year").distinct().orderBy(F.desc("year")).limit(3).collect())
    root = scratch_path(spark, "alert_changes")
    state = spark.createDataFrame([], alerts.worst_incidents(inc).schema)
    for year in years:
        worst = alerts.worst_incidents(inc.filter(F.col("year") == year))
        (alerts.alert_changes(state, worst).withColumn("batch", F.lit(year))
         .write.mode("append").parquet(f"{root}/changes"))
        of_batch = spark.read.parquet(f"{root}/changes").filter(F.col("batch") == year)
        alerts.alert_state(state, of_batch).write.parquet(f"{root}/state{year}")
        state = spark.read.parquet(f"{root}/state{year}")
    return spark.read.parquet(f"{root}/changes").select("batch", "change", "city", "category", "delay_seconds",
                                                        "before_delay", "to_road")


def q_type_drift(spark, sf_dir):
    """JSON records of orders with wrong types mixed in, counted per field and city."""
    contract = "frc string, current_speed int, travel_time int, confidence double, road_closure boolean"
    k = F.col("o_orderkey")
    hit = lambda n: F.pmod(k, F.lit(n)) == 0
    field = lambda name, text: F.concat(F.lit(f'"{name}":'), text)
    speed = F.when(hit(11), F.lit('"fast"')).when(hit(5), F.lit("null")).otherwise(F.pmod(k, F.lit(90)).cast("string"))
    travel = F.when(hit(13), F.lit("12.5")).otherwise(F.pmod(k, F.lit(600)).cast("string"))
    confidence = F.when(hit(17), F.lit('{"value":1}')).when(hit(2), F.lit("1")).otherwise(F.lit("0.25"))
    closure = F.when(hit(7), F.lit('"yes"')).otherwise(F.when(hit(3), F.lit("true")).otherwise(F.lit("false")))
    body = F.concat(F.lit('{"frc":'), F.when(hit(4), F.lit("7")).otherwise(F.lit('"FRC7"')), F.lit(","),
                    F.concat_ws(",", field("current_speed", speed), field("travel_time", travel),
                                field("confidence", confidence), field("road_closure", closure)), F.lit("}"))
    o = _load(spark, sf_dir, "orders", spread=True)
    lines = o.select(F.col("o_orderstatus").alias("city"), F.when(hit(19), F.lit("{broken")).otherwise(body).alias("value"))
    return drift.type_drift(lines, StructType.fromDDL(contract), ["city"])


def q_health_quantiles(spark, sf_dir):
    """Median and 95th percentile per (dag, task) from daily histograms of two halves, against the exact ranks."""
    m = _orders_metrics(spark, sf_dir)
    x = "total_execution_time"
    half = F.floor(F.col("records_read")) % 2 == 0
    days = quantiles.duration_histogram(m.filter(half)).unionByName(quantiles.duration_histogram(m.filter(~half)))
    est = quantiles.quantiles(days, {"p50": 0.5, "p95": 0.95})
    order = Window.partitionBy("dag_id", "task_id").orderBy(x)
    ranked = m.select("dag_id", "task_id", x, F.row_number().over(order).alias("rank"),
                      F.count(F.lit(1)).over(Window.partitionBy("dag_id", "task_id")).alias("all"))
    exact = ranked.groupBy("dag_id", "task_id").agg(*[
        F.max(F.when(F.col("rank") == F.ceil(F.col("all") * q), F.col(x))).alias(f"exact_{name}")
        for name, q in (("p50", 0.5), ("p95", 0.95))])
    near = lambda name: F.abs(F.col(name) - F.col(f"exact_{name}")) <= 0.01 * F.col(f"exact_{name}")
    return est.join(exact, ["dag_id", "task_id"]).select(
        "dag_id", "task_id", "n", near("p50").alias("p50_within"), near("p95").alias("p95_within"),
        F.round("exact_p50", 6).alias("exact_p50"), F.round("exact_p95", 6).alias("exact_p95"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_kpi": q_hourly_kpi,
    "speed_ratio": q_speed_ratio,
    "congestion_level": q_congestion_level,
    "road_id": q_road_id,
    "heatmap_points": q_heatmap_points,
    "latest_hour": q_latest_hour,
    "latest_batch": q_latest_batch,
    "latest_batch_by_city": q_latest_batch_by_city,
    "batch_date": q_batch_date,
    "complete_hours": q_complete_hours,
    "dedup_latest": q_dedup_latest,
    "alert_top_incident": q_alert_top_incident,
    "alert_text": q_alert_text,
    "incident_flatten": q_incident_flatten,
    "incident_gold": q_incident_gold,
    "incident_alert": q_incident_alert,
    "serving_conform": q_serving_conform,
    "not_null_gate": q_not_null_gate,
    "payload_flatten": q_payload_flatten,
    "ingest_tallies": q_ingest_tallies,
    "grid": q_grid,
    "site_validation": q_site_validation,
    "grid_coverage": q_grid_coverage,
    "grid_coverage_summary": q_grid_coverage_summary,
    "batch_metrics": q_batch_metrics,
    "metrics_health": q_metrics_health,
    "flow_silver": q_flow_silver,
    "flow_gold": q_flow_gold,
    "flow_points": q_flow_points,
    "sink_roundtrip": q_sink_roundtrip,
    "idempotent_write": q_idempotent_write,
    "silver_job_metrics": q_silver_job_metrics,
    "incident_job_alert": q_incident_job_alert,
    "stream_hourly": q_stream_hourly,
    "stream_dedup": q_stream_dedup,
    "stream_gold": q_stream_gold,
    "bronze_stream": q_bronze_stream,
    "silver_backlog": q_silver_backlog,
    "reject_ledger": q_reject_ledger,
    "job_metrics": q_job_metrics,
    "snapshot_write": q_snapshot_write,
    "append_by_city": q_append_by_city,
    "json_documents": q_json_documents,
    "alert_count": q_alert_count,
    "late_files": q_late_files,
    "late_rows_refresh": q_late_rows_refresh,
    "reject_job": q_reject_job,
    "kpi_merge": q_kpi_merge,
    "gold_backlog": q_gold_backlog,
    "stream_update": q_stream_update,
    "coverage_bitmaps": q_coverage_bitmaps,
    "outage_intervals": q_outage_intervals,
    "incident_episodes": q_incident_episodes,
    "alert_changes": q_alert_changes,
    "type_drift": q_type_drift,
    "health_quantiles": q_health_quantiles,
}
