"""Layer contracts as StructType constants (columns in order)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Batch key format: the scheduler's compact run timestamp, e.g. 20260720T191500.
BATCH_FORMAT = "yyyyMMdd'T'HHmmss"

FLOW_RAW = _s(
    ("city", StringType()),
    ("batch_ts", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("frc", StringType()),
    ("current_speed", IntegerType()),
    ("free_flow_speed", IntegerType()),
    ("travel_time", IntegerType()),
    ("confidence", DoubleType()),
    ("road_closure", BooleanType()),
)

FLOW_BRONZE = StructType(FLOW_RAW.fields + [
    StructField("ingested_at", TimestampType(), True),
    StructField("date", DateType(), True),
])

FLOW_SILVER = StructType(FLOW_BRONZE.fields + [
    StructField("road_id", StringType(), True),
    StructField("speed_ratio", DoubleType(), True),
    StructField("processed_at", TimestampType(), True),
])

FLOW_GOLD = _s(
    ("city", StringType()),
    ("road_id", StringType()),
    ("frc", StringType()),
    ("observation_ts", TimestampType()),
    ("current_speed", DoubleType()),
    ("free_flow_speed", DoubleType()),
    ("current_travel_time", DoubleType()),
    ("free_flow_travel_time", DoubleType()),
    ("confidence", DoubleType()),
    ("road_closure", BooleanType()),
    ("speed_ratio", DoubleType()),
    ("congested_segments", LongType()),
    ("road_segments", LongType()),
    ("congestion_percent", DoubleType()),
    ("delay_seconds", DoubleType()),
    ("congestion_level", StringType()),
)

# Serving table: gold minus congested_segments, road_segments, congestion_percent.
TRAFFIC_KPIS = StructType([f for f in FLOW_GOLD.fields
                           if f.name not in ("congested_segments", "road_segments",
                                             "congestion_percent")])

TRAFFIC_POINTS = _s(
    ("city", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("speed_ratio", DoubleType()),
    ("observation_ts", TimestampType()),
    ("congestion_level", StringType()),
)

INCIDENT_RAW = _s(
    ("city", StringType()),
    ("batch_ts", StringType()),
    ("incident_type", StringType()),
    # JSON integer read into a string column on purpose: 8 -> "8".
    ("category", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("delay_seconds", DoubleType()),
    ("road_numbers", StringType()),
    ("from_road", StringType()),
    ("to_road", StringType()),
    ("start_time", StringType()),
    ("end_time", StringType()),
)

INCIDENT_BRONZE = StructType(INCIDENT_RAW.fields + [
    StructField("date", DateType(), True),
])

INCIDENT_SILVER = _s(
    ("city", StringType()),
    ("batch_ts", StringType()),
    ("incident_type", StringType()),
    ("category", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("delay_seconds", DoubleType()),
    ("road_numbers", StringType()),
    ("from_road", StringType()),
    ("to_road", StringType()),
    ("start_time", TimestampType()),
    ("end_time", TimestampType()),
    ("observed_at", TimestampType()),
    ("processed_at", TimestampType()),
    ("date", DateType()),
)

TRAFFIC_INCIDENTS = _s(
    ("city", StringType()),
    ("incident_type", StringType()),
    ("category", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("delay_seconds", DoubleType()),
    ("road_numbers", StringType()),
    ("from_road", StringType()),
    ("to_road", StringType()),
    ("start_time", TimestampType()),
    ("end_time", TimestampType()),
    ("observed_at", TimestampType()),
    ("batch_ts", StringType()),
)

PIPELINE_METRICS = _s(
    ("dag_id", StringType()),
    ("run_id", StringType()),
    ("task_id", StringType()),
    ("batch_id", StringType()),
    ("city", StringType()),
    ("ingestion_timestamp", TimestampType()),
    ("records_read", LongType()),
    ("records_written", LongType()),
    ("records_dropped", LongType()),
    ("rows_processed", LongType()),
    ("api_execution_time", DoubleType()),
    ("spark_execution_time", DoubleType()),
    ("total_execution_time", DoubleType()),
    ("status", StringType()),
    ("error_message", StringType()),
    ("measured_at", TimestampType()),
)

SITES = _s(
    ("city", StringType()),
    ("bbox", ArrayType(DoubleType())),
    ("grid_steps", IntegerType()),
)

# Serving-table text widths, VARCHAR(n) of the serving DDL.
SERVING_WIDTHS = {
    "traffic_kpis": {"city": 64, "road_id": 256, "frc": 16, "congestion_level": 32},
    "traffic_points": {"city": 64, "congestion_level": 32},
    "traffic_incidents": {"city": 64, "incident_type": 64, "category": 64,
                          "road_numbers": 256, "from_road": 256, "to_road": 256,
                          "batch_ts": 64},
    "pipeline_metrics": {"dag_id": 128, "run_id": 256, "task_id": 128,
                         "batch_id": 256, "city": 64, "status": 32},
}

SERVING_CONTRACTS = {
    "traffic_kpis": TRAFFIC_KPIS,
    "traffic_points": TRAFFIC_POINTS,
    "traffic_incidents": TRAFFIC_INCIDENTS,
    "pipeline_metrics": PIPELINE_METRICS,
}
