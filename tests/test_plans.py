"""Plan-shape checks: pruning, top-1 limits, scalar subqueries, no Python in the plan."""

import os

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import batch_timestamp
from roadpulse.operators import latest_batch, latest_hour, latest_hour_of_key, worst_incidents
from roadpulse.plans.catalog import QUERIES
from roadpulse.sinks.files import write_batch

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan(df)


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")    # else filters are cut off in plan texts
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    from roadpulse.session import scratch_path
    path = scratch_path(spark, "plan_layer")
    rows = [("a", f"2026-07-{d:02d}", f"202607{d:02d}T{h:02d}0000", float(d * 100 + h))
            for d in range(18, 21) for h in (9, 10, 11)]
    df = spark.createDataFrame(rows, "city string, date string, batch_ts string, v double") \
        .withColumn("date", F.to_date("date"))
    write_batch(df, path)
    return path


def test_latest_hour_prunes_date_partitions(spark, layer):
    df = spark.read.parquet(layer)
    out = latest_hour(df, batch_timestamp("batch_ts"), within="date")
    assert sorted(r.v for r in out.collect()) == [2011.0]
    scans = [line for line in plan(out).splitlines() if "FileScan parquet" in line
             and "ReadSchema: struct<v:double>" in line]
    assert scans
    # the date predicate prunes partitions
    for s_ in scans:
        part = s_.split("PartitionFilters:")[1].split("PushedFilters")[0]
        assert "isnotnull(date" in part and "Subquery" in part


def test_latest_hour_of_key_prunes_by_the_raw_key(spark, layer):
    out = latest_hour_of_key(spark.read.parquet(layer), "batch_ts", within="date")
    assert sorted(r.v for r in out.collect()) == [2011.0]
    scan = next(x for x in plan(out).splitlines() if "FileScan parquet" in x and "struct<v:double>" in x)
    part = scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "(batch_ts" in part and ">=" in part and "timestamp" not in part.lower()


def test_alert_reads_the_latest_partition_only(spark):
    from roadpulse.session import scratch_path
    path = scratch_path(spark, "plan_gold")
    rows = [("a", "1", 5.0 + d, "x", "y", f"2026070{d}T000000", 1.0, 2.0) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "city string, category string, delay_seconds double, from_road string, "
                                     "to_road string, batch_ts string, lat double, lon double")
    df = df.withColumns({"incident_type": F.lit("t"), "observed_at": F.col("batch_ts"),
                         "start_time": F.col("batch_ts")})
    df.write.partitionBy("batch_ts").parquet(path)
    out = worst_incidents(spark.read.parquet(path), within="batch_ts")
    assert [r.delay_seconds for r in out.collect()] == [8.0]
    scans = [x for x in plan(out).splitlines() if "FileScan parquet" in x and "delay_seconds" in x]
    assert scans and all("batch_ts" in x.split("PartitionFilters:")[1].split("PushedFilters")[0] for x in scans)


def test_silver_dedups_once_per_job(spark):
    assert plan(QUERIES["flow_silver"](spark, SF)).count("Window [") == 1


def test_latest_batch_within_partition(spark, layer):
    df = spark.read.parquet(layer)
    out = latest_batch(df, "batch_ts", within="date")
    assert [r.batch_ts for r in out.collect()] == ["20260720T110000"]
    assert "PartitionFilters" in plan(out)


def test_keep_one_uses_partial_window_group_limit(spark):
    p = plan(QUERIES["dedup_latest"](spark, SF))
    # one above and one below the shuffle
    top, _, below = p.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in top and "WindowGroupLimit" in below


def test_kpi_is_partial_then_final_hash_aggregate(spark):
    p = plan(QUERIES["hourly_kpi"](spark, SF))
    assert p.count("HashAggregate") >= 2
    read = p.split("ReadSchema: struct<")[1]
    assert "l_extendedprice" in read and "l_orderkey" not in read and "l_linenumber" not in read


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["latest_hour"](spark, SF)
    scans = [line for line in plan(df).splitlines() if "FileScan parquet" in line]
    assert scans and all("props" not in s and "value" not in s for s in scans)


def test_no_driver_collect_in_latest_batch(spark):
    # the max is a scalar subquery inside the plan, not a literal collected first
    p = plan(QUERIES["latest_batch"](spark, SF))
    assert "Subquery" in p


# these write files and read them back: what they return is a scan
WRITES = {"sink_roundtrip", "idempotent_write", "stream_hourly", "stream_dedup", "stream_gold", "bronze_stream",
          "silver_job_metrics", "incident_job_alert", "silver_backlog", "job_metrics", "snapshot_write",
          "append_by_city", "json_documents"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_udf_in_plans(spark, name):
    p = plan(QUERIES[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in p
