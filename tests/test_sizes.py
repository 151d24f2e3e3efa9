"""What a task, a shuffle and a file hold does not grow faster than the input, and results stay as they were."""

import os

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import kpi, layers
from roadpulse.operators.kpi_state import kpi_state
from roadpulse.operators.layers import (CELL, ROAD, deal_roads, deal_silver, dedup_silver, flow_bronze, flow_silver,
                                        silver_features)
from roadpulse.plans import catalog, flow
from roadpulse.schemas import FLOW_BRONZE, FLOW_SILVER
from roadpulse.session import even, scratch_path
from roadpulse.sinks.files import write_batch, write_raw
from roadpulse.functions import stable_key
from roadpulse.streaming import (close_flow_stream, flow_kpis, latest_versions, open_windows, run_available, run_flow_stream,
                                 run_flow_updates)

RUN = "2026-07-20 20:00:00"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_tables(spark):
    """No table counts as small, as when statistics overrate it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def samples(spark, n, copies=2):
    k = F.col("id")
    return spark.range(n * copies).select(
        F.when(F.pmod(k, F.lit(5)) != 0, F.lit("a")).alias("city"), F.concat(F.lit("20260720T19"), F.pmod(F.floor(k / n), F.lit(1)).cast("string"), F.lit("000")).alias("batch_ts"),
        (F.pmod(k, F.lit(n)) / 4.0).alias("lat"), F.lit(1.0).alias("lon"), F.when(k % 3 != 0, F.lit("FRC1")).alias("frc"),
        (k % 50).cast("int").alias("current_speed"), F.lit(40).alias("free_flow_speed"), F.lit(10).alias("travel_time"),
        F.lit(0.5).alias("confidence"), F.lit(False).alias("road_closure"))


def test_even_makes_more_tasks_of_more_rows(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        largest = [even(spark.range(0, n, 1, n // 5_000).withColumn("v", F.sha2(F.col("id").cast("string"), 256)))
                   .groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] for n in (40_000, 320_000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert largest[1] < 4 * largest[0]  # of eight times the rows


def test_silver_is_dealt_once_and_keeps_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(layers, "CELL_ROWS", 50)
    bronze = samples(spark, 300).withColumns({"ingested_at": F.lit(RUN).cast("timestamp"),
                                              "date": F.to_date(F.lit("2026-07-20"))})
    ok = F.col("reject_reason").isNull()
    dealt = dedup_silver(silver_features(deal_silver(bronze, 600, 600), RUN).filter(ok), within=(CELL,)).drop(CELL)
    assert plan(dealt).count("Exchange hashpartitioning") == 1
    plain = dedup_silver(silver_features(bronze, RUN).filter(ok)).select(*dealt.columns)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert deal_silver(bronze, 600, 600).select(CELL).distinct().count() == 12


def test_silver_job_sorts_rows_of_one_shuffle(spark, workdir, monkeypatch):
    monkeypatch.setattr(layers, "CELL_ROWS", 50)
    write_raw(samples(spark, 300).where("city is not null"), f"{workdir}/raw", compression="gzip")
    flow.run_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", run_ts=RUN)
    seen = []
    monkeypatch.setattr(flow, "write_batch", lambda df, path, **how: (
        seen.append((path, df, how)), write_batch(df, path, **how))[1])
    res = flow.run_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", run_ts=RUN)
    df, how = next((d, h) for p, d, h in seen if p.endswith("/silver"))
    assert how["files_per_partition"] == 0 and plan(df).count("Exchange hashpartitioning") == 1
    keys = [tuple(r) for r in res.output.select("city", "batch_ts", "road_id").collect()]
    raw = samples(spark, 300).where("city is not null")
    assert len(keys) == len(set(keys)) == raw.select("lat", F.coalesce("frc", F.lit(""))).distinct().count()
    assert sorted(res.output.columns) == sorted(FLOW_SILVER.fieldNames())


def test_silver_stamps_a_run_once(spark, workdir):
    rows = samples(spark, 20).where("city is not null").withColumn(
        "current_speed", F.when(F.col("lat") != 1.0, F.col("current_speed")))
    write_raw(rows, f"{workdir}/raw")
    flow.run_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze")
    res = flow.run_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", reject_path=f"{workdir}/bad")
    assert res.rejected.count() > 0
    stamps = res.output.select("processed_at").union(res.rejected.select("processed_at")).distinct()
    assert stamps.count() == 1


def test_raw_and_layer_rows_are_not_shuffled_to_meet_their_batches(spark, workdir, no_small_tables):
    write_raw(samples(spark, 20).where("city is not null"), f"{workdir}/raw")
    load = flow.next_load(spark, f"{workdir}/raw", f"{workdir}/bronze", flow.read_flow_raw)
    assert "BroadcastHashJoin" in plan(load.rows) and "SortMergeJoin" not in plan(load.rows)
    flow.run_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", run_ts=RUN)
    batches = spark.createDataFrame([("a", "20260720T190000", 1)], "city string, batch_ts string, version long")
    rows = flow.current_rows(spark, f"{workdir}/bronze", FLOW_BRONZE, batches)
    assert "SortMergeJoin" not in plan(rows) and rows.count() > 0


def test_open_windows_leaves_rows_where_they_are(spark, no_small_tables):
    rows = spark.createDataFrame([(f"2026-07-20 1{h}:05:00",) for h in (7, 8, 9)], "t string") \
        .select(F.col("t").cast("timestamp").alias("t"))
    emitted = rows.limit(1).select(F.date_trunc("hour", "t").alias("window_start"))
    rest = open_windows(rows, emitted, "t")
    assert "SortMergeJoin" not in plan(rest) and "BroadcastHashJoin" in plan(rest)
    assert sorted(r.t.hour for r in rest.collect()) == [18, 19]


def lineitem(spark, n, path):
    spark.range(n).select(
        F.lit("A").alias("l_returnflag"), F.lit("2026-07-20").cast("timestamp").alias("l_shipdate"),
        (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 4).alias("l_suppkey"), F.lit("O").alias("l_linestatus"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.lit(1).alias("l_linenumber"), F.lit(900.0).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.0).alias("l_tax")).write.parquet(f"{path}/lineitem.parquet")


def test_gold_is_worked_behind_one_shuffle_of_samples(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "CELL_ROWS", 50)
    raw = samples(spark, 90).unionByName(samples(spark, 90, copies=1).withColumn(
        "batch_ts", F.lit("20260720T191500"))).where("city is not null").withColumn("lat", F.when(F.col("lat") != 3.0, F.col("lat")))
    bronze = flow_bronze(raw, RUN).where("reject_reason is null").drop("reject_reason")
    silver = flow_silver(deal_roads(bronze, 270), RUN, within=(ROAD,))
    dealt = kpi.hourly_segment_kpis(silver, (ROAD, "city", "road_id", "frc"))
    plain = kpi.hourly_segment_kpis(flow_silver(bronze, RUN))
    assert dealt.columns == plain.columns
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert deal_roads(bronze, 270).rdd.getNumPartitions() == 6
    lineitem(spark, 200, tmp_path)
    gold = catalog.q_flow_gold(spark, str(tmp_path))
    assert plan(gold).count("Exchange") == 1 and gold.agg(F.sum("road_segments")).first()[0] == 40


def test_backlog_of_gold_is_worked_behind_one_shuffle_of_samples(spark, workdir, monkeypatch):
    monkeypatch.setattr(layers, "CELL_ROWS", 50)
    write_raw(samples(spark, 200).where("city is not null"), f"{workdir}/raw")
    flow.run_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", run_ts=RUN)
    silver = flow.run_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", run_ts=RUN).output
    seen = []
    monkeypatch.setattr(flow, "write_batch", lambda df, path, **how: (
        seen.append((path, plan(df), how)), write_batch(df, path, **how))[1])
    gold = flow.run_gold_backlog(spark, f"{workdir}/silver", f"{workdir}/gold", run_ts=RUN, min_batches=1).output
    p, how = next((p, h) for at, p, h in seen if at.endswith("/gold"))
    first = p[p.index("Exchange"):].splitlines()[0]  # nothing is shuffled above the samples
    assert how["files_per_partition"] == 0 and "REPARTITION_BY_NUM" in first and CELL not in gold.columns
    want = kpi.hourly_segment_kpis(silver)
    assert sorted(map(str, gold.select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 100


def test_state_is_built_behind_one_shuffle_of_samples(spark):
    rows = samples(spark, 50).withColumns({"road_id": F.col("lat").cast("string"), "speed_ratio": F.lit(0.5)})
    p = plan(kpi_state(rows))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.rindex("HashAggregate") < p.index("Exchange hashpartitioning")  # no wide states are shuffled


def test_streams_carry_the_text_of_a_road_and_name_it_in_their_figures(spark, workdir):
    rows = samples(spark, 30).where("city is not null")
    rows.write.json(f"{workdir}/raw")
    roads = sorted(r[0] for r in rows.select(stable_key("city", "lat", "lon", "frc").alias("k")).distinct().collect())
    run_flow_stream(spark, f"{workdir}/raw", f"{workdir}/gold", f"{workdir}/ck")
    gold = close_flow_stream(spark, f"{workdir}/raw", f"{workdir}/gold")
    run_flow_updates(spark, f"{workdir}/raw", f"{workdir}/samples", f"{workdir}/ck2", watermark="3000 days")
    kpis = flow_kpis(spark, f"{workdir}/samples")
    assert "road_id" not in spark.read.parquet(f"{workdir}/samples").columns
    assert plan(kpis).count("Exchange hashpartitioning") == 1
    for out in (gold, kpis):
        assert out.columns[:5] == ["window_start", "window_end", "city", "road_id", "frc"]
        assert sorted(r.road_id for r in out.collect()) == roads
    assert sorted(map(str, gold.select(*kpis.columns).collect())) == sorted(map(str, kpis.collect()))
    assert latest_versions(spark, f"{workdir}/samples").count() == len(roads)


def test_update_mode_keeps_its_state_on_disk_and_restores_the_settings(spark, workdir):
    names = [f"spark.sql.streaming.stateStore.{k}" for k in ("providerClass", "rocksdb.boundedMemoryUsage", "compression.codec")]
    before = [spark.conf.get(n, None) for n in names]
    samples(spark, 10).where("city is not null").write.json(f"{workdir}/raw")
    run_flow_updates(spark, f"{workdir}/raw", f"{workdir}/samples", f"{workdir}/ck", watermark="3000 days")
    offsets = spark.read.text(f"{workdir}/ck/offsets").collect()
    assert any("RocksDBStateStoreProvider" in r.value for r in offsets)
    assert [spark.conf.get(n, None) for n in names] == before


def test_stream_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "STREAM_FILE_ROWS", 1_000)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    spark.range(6_500).select(
        F.lit("A").alias("l_returnflag"), F.lit("2026-07-20").cast("timestamp").alias("l_shipdate"),
        F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit("O").alias("l_linestatus"),
        F.lit(5.0).alias("l_quantity"), F.lit(1).alias("l_linenumber"), F.lit(900.0).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.0).alias("l_tax")).write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    out = catalog.q_bronze_stream(spark, f"{tmp_path}/sf")
    files = [f for f in os.listdir(f"{tmp_path}/bronze_stream/raw") if f.startswith("part-")]
    assert len(files) == 7 and out.count() == 6_500


def test_stream_packs_its_files_and_restores_the_setting(spark, workdir):
    name = "spark.sql.streaming.stateStore.compression.codec"
    before = spark.conf.get(name)
    spark.range(100).write.parquet(f"{workdir}/in")
    stream = spark.readStream.schema("id long").parquet(f"{workdir}/in")
    out = run_available(stream, f"{workdir}/out", f"{workdir}/checkpoint")
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(out))
    assert spark.conf.get(name) == before and spark.read.parquet(out).count() == 100
