"""Batch and stream give the same answer on the same files."""

import os

from pyspark.sql import functions as F

from roadpulse.operators.layers import flow_silver
from roadpulse.schemas import FLOW_RAW
from roadpulse.streaming import (close_flow_stream, ingest_available, late_rows, open_windows, run_available,
                                 stream_dedup, stream_keep_one, stream_kpi)

from fixtures import BATCHES, flow_rows, write_flow_batches


def _stream(spark, raw):
    s = spark.readStream.schema(FLOW_RAW).json(raw)
    return s.withColumn("observation_ts", F.to_timestamp("batch_ts", "yyyyMMdd'T'HHmmss")) \
            .withColumn("speed_ratio", F.round(F.col("current_speed") / F.col("free_flow_speed"), 3))


def test_stream_kpi_equals_batch(spark, workdir):
    raw = os.path.join(workdir, "raw")
    write_flow_batches(raw, BATCHES)
    # one later batch in the next hour so the watermark passes 19:00-20:00
    write_flow_batches(raw, ["20260720T211500"])
    agg = stream_kpi(_stream(spark, raw), "observation_ts", watermark="1 hour",
                     keys=["city", "lat", "lon", "frc"])
    out = spark.read.parquet(run_available(agg, workdir + "/out", workdir + "/ck"))
    assert out.count() == 66
    batch = spark.read.schema(FLOW_RAW).json(raw).filter("batch_ts < '20260720T2'") \
        .withColumn("r", F.round(F.col("current_speed") / F.col("free_flow_speed"), 3)) \
        .groupBy("city", "lat", "lon", "frc").agg(F.round(F.avg(F.col("r").cast("decimal(10,3)")), 3).cast("double")
                                                 .alias("speed_ratio"),
                                                 F.count(F.lit(1)).alias("road_segments"))
    a = sorted((r.city, r.lat, r.lon, r.speed_ratio, r.road_segments) for r in out.collect())
    b = sorted((r.city, r.lat, r.lon, r.speed_ratio, r.road_segments) for r in batch.collect())
    assert a == b


def test_stream_dedup(spark, workdir):
    raw = os.path.join(workdir, "raw")
    write_flow_batches(raw, BATCHES[:1])
    write_flow_batches(os.path.join(raw, "copy"), BATCHES[:1])
    s = spark.readStream.schema(FLOW_RAW).option("recursiveFileLookup", True).json(raw) \
        .withColumn("observation_ts", F.to_timestamp("batch_ts", "yyyyMMdd'T'HHmmss"))
    d = stream_dedup(s, ["city", "batch_ts", "lat", "lon"], "observation_ts", "1 hour")
    out = spark.read.parquet(run_available(d, workdir + "/out", workdir + "/ck"))
    assert out.count() == 66


def test_ingest_available_processes_only_new_files(spark, workdir):
    raw, bronze = os.path.join(workdir, "raw"), os.path.join(workdir, "bronze")
    seen = []

    def handle(df, batch_id):
        seen.append(df.count())
        df.write.mode("append").parquet(bronze)

    write_flow_batches(raw, BATCHES[:1])
    ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", handle).awaitTermination()
    write_flow_batches(raw, BATCHES[1:2])
    ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", handle).awaitTermination()
    assert sum(seen) == 132 and spark.read.parquet(bronze).count() == 132


def test_late_rows_behind_watermark_are_dropped(spark, workdir):
    """A batch arriving after the watermark moved past its hour is not counted by the stream."""
    from fixtures import flow_rows, write_jsonl
    raw = os.path.join(workdir, "raw")
    ck, out = workdir + "/ck", workdir + "/out"
    first = [r for r in flow_rows(["20260720T191500", "20260720T221500"]) if r["city"] == "bremen"]
    write_jsonl(os.path.join(raw, "a.jsonl"), first)
    agg = lambda: stream_kpi(_stream(spark, raw), "observation_ts", watermark="1 hour", keys=["city"])
    run_available(agg(), out, ck)
    late = [r for r in flow_rows(["20260720T193000"]) if r["city"] == "bremen"]
    write_jsonl(os.path.join(raw, "b.jsonl"), late)          # 19:30 after watermark 21:15
    run_available(agg(), out, ck)
    emitted = spark.read.parquet(out)
    rows = {r.window_start.hour: r.road_segments for r in emitted.collect()}
    assert rows == {19: 16}      # the late 19:30 batch is dropped; 22:00 not yet final
    everything = spark.read.schema(FLOW_RAW).json(raw).withColumn(
        "observation_ts", F.to_timestamp("batch_ts", "yyyyMMdd'T'HHmmss"))
    late = late_rows(everything, emitted, "observation_ts").collect()
    assert [(r.window_start.hour, r.late) for r in late] == [(19, 16)]      # and they are told
    rest = open_windows(everything, emitted, "observation_ts")
    assert rest.count() == 16 and rest.filter("batch_ts <> '20260720T221500'").count() == 0


def test_counted_observation(spark, workdir):
    from roadpulse.operators import counted
    df, obs = counted(spark.range(10), "rows")
    df.write.mode("overwrite").parquet(workdir)
    assert obs.get["rows"] == 10


def test_incremental_flow_job_equals_batch(spark, workdir):
    """Two runs over growing input, with a duplicated file, give the batch gold."""
    from roadpulse.operators import hourly_segment_kpis
    from roadpulse.operators.layers import flow_bronze, flow_silver
    from roadpulse.streaming import run_flow_stream
    raw = os.path.join(workdir, "raw")
    gold, ck = workdir + "/gold", workdir + "/ck"
    write_flow_batches(raw, BATCHES[:2])
    run_flow_stream(spark, raw, gold, ck)
    write_flow_batches(raw, BATCHES)                      # rewrites 1-2, adds 3-4
    again = [r for r in flow_rows() if r["batch_ts"] == BATCHES[2]]
    write_flow_batches(os.path.join(raw, "dup"), BATCHES[2:3], rows=again)   # same samples twice
    write_flow_batches(raw, ["20260720T211500"])          # moves the watermark past 20:00
    run_flow_stream(spark, raw, gold, ck)
    out = spark.read.parquet(gold)
    assert out.count() == 66 and out.filter("road_segments != 4").count() == 0
    batch_rows = spark.read.schema(FLOW_RAW).json(raw + "/*.jsonl").filter("batch_ts < '20260720T2'")
    b = hourly_segment_kpis(flow_silver(flow_bronze(batch_rows).drop("reject_reason")))
    want = sorted((r.road_id, r.current_speed, r.speed_ratio, r.road_segments)
                  for r in b.collect())
    got = sorted((r.road_id, round(r.current_speed, 2), r.speed_ratio, r.road_segments)
                 for r in out.collect())
    assert got == want


def test_ingest_into_bronze_with_metrics(spark, workdir):
    from roadpulse.plans.flow import bronze_batch_handler
    raw, bronze, met = (os.path.join(workdir, p) for p in ("raw", "bronze", "metrics"))
    handler = bronze_batch_handler(bronze, met)
    write_flow_batches(raw, BATCHES[:1])
    ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", handler).awaitTermination()
    write_flow_batches(raw, BATCHES[1:2])
    ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", handler).awaitTermination()
    assert spark.read.parquet(bronze).count() == 132
    m = spark.read.parquet(met)
    assert m.count() == 6 and m.agg(F.sum("records_written")).first()[0] == 132


def test_a_batch_over_several_micro_batches_stays_whole(spark, workdir):
    """Three files of one batch, one per trigger, then a late file of it: nothing is overwritten."""
    from fixtures import flow_rows, write_jsonl
    from roadpulse.plans.flow import bronze_batch_handler
    raw, bronze, rejects = (os.path.join(workdir, p) for p in ("raw", "bronze", "rejects"))
    rows = flow_rows(BATCHES[:1])
    rows[0]["lat"] = None
    go = lambda: ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", bronze_batch_handler(
        bronze, reject_path=rejects), max_files_per_trigger=1).awaitTermination()
    for i in range(3):
        write_jsonl(os.path.join(raw, f"{i}.jsonl"), rows[i * 20:(i + 1) * 20])
    go()
    assert spark.read.parquet(bronze).count() == 59 and spark.read.parquet(rejects).count() == 1
    write_jsonl(os.path.join(raw, "late.jsonl"), rows[60:])
    go()
    assert spark.read.parquet(bronze).count() == 65 and spark.read.parquet(rejects).count() == 1


def test_stream_keep_one_is_total_ordered(spark, workdir):
    """Copies that differ: the same one wins whichever comes first."""
    from fixtures import flow_rows, write_jsonl
    keep = lambda s: stream_keep_one(s, ["city", "batch_ts"], "observation_ts", [], ["current_speed"])
    rows = [r for r in flow_rows(["20260720T191500", "20260720T221500"]) if r["city"] == "bremen"]
    seen = []
    for name, order in (("a", rows), ("b", rows[::-1])):
        raw = os.path.join(workdir, name)
        write_jsonl(os.path.join(raw, "x.jsonl"), order)
        out = run_available(keep(_stream(spark, raw)), f"{raw}-out", f"{raw}-ck")
        seen.append([tuple(r) for r in spark.read.parquet(out).select("batch_ts", "current_speed").collect()])
    assert seen[0] == seen[1] == [("20260720T191500", min(r["current_speed"] for r in rows[:16]))]


def test_closing_pass_and_rejects_of_the_flow_stream(spark, workdir):
    from roadpulse.streaming import run_flow_stream
    raw, gold, bad = (os.path.join(workdir, p) for p in ("raw", "gold", "bad"))
    write_flow_batches(raw, [*BATCHES, "20260720T211500"], extra_lines=["{not json"])
    run_flow_stream(spark, raw, gold, workdir + "/ck", reject_path=bad)
    assert [r.reject_reason for r in spark.read.parquet(bad).collect()] == ["malformed json line"]
    assert spark.read.parquet(gold).count() == 66                  # 21:00 is still open
    whole = close_flow_stream(spark, raw, gold)
    assert whole.count() == 132 and whole.agg(F.sum("road_segments")).first()[0] == 66 * 5
