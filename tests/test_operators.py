import datetime as dt

from pyspark.sql import functions as F

from roadpulse.functions import batch_timestamp
from roadpulse.operators import (alert_rows, alert_summary, batch_metrics, complete_hours,
                                 coverage_gaps, flatten_flow, flatten_incidents,
                                 hourly_segment_kpis, keep_one, latest_batch, latest_hour,
                                 metrics_health, require_not_null, split_rejects,
                                 worst_incidents)

FLOW = ("city string, batch_ts string, lat double, lon double, frc string, current_speed int, "
        "free_flow_speed int, travel_time int, confidence double, road_closure boolean")


def test_latest_batch_global_and_by_city(spark):
    df = spark.createDataFrame(
        [("a", "20260720T191500"), ("a", "20260720T194500"), ("b", "20260720T193000"),
         (None, "20260720T193000")], "city string, batch_ts string")
    assert sorted(r.city for r in latest_batch(df).collect()) == ["a"]
    got = sorted((r.city or "", r.batch_ts) for r in latest_batch(df, by=["city"]).collect())
    assert got == [("", "20260720T193000"), ("a", "20260720T194500"), ("b", "20260720T193000")]


def test_latest_batch_empty_input(spark):
    df = spark.createDataFrame([], "city string, batch_ts string")
    assert latest_batch(df).count() == 0 and latest_batch(df, by=["city"]).count() == 0


def test_latest_hour(spark):
    df = spark.createDataFrame(
        [("20260720T185900",), ("20260720T190000",), ("20260720T194500",), ("20260720T200000",)],
        "batch_ts string")
    out = latest_hour(df, batch_timestamp("batch_ts")).collect()
    assert [r.batch_ts for r in out] == ["20260720T200000"]
    out = latest_hour(df.filter("batch_ts < '20260720T2'"), batch_timestamp("batch_ts")).collect()
    assert sorted(r.batch_ts for r in out) == ["20260720T190000", "20260720T194500"]


def test_complete_hours(spark):
    rows = [("a", f"20260720T19{m:02d}00") for m in (0, 15, 30, 45)] + \
           [("b", f"20260720T19{m:02d}00") for m in (0, 15, 30)] + [("a", "20260720T194500")]
    df = spark.createDataFrame(rows, "city string, batch_ts string")
    out = complete_hours(df, batch_timestamp("batch_ts")).collect()
    assert [(r.city, r.n_batches) for r in out] == [("a", 4)]


def test_keep_one_is_deterministic(spark):
    rows = [("k", 1, "x", 3.0), ("k", 1, "a", 3.0), ("k", 2, "z", 1.0), ("j", 5, "b", None)]
    df = spark.createDataFrame(rows, "key string, v int, s string, d double")
    out = {r.key: (r.v, r.s) for r in keep_one(df, ["key"], [F.col("v").asc()]).collect()}
    assert out == {"k": (1, "a"), "j": (5, "b")}
    # reversed input order gives the same survivor
    out2 = {r.key: (r.v, r.s) for r in keep_one(df.orderBy(F.desc("s")), ["key"],
                                                 [F.col("v").asc()]).collect()}
    assert out == out2


def test_segment_kpi_golden(spark):
    # four samples of one segment; ratios .806, .806, .806, .897 -> avg .829
    rows = [("berlin", b, 52.5425, 13.425, "FRC1", c, 36, 100 + i, 1.0, i == 3)
            for i, (b, c) in enumerate([("20260720T191500", 29), ("20260720T193000", 29),
                                        ("20260720T193951", 29), ("20260720T194500", 32)])]
    from roadpulse.operators.layers import flow_silver
    df = spark.createDataFrame(rows, FLOW).withColumn("ingested_at", F.current_timestamp()) \
        .withColumn("date", F.to_date(F.lit("2026-07-20")))
    silver = flow_silver(df, run_ts="2026-07-20 20:00:00")
    g = hourly_segment_kpis(silver.filter("reject_reason is null")).collect()
    assert len(g) == 1
    r = g[0]
    assert r.current_speed == 29.75 and r.free_flow_speed == 36.0
    assert r.speed_ratio == round((0.806 * 3 + 0.889) / 4, 3)
    assert r.congested_segments == 0 and r.road_segments == 4
    assert r.congestion_percent == 0.0 and r.delay_seconds == 0.0
    assert r.road_closure is True and r.congestion_level == "moderate"
    assert r.observation_ts == dt.datetime(2026, 7, 20, 19, 45)


def test_null_ratio_counts_as_severe(spark):
    rows = [("x", "20260720T191500", 1.0, 2.0, "FRC0", 10, 0, 5, None, None)]
    df = spark.createDataFrame(rows, FLOW).withColumn("speed_ratio", F.lit(None).cast("double"))
    r = hourly_segment_kpis(df, keys=["city", "frc"]).first()
    assert r.congestion_level == "severe" and r.congested_segments == 0 and r.road_closure is False


def test_split_rejects_and_not_null(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", None)], "city string, lat double")
    ok, bad = split_rejects(df, [("null city", F.col("city").isNotNull()),
                                 ("null lat", F.col("lat").isNotNull())])
    assert [r.city for r in ok.collect()] == ["a"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["null city", "null lat"]
    assert require_not_null(df, ["city", "lat"]).count() == 1


def _incidents(spark, rows):
    return spark.createDataFrame(rows, (
        "city string, incident_type string, category string, delay_seconds double, "
        "from_road string, to_road string, observed_at timestamp, start_time timestamp, "
        "lat double, lon double"))


def test_worst_incidents(spark):
    t1, t2 = dt.datetime(2026, 7, 20, 20, 25), dt.datetime(2026, 7, 20, 20, 30)
    s = dt.datetime(2026, 7, 20, 10, 0)
    rows = [
        ("bremen", "Feature", "8", None, "B", "C", t2, s, 1.0, 1.0),
        ("bremen", "Feature", "8", None, "A", "C", t2, s, 1.0, 1.0),
        ("bremen", "Feature", "1", 30.0, "X", "Y", t2, s, 1.0, 1.0),
        ("bremen", "Feature", "1", 90.0, "Q", "R", t2, s, 1.0, 1.0),
        ("bremen", "Feature", "7", 999.0, "Q", "R", t2, s, 1.0, 1.0),
        ("berlin", "Feature", "1", 500.0, "Old", "Row", t1, s, 1.0, 1.0),
    ]
    out = worst_incidents(_incidents(spark, rows)).collect()
    assert [(r.city, r.category, r.delay_seconds, r.from_road) for r in out] == \
        [("bremen", "1", 90.0, "Q"), ("bremen", "8", None, "A")]
    text = alert_rows(worst_incidents(_incidents(spark, rows))).collect()
    assert text[0].category_name == "Accident" and text[0].delay == "90 seconds"
    assert text[1].location == "A → C" and text[1].delay == "unknown"
    assert alert_summary(worst_incidents(_incidents(spark, rows))).first().n_alerts == 2


def test_flatten_flow(spark):
    rows = [
        ("b", "1", 1.0, 2.0, '{"flowSegmentData": {"frc": "FRC2", "currentSpeed": 40, '
                             '"freeFlowSpeed": 50, "currentTravelTime": 12, "confidence": 0.98, '
                             '"roadClosure": true}}'),
        ("b", "1", 1.0, 3.0, '{"flowSegmentData": {"frc": "FRC1", "currentSpeed": 4}}'),
        ("b", "1", 1.0, 4.0, '{"flowSegmentData": {}}'),
        ("b", "1", 1.0, 5.0, '{"other": 1}'),
        ("b", "1", 1.0, 6.0, 'not json'),
    ]
    df = spark.createDataFrame(rows, "city string, batch_ts string, lat double, lon double, payload string")
    out = flatten_flow(df).orderBy("lon").collect()
    assert [r.ok for r in out] == [True, True, False, False, False]
    assert out[0].road_closure is True and out[0].confidence == 0.98 and out[0].travel_time == 12
    assert out[1].confidence == 0.0 and out[1].road_closure is False and out[1].free_flow_speed is None


def test_flatten_incidents_geometries(spark):
    payload = ('{"incidents": ['
               '{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[8.8, 53.1], [8.9, 53.2]]},'
               ' "properties": {"iconCategory": 8, "from": "Am Wall", "to": "Ring", "roadNumbers": ["A1", "E22"],'
               ' "startTime": "2026-07-20T18:00:00Z", "endTime": null}},'
               '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [8.7, 53.0]},'
               ' "properties": {"iconCategory": 1, "delay": 120.5}},'
               '{"type": "Feature", "geometry": {"type": "Point", "coordinates": []}, "properties": {}},'
               '{"type": "Feature", "properties": {"iconCategory": 6}}]}')
    df = spark.createDataFrame([("bremen", "20260720T203000", payload),
                                ("bremen", "20260720T203000", '{"incidents": []}')],
                               "city string, batch_ts string, payload string")
    out = flatten_incidents(df).collect()
    assert len(out) == 2
    a, b = out
    assert (a.lon, a.lat, a.category, a.road_numbers) == (8.8, 53.1, "8", '["A1", "E22"]')
    assert a.end_time is None and a.start_time == "2026-07-20T18:00:00Z"
    assert (b.lon, b.lat, b.category, b.delay_seconds, b.road_numbers) == (8.7, 53.0, "1", 120.5, "[]")


def test_batch_metrics_true_per_city(spark):
    rows = [("a", "1", None), ("a", "1", "null lat"), ("b", "1", None), ("b", "1", None)]
    df = spark.createDataFrame(rows, "city string, batch_ts string, reject_reason string")
    m = {r.city: r for r in batch_metrics(df, dag_id="d", task_id="t", run_ts="2026-01-01").collect()}
    assert (m["a"].records_read, m["a"].records_written, m["a"].records_dropped) == (2, 1, 1)
    assert (m["b"].records_read, m["b"].records_written, m["b"].records_dropped) == (2, 2, 0)
    assert m["a"].batch_id == "1" and m["a"].status == "success"


def test_metrics_health(spark):
    rows = [("d", "t", "success", 10, 8, 2, 1.0), ("d", "t", "success", 0, 0, 0, 3.0),
            ("d", "t", "failed", 5, 0, 5, 2.0)]
    df = spark.createDataFrame(rows, "dag_id string, task_id string, status string, records_read long, "
                                     "records_written long, records_dropped long, total_execution_time double") \
        .withColumn("measured_at", F.current_timestamp())
    h = {r.status: r for r in metrics_health(df).collect()}
    assert h["success"].runs == 2 and h["success"].drop_rate == 0.2 and h["success"].avg_total_time == 2.0
    assert h["failed"].drop_rate == 1.0


def test_coverage_gaps(spark):
    exp = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "city string, lat double")
    got = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "city string, lat double")
    out = sorted((r.city, r.lat) for r in coverage_gaps(exp, got, ["city", "lat"]).collect())
    assert out == [("a", 2.0), ("b", 1.0)]
