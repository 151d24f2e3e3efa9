"""Late and replaced files, versions between layers, rejects of clean runs, backlogs and mergeable state."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import alerts, batches, drift, episodes, kpi, outages, quantiles
from roadpulse.operators.kpi_state import KpiTable
from roadpulse.plans import flow, incidents
from roadpulse.schemas import FLOW_RAW
from roadpulse.sources.loads import LoadLog

from fixtures import BATCHES, flow_rows, incident, write_jsonl

RUN = "2026-07-20 20:00:00"


def paths(root):
    return (os.path.join(root, p) for p in ("raw", "bronze", "silver", "gold"))


def keys(df):
    return sorted((r.city, r.batch_ts, r.lat) for r in df.collect())


# ----------------------------------------------------------------------------- files and versions

def test_a_late_file_of_a_known_batch_reaches_silver(spark, workdir):
    raw, bronze, silver, _ = paths(workdir)
    rows = [r for r in flow_rows(BATCHES[:1]) if r["city"] == "berlin"]
    write_jsonl(f"{raw}/a.jsonl", rows[:10])
    flow.run_bronze(spark, f"{raw}/*.jsonl", bronze, run_ts=RUN)
    assert flow.run_silver(spark, bronze, silver, run_ts=RUN).output.count() == 10
    write_jsonl(f"{raw}/b.jsonl", [*rows[10:], rows[0]])     # late rows, and a copy of one that is there
    b = flow.run_bronze(spark, f"{raw}/*.jsonl", bronze, run_ts=RUN)
    assert [m.records_read for m in b.metrics.collect()] == [16]
    s = flow.run_silver(spark, bronze, silver, run_ts=RUN)
    assert keys(s.output) == sorted((r["city"], r["batch_ts"], r["lat"]) for r in rows)
    assert [(m.records_read, m.records_written, m.records_dropped) for m in s.metrics.collect()] == [(26, 25, 1)]


def test_no_new_file_means_nothing_is_parsed(spark, workdir, monkeypatch):
    raw, bronze, silver, _ = paths(workdir)
    write_jsonl(f"{raw}/a.jsonl", flow_rows(BATCHES[:1]))
    flow.run_bronze(spark, raw, bronze, run_ts=RUN)
    flow.run_silver(spark, bronze, silver, run_ts=RUN)

    def fail(*a, **k):
        raise AssertionError("parsed without need")

    monkeypatch.setattr(flow, "read_flow_raw", fail)
    monkeypatch.setattr(flow, "silver_features", fail)
    assert flow.run_bronze(spark, raw, bronze, run_ts=RUN).metrics.count() == 0
    s = flow.run_silver(spark, bronze, silver, run_ts=RUN)
    assert s.metrics.count() == 0 and s.output.count() == 66


def test_only_new_files_are_opened(spark, workdir):
    """The scan of a load lists the new files alone, not those taken before."""
    raw, bronze, *_ = paths(workdir)
    for i in range(4):
        write_jsonl(f"{raw}/f{i}.jsonl", flow_rows(BATCHES[i:i + 1]))
    flow.run_bronze(spark, raw, bronze, run_ts=RUN)
    write_jsonl(f"{raw}/new.jsonl", flow_rows(BATCHES[:1])[:3])
    load = flow.next_load(spark, raw, bronze, flow.read_flow_raw)
    assert load.number == 2 and [r.path.rsplit("/", 1)[1] for r in load.files.collect()] == ["new.jsonl"]
    assert load.rows.count() == 3
    scan = load.rows.select("lat")
    scan.collect()
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan and "f0.jsonl" not in plan


def test_a_file_written_anew_replaces_its_rows(spark, workdir):
    raw, bronze, silver, _ = paths(workdir)
    rows = [r for r in flow_rows(BATCHES[:2]) if r["city"] == "bremen"]
    write_jsonl(f"{raw}/a.jsonl", rows)
    write_jsonl(f"{raw}/b.jsonl", [r for r in flow_rows(BATCHES[:1]) if r["city"] == "berlin"])
    flow.run_bronze(spark, raw, bronze, run_ts=RUN)
    flow.run_silver(spark, bronze, silver, run_ts=RUN)
    changed = [dict(r, current_speed=1) for r in rows if r["batch_ts"] == BATCHES[0]][:5]
    write_jsonl(f"{raw}/a.jsonl", changed)      # fewer rows, and the second batch is gone
    out = flow.run_bronze(spark, raw, bronze, run_ts=RUN).output
    assert out.count() == 30 and out.filter("current_speed = 1").count() == 5
    s = flow.run_silver(spark, bronze, silver, run_ts=RUN).output
    assert s.count() == 30 and s.filter("city = 'bremen' and current_speed = 1").count() == 5
    assert flow.run_silver(spark, bronze, silver, run_ts=RUN).metrics.count() == 0


def test_a_load_that_breaks_off_is_made_again(spark, workdir, monkeypatch):
    raw, bronze, silver, _ = paths(workdir)
    write_jsonl(f"{raw}/a.jsonl", flow_rows(BATCHES[:1]))
    real = LoadLog.commit

    def broken(self, *a, **k):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(LoadLog, "commit", broken)
    with pytest.raises(RuntimeError):
        flow.run_bronze(spark, raw, bronze, run_ts=RUN)
    monkeypatch.setattr(LoadLog, "commit", real)
    write_jsonl(f"{raw}/b.jsonl", flow_rows(BATCHES[1:2]))
    assert flow.run_silver(spark, bronze, silver, run_ts=RUN).output.count() == 0     # that load does not count
    assert flow.run_bronze(spark, raw, bronze, run_ts=RUN).output.count() == 132
    assert flow.run_silver(spark, bronze, silver, run_ts=RUN).output.count() == 132


def test_the_stream_and_silver_share_versions(spark, workdir):
    from roadpulse.streaming import ingest_available
    raw, bronze, silver, _ = paths(workdir)
    rows = [r for r in flow_rows(BATCHES[:1]) if r["city"] == "berlin"]
    for i, part in enumerate((rows[:5], rows[5:])):
        write_jsonl(f"{raw}/{i}.jsonl", part)
        ingest_available(spark, raw, FLOW_RAW, workdir + "/ck", flow.bronze_batch_handler(bronze)).awaitTermination()
        silver_rows = flow.run_silver(spark, bronze, silver, run_ts=RUN).output.count()
    assert silver_rows == 25


def test_incidents_come_late_too(spark, workdir):
    raw, bronze, silver, _ = paths(workdir)
    row = lambda i: incident("bremen", BATCHES[0], "8", float(i), f"R{i}", "Ring", 53.0, 8.8, "2026-07-20T18:00:00Z")
    write_jsonl(f"{raw}/a.jsonl", [row(i) for i in range(3)])
    incidents.run_bronze(spark, raw, bronze, run_ts=RUN)
    incidents.run_silver(spark, bronze, silver, run_ts=RUN)
    write_jsonl(f"{raw}/b.jsonl", [row(i) for i in range(2, 5)])
    assert incidents.run_bronze(spark, raw, bronze, run_ts=RUN).output.count() == 6
    assert incidents.run_silver(spark, bronze, silver, run_ts=RUN).output.count() == 6
    dedup = incidents.run_silver(spark, bronze, silver + "2", run_ts=RUN, dedup=True)
    assert dedup.output.count() == 5 and dedup.metrics.first().records_dropped == 1


# ----------------------------------------------------------------------------- rejects

@pytest.mark.parametrize("domain", ["flow", "incidents"])
def test_clean_runs_with_a_reject_ledger(spark, workdir, domain):
    raw, bronze, silver, _ = paths(workdir)
    job = flow if domain == "flow" else incidents
    rows = flow_rows(BATCHES[:1]) if domain == "flow" else [
        incident("bremen", BATCHES[0], "8", 1.0, "A", "B", 53.0, 8.8, "2026-07-20T18:00:00Z")]
    write_jsonl(f"{raw}/a.jsonl", rows)
    for _ in range(2):
        b = job.run_bronze(spark, raw, bronze, run_ts=RUN, reject_path=f"{workdir}/bad/b")
        s = job.run_silver(spark, bronze, silver, run_ts=RUN, reject_path=f"{workdir}/bad/s")
        assert b.rejected.count() == 0 and s.rejected.count() == 0
        assert b.written == (0 if _ else len(rows))      # observed on the write; the second run has no news
        assert s.output.count() == len(rows)
    write_jsonl(f"{raw}/b.jsonl", [dict(rows[0], lat=None)])        # then one bad row
    b = job.run_bronze(spark, raw, bronze, run_ts=RUN, run_id="2", reject_path=f"{workdir}/bad/b")
    s = job.run_silver(spark, bronze, silver, run_ts=RUN, run_id="2", reject_path=f"{workdir}/bad/s")
    assert [r.reject_reason for r in (b if domain == "flow" else s).rejected.collect()] == ["null lat"]


def test_a_reject_is_kept_once_though_its_batch_is_worked_again(spark, workdir):
    raw, bronze, silver, _ = paths(workdir)
    rows = [r for r in flow_rows(BATCHES[:1]) if r["city"] == "berlin"]
    write_jsonl(f"{raw}/a.jsonl", [dict(rows[0], current_speed=None), *rows[1:5]])
    for run, more in (("1", rows[5:7]), ("2", rows[7:9]), ("3", [])):
        flow.run_bronze(spark, raw, bronze, run_ts=RUN)
        s = flow.run_silver(spark, bronze, silver, run_ts=RUN, run_id=run, reject_path=f"{workdir}/bad")
        if more:
            write_jsonl(f"{raw}/late{run}.jsonl", more)
    assert [(r.run, r.reject_reason) for r in s.rejected.collect()] == [("1", "null current_speed")]
    assert s.output.count() == 8


# ----------------------------------------------------------------------------- gold

HOURS = ["20260720T10", "20260720T11", "20260720T12"]


def test_every_complete_hour_of_every_city_reaches_gold(spark, workdir):
    raw, bronze, silver, gold = paths(workdir)
    full = lambda h: [f"{h}{m}00" for m in ("00", "15", "30", "45")]
    of = lambda city, stamps: [r for r in flow_rows(stamps) if r["city"] == city]

    def run(name, rows, **how):
        write_jsonl(f"{raw}/{name}.jsonl", rows)
        flow.run_bronze(spark, raw, bronze, run_ts=RUN)
        flow.run_silver(spark, bronze, silver, run_ts=RUN)
        res = flow.run_gold_backlog(spark, silver, gold, run_ts=RUN, **how)
        return ({(r.city, r.hour) for r in res.output.select("city", "hour").distinct().collect()},
                {(r.city, r.batch_id) for r in res.metrics.collect()})

    # berlin lands two hours at once, bremen lags behind by one and lacks a batch of it
    got, worked = run("a", of("berlin", full(HOURS[0]) + full(HOURS[1])) + of("bremen", full(HOURS[0])[:3]))
    want = {("berlin", HOURS[0] + "0000"), ("berlin", HOURS[1] + "0000")}
    assert got == want and worked == want
    got, worked = run("b", of("bremen", full(HOURS[0])[3:]))
    assert got == want | {("bremen", HOURS[0] + "0000")} and worked == {("bremen", HOURS[0] + "0000")}
    # a late row of a complete hour has only that hour worked again; without news nothing is
    late = [dict(r, lat=1.0) for r in of("berlin", full(HOURS[0])[:1])[:1]]
    got2, worked = run("c", late)
    assert got2 == got and worked == {("berlin", HOURS[0] + "0000")}
    assert flow.run_gold_backlog(spark, silver, gold, run_ts=RUN).metrics.count() == 0
    back = spark.read.parquet(gold)
    assert back.filter("city = 'berlin'").groupBy("hour").count().count() == 2
    assert back.filter("lat is not null").count() == 0 if "lat" in back.columns else True
    assert sum(r.road_segments for r in back.filter("city = 'berlin'").collect()) == 25 * 8 + 1
    # an hour that lacks a batch is closed once its city has moved on
    got, _ = run("d", of("bremen", full(HOURS[1])[:2] + [HOURS[2] + "4500"]), close_after="30 minutes")
    assert ("bremen", HOURS[1] + "0000") in got and ("bremen", HOURS[2] + "0000") not in got


def test_low_watermarks(spark):
    rows = [("x", f"20260720T10{m}00", 1) for m in ("00", "15", "30", "45")] + [("x", "20260720T110000", 2), ("y", "bad", 1),
                                                                                  ("y", "20260720T100000", 3)]
    p = batches.hour_progress(spark.createDataFrame(rows, "city string, batch_ts string, version long"))
    marks = {r.city: (str(r.low_watermark), r.complete_hours) for r in batches.low_watermarks(p).collect()}
    assert marks == {"x": ("2026-07-20 11:00:00", 1), "y": ("2026-07-20 10:00:00", 0)}


def test_kpi_state_merges_to_the_same_figures(spark, workdir):
    rnd = random.Random(3)
    rows = [dict(r, current_speed=rnd.randint(0, 60), travel_time=rnd.choice([None, 5, 70, 10**9]))
            for r in flow_rows(BATCHES) for _ in range(3)]
    df = spark.createDataFrame(rows, FLOW_RAW).withColumn("road_id", F.col("lat").cast("string")) \
        .withColumn("speed_ratio", F.round(F.col("current_speed") / F.col("free_flow_speed"), 3))
    table = KpiTable(spark, workdir + "/kpi")
    part = F.pmod(F.xxhash64(*df.columns), F.lit(4))
    for i in range(4):
        table.add(df.filter(part == i), i)
        table.add(df.filter(part == i), i)      # a repeated delivery replaces itself
        if i in (1, 3):
            table.compact()
            table.compact()
    whole = kpi.hourly_segment_kpis(df, estimate_free_flow=True)
    for unit in (None, "day"):
        got = table.kpis(unit, estimate_free_flow=True).select(*whole.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert spark.read.parquet(workdir + "/kpi/marks").count() == 2


def test_exact_means_of_large_and_negative_values(spark):
    from roadpulse.functions.measures import exact_means
    df = spark.createDataFrame([(-1.0005,), (-1.0005,), (3e12,), (None,), (0.5,)], "x double")
    got = exact_means(df, [F.lit(1).alias("g")], {"m": (F.col("x"), 3)}).first()
    assert got.m == round((3e12 - 2.001 + 0.5) / 4, 3)
    neg = exact_means(df.filter("x < 0"), [F.lit(1).alias("g")], {"m": (F.col("x"), 3)}).first()
    assert neg.m == -1.001


# ----------------------------------------------------------------------------- coverage and outages

def test_coverage_bitmaps_of_small_and_large_grids(spark):
    big = 70_000
    sites = spark.createDataFrame([("a", 4), ("b", 9), ("n", 0), ("z", 5)], "city string, points int")
    rows = [("a", "t1", i) for i in (0, 2, 2, 7, -1)] + [("b", "t1", 8), ("b", "t2", 0), ("q", "t1", 1), ("n", "t1", 0)]
    got = spark.createDataFrame(rows, "city string, batch_ts string, point_index int")
    out = {(r.city, r.batch_ts): (r.points_expected, r.points_received, list(r.missing))
           for r in outages.coverage_bitmaps(got, sites).collect()}
    assert out == {("a", "t1"): (4, 2, [1, 3]), ("b", "t1"): (9, 1, [0, 1, 2, 3, 4, 5, 6, 7]),
                   ("b", "t2"): (9, 1, list(range(1, 9)))}
    wide = spark.createDataFrame([("a", big), ("b", 9)], "city string, points int")
    seen = spark.range(big).where("id % 1000 != 7").select(F.lit("a").alias("city"), F.lit("t").alias("batch_ts"),
                                                           F.col("id").alias("point_index"))
    r = outages.coverage_bitmaps(seen.unionByName(got.where("city = 'b'")), wide).where("city = 'a'").first()
    assert list(r.missing) == list(range(7, big, 1000)) and r.points_received == big - 70
    last = spark.createDataFrame([("a", "t", big - 1)], "city string, batch_ts string, point_index int")
    assert outages.coverage_bitmaps(last, wide).first().points_received == 1


def test_outage_intervals(spark):
    at = lambda m: f"2026-07-20 {10 + m // 60:02d}:{m % 60:02d}:00"
    rows = [("x", at(m)) for m in (0, 0, 15, 60, 75)] + [("y", at(m)) for m in (30, 45)] + [("x", None)]
    df = spark.createDataFrame(rows, "city string, t string").withColumn("batch_time", F.to_timestamp("t"))
    cities = spark.createDataFrame([("x",), ("z",)], "city string")
    got = sorted((r.city, str(r.first_missing)[11:16], str(r.last_missing)[11:16], r.n_missing)
                 for r in outages.outage_intervals(df, 900, cities=cities).collect())
    assert got == [("x", "10:30", "10:45", 2), ("y", "10:00", "10:15", 2), ("y", "11:00", "11:15", 2),
                   ("z", "10:00", "11:15", 6)]
    assert outages.outage_intervals(df.limit(0), 900, cities=cities).count() == 0


# ----------------------------------------------------------------------------- incidents over time

def brute_episodes(obs, known):
    """obs: (city, batch, road) -> band; one pass over the batches of each city."""
    out = []
    for city in {c for c, _ in known}:
        order = sorted(b for c, b in known if c == city)
        for road in {r for c, _, r in obs if c == city}:
            run = None
            for b in order:
                band = obs.get((city, b, road), "absent")
                if run and band == run[0]:
                    run[2], run[3] = b, run[3] + 1
                    continue
                if run:
                    out.append((city, road, *run, run[2] == order[-1]))
                run = None if band == "absent" else [band, b, b, 1]
            if run:
                out.append((city, road, *run, run[2] == order[-1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_episodes_in_any_order_of_deliveries(spark, seed):
    rnd = random.Random(seed)
    known = [(c, f"b{i:02d}") for c in ("x", "y") for i in range(10)]
    rnd.shuffle(known)
    names = {"identity": ("city", "road"), "attributes": ("band",)}
    schema = "city string, batch_ts string, road string, band int"
    state, done, truth = None, [], {}
    deliveries = [known[:7], known[7:12], known[12:], known[3:9]]      # the last one delivers batches again
    for d in deliveries:
        obs = {(c, b, f"r{k}"): rnd.choice([None, 1, 1, 2]) for c, b in d for k in range(3) if rnd.random() < .7}
        truth = {k: v for k, v in truth.items() if (k[0], k[1]) not in d} | obs
        rows = [(*k, v) for k, v in obs.items()] + [(*k, v) for k, v in list(obs.items())[:2]]
        df = spark.createDataFrame(rows, schema)
        delivered = spark.createDataFrame(d, "city string, batch_ts string")
        before = spark.createDataFrame(done, "city string, batch_ts string")
        state = episodes.incident_episodes(df, delivered, state, before if state is not None else None, **names)
        state = spark.createDataFrame(state.collect(), state.schema)
        done = sorted(set(done) | set(d))
        got = sorted(((r.city, r.road, r.band, r.first_batch, r.last_batch, r.n_batches, r.open)
                      for r in state.collect()), key=str)
        assert got == brute_episodes(truth, done)


def test_alerts_are_sent_once(spark):
    schema = ("city string, incident_type string, category string, delay_seconds double, from_road string, "
              "to_road string, observed_at string")
    frame = lambda rows: spark.createDataFrame([(c, "t", k, d, "f", to, "now") for c, k, d, to in rows], schema)
    state, seen = frame([]), []
    for rows in ([("x", "1", 10.0, "A"), ("x", "8", None, "B")], [("x", "1", 10.0, "A"), ("x", "8", 5.0, "B")],
                 [("x", "1", 9.0, "A"), ("x", "8", 5.0, "C"), (None, "1", 1.0, "D")], [(None, "1", 1.0, "D")], []):
        changes = alerts.alert_changes(state, frame(rows))
        seen.append(sorted((r.change, r.city, r.category, r.before_delay) for r in changes.collect()))
        new = alerts.alert_state(state, changes)
        assert sorted(((r.city, r.category, r.delay_seconds, r.to_road) for r in new.collect()), key=str) == sorted(rows, key=str)
        state = spark.createDataFrame(new.collect(), new.schema)
    assert seen == [[("opened", "x", "1", None), ("opened", "x", "8", None)], [("worsened", "x", "8", None)],
                    [("changed", "x", "8", 5.0), ("eased", "x", "1", 10.0), ("opened", None, "1", None)],
                    [("closed", "x", "1", 9.0), ("closed", "x", "8", 5.0)], [("closed", None, "1", 1.0)]]


# ----------------------------------------------------------------------------- drift and quantiles

def test_type_drift_sees_what_the_reader_nulls(spark, workdir):
    rows = flow_rows(BATCHES[:1])[:6]
    rows[0]["travel_time"] = "slow"
    rows[1]["travel_time"] = 1.5
    rows[2]["confidence"] = [1]
    rows[3]["frc"] = 7              # a number reads as text
    del rows[4]["lon"]
    rows[5]["road_closure"] = None
    write_jsonl(f"{workdir}/raw/a.jsonl", rows, extra_lines=["{oops", ""])
    lines = drift.read_lines(spark, f"{workdir}/raw")
    got = {r.field: (r.records, r.missing, r.wrong, r.seen) for r in drift.type_drift(lines, FLOW_RAW).collect()}
    bad = 2 if lines.count() == 8 else 1        # an empty line is no record of JSON
    n, tail = 6 + bad, f"not json:{bad}"
    assert got["travel_time"] == (n, 0, 2 + bad, f"decimal:1, {tail}, string:1")
    assert got["confidence"] == (n, 0, 1 + bad, f"array:1, {tail}")
    assert got["frc"] == (n, 0, bad, tail) and got["lon"] == (n, 1, bad, tail) and got["road_closure"] == (n, 1, bad, tail)
    per = drift.type_drift(lines, FLOW_RAW, group=["city"]).where("city = 'berlin' and field = 'travel_time'").first()
    assert (per.records, per.wrong) == (6, 2)
    shown = drift.schemas_seen(lines.withColumn("g", F.lit(1)), ["g"]).first().json_schema
    assert "travel_time" in shown


def test_quantiles_of_merged_histograms(spark):
    rnd = random.Random(1)
    xs = [rnd.lognormvariate(0, 3) for _ in range(3000)] + [0.0, -1.0]
    rows = [("d", f"t{i % 2}", x, f"2026-07-{1 + i % 9:02d} 00:00:00") for i, x in enumerate(xs)] + [
        ("d", "t0", None, "2026-07-01 00:00:00"), ("d", "t1", float("inf"), None), ("e", "t", 5.0, None)]
    df = spark.createDataFrame(rows, "dag_id string, task_id string, total_execution_time double, measured_at string")
    hist = quantiles.duration_histogram(df)
    assert hist.where("day = '2026-07-03'").count() > 0
    at = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {(r.dag_id, r.task_id): r for r in quantiles.quantiles(hist, at).collect()}
    for t in ("t0", "t1"):
        mine = sorted(x for i, x in enumerate(xs) if f"t{i % 2}" == t)
        r = got["d", t]
        assert r.n == len(mine)
        for name, q in at.items():
            exact = mine[max(0, -(-int(q * 10**6) * len(mine) // 10**6) - 1)]
            assert abs(r[name] - max(0.0, exact)) <= 0.01001 * abs(max(0.0, exact))
    assert abs(got["e", "t"].p50 - 5) <= 0.05
