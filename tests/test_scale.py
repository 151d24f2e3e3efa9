"""Scale guards: lazy operators, order-independent means, sizing, hot keys, shared folders."""

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import batch_key
from roadpulse.operators import conform, keep_one, latest_batch, segment_kpi
from roadpulse.session import checkpoint_root, sizing, spread


def _events(spark):
    rows = [(c, f"b{b}", i) for c in ("a", "b", "c") for b in range(4) for i in range(3)]
    return spark.createDataFrame(rows, "city string, batch_ts string, i int")


def test_latest_batch_by_group_is_lazy(spark):
    df = _events(spark)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    out = latest_batch(df, "batch_ts", by=["city"])
    assert len(jobs.getJobIdsForGroup(None)) == before          # nothing runs while it is built
    assert {r.batch_ts for r in out.collect()} == {"b3"} and out.count() == 9
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_kpis_do_not_depend_on_partitioning(spark):
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    from roadpulse.plans.catalog import _lineitem_flow
    from roadpulse.operators import hourly_segment_kpis
    rows = [sorted(map(tuple, hourly_segment_kpis(_lineitem_flow(x), observed="observed",
                                                  estimate_free_flow=True).collect()))
            for x in (li, li.repartition(7), li.repartition(5, "l_partkey"))]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 6000


def test_estimate_is_per_sample(spark):
    # each sample's own speeds count, not its rounded ratio; no estimate without a free-flow speed
    rows = [("a", 100, 1, 10, 0.1), ("a", 10, 7, 7, 1.0), ("b", 3000, 1, 3, 0.333), ("b", 50, 5, 0, None)]
    df = spark.createDataFrame(rows, "city string, travel_time int, current_speed int, free_flow_speed int, "
                                     "speed_ratio double").selectExpr("*", "1.0D as confidence", "false as road_closure")
    from roadpulse.operators import hourly_segment_kpis
    out = {r.city: r for r in hourly_segment_kpis(df, ["city"], estimate_free_flow=True,
                                                  observed=F.current_timestamp()).collect()}
    assert out["a"].est_free_flow_travel_time == 10.0 and out["a"].est_delay_seconds == 45.0
    assert out["b"].est_free_flow_travel_time == 1000.0


def test_hot_key_top1_and_kpi(spark):
    # one key holds most of the rows: results stay whole and correct
    rows = [("hot", "b1", "r", i % 7, 10, 5, 1.0, False, round((i % 7) / 10, 3))
            for i in range(3000)] + [("cold", "b1", "r", 1, 10, 5, 1.0, True, 0.1)]
    df = spark.createDataFrame(rows, "city string, batch_ts string, road_id string, "
                                     "current_speed int, free_flow_speed int, travel_time int, "
                                     "confidence double, road_closure boolean, speed_ratio double")
    top = {r.city: r.current_speed for r in
           keep_one(df, ["city"], [F.col("current_speed").desc()], []).collect()}
    assert top == {"hot": 6, "cold": 1}
    k = {r.city: r for r in segment_kpi(df, keys=["city"], observed=F.current_timestamp())
         .collect()}
    assert k["hot"].road_segments == 3000 and k["cold"].road_closure == 1


def test_spread_deals_rows_over_the_cores(spark):
    out = spread(spark.range(0, 1000, numPartitions=1))
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert out.count() == 1000


def test_conform_rejects_what_does_not_fit(spark):
    from pyspark.sql import types as T
    contract = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([("1", "ok"), ("x", "ok"), (None, "too long")], "n string, t string")
    got = [tuple(r) for r in conform(df, contract, {"t": 3}).collect()]
    assert got == [(1, "ok", None), (None, "ok", "n is not int"), (None, "too long", "t longer than 3")]


def test_batch_key_keeps_null_times(spark):
    df = spark.createDataFrame([("2026-07-20 19:17:03",), (None,)], "t string").withColumn("t", F.to_timestamp("t"))
    assert [r.k for r in df.select(batch_key("t").alias("k")).collect()] == ["20260720T191500", None]


def test_checkpoint_folder_is_required_off_local_masters():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_sizing():
    conf = sizing(100 * 1024 ** 4, total_cores=8000)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(conf["spark.sql.shuffle.partitions"]) == 20_000
    assert int(sizing(100 * 1024 ** 4, 8000, shuffle_bytes=1 << 40)["spark.sql.shuffle.partitions"]) == 16_000
    small = sizing(10 << 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
