from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import functions as RF


def one(spark, expr, schema="x double", rows=((1.0,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def test_stable_key_golden(spark):
    df = spark.createDataFrame([("berlin", 52.46, 13.28, "FRC3")], "city string, lat double, lon double, frc string")
    key = df.select(RF.stable_key("city", "lat", "lon", "frc")).first()[0]
    assert key == "d74c9a4988a87f9531b6655a6de339d681ce4fc4d213e4677189ef6c4e97efa5"


def test_stable_key_skips_nulls_and_uses_java_double_text(spark):
    df = spark.createDataFrame([("a", None, 8.0), ("a", None, 1e-5)], "a string, b string, c double")
    keys = [r[0] for r in df.select(RF.stable_key("a", "b", "c")).collect()]
    import hashlib
    assert keys[0] == hashlib.sha256(b"a|8.0").hexdigest()
    assert keys[1] == hashlib.sha256(b"a|1.0E-5").hexdigest()


def test_safe_ratio(spark):
    df = spark.createDataFrame([(29, 36), (5, 0), (None, 10), (10, None), (2, 3)], "a int, b int")
    got = [r[0] for r in df.select(RF.safe_ratio("a", "b", 3)).collect()]
    assert got == [0.806, None, None, None, 0.667]


def test_level_bounds_and_null(spark):
    vals = [(0.9,), (0.8999,), (0.7,), (0.5,), (0.49,), (None,)]
    df = spark.createDataFrame(vals, "r double")
    assert [r[0] for r in df.select(RF.level("r")).collect()] == \
        ["free", "moderate", "moderate", "heavy", "severe", "severe"]
    assert df.select(RF.level("r", null_label="unknown")).collect()[-1][0] == "unknown"


def test_batch_key_parsing(spark):
    df = spark.createDataFrame([("20260720T191500",), ("bad",), (None,)], "b string")
    got = df.select(RF.batch_date("b").alias("d"), RF.batch_timestamp("b").alias("t")).collect()
    assert str(got[0].d) == "2026-07-20" and got[0].t.hour == 19 and got[0].t.minute == 15
    assert got[1].d is None and got[1].t is None and got[2].t is None


def test_iso_timestamp(spark):
    df = spark.createDataFrame([("2026-07-20T19:15:00Z",), (None,)], "s string")
    got = df.select(RF.iso_timestamp("s")).collect()
    assert got[0][0].hour == 19 and got[1][0] is None


def test_category_name_passthrough(spark):
    df = spark.createDataFrame([("1",), ("8",), ("14",), ("42",)], "c string")
    assert [r[0] for r in df.select(RF.category_name("c")).collect()] == \
        ["Accident", "Road Closed", "Broken Down Vehicle", "42"]


def test_location_and_delay_text(spark):
    df = spark.createDataFrame([("A", "B", 125.7), ("", None, 0.0), (None, "X", None),
                                ("Straße", "Brücke", -3.9)],
                               "f string, t string, d double")
    got = df.select(RF.location_text("f", "t"), RF.delay_text("d")).collect()
    assert got[0][0] == "A → B" and got[0][1] == "125 seconds"
    assert got[1][0] == "N/A → N/A" and got[1][1] == "unknown"
    assert got[2][0] == "N/A → X" and got[2][1] == "unknown"
    assert got[3][0] == "Straße → Brücke" and got[3][1] == "-3 seconds"


def test_json_list_text(spark):
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame([(["A1", "E22"],), ([],), (None,), (['q"x'],)], schema)
    got = [r[0] for r in df.select(RF.json_list_text("a")).collect()]
    assert got == ['["A1", "E22"]', "[]", "[]", '["q\\"x"]']


def test_stamp_is_one_value(spark):
    df = spark.range(5)
    out = RF.stamp(df, "ts", "2026-01-01 10:00:00").select("ts").distinct().collect()
    assert len(out) == 1 and out[0][0].hour == 10
