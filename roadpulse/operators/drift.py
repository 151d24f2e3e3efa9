"""Field-level type drift: what the fields of raw records hold against the contract.

A reader with a declared schema turns a value of the wrong type into null. Here the
records are read as variants, which keep the types they came with, and every field's
type is counted per group, so that a producer's change is seen in the batch it begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructType

MISSING, NOT_JSON = "missing", "not json"

# The JSON types that a reader accepts for a declared type. Numbers are
# read into text fields as their digits.
ACCEPTED: dict[type[DataType], tuple[str, ...]] = {
    StringType: ("string", "integer", "decimal", "double"),
    IntegerType: ("integer",),
    LongType: ("integer",),
    DoubleType: ("integer", "decimal", "double"),
    BooleanType: ("boolean",),
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines of JSON files as text: value, source_file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def field_type(record: Column, field: str) -> Column:
    """The JSON type of a record's field: string, integer, decimal, double, boolean, object, array, missing.

    A field that is absent and one that is null are both missing.
    """
    name = F.schema_of_variant(F.try_variant_get(record, f"$['{field}']", "variant"))
    return (F.when(record.isNull(), NOT_JSON)
            .when(name.isNull() | (name == "VOID"), MISSING)
            .when(name == "STRING", "string").when(name == "BOOLEAN", "boolean")
            .when(name.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
            .when(name.startswith("DECIMAL"), "decimal").when(name.isin("DOUBLE", "FLOAT"), "double")
            .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object")
            .otherwise(F.lower(name)))


def type_drift(lines: DataFrame, contract: StructType, group: Sequence[str] = (), value: str = "value",
               accepted: dict[type[DataType], tuple[str, ...]] = ACCEPTED) -> DataFrame:
    """Per group and field of the contract: records, missing, wrong and the types seen.

    ``lines`` hold a JSON record each as text. ``group`` are columns of ``lines``, or
    fields of the record itself where ``lines`` has no such column. A line that is not
    JSON, or null, is wrong in every field. ``seen`` lists the types that were wrong with
    their counts, in the order of their names. Each record is parsed once and reduced in
    the map task; one small shuffle follows.
    """
    record = lines.withColumn("__record", F.try_parse_json(F.col(value)))
    keys = [F.col(g).alias(g) if g in lines.columns
            else F.try_variant_get("__record", f"$['{g}']", "string").alias(g) for g in group]
    checks = F.array(*[F.struct(F.lit(f.name).alias("field"), field_type(F.col("__record"), f.name).alias("type"),
                                F.array(*map(F.lit, accepted[type(f.dataType)])).alias("accepted"))
                       for f in contract.fields])
    seen = record.select(*keys, F.explode(checks).alias("c")).select(*group, "c.*")
    counts = seen.groupBy(*group, "field", "type", "accepted").agg(F.count(F.lit(1)).alias("n"))
    wrong = (F.col("type") != MISSING) & ~F.array_contains("accepted", F.col("type"))
    shown = F.when(wrong, F.concat_ws(":", "type", "n"))
    return counts.groupBy(*group, "field").agg(
        F.sum("n").alias("records"), F.sum(F.when(F.col("type") == MISSING, F.col("n")).otherwise(0)).alias("missing"),
        F.sum(F.when(wrong, F.col("n")).otherwise(0)).alias("wrong"),
        F.array_join(F.sort_array(F.collect_list(shown)), ", ").alias("seen"))


def schemas_seen(lines: DataFrame, group: Sequence[str], value: str = "value") -> DataFrame:
    """Per group the one schema that all its JSON records fit, for a look at a producer's change."""
    record = F.try_parse_json(F.col(value))
    return (lines.select(*group, record.alias("__record")).where("__record is not null")
            .groupBy(*group).agg(F.schema_of_variant_agg("__record").alias("json_schema")))
