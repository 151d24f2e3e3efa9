"""File sources (S1-S4, S11 read side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import FLOW_RAW, INCIDENT_RAW

CORRUPT_COL = "_corrupt_record"


def with_corrupt(schema: StructType, name: str = CORRUPT_COL) -> StructType:
    """The schema with a column for the text of lines that cannot be read."""
    return StructType(schema.fields + [StructField(name, StringType(), True)])


def read_json_records(spark: SparkSession, path: str, schema: StructType,
                      keep_corrupt: bool = False, corrupt_col: str = CORRUPT_COL,
                      **options) -> DataFrame:
    """JSON lines under a declared schema (PERMISSIVE).

    A wrong-typed field reads as null. With ``keep_corrupt`` a line that is
    not JSON keeps its text in ``corrupt_col`` so the gate can reject it with
    a reason instead of losing it silently.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = with_corrupt(schema, corrupt_col)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.schema(schema).json(path)


def read_flow_raw(spark: SparkSession, path: str, keep_corrupt: bool = False,
                  **options) -> DataFrame:
    """Flow samples: 10 declared fields, glob over every batch file."""
    return read_json_records(spark, path, FLOW_RAW, keep_corrupt, **options)


def read_incident_raw(spark: SparkSession, path: str, keep_corrupt: bool = False,
                      **options) -> DataFrame:
    """Incidents: 12 declared fields; a JSON integer category reads as text."""
    return read_json_records(spark, path, INCIDENT_RAW, keep_corrupt, **options)


def read_json_documents(spark: SparkSession, path: str,
                        schema: StructType | None = None) -> DataFrame:
    """Multi-line JSON documents (one object or array per file).

    Prefer passing ``schema``: inference reads every file an extra time.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that a glob names, exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def layer_or_empty(spark: SparkSession, path: str | None, schema: StructType) -> DataFrame:
    """The layer at ``path``, or an empty frame of ``schema`` where nothing was written yet."""
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_layer(spark, path, schema)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None,
               base_path: str | None = None) -> DataFrame:
    """A lake layer (Parquet) with partition discovery.

    With ``schema`` partition columns keep their declared types (``batch_ts``
    stays text instead of being inferred as a number).
    """
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
