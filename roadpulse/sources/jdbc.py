"""JDBC serving-table source."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def read_serving(spark: SparkSession, table: str, url: str, properties: dict | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None) -> DataFrame:
    """Read a serving table; give a numeric ``partition_column`` to read in parallel."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_serving_or_empty(spark: SparkSession, table: str, url: str, properties: dict | None,
                          schema) -> DataFrame:
    """The serving table, or an empty frame of ``schema`` when it does not exist yet."""
    try:
        df = read_serving(spark, table, url, properties)
        df.schema  # resolves the table
        return df
    except Exception as e:  # table not created yet (first run)
        # only a message that names the table itself: a missing column or schema is an error
        text = str(e).lower().replace('"', "").replace("'", "")
        name = rf"(\w+\.)*{re.escape(table.lower().split('.')[-1])}"
        if re.search(rf"(table|relation|table/view|view) {name} (does not|doesnt) exist", text) \
                or re.search(rf"no such table:? {name}\b|table {name} not found", text):
            return spark.createDataFrame([], schema)
        raise
