"""Batch-key and timestamp parsing.

All parsers are the ``try_`` variants: under ANSI mode (default in Spark 4)
a malformed key yields null, which the quality gate turns into a reject,
instead of failing the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BATCH_FORMAT
from ._cols import as_col


# Seconds of the units a bucket width may be given in.
WIDTH_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def batch_date(c, fmt: str = BATCH_FORMAT) -> Column:
    """Date of a batch key such as ``20260720T191500``."""
    return F.to_date(batch_timestamp(c, fmt))


def batch_timestamp(c, fmt: str = BATCH_FORMAT) -> Column:
    """Timestamp of a batch key (session time zone)."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def batch_timestamp_ntz(c, fmt: str = BATCH_FORMAT) -> Column:
    """Timestamp-without-zone of a batch key."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def iso_timestamp(c) -> Column:
    """ISO-8601 text (``2026-07-20T19:15:00Z``) to timestamp; null stays null."""
    return F.try_to_timestamp(as_col(c))


def batch_key(ts, width: str = "15 minutes", fmt: str = BATCH_FORMAT) -> Column:
    """Batch key text of the fixed-width time bucket holding ``ts``; null stays null."""
    n, unit = width.split()
    seconds = int(n) * WIDTH_SECONDS[unit.rstrip("s")]
    start = F.floor(F.unix_micros(as_col(ts).cast("timestamp")) / (seconds * 1_000_000)) * seconds
    return F.date_format(F.timestamp_seconds(start), fmt)


def stamp(df: DataFrame, name: str, run_ts=None) -> DataFrame:
    """Add a run stamp column.

    ``run_ts`` (a datetime or text) makes every action of one run agree on
    the value; without it the query start time is used.
    """
    value = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.withColumn(name, value)
