"""API payload flattening (P13, P14, P15, F9) with built-in JSON/variant functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import json_list_text

# What can be wrong with an incident payload.
BAD_JSON = "payload is not JSON"
NO_INCIDENTS = "payload has no incidents list"
NO_COORDINATES = "incident has no coordinates"

FLOW_PAYLOAD_SCHEMA = (
    "flowSegmentData struct<frc: string, currentSpeed: int, freeFlowSpeed: int, "
    "currentTravelTime: int, confidence: double, roadClosure: boolean>"
)


def flatten_flow(df: DataFrame, payload: str = "payload",
                 keep: Sequence[str] = ("city", "batch_ts", "lat", "lon"),
                 ok_col: str = "ok") -> DataFrame:
    """One flow record per payload, plus an ``ok`` flag.

    A payload without a (non-empty) ``flowSegmentData`` object is not ok:
    callers count it as failed and drop it. Missing confidence reads as 0.0
    and missing closure as false; other missing fields stay null.
    """
    seg = F.from_json(F.col(payload), FLOW_PAYLOAD_SCHEMA).getField("flowSegmentData")
    fields = ["frc", "currentSpeed", "freeFlowSpeed", "currentTravelTime",
              "confidence", "roadClosure"]
    present = None
    for f in fields:
        c = seg.getField(f).isNotNull()
        present = c if present is None else present | c
    return df.select(
        *keep,
        seg.getField("frc").alias("frc"),
        seg.getField("currentSpeed").alias("current_speed"),
        seg.getField("freeFlowSpeed").alias("free_flow_speed"),
        seg.getField("currentTravelTime").alias("travel_time"),
        F.coalesce(seg.getField("confidence"), F.lit(0.0)).alias("confidence"),
        F.coalesce(seg.getField("roadClosure"), F.lit(False)).alias("road_closure"),
        F.coalesce(seg.isNotNull() & present, F.lit(False)).alias(ok_col),
    )


def _vget(v, path: str, typ: str):
    return F.try_variant_get(v, path, typ)


def flatten_incidents(df: DataFrame, payload: str = "payload",
                      keep: Sequence[str] = ("city", "batch_ts"),
                      problem: str | None = None) -> DataFrame:
    """One row per element of ``incidents``.

    The position is the first vertex of a line geometry, or the point itself;
    coordinates come in (lon, lat) order. ``category`` keeps the code as text.
    Elements without coordinates, and payloads that are no JSON or have no
    ``incidents`` list, are left out; with ``problem`` they stay as a row whose
    column of that name says what is wrong (null on good rows), so that they can
    be counted. A payload with an empty list has no row either way.
    """
    parsed = F.try_parse_json(F.col(payload))
    found = _vget(parsed, "$.incidents", "array<variant>")
    # a payload with nothing to list keeps one row with a null element
    rows = df.select(*keep, parsed.isNull().alias("__bad"), found.isNull().alias("__none"),
                     F.explode(F.coalesce(found, F.array(F.lit(None).cast("variant")))).alias("__i"))
    i = F.col("__i")
    coords = _vget(i, "$.geometry.coordinates", "array<variant>")
    lon = F.coalesce(_vget(i, "$.geometry.coordinates[0][0]", "double"),
                     _vget(i, "$.geometry.coordinates[0]", "double"))
    lat = F.coalesce(_vget(i, "$.geometry.coordinates[0][1]", "double"),
                     _vget(i, "$.geometry.coordinates[1]", "double"))
    why = (F.when(F.col("__bad"), BAD_JSON).when(F.col("__none"), NO_INCIDENTS)
           .when(~F.coalesce(F.size(coords) > 0, F.lit(False)), NO_COORDINATES))
    if problem is None:
        rows, extra = rows.filter(why.isNull()), []
    else:
        extra = [why.alias(problem)]
    return (rows.select(
                    *keep,
                    _vget(i, "$.type", "string").alias("incident_type"),
                    _vget(i, "$.properties.iconCategory", "string").alias("category"),
                    lat.alias("lat"),
                    lon.alias("lon"),
                    _vget(i, "$.properties.delay", "double").alias("delay_seconds"),
                    json_list_text(_vget(i, "$.properties.roadNumbers", "array<string>"))
                    .alias("road_numbers"),
                    _vget(i, "$.properties.from", "string").alias("from_road"),
                    _vget(i, "$.properties.to", "string").alias("to_road"),
                    _vget(i, "$.properties.startTime", "string").alias("start_time"),
                    _vget(i, "$.properties.endTime", "string").alias("end_time"),
                    *extra,
                ))
