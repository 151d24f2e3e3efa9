"""Summarise the physical plan of every registered query (markdown table).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Queries that write as a side effect (sinks, streams) are listed but not planned.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadpulse.plans.catalog import QUERIES  # noqa: E402
from roadpulse.session import build_session  # noqa: E402

SIDE_EFFECTS = {"sink_roundtrip", "idempotent_write", "stream_hourly", "stream_dedup",
                "silver_job_metrics", "incident_job_alert", "stream_gold", "bronze_stream",
                "silver_backlog", "job_metrics", "snapshot_write", "append_by_city", "json_documents"}


def summary(plan: str) -> dict:
    """Counts of distinct operators (the plan text repeats reused subquery trees)."""
    # every scan's line ends with its read schema; names and types, nested ones included
    scans = [line.split("ReadSchema: struct<", 1)[1].rstrip()[:-1]
             for line in plan.splitlines() if "FileScan parquet" in line and "ReadSchema: struct<" in line]
    exchanges = set(re.findall(r"(?<!Broadcast)Exchange [^\n]*?\[plan_id=(\d+)\]", plan))
    broadcasts = set(re.findall(r"BroadcastExchange [^\n]*?\[plan_id=(\d+)\]", plan))
    subqueries = set(re.findall(r"Subquery subquery#(\d+)", plan))
    return {
        "exchanges": len(exchanges),
        "broadcast": len(broadcasts),
        "joins": ", ".join(sorted({j for j in ("BroadcastHashJoin", "SortMergeJoin",
                                               "ShuffledHashJoin", "BroadcastNestedLoopJoin")
                                   if j in plan})) or "-",
        "partial_top1": "yes" if plan.count("WindowGroupLimit") >= 2 else "-",
        "hash_agg": "yes" if "HashAggregate" in plan else "-",
        "subqueries": len(subqueries),
        "python": "yes" if re.search(r"EvalPython|InPandas", plan) else "no",
        "scan_columns": "; ".join(sorted({s for s in scans if s})),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.sql.maxMetadataStringLength": "2000", "spark.sql.debug.maxToStringFields": "200"})
    print(f"# Physical plans ({sf}, local[8])\n")
    print("Generated by `tools/plan_report.py`. Exchanges count shuffles (incl. the "
          "round-robin spread of single-split inputs) by distinct plan id, including those "
          "inside scalar subqueries; partial_top1 = WindowGroupLimit before and after the "
          "shuffle; subqueries = distinct scalar subqueries (reused ones counted once); "
          "python = any Python evaluation in the plan.\n")
    print("| query | exchanges | broadcasts | joins | partial_top1 | hash aggs | subqueries "
          "| python | scan columns |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SIDE_EFFECTS:
            print(f"| {name} | (writes; not planned here) | | | | | | | |")
            continue
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()   # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        print(f"| {name} | {s['exchanges']} | {s['broadcast']} | {s['joins']} | "
              f"{s['partial_top1']} | {s['hash_agg']} | {s['subqueries']} | {s['python']} | "
              f"{s['scan_columns']} |")


if __name__ == "__main__":
    main()
