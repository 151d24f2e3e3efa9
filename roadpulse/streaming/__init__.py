"""Structured Streaming forms of the micro-batch jobs."""

from .flow import (close_flow_stream, flow_kpi_stream, flow_kpis, latest_versions, run_flow_stream, run_flow_updates,
                   upsert_versions)
from .ingest import ingest_available, run_available
from .kpi import late_rows, open_windows, stream_dedup, stream_keep_one, stream_kpi, stream_means

__all__ = ["close_flow_stream", "flow_kpi_stream", "flow_kpis", "ingest_available", "latest_versions", "late_rows", "open_windows",
           "run_available", "run_flow_stream", "run_flow_updates", "upsert_versions", "stream_dedup", "stream_keep_one", "stream_kpi",
           "stream_means"]
