"""DataFrame -> DataFrame operators."""

from .alerts import alert_rows, alert_summary, worst_incidents
from .batches import complete_hours, latest_batch, latest_hour, latest_hour_of_key, max_key
from .dedup import keep_one
from .grid import (coverage_gaps, grid_coverage, sampling_grid, sites_frame,
                   validate_sites)
from .joins import semi_join
from .kpi import finish_kpis, heatmap_points, hourly_segment_kpis, segment_kpi
from .layers import flow_bronze, flow_silver, incident_gold, incident_silver
from .metrics import batch_metrics, counted, ingestion_tallies, metrics_health
from .payloads import flatten_flow, flatten_incidents
from .quality import conform, require_not_null, split_rejects, tag_rejects

__all__ = [
    "alert_rows", "alert_summary", "batch_metrics",
    "complete_hours", "conform", "counted", "coverage_gaps", "finish_kpis",
    "flatten_flow", "flatten_incidents", "flow_bronze", "flow_silver",
    "grid_coverage", "heatmap_points", "hourly_segment_kpis", "incident_gold",
    "incident_silver", "ingestion_tallies", "keep_one", "latest_batch",
    "latest_hour", "latest_hour_of_key", "max_key", "metrics_health", "require_not_null",
    "sampling_grid", "segment_kpi", "semi_join", "sites_frame", "split_rejects",
    "tag_rejects", "validate_sites", "worst_incidents",
]
