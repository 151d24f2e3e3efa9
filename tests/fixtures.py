"""Hand-made rows shaped like the flow and incident samples."""

from __future__ import annotations

import json
import os

from roadpulse.operators.grid import DEFAULT_SITES

BATCHES = ["20260720T191500", "20260720T193000", "20260720T193951", "20260720T194500"]
FRCS = ["FRC0", "FRC1", "FRC2", "FRC3", "FRC4"]


# Samples per city of one batch, and where the first one lies.
CITY_SAMPLES = {"berlin": (25, 52.46, 13.28), "bremen": (16, 53.03, 8.72), "frankfurt": (25, 50.05, 8.55)}


def flow_rows(batches=BATCHES):
    """66 samples per batch; speeds vary by point and batch."""
    rows = []
    for b_i, b in enumerate(batches):
        for city, (samples, lat0, lon) in CITY_SAMPLES.items():
            for p_i in range(samples):
                lat = round(lat0 + p_i / 1000, 3)
                free = 30 + (p_i % 5) * 10
                cur = free - ((p_i * 7 + b_i * 3) % 13)
                rows.append({
                    "city": city, "batch_ts": b, "lat": lat, "lon": lon,
                    "frc": FRCS[p_i % 5], "current_speed": cur, "free_flow_speed": free,
                    "travel_time": 60 + p_i, "confidence": 1.0 if p_i % 9 else 0.99,
                    "road_closure": False,
                })
    return rows


def write_jsonl(path, rows, extra_lines=()):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
        for line in extra_lines:
            f.write(line + "\n")


def write_flow_batches(root, batches=BATCHES, rows=None, extra_lines=()):
    rows = flow_rows(batches) if rows is None else rows
    for b in batches:
        for city in DEFAULT_SITES:
            part = [r for r in rows if r["batch_ts"] == b and r["city"] == city]
            if part:
                write_jsonl(os.path.join(root, f"flow_{city}_{b}.jsonl"), part)
    known = set(DEFAULT_SITES)
    other = [r for r in rows if r["batch_ts"] in batches and r["city"] not in known]
    if other:
        write_jsonl(os.path.join(root, "flow_other.jsonl"), other)
    if extra_lines:
        write_jsonl(os.path.join(root, "flow_extra.jsonl"), [], extra_lines)
    return root


def incident(city, batch, category, delay, frm, to, lat, lon, start, end=None, roads=()):
    return {"city": city, "batch_ts": batch, "incident_type": "Feature", "category": category,
            "lat": lat, "lon": lon, "delay_seconds": delay,
            "road_numbers": json.dumps(list(roads)), "from_road": frm, "to_road": to,
            "start_time": start, "end_time": end}
