"""Composed jobs (flow and incident layers, alerts) and the driver-table catalog."""
