"""Readers of landed files, raw-table sinks and seed tables."""

from .airspace import dedup_airspace_status, flatten_airspace, read_airspace_status, unread_airspace
from .flights import csv_headers, read_flights_csv, unfit_values
from .positions import US_BOUNDS, filter_bbox, flatten_positions, read_position_snapshots
from .seeds import read_seeds
from .sinks import append_raw, read_raw, write_json_snapshots
from .weather import flatten_weather, read_weather_snapshots

__all__ = [
    "US_BOUNDS", "append_raw", "csv_headers", "dedup_airspace_status", "filter_bbox", "flatten_positions",
    "flatten_airspace", "flatten_weather", "read_airspace_status",
    "read_flights_csv", "read_position_snapshots", "read_raw", "read_seeds", "read_weather_snapshots",
    "unfit_values", "unread_airspace", "write_json_snapshots",
]
