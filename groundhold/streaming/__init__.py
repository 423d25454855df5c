"""Structured Streaming: landed snapshots to raw tables, and stateful views of them."""

from .feeds import (
    airspace_source,
    positions_source,
    read_latest_weather,
    stream_airspace,
    write_unique_airspace,
    stream_latest_weather,
    stream_positions,
    stream_weather,
    weather_source,
    write_latest_weather,
)

__all__ = [
    "airspace_source", "positions_source", "read_latest_weather", "stream_airspace",
    "write_unique_airspace", "stream_latest_weather", "stream_positions", "stream_weather",
    "weather_source", "write_latest_weather",
]
