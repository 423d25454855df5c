"""Delay-cause classification.

Two precedence orders exist on purpose: a flight prefers Weather, NAS/ATC, Late
Aircraft, Carrier; a route prefers Weather, Late Aircraft, NAS/ATC, Carrier.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _first_largest(ranked: list[tuple[str, Column]], most: Column) -> Column:
    """Name of the first entry that reaches ``most``; NULL entries never do."""
    return F.coalesce(*[F.when(value == most, name) for name, value in ranked])


def primary_delay_cause(
    cancelled: Column | str = "cancelled",
    dep_delay_minutes: Column | str = "depdelayminutes",
    weather: Column | str = "weatherdelay",
    nas: Column | str = "nasdelay",
    late_aircraft: Column | str = "lateaircraftdelay",
    carrier: Column | str = "carrierdelay",
    security: Column | str = "securitydelay",
) -> Column:
    """Cause with the most minutes among the four main ones, earlier names winning ties.

    Cancelled flights and departures up to 15 minutes late come first; security
    counts only when the four main causes are all zero or missing.
    """
    ranked = [
        ("Weather", _col(weather)),
        ("NAS/ATC", _col(nas)),
        ("Late Aircraft", _col(late_aircraft)),
        ("Carrier", _col(carrier)),
    ]
    most = F.greatest(*[minutes for _, minutes in ranked])  # skips NULLs
    return (
        F.when(_col(cancelled) == 1, "Cancelled")
        .when(F.coalesce(_col(dep_delay_minutes), F.lit(0.0)) <= 15, "On Time")
        .when(most > 0, _first_largest(ranked, most))
        .when(_col(security) > 0, "Security")
        .otherwise("Other")
    )


def dominant_delay_cause(
    weather: Column | str = "weather_count",
    late_aircraft: Column | str = "late_aircraft_count",
    nas: Column | str = "nas_count",
    carrier: Column | str = "carrier_count",
) -> Column:
    """Most frequent cause of a route; ties go to the earlier argument."""
    ranked = [
        ("Weather", _col(weather)),
        ("Late Aircraft", _col(late_aircraft)),
        ("NAS/ATC", _col(nas)),
        ("Carrier", _col(carrier)),
    ]
    return _first_largest(ranked, F.greatest(*[count for _, count in ranked]))
