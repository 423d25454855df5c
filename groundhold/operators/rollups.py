"""Intermediate roll-ups of staged flights.

The raw rows are read once and reduced to *cells*: additive measures per
(day, origin, destination, airline). Spark combines them before the shuffle, so a
hub or day that holds a large share of all flights sends only its cells. Distinct
counts then run over cells; run on the raw rows they would make Spark expand every
row once per distinct column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import percent

DAY_KEYS = ["origin_airport", "flight_date", "day_name", "is_weekend", "month"]
ROUTE_KEYS = ["route_id", "origin_airport", "dest_airport", "origin_city", "dest_city", "airline_iata"]
CELL_KEYS = list(dict.fromkeys(DAY_KEYS + ROUTE_KEYS + ["is_cancelled"]))

_CAUSE_MINUTES = {
    "carrier": "carrier_delay_minutes",
    "weather": "weather_delay_minutes",
    "nas": "nas_delay_minutes",
    "late_aircraft": "late_aircraft_delay_minutes",
}
_CAUSE_LABELS = {"weather": "Weather", "carrier": "Carrier", "nas": "NAS/ATC", "late_aircraft": "Late Aircraft"}


def _measures() -> dict[str, Column]:
    sums = {
        "flights": F.count(F.lit(1)),
        "dep_minutes": F.sum("dep_delay_abs_minutes"),
        "arr_minutes": F.sum("arr_delay_abs_minutes"),
        "delayed": F.sum(F.col("is_dep_delayed_15").cast("long")),
        "cancelled": F.sum(F.col("is_cancelled").cast("long")),
        "miles": F.sum("distance_miles"),
        "air_minutes": F.sum("air_time_minutes"),
    }
    for cause, minutes in _CAUSE_MINUTES.items():
        positive = F.col(minutes) > 0
        sums[f"{cause}_minutes"] = F.sum(F.when(positive, F.col(minutes)).otherwise(0.0))
        sums[f"{cause}_flights"] = F.count(F.when(positive, 1))
        sums[f"{cause}_primary"] = F.count(F.when(F.col("primary_delay_cause") == _CAUSE_LABELS[cause], 1))
    return sums


def staged_cells(stg: DataFrame, keys: list[str] = CELL_KEYS) -> DataFrame:
    """Additive measures per combination of ``keys``."""
    return stg.groupBy(*keys).agg(*[column.alias(name) for name, column in _measures().items()])


def _totals(keys: list[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in _measures() if name not in keys]


def _mean(total: str, count: str, digits: int = 1) -> Column:
    return F.round(F.col(total) / F.nullif(F.col(count), F.lit(0)), digits)


def int_airport_daily(stg: DataFrame | None = None, cells: DataFrame | None = None) -> DataFrame:
    """Airport by day, flown flights only, from staged flights or from their cells.

    Cancelled flights are excluded first, so the cancellation columns are 0.
    """
    if cells is None:
        cells = staged_cells(
            stg.filter(F.col("is_cancelled") == 0), DAY_KEYS + ["dest_airport", "airline_iata"]
        )
    else:
        cells = cells.filter(F.col("is_cancelled") == 0)
    days = cells.groupBy(*DAY_KEYS).agg(
        *_totals(DAY_KEYS),
        F.countDistinct("dest_airport").alias("routes_served"),
        F.countDistinct("airline_iata").alias("airlines_operating"),
    )
    flights = F.col("flights")
    return days.select(
        F.col("origin_airport").alias("airport"),
        "flight_date",
        "day_name",
        "is_weekend",
        "month",
        flights.alias("total_departures"),
        _mean("dep_minutes", "flights").alias("avg_dep_delay_min"),
        _mean("arr_minutes", "flights").alias("avg_arr_delay_min"),
        F.col("delayed").alias("flights_delayed_15"),
        percent(F.col("delayed"), flights).alias("pct_delayed_15"),
        F.col("cancelled").alias("flights_cancelled"),
        percent(F.col("cancelled"), flights, 2).alias("pct_cancelled"),
        *[_mean(f"{c}_minutes", f"{c}_flights").alias(f"avg_{c}_delay") for c in _CAUSE_MINUTES],
        *[F.col(f"{c}_primary").alias(f"{c}_delays") for c in _CAUSE_LABELS],
        "routes_served",
        "airlines_operating",
    )


def int_route_performance(
    stg: DataFrame | None = None, min_flights: int = 30, cells: DataFrame | None = None
) -> DataFrame:
    """Route by airline with at least ``min_flights`` flights, cancelled ones included."""
    if cells is None:
        routes = staged_cells(stg, ROUTE_KEYS)
    else:
        routes = cells.groupBy(*ROUTE_KEYS).agg(*_totals(ROUTE_KEYS))
    flights = F.col("flights")
    return routes.filter(flights >= min_flights).select(
        *ROUTE_KEYS,
        flights.alias("total_flights"),
        _mean("dep_minutes", "flights").alias("avg_dep_delay"),
        _mean("arr_minutes", "flights").alias("avg_arr_delay"),
        F.col("delayed").alias("delayed_flights"),
        percent(F.col("delayed"), flights).alias("pct_delayed"),
        F.col("cancelled").alias("cancelled_flights"),
        percent(F.col("cancelled"), flights, 2).alias("pct_cancelled"),
        _mean("miles", "flights", 0).alias("avg_distance_miles"),
        _mean("air_minutes", "flights", 0).alias("avg_air_time_min"),
        *[F.col(f"{c}_primary").alias(f"{c}_count") for c in _CAUSE_LABELS],
    )
