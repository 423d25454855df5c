"""Dollar columns of the delay cost model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULT_COSTS, CostParameters


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def passenger_cost(
    delayed_flights: Column | str, mean_delay: Column | str, costs: CostParameters = DEFAULT_COSTS
) -> Column:
    """Unrounded cost of passenger time: flights x seats x load x minutes x rate."""
    passengers = _col(delayed_flights) * F.lit(costs.seats) * F.lit(costs.load_factor)
    return passengers * _col(mean_delay) * F.lit(costs.passenger_minute)


def airline_cost(
    delayed_flights: Column | str, mean_delay: Column | str, costs: CostParameters = DEFAULT_COSTS
) -> Column:
    """Unrounded operating cost: flights x minutes x rate."""
    return _col(delayed_flights) * _col(mean_delay) * F.lit(costs.flight_minute)


def delay_cost_columns(
    delayed_flights: Column | str,
    mean_delay: Column | str,
    costs: CostParameters = DEFAULT_COSTS,
    total_flights: Column | str | None = None,
) -> dict[str, Column]:
    """Rounded ``passenger``, ``airline`` and ``total`` cost, and ``per_flight`` when asked.

    The total rounds the sum, it does not add the rounded parts; the cost per
    flight is NULL for a group without flights.
    """
    passenger = passenger_cost(delayed_flights, mean_delay, costs)
    airline = airline_cost(delayed_flights, mean_delay, costs)
    columns = {
        "passenger": F.round(passenger, 0),
        "airline": F.round(airline, 0),
        "total": F.round(passenger + airline, 0),
    }
    if total_flights is not None:
        flights = F.nullif(_col(total_flights), F.lit(0))
        columns["per_flight"] = F.round((passenger + airline) / flights, 0)
    return columns
