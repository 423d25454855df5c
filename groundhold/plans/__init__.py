"""Marts, portfolio questions and serving queries composed from the operators."""

from .marts import (
    mart_cascade_vulnerability,
    mart_delay_economics,
    mart_route_economics,
    materialize_marts,
)
from .portfolio import (
    airline_scorecard,
    day_month_heatmap,
    delay_cause_by_hour,
    hub_vulnerability_ranking,
    partition_benchmark,
    rolling_delay_trend,
    route_economic_impact,
)
from .refresh import build_days, refresh_days
from .serving import (
    airport_delay_summary,
    airport_map_join,
    airport_trend,
    cause_distribution,
    costliest_routes,
    daily_impact,
    date_range,
    delay_rate_heatmap,
    economic_top_n,
    latest_weather,
    metric_query,
    overview_kpis,
    simulate_cascade,
    vulnerability_top_n,
)

__all__ = [
    "airline_scorecard", "airport_delay_summary", "airport_map_join", "airport_trend", "build_days",
    "cause_distribution", "costliest_routes", "daily_impact", "date_range", "day_month_heatmap",
    "delay_cause_by_hour", "delay_rate_heatmap", "economic_top_n", "hub_vulnerability_ranking",
    "latest_weather", "mart_cascade_vulnerability", "mart_delay_economics", "mart_route_economics",
    "materialize_marts", "metric_query", "overview_kpis", "partition_benchmark", "refresh_days",
    "rolling_delay_trend", "route_economic_impact", "simulate_cascade", "vulnerability_top_n",
]
