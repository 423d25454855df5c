"""DataFrame operators: staging, roll-ups, windows, cascade joins and data checks."""

from .cascade import (
    ConnectionWindow,
    cascade_by_destination,
    cascade_chain,
    cascade_destination_detail,
    cascade_estimate,
    cascade_impact,
    cascade_matches,
)
from .presence import code_book, daily_presence, distinct_over
from .quality import (
    DEFAULT_EXPECTATIONS,
    Expectation,
    assert_non_negative_delay,
    detect_issues,
    health_rollup,
    load_summary,
    table_health,
    table_inventory,
)
from .ranking import distinct_dates, rolling_7row_avg, top_n
from .rollups import int_airport_daily, int_route_performance, staged_cells
from .staging import stg_airspace, stg_flights, stg_positions, stg_weather

__all__ = [
    "ConnectionWindow", "DEFAULT_EXPECTATIONS", "Expectation", "assert_non_negative_delay",
    "cascade_by_destination", "cascade_chain", "cascade_destination_detail", "cascade_estimate",
    "cascade_impact", "cascade_matches", "code_book", "daily_presence", "detect_issues", "distinct_dates",
    "distinct_over", "health_rollup",
    "int_airport_daily", "int_route_performance", "load_summary", "rolling_7row_avg",
    "staged_cells", "stg_airspace", "stg_flights", "stg_positions", "stg_weather",
    "table_health", "table_inventory", "top_n",
]
