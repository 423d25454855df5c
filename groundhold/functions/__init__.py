"""Column functions. All of them are compositions of built-in Spark expressions."""

from .causes import dominant_delay_cause, primary_delay_cause
from .clock import DAY_NAMES, day_name, hhmm_to_minutes, is_weekend, scheduled_hour, time_block
from .costs import airline_cost, delay_cost_columns, passenger_cost
from .labels import (
    delay_category,
    flight_category_meaning,
    flight_phase,
    is_delay_risk_weather,
    is_severe_program,
    performance_tier,
    risk_band,
    trend_status,
    weather_or_none,
    weather_severity,
)
from .measures import exact_mean, mean_positive, percent, tolerant_double
from .routes import route_id
from .sky import ceiling_ft, cloud_cover

__all__ = [
    "DAY_NAMES", "airline_cost", "ceiling_ft", "cloud_cover", "day_name", "delay_category",
    "delay_cost_columns", "dominant_delay_cause", "exact_mean", "flight_category_meaning", "flight_phase",
    "hhmm_to_minutes", "is_delay_risk_weather", "is_severe_program", "is_weekend",
    "mean_positive", "passenger_cost", "percent", "performance_tier", "primary_delay_cause",
    "risk_band", "route_id", "scheduled_hour", "time_block", "tolerant_double", "trend_status",
    "weather_or_none", "weather_severity",
]
