"""Staging: raw tables to typed, renamed, derived columns. Narrow plans, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    day_name,
    delay_category,
    flight_phase,
    hhmm_to_minutes,
    is_delay_risk_weather,
    is_severe_program,
    is_weekend,
    primary_delay_cause,
    route_id,
    weather_severity,
)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name).cast("int"), F.lit(0))


def stg_flights(raw: DataFrame) -> DataFrame:
    """Raw flights with scheduled times, renamed, cast and classified.

    Missing delays count as 0 minutes here, so staged means include them.
    """
    scheduled = raw.filter(F.col("crsdeptime").isNotNull() & F.col("crsarrtime").isNotNull())
    columns = {
        "flight_date": F.col("flightdate"),
        "airline_code": F.col("reporting_airline"),
        "airline_iata": F.col("iata_code_reporting_airline"),
        "flight_number": F.col("flight_number_reporting_airline").cast("int"),
        "origin_airport": F.col("origin"),
        "origin_city": F.col("origincityname"),
        "origin_state": F.col("originstate"),
        "dest_airport": F.col("dest"),
        "dest_city": F.col("destcityname"),
        "dest_state": F.col("deststate"),
        "route_id": route_id("origin", "dest"),
        "year": F.col("year").cast("int"),
        "quarter": F.col("quarter").cast("int"),
        "month": F.col("month").cast("int"),
        "day_of_month": F.col("dayofmonth").cast("int"),
        "day_of_week": F.col("dayofweek").cast("int"),
        "day_name": day_name("dayofweek"),
        "is_weekend": is_weekend("dayofweek"),
        "scheduled_dep_hhmm": F.col("crsdeptime").cast("int"),
        "scheduled_dep_minutes": hhmm_to_minutes("crsdeptime"),
        "scheduled_arr_hhmm": F.col("crsarrtime").cast("int"),
        "scheduled_arr_minutes": hhmm_to_minutes("crsarrtime"),
        "actual_dep_hhmm": F.col("deptime").cast("int"),
        "actual_arr_hhmm": F.col("arrtime").cast("int"),
        "dep_delay_minutes": _or_zero("depdelay"),
        "dep_delay_abs_minutes": _or_zero("depdelayminutes"),
        "is_dep_delayed_15": _flag("depdel15"),
        "arr_delay_minutes": _or_zero("arrdelay"),
        "arr_delay_abs_minutes": _or_zero("arrdelayminutes"),
        "is_arr_delayed_15": _flag("arrdel15"),
        "carrier_delay_minutes": _or_zero("carrierdelay"),
        "weather_delay_minutes": _or_zero("weatherdelay"),
        "nas_delay_minutes": _or_zero("nasdelay"),
        "security_delay_minutes": _or_zero("securitydelay"),
        "late_aircraft_delay_minutes": _or_zero("lateaircraftdelay"),
        "is_cancelled": F.col("cancelled").cast("int"),
        "cancellation_reason": F.col("cancellationcode"),
        "is_diverted": F.col("diverted").cast("int"),
        "scheduled_elapsed_minutes": _or_zero("crselapsedtime"),
        "actual_elapsed_minutes": _or_zero("actualelapsedtime"),
        "air_time_minutes": _or_zero("airtime"),
        "distance_miles": _or_zero("distance"),
        "primary_delay_cause": primary_delay_cause(),
    }
    return scheduled.select(*[column.alias(name) for name, column in columns.items()])


def stg_positions(raw: DataFrame) -> DataFrame:
    """Aircraft positions in metric and aviation units with the phase of flight."""
    located = raw.dropna(subset=["icao24", "latitude", "longitude"])
    return located.select(
        F.col("icao24").alias("aircraft_id"),
        "callsign",
        "origin_country",
        "longitude",
        "latitude",
        F.round("baro_altitude", 0).alias("barometric_altitude_m"),
        F.round("geo_altitude", 0).alias("geometric_altitude_m"),
        F.col("on_ground").alias("is_on_ground"),
        F.round("velocity", 1).alias("ground_speed_ms"),
        F.round(F.col("velocity") * 1.944, 1).alias("ground_speed_knots"),
        F.round("true_track", 1).alias("heading_degrees"),
        F.round("vertical_rate", 1).alias("vertical_rate_ms"),
        "snapshot_time",
        "polled_at",
        F.round(F.col("baro_altitude") * 3.281, 0).alias("altitude_ft"),
        flight_phase("on_ground", "vertical_rate").alias("flight_phase"),
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    """Weather observations with Fahrenheit, a delay-risk flag and a severity tier."""
    risk = is_delay_risk_weather(
        "flight_category", "visibility_miles", "ceiling_ft", "wind_gust_kt", "weather_string"
    )
    severity = weather_severity("flight_category", "wind_gust_kt", "weather_string")
    return raw.filter(F.col("station_id").isNotNull()).select(
        "station_id",
        F.col("iata_code").alias("airport_code"),
        "observation_time",
        "raw_metar",
        "wind_direction_deg",
        F.col("wind_speed_kt").alias("wind_speed_knots"),
        F.col("wind_gust_kt").alias("wind_gust_knots"),
        "visibility_miles",
        "temperature_c",
        "dewpoint_c",
        F.round(F.col("temperature_c") * 9.0 / 5.0 + 32, 1).alias("temperature_f"),
        "altimeter_inhg",
        "cloud_cover",
        F.col("ceiling_ft").alias("ceiling_feet"),
        "weather_string",
        "flight_category",
        risk.alias("is_delay_risk_weather"),
        severity.alias("weather_severity"),
        "polled_at",
    )


def stg_airspace(raw: DataFrame) -> DataFrame:
    """Airspace status with its category and whether it is a severe program."""
    return raw.filter(F.col("airport_code").isNotNull()).select(
        "*",
        delay_category("delay_type").alias("delay_category"),
        is_severe_program("delay_type").alias("is_severe_program"),
    )
