"""Status labels derived from one or two columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flight category texts.
FLIGHT_CATEGORIES = {
    "VFR": "Visual Flight Rules — clear skies, good visibility",
    "MVFR": "Marginal VFR — reduced visibility, some restrictions",
    "IFR": "Instrument Flight Rules — low visibility, potential delays",
    "LIFR": "Low IFR — very poor visibility, likely delays/diversions",
}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _band(value: Column, limit: float, above: str, below: str, between: str) -> Column:
    return F.when(value > limit, above).when(value < -limit, below).otherwise(between)


def trend_status(change: Column | str, threshold: float = 5) -> Column:
    """WORSENING above the threshold, IMPROVING below its negative, else STABLE (also for NULL)."""
    return _band(_col(change), threshold, "WORSENING", "IMPROVING", "STABLE")


def performance_tier(difference: Column | str, threshold: float = 3) -> Column:
    """More delay than peers is UNDERPERFORMER, less is OUTPERFORMER."""
    return _band(_col(difference), threshold, "UNDERPERFORMER", "OUTPERFORMER", "AVERAGE")


def risk_band(pct_delayed: Column | str, high: float = 22, moderate: float = 18) -> Column:
    pct = _col(pct_delayed)
    return (
        F.when(pct > high, f"High (>{high:g}%)")
        .when(pct > moderate, f"Moderate ({moderate:g}-{high:g}%)")
        .otherwise(f"Low (<{moderate:g}%)")
    )


def flight_category_meaning(category: Column | str) -> Column:
    texts = F.create_map(*[F.lit(part) for pair in FLIGHT_CATEGORIES.items() for part in pair])
    return F.coalesce(F.try_element_at(texts, _col(category)), F.lit("Unknown"))


def weather_or_none(weather: Column | str) -> Column:
    """Present weather, or a plain sentence when the field is blank."""
    return F.coalesce(F.nullif(_col(weather), F.lit("")), F.lit("No significant weather"))


def flight_phase(on_ground: Column | str, vertical_rate: Column | str) -> Column:
    """Ground, Climbing, Descending or Cruise; unknown inputs count as Cruise."""
    rate = _col(vertical_rate)
    return (
        F.when(_col(on_ground), "Ground")
        .when(rate > 2, "Climbing")
        .when(rate < -2, "Descending")
        .otherwise("Cruise")
    )


def _mentions(weather: Column, *codes: str) -> Column:
    found = F.lit(False)
    for code in codes:
        found = found | weather.contains(code)
    return found


def is_delay_risk_weather(
    category: Column | str,
    visibility: Column | str,
    ceiling: Column | str,
    gust: Column | str,
    weather: Column | str,
) -> Column:
    """Instrument conditions, poor visibility, low ceiling, gusts, storms, ice or snow."""
    risky = (
        _col(category).isin("IFR", "LIFR")
        | (_col(visibility) < 3)
        | (_col(ceiling) < 1000)
        | (_col(gust) > 35)
        | _mentions(_col(weather), "TS", "FZ", "SN")
    )
    return F.coalesce(risky, F.lit(False))


def weather_severity(category: Column | str, gust: Column | str, weather: Column | str) -> Column:
    """First match wins: the flight category, then gusts, then thunderstorms."""
    by_category = F.create_map(
        *[F.lit(part) for part in ("LIFR", "Severe", "IFR", "Moderate", "MVFR", "Marginal")]
    )
    return F.coalesce(
        F.try_element_at(by_category, _col(category)),
        F.when(_col(gust) > 35, "Moderate"),
        F.when(_mentions(_col(weather), "TS"), "Severe"),
        F.lit("Clear"),
    )


def delay_category(delay_type: Column | str) -> Column:
    kind = _col(delay_type)
    return (
        F.when(kind == "Ground Stop", "Ground Stop")
        .when(kind == "Ground Delay Program", "GDP")
        .when(kind.contains("Arrival"), "Arrival Delay")
        .when(kind.contains("Departure"), "Departure Delay")
        .when(kind == "No Active Delays", "Normal Operations")
        .otherwise("Other")
    )


def is_severe_program(delay_type: Column | str) -> Column:
    return F.coalesce(_col(delay_type).isin("Ground Stop", "Ground Delay Program"), F.lit(False))
