"""Parametrised questions over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import DAY_NAMES, exact_mean, flight_category_meaning, risk_band, weather_or_none
from ..operators.cascade import cascade_impact
from ..operators.ranking import top_n
from ..params import DEFAULT_COSTS, CostParameters

MAP_AIRPORTS = 26
CAUSES = ("Weather", "Carrier", "NAS/ATC", "Late Aircraft")
TREND_AIRPORTS = ("ORD", "ATL", "DFW", "JFK", "DEN")

# measure name -> aggregate and mart column; dimensions are mart columns
METRICS = {
    "total_economic_impact": (F.sum, "est_total_economic_impact"),
    "avg_delay": (exact_mean, "avg_dep_delay_min"),
    "total_departures": (F.sum, "total_departures"),
}
DIMENSIONS = ("flight_date", "airport", "day_name")


def _millions(column: str) -> Column:
    return F.round(F.col(column) / F.lit(1e6), 1)


def airport_delay_summary(econ: DataFrame, airport: str, date: str | None = None) -> DataFrame:
    """All figures of one airport and day, by default the newest day of the mart."""
    day = F.lit(date) if date is not None else econ.agg(F.max("flight_date")).scalar()
    return econ.filter((F.col("airport") == airport.upper()) & (F.col("flight_date") == day)).select(
        "airport",
        F.col("flight_date").alias("date"),
        "total_departures",
        F.col("avg_dep_delay_min").alias("avg_departure_delay_minutes"),
        F.col("pct_delayed_15").alias("pct_flights_delayed_15plus"),
        F.col("flights_delayed_15").alias("flights_delayed"),
        "pct_cancelled",
        F.col("est_total_economic_impact").alias("estimated_economic_impact_usd"),
        F.struct(
            "weather_delays", "carrier_delays", F.col("nas_delays").alias("nas_atc_delays"), "late_aircraft_delays"
        ).alias("delay_causes"),
        F.struct(
            F.col("avg_weather_delay").alias("weather"),
            F.col("avg_carrier_delay").alias("carrier"),
            F.col("avg_nas_delay").alias("nas_atc"),
            F.col("avg_late_aircraft_delay").alias("late_aircraft"),
        ).alias("avg_delay_by_cause_minutes"),
        F.struct("rolling_7day_avg_delay", "rolling_7day_pct_delayed").alias("trends"),
    )


def simulate_cascade(
    flights: DataFrame,
    airport: str,
    delay_minutes: float,
    date: str | None = None,
    costs: CostParameters = DEFAULT_COSTS,
) -> DataFrame:
    """Cascade impact of one hub and day, by default the newest day flown, with 15 destinations."""
    hub = airport.upper()
    if date is None:
        newest = flights.filter(
            F.col("crsdeptime").isNotNull() & F.col("crsarrtime").isNotNull() & (F.col("cancelled") == 0)
        ).agg(F.max("flightdate"))
        date = newest.first()[0]  # one row
    return cascade_impact(
        flights, [delay_minutes], hubs=[hub], dates=None if date is None else [date], costs=costs, top_dest=15
    )


def vulnerability_top_n(vulnerability: DataFrame, n: int = 15) -> DataFrame:
    """Airports by vulnerability rank."""
    return top_n(vulnerability, "vulnerability_rank", n, ["airport"], descending=False)


def economic_top_n(vulnerability: DataFrame, n: int = 12) -> DataFrame:
    """Airports by total cost, with the cost in millions."""
    return top_n(vulnerability, "total_economic_impact", n, ["airport"]).withColumn(
        "cost_m", _millions("total_economic_impact")
    )


def airport_map_join(vulnerability: DataFrame, airports: DataFrame, n: int = MAP_AIRPORTS) -> DataFrame:
    """The ``n`` most vulnerable airports that have coordinates, with cost in millions and risk band.

    At most ``n`` rows meet the airport dimension, so that side is the one sent around.
    """
    ranked = top_n(vulnerability, "vulnerability_rank", n, ["airport"], descending=False)
    places = airports.select(F.col("iata_code").alias("airport"), "airport_name", "latitude", "longitude")
    return places.join(F.broadcast(ranked), "airport").select(
        "airport",
        "airport_name",
        "latitude",
        "longitude",
        F.concat("airport", F.lit(" — "), "airport_name").alias("label"),
        "cascade_vulnerability_score",
        "avg_delay_min",
        "avg_pct_delayed",
        (F.col("total_economic_impact") / F.lit(1e6)).alias("cost_m"),
        risk_band("avg_pct_delayed").alias("risk"),
    )


def costliest_routes(
    routes: DataFrame,
    n: int = 20,
    cause: str | None = None,
    min_flights: int | None = None,
    causes: Sequence[str] | None = None,
) -> DataFrame:
    """Routes by total cost, optionally of one dominant cause, a set of them, or a minimum of flights."""
    if cause:
        routes = routes.filter(F.col("dominant_delay_cause") == cause)
    if causes is not None:
        routes = routes.filter(F.col("dominant_delay_cause").isin(list(causes)))
    if min_flights is not None:
        routes = routes.filter(F.col("total_flights") >= min_flights)
    return top_n(routes, "est_total_economic_impact", n, ["route_id", "airline_iata"])


def latest_weather(weather: DataFrame, station: str | None = None) -> DataFrame:
    """Newest observation per station, or of one airport given by IATA or ICAO code.

    Takes the largest (poll, observation, ...) row per station; partial maxima are
    formed before the shuffle, so a station that reports very often costs no more
    to combine than others.
    """
    rest = [c for c in weather.columns if c not in ("polled_at", "observation_time", "station_id")]
    if station is not None:
        iata = station.upper()
        icao = f"K{iata}" if len(iata) == 3 else iata
        weather = weather.filter((F.col("iata_code") == iata) | (F.col("station_id") == icao))
    by = [] if station is not None else ["station_id"]
    row = F.struct("polled_at", "observation_time", "station_id", *rest)
    newest = weather.groupBy(*by).agg(F.max(row).alias("row")).filter(F.col("row").isNotNull())
    return newest.select("row.*").withColumns(
        {
            "weather": weather_or_none("weather_string"),
            "flight_category_meaning": flight_category_meaning("flight_category"),
        }
    )


def overview_kpis(econ: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Totals and plain means over all airport days."""
    return econ.agg(
        F.sum("total_departures").alias("total_flights"),
        F.round(exact_mean("avg_dep_delay_min", null_as_zero=null_as_zero), 1).alias("avg_delay"),
        F.round(exact_mean("pct_delayed_15", null_as_zero=null_as_zero), 1).alias("pct_delayed"),
        F.round(F.sum("est_total_economic_impact"), 0).alias("total_impact"),
    )


def airport_trend(econ: DataFrame, airports: Sequence[str] = TREND_AIRPORTS, wide: bool = False) -> DataFrame:
    """Rolling mean delay of some airports: one row per date and airport, or one column per airport."""
    series = econ.filter(F.col("airport").isin(list(airports))).select(
        "flight_date", "airport", "rolling_7day_avg_delay"
    )
    if not wide:
        return series.orderBy("flight_date", "airport")
    table = series.groupBy("flight_date").pivot("airport", list(airports)).agg(F.first("rolling_7day_avg_delay"))
    return table.orderBy("flight_date")


def delay_rate_heatmap(econ: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Weekday by month: mean of the daily delay rates, Monday first."""
    day_order = F.array_position(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("day_name"))
    return (
        econ.groupBy("day_name", "month")
        .agg(F.round(exact_mean("pct_delayed_15", null_as_zero=null_as_zero), 1).alias("value"))
        .withColumn("day_order", day_order)
        .orderBy("day_order", "month")
    )


def cause_distribution(econ: DataFrame) -> DataFrame:
    """Flights per main cause and their share, over the whole mart."""
    counts = econ.agg(
        F.sum("weather_delays").alias("Weather"),
        F.sum("carrier_delays").alias("Carrier"),
        F.sum("nas_delays").alias("NAS/ATC"),
        F.sum("late_aircraft_delays").alias("Late Aircraft"),
    )
    whole = Window.partitionBy()
    share = F.col("count") * F.lit(100.0) / F.nullif(F.sum("count").over(whole), F.lit(0))
    return counts.unpivot([], list(CAUSES), "cause", "count").withColumn("share_pct", F.round(share, 1))


def daily_impact(econ: DataFrame, airport: str = "ORD") -> DataFrame:
    """Cost per day of one airport."""
    days = econ.filter(F.col("airport") == airport)
    return days.select("flight_date", "est_total_economic_impact").orderBy("flight_date")


def date_range(econ: DataFrame) -> DataFrame:
    return econ.agg(F.min("flight_date").alias("min_date"), F.max("flight_date").alias("max_date"))


def metric_query(econ: DataFrame, measures: Sequence[str], dims: Sequence[str] = ()) -> DataFrame:
    """Any registered measures by any registered dimensions."""
    unknown = [m for m in measures if m not in METRICS] + [d for d in dims if d not in DIMENSIONS]
    if unknown or not measures:
        raise ValueError(f"unknown measures or dimensions: {unknown}" if unknown else "no measures given")
    columns = []
    for name in measures:
        aggregate, column = METRICS[name]
        columns.append(aggregate(column).alias(name))
    return econ.groupBy(*dims).agg(*columns)
