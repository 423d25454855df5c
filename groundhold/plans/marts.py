"""Marts over the roll-ups, and the job that writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import delay_cost_columns, dominant_delay_cause, exact_mean
from ..operators.ranking import rolling_7row_avg, vulnerability_score
from ..operators.rollups import int_airport_daily, int_route_performance, staged_cells
from ..operators.staging import stg_flights
from ..params import DEFAULT_COSTS, CostParameters


def mart_delay_economics(daily: DataFrame, costs: CostParameters = DEFAULT_COSTS) -> DataFrame:
    """Airport by day with delay costs and seven-row rolling means (26 columns)."""
    cost = delay_cost_columns("flights_delayed_15", "avg_dep_delay_min", costs)
    return daily.select(
        "airport",
        "flight_date",
        "day_name",
        "is_weekend",
        "month",
        "total_departures",
        "avg_dep_delay_min",
        "pct_delayed_15",
        "flights_delayed_15",
        "flights_cancelled",
        "pct_cancelled",
        cost["passenger"].alias("est_passenger_delay_cost"),
        cost["airline"].alias("est_airline_ops_cost"),
        cost["total"].alias("est_total_economic_impact"),
        "avg_weather_delay",
        "avg_carrier_delay",
        "avg_nas_delay",
        "avg_late_aircraft_delay",
        "weather_delays",
        "carrier_delays",
        "nas_delays",
        "late_aircraft_delays",
        "routes_served",
        "airlines_operating",
        rolling_7row_avg("avg_dep_delay_min", "airport", "flight_date").alias("rolling_7day_avg_delay"),
        rolling_7row_avg("pct_delayed_15", "airport", "flight_date").alias("rolling_7day_pct_delayed"),
    )


def mart_cascade_vulnerability(econ: DataFrame, min_departures: int = 1000) -> DataFrame:
    """Airports by their exposure to cascading delays (13 columns).

    The rank has no partition key: its input is one row per airport.
    """
    airports = (
        econ.groupBy("airport")
        .agg(
            F.count(F.lit(1)).alias("operating_days"),
            F.sum("total_departures").alias("total_departures"),
            F.round(exact_mean("avg_dep_delay_min"), 1).alias("avg_delay_min"),
            F.round(exact_mean("pct_delayed_15"), 1).alias("avg_pct_delayed"),
            F.round(exact_mean("pct_cancelled", 2), 2).alias("avg_pct_cancelled"),
            F.max("routes_served").alias("max_routes_served"),
            F.max("airlines_operating").alias("max_airlines"),
            F.round(exact_mean("avg_late_aircraft_delay"), 1).alias("avg_late_aircraft_delay"),
            F.round(F.avg("est_total_economic_impact"), 0).alias("avg_daily_economic_impact"),
            F.round(F.sum("est_total_economic_impact"), 0).alias("total_economic_impact"),
        )
        .filter(F.col("total_departures") >= min_departures)
        .withColumn(
            "score",
            vulnerability_score("avg_pct_delayed", "avg_late_aircraft_delay", "max_routes_served", "max_airlines"),
        )
    )
    rank = F.rank().over(Window.orderBy(F.col("score").desc())).cast("long")
    return airports.select(
        *[name for name in airports.columns if name != "score"],
        F.round("score", 1).alias("cascade_vulnerability_score"),
        rank.alias("vulnerability_rank"),
    )


def mart_route_economics(routes: DataFrame, costs: CostParameters = DEFAULT_COSTS) -> DataFrame:
    """Route by airline with delay costs and the dominant cause (18 columns)."""
    cost = delay_cost_columns("delayed_flights", "avg_dep_delay", costs, total_flights="total_flights")
    return routes.select(
        "route_id",
        "origin_airport",
        "dest_airport",
        "origin_city",
        "dest_city",
        "airline_iata",
        "total_flights",
        "delayed_flights",
        "pct_delayed",
        "avg_dep_delay",
        "cancelled_flights",
        "pct_cancelled",
        "avg_distance_miles",
        cost["passenger"].alias("est_passenger_cost"),
        cost["airline"].alias("est_airline_ops_cost"),
        cost["total"].alias("est_total_economic_impact"),
        cost["per_flight"].alias("est_cost_per_flight"),
        dominant_delay_cause().alias("dominant_delay_cause"),
    )


def materialize_marts(
    raw_flights: DataFrame,
    out: str,
    costs: CostParameters = DEFAULT_COSTS,
    min_flights: int = 30,
    min_departures: int = 1000,
) -> dict[str, str]:
    """Rebuild all marts as Parquet tables below ``out`` and return their paths.

    The flights are scanned once: their cells are written first and both mart
    chains read them back, which also cuts the lineage: a lost executor costs a
    re-read of cells, not of raw flights. The route mart has its costliest routes
    first in each file.
    """
    spark = raw_flights.sparkSession
    paths = {
        name: f"{out.rstrip('/')}/{name}"
        for name in ("flight_cells", "mart_delay_economics", "mart_cascade_vulnerability", "mart_route_economics")
    }

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    cells = write(staged_cells(stg_flights(raw_flights)), "flight_cells")
    econ = write(mart_delay_economics(int_airport_daily(cells=cells), costs), "mart_delay_economics")
    write(mart_cascade_vulnerability(econ, min_departures), "mart_cascade_vulnerability")
    routes = mart_route_economics(int_route_performance(cells=cells, min_flights=min_flights), costs)
    write(routes.sortWithinPartitions(F.col("est_total_economic_impact").desc()), "mart_route_economics")
    return paths
