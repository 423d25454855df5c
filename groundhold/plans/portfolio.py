"""The portfolio questions, asked of raw flights.

Unlike the staged marts these average only the delays that were reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    day_name,
    exact_mean,
    mean_positive,
    percent,
    performance_tier,
    route_id,
    scheduled_hour,
    time_block,
    trend_status,
)
from ..operators.ranking import rolling_7row_avg, vulnerability_score
from ..params import DEFAULT_COSTS, CostParameters

AIRLINE = "iata_code_reporting_airline"

# The hubs of the trend report.
TREND_HUBS = ("ORD", "ATL", "JFK", "DFW", "LAX", "DEN", "EWR")
# Month number and column prefix of the seasonal heatmap.
SEASON_MONTHS = {9: "sep", 10: "oct", 11: "nov"}


def _delayed() -> Column:
    return F.count(F.when(F.col("depdel15") == 1, 1))


def _flights() -> Column:
    return F.count(F.lit(1))


def hub_vulnerability_ranking(
    raw: DataFrame, since: str = "2025-09-01", min_departures: int = 1000, n: int = 20
) -> DataFrame:
    """Hubs by vulnerability score with their rank and delay quintile.

    Rank and quintile see every qualifying airport; only then is the list cut.
    Ties go by airport code.
    """
    cells = (
        raw.filter(F.col("flightdate") >= since)
        .groupBy("origin", "dest", AIRLINE)
        .agg(
            _flights().alias("flights"),
            F.sum("depdelayminutes").alias("minutes"),
            F.count("depdelayminutes").alias("timed"),
            _delayed().alias("delayed"),
            F.sum(F.when(F.col("lateaircraftdelay") > 0, F.col("lateaircraftdelay"))).alias("late_minutes"),
            F.count(F.when(F.col("lateaircraftdelay") > 0, 1)).alias("late_flights"),
        )
    )

    def mean(total, count):
        return F.round(F.sum(total) / F.nullif(F.sum(count), F.lit(0)), 1)

    hubs = (
        cells.groupBy(F.col("origin").alias("airport"))
        .agg(
            F.sum("flights").alias("total_departures"),
            mean("minutes", "timed").alias("avg_dep_delay"),
            percent(F.sum("delayed"), F.sum("flights")).alias("pct_delayed_15plus"),
            F.countDistinct("dest").alias("route_count"),
            F.countDistinct(AIRLINE).alias("airline_count"),
            mean("late_minutes", "late_flights").alias("avg_late_aircraft_delay"),
        )
        .filter(F.col("total_departures") >= min_departures)
    )
    score = vulnerability_score("pct_delayed_15plus", "avg_late_aircraft_delay", "route_count", "airline_count")
    by_score = Window.orderBy(F.col("score").desc())
    by_rate = Window.orderBy(F.col("pct_delayed_15plus").desc(), F.col("airport"))
    return (
        hubs.withColumn("score", score)
        .withColumn("cascade_vulnerability_score", F.round("score", 1))
        .withColumn("vulnerability_rank", F.rank().over(by_score).cast("long"))
        .withColumn("delay_quintile", F.ntile(5).over(by_rate).cast("long"))
        .drop("score")
        .orderBy(F.col("cascade_vulnerability_score").desc(), "airport")
        .limit(n)
    )


def rolling_delay_trend(
    raw: DataFrame,
    airports: Sequence[str] = TREND_HUBS,
    start: str = "2025-10-01",
    end: str = "2025-10-31",
    cut: str = "2025-10-08",
    threshold: float = 5,
) -> DataFrame:
    """Daily rolling means per hub with the change against seven rows earlier.

    The rolling means see all days from ``start``; rows before ``cut`` are dropped
    before the comparison, so the first seven rows of a hub have no change.
    """
    daily = (
        raw.filter(F.col("origin").isin(list(airports)) & F.col("flightdate").between(start, end))
        .groupBy(F.col("origin").alias("airport"), "flightdate")
        .agg(
            _flights().alias("flights"),
            F.round(F.avg("depdelayminutes"), 1).alias("daily_avg_delay"),
            _delayed().alias("delayed"),
        )
    )
    share = F.col("delayed") * F.lit(100.0) / F.col("flights")
    week_ago = F.lag("rolling_7day_avg_delay", 7).over(Window.partitionBy("airport").orderBy("flightdate"))
    return (
        daily.select(
            "airport",
            "flightdate",
            "daily_avg_delay",
            rolling_7row_avg("daily_avg_delay", "airport", "flightdate").alias("rolling_7day_avg_delay"),
            rolling_7row_avg(share, "airport", "flightdate", scale=None).alias("rolling_7day_pct_delayed"),
        )
        .filter(F.col("flightdate") >= cut)
        .withColumn("change", F.col("rolling_7day_avg_delay") - week_ago)
        .withColumn("wow_delay_change", F.round("change", 1))
        .withColumn("trend_status", trend_status("change", threshold))
        .drop("change")
        .orderBy("airport", "flightdate")
    )


def delay_cause_by_hour(raw: DataFrame, min_hhmm: int = 500, hours: tuple[int, int] = (5, 23)) -> DataFrame:
    """Delay causes by scheduled departure hour.

    Shares divide flights with the cause by departures 15 minutes late or more, so
    they can pass 100 and are NULL for an hour without such departures.
    """
    causes = {
        "carrier": ("carrierdelay", "avg_carrier_delay", "pct_carrier_caused"),
        "weather": ("weatherdelay", "avg_weather_delay", "pct_weather_caused"),
        "nas": ("nasdelay", "avg_nas_delay", "pct_nas_caused"),
        "late_aircraft": ("lateaircraftdelay", "avg_late_aircraft", "pct_late_aircraft_caused"),
    }
    hour = F.col("dep_hour")
    return (
        raw.filter(F.col("crsdeptime") >= min_hhmm)
        .withColumn("dep_hour", scheduled_hour("crsdeptime"))
        .filter(hour.between(*hours))
        .groupBy("dep_hour")
        .agg(
            _flights().alias("total_flights"),
            _delayed().alias("delayed_flights"),
            *[F.round(mean_positive(minutes), 1).alias(mean) for minutes, mean, _ in causes.values()],
            *[
                percent(F.count(F.when(F.col(minutes) > 0, 1)), _delayed()).alias(share)
                for minutes, _, share in causes.values()
            ],
        )
        .withColumn("time_block", time_block("dep_hour"))
        .withColumn("pct_delayed", percent(F.col("delayed_flights"), F.col("total_flights")))
        .orderBy("dep_hour")
    )


def partition_benchmark(perf: DataFrame) -> DataFrame:
    """Adds the mean of all airlines on the same route, and how many there are."""
    route = Window.partitionBy("origin", "dest")
    return perf.withColumns(
        {
            "route_avg_delay": F.round(exact_mean("avg_delay", over=route), 1),
            "route_avg_pct_delayed": F.round(exact_mean("pct_delayed", over=route), 1),
            "airlines_on_route": F.count(F.lit(1)).over(route),
        }
    )


def airline_route_performance(raw: DataFrame, min_flights: int = 50) -> DataFrame:
    """Airline by route with at least ``min_flights`` flights."""
    return (
        raw.groupBy(F.col(AIRLINE).alias("airline"), "origin", "dest")
        .agg(
            _flights().alias("flights"),
            F.round(F.avg("depdelayminutes"), 1).alias("avg_delay"),
            percent(_delayed(), _flights()).alias("pct_delayed"),
            percent(F.sum("cancelled"), _flights(), 2).alias("pct_cancelled"),
        )
        .filter(F.col("flights") >= min_flights)
    )


def airline_scorecard(
    raw: DataFrame, min_flights: int = 50, min_airlines: int = 2, min_routes: int = 10, threshold: float = 3
) -> DataFrame:
    """Airlines against their peers on the routes they share."""
    compared = partition_benchmark(airline_route_performance(raw, min_flights)).filter(
        F.col("airlines_on_route") >= min_airlines
    )
    below = F.count(F.when(F.col("avg_delay") < F.col("route_avg_delay"), 1))
    position = F.percent_rank().over(Window.orderBy("avg_delay_vs_benchmark"))
    return (
        compared.groupBy("airline")
        .agg(
            _flights().alias("routes_served"),
            F.round(exact_mean("avg_delay"), 1).alias("overall_avg_delay"),
            F.round(exact_mean("pct_delayed"), 1).alias("overall_pct_delayed"),
            F.round(exact_mean("pct_cancelled", 2), 2).alias("overall_pct_cancelled"),
            percent(below, _flights()).alias("pct_routes_below_avg_delay"),
            F.round(exact_mean(F.col("avg_delay") - F.col("route_avg_delay")), 1).alias("avg_delay_vs_benchmark"),
        )
        .filter(F.col("routes_served") >= min_routes)
        .withColumn("performance_tier", performance_tier("avg_delay_vs_benchmark", threshold))
        .withColumn("performance_percentile", position)
        .orderBy("avg_delay_vs_benchmark", "airline")
    )


def day_month_heatmap(raw: DataFrame, months: dict[int, str] | None = None) -> DataFrame:
    """Weekday by month: mean delay and share of late departures."""
    months = SEASON_MONTHS if months is None else months
    cells = []
    for month, prefix in months.items():
        here = F.col("month") == month
        cells.append(F.round(F.avg(F.when(here, F.col("depdelayminutes"))), 1).alias(f"{prefix}_avg_delay"))
    for month, prefix in months.items():
        here = F.col("month") == month
        late = F.count(F.when(here & (F.col("depdel15") == 1), 1))
        cells.append(percent(late, F.count(F.when(here, 1))).alias(f"{prefix}_pct_delayed"))
    return (
        raw.groupBy("dayofweek")
        .agg(*cells, _flights().alias("total_flights"))
        .withColumn("day_name", day_name("dayofweek"))
        .orderBy("dayofweek")
    )


def route_economic_impact(
    raw: DataFrame, costs: CostParameters = DEFAULT_COSTS, min_flights: int = 100, n: int = 25
) -> DataFrame:
    """Costliest routes, priced at the mean of delays above 15 minutes over all flights."""
    long_delay = F.when(F.col("depdelayminutes") > 15, F.col("depdelayminutes")).otherwise(0.0)
    priced = (
        raw.groupBy("origin", "dest")
        .agg(
            _flights().alias("total_flights"),
            _delayed().alias("delayed_flights"),
            F.round(F.avg("depdelayminutes"), 1).alias("avg_delay_min"),
            F.avg(long_delay).alias("mean_long_delay"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    passengers = F.col("delayed_flights") * F.lit(costs.seats) * F.lit(costs.load_factor)
    passenger = passengers * F.col("mean_long_delay") * F.lit(costs.passenger_minute)
    airline = F.col("delayed_flights") * F.col("mean_long_delay") * F.lit(costs.flight_minute)
    total = F.col("est_passenger_cost") + F.col("est_airline_ops_cost")
    return (
        priced.withColumn("est_passenger_cost", F.round(passenger, 0))
        .withColumn("est_airline_ops_cost", F.round(airline, 0))
        .select(
            route_id("origin", "dest", " → ").alias("route"),
            "total_flights",
            "delayed_flights",
            percent(F.col("delayed_flights"), F.col("total_flights")).alias("pct_delayed"),
            "avg_delay_min",
            "est_passenger_cost",
            "est_airline_ops_cost",
            total.alias("total_economic_impact"),
            F.round(total / F.col("total_flights"), 0).alias("cost_per_flight"),
        )
        .orderBy(F.col("total_economic_impact").desc(), "route")
        .limit(n)
    )
