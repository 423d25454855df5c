"""One entry per operator: (spark, sf_dir) -> DataFrame over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundhold import functions as fn
from groundhold import operators as op
from groundhold import plans
from groundhold import sources as src
from groundhold import streaming
from groundhold.operators.quality import DEFAULT_EXPECTATIONS
from groundhold.params import CostParameters
from groundhold.plans.portfolio import airline_route_performance
from groundhold.schemas import RAW_AIRSPACE, RAW_FLIGHTS, RAW_POSITIONS, RAW_WEATHER
from groundhold.session import scratch_path, tune

from . import payloads
from .frames import derive

Query = Callable[[SparkSession, str], DataFrame]

DELAYS = list(range(15, 241, 15))
HEALTH_NOW = "2024-01-31T12:00:00Z"
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# ------------------------------------------------------------------ inputs


def flights(spark, sf) -> DataFrame:
    return derive(spark, sf, "raw_flights")


def staged(spark, sf) -> DataFrame:
    return op.stg_flights(flights(spark, sf))


def daily(spark, sf) -> DataFrame:
    return op.int_airport_daily(staged(spark, sf))


def econ(spark, sf) -> DataFrame:
    return plans.mart_delay_economics(daily(spark, sf))


def vulnerability(spark, sf) -> DataFrame:
    return plans.mart_cascade_vulnerability(econ(spark, sf))


def routes(spark, sf) -> DataFrame:
    return plans.mart_route_economics(op.int_route_performance(staged(spark, sf)))


def weather(spark, sf) -> DataFrame:
    return derive(spark, sf, "raw_weather")


def positions(spark, sf) -> DataFrame:
    return derive(spark, sf, "raw_positions")


def airspace(spark, sf) -> DataFrame:
    return derive(spark, sf, "raw_airspace")


def _without_poll(df: DataFrame) -> DataFrame:
    """The poll time of landed files is the clock's; it is left out of comparisons."""
    return df.drop("polled_at")


# ------------------------------------------------------------------ sources and sinks


def _land_csv(rows: DataFrame, path: str, **options: str) -> None:
    rows.write.mode("append").options(header="true", encoding="ISO-8859-1", **options).csv(path)


def _land_layouts(rows: DataFrame, path: str) -> None:
    """The flights of each month under another header: padded and upper case, turned round and quoted, with columns between."""
    padded = rows.filter("month = 9").withColumn("tail_number", F.lit("N1"))
    _land_csv(padded.select(*[F.col(c).alias(f" {c.upper()} " if i % 2 else c) for i, c in enumerate(padded.columns)]), path)
    _land_csv(rows.filter("month = 10").select(*rows.columns[::-1]), path, quoteAll="true", ignoreLeadingWhiteSpace="false")
    spread = [F.col(name).alias(name.title()) for name in rows.columns]
    for at in range(0, 40, 9):
        spread.insert(at, F.lit("x, y").alias(f"div_{at}"))
    _land_csv(rows.filter("month not in (9, 10)").select(*spread), path)


@query
def read_flights_csv(spark, sf):
    path = scratch_path(spark, "flights-csv")
    _land_layouts(flights(spark, sf), path)
    return src.read_flights_csv(spark, path)


@query
def unfit_csv_values(spark, sf):
    """Unfit values per column; two layouts of which one lacks a column."""
    path = scratch_path(spark, "flights-unfit")
    odd = flights(spark, sf).withColumn("distance", F.expr("if(flight_number_reporting_airline % 7 = 0, 'far', cast(distance as string))"))
    odd = odd.withColumn("crsdeptime", F.expr("case when crsdeptime is null then 'n/a' else cast(crsdeptime as string) end"))
    _land_csv(odd.filter("month = 9"), path)
    _land_csv(odd.filter("month <> 9").withColumn("year", F.lit("20x5")).drop("crsdeptime"), path)
    found = src.unfit_values(spark, path)
    return found.groupBy("column_name").agg(F.sum("unfit").alias("unfit"), F.min("example").alias("example"))


@query
def append_raw(spark, sf):
    path = scratch_path(spark, "raw-flights")
    raw = flights(spark, sf)
    src.append_raw(raw.filter(F.col("month") == 9), path, "flightdate")
    src.append_raw(raw.filter(F.col("month") != 9), path, "flightdate")
    back = src.read_raw(spark, path, RAW_FLIGHTS)
    return back.groupBy("flightdate").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("distance").alias("miles"), F.sum("arrdelay").alias("arr_delay")
    )


@query
def read_position_snapshots(spark, sf):
    path = payloads.land_json(spark, payloads.position_payload(spark, sf), "positions")
    return _without_poll(src.read_position_snapshots(spark, path, multi_line=False))


@query
def filter_bbox(spark, sf):
    return src.filter_bbox(positions(spark, sf)).select("icao24", "latitude", "longitude", "polled_at")


@query
def read_weather_snapshots(spark, sf):
    path = payloads.land_json(spark, payloads.weather_payload(spark, sf), "weather")
    return _without_poll(src.read_weather_snapshots(spark, path, multi_line=False))


@query
def cloud_cover(spark, sf):
    rows = payloads.with_clouds(payloads.events(spark, sf))
    return rows.select(F.col("e").alias("event_id"), fn.cloud_cover("clouds").alias("cloud_cover"))


@query
def ceiling_ft(spark, sf):
    rows = payloads.with_clouds(payloads.events(spark, sf))
    return rows.select(F.col("e").alias("event_id"), fn.ceiling_ft("clouds").alias("ceiling_ft"))


@query
def read_airspace_status(spark, sf):
    return _without_poll(src.read_airspace_status(spark, payloads.land_airspace(spark, sf)))


@query
def dedup_airspace_status(spark, sf):
    polled = airspace(spark, sf).withColumn("polled_at", F.substring("polled_at", 1, 15))
    active = polled.filter(F.col("has_delay") & F.col("airport_code").isNotNull())
    return src.dedup_airspace_status(active, polled.select("polled_at"))


@query
def write_json_snapshots(spark, sf):
    path = scratch_path(spark, "weather-backup")
    src.write_json_snapshots(weather(spark, sf), path)
    return spark.read.schema(RAW_WEATHER).json(path)


@query
def read_seeds(spark, sf):
    airports, parameters = src.read_seeds(spark)
    costs = CostParameters.from_table(parameters)
    departures = flights(spark, sf).groupBy(F.col("origin").alias("iata_code")).agg(F.count(F.lit(1)).alias("departures"))
    known = departures.join(airports, "iata_code")
    return known.withColumn("seats_offered", F.col("departures") * costs.seats)


@query
def materialize_marts(spark, sf):
    paths = plans.materialize_marts(flights(spark, sf), scratch_path(spark, "marts"))
    measures = {
        "mart_delay_economics": "est_total_economic_impact",
        "mart_cascade_vulnerability": "total_economic_impact",
        "mart_route_economics": "est_total_economic_impact",
    }
    parts = [
        spark.read.parquet(paths[mart]).agg(
            F.lit(mart).alias("mart"), F.count(F.lit(1)).alias("row_count"), F.sum(column).alias("total_impact")
        )
        for mart, column in measures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


REFRESHED = ["2025-09-01", "2025-10-15", "2025-10-16", "2025-11-28"]


@query
def refresh_days(spark, sf):
    """The airport-day mart, built from flights of which some days lacked half, one lacked all, and then brought up to date."""
    raw, out = flights(spark, sf), scratch_path(spark, "marts-by-day")
    day, number = F.col("flightdate"), F.col("flight_number_reporting_airline")
    lacking = day.isin(REFRESHED[:3]) & (number % 2 == 0) | (day == REFRESHED[3])
    plans.build_days(raw.filter(~lacking), out)
    return plans.refresh_days(raw, out, REFRESHED)


RANGES = {"september": ("2025-09-01", "2025-09-30"), "one day": ("2025-10-15", "2025-10-15"), "all": ("2025-01-01", "2025-12-31"),
          "nothing": ("2030-01-01", "2030-12-31"), "overlap": ("2025-09-15", "2025-10-15")}
PRESENT = ["origin", "dest", "iata_code_reporting_airline", "flight_number_reporting_airline"]


@query
def distinct_over_ranges(spark, sf):
    raw = flights(spark, sf)
    older = raw.filter("flightdate < '2025-10-01'")
    book = op.code_book(raw, PRESENT, op.code_book(older, PRESENT))
    return op.distinct_over(op.daily_presence(raw, "flightdate", PRESENT, book), RANGES)


@query
def load_summary(spark, sf):
    return op.load_summary(flights(spark, sf))


# ------------------------------------------------------------------ staging and columns


@query
def stg_flights(spark, sf):
    return staged(spark, sf)


@query
def hhmm_to_minutes(spark, sf):
    return (
        flights(spark, sf)
        .groupBy("crsdeptime", fn.hhmm_to_minutes("crsdeptime").alias("dep_minutes"))
        .agg(F.count(F.lit(1)).alias("flights"))
    )


@query
def day_name(spark, sf):
    return (
        flights(spark, sf)
        .groupBy("flightdate", fn.day_name("dayofweek").alias("day_name"), fn.is_weekend("dayofweek").alias("is_weekend"))
        .agg(F.count(F.lit(1)).alias("flights"))
    )


@query
def route_id(spark, sf):
    return (
        flights(spark, sf)
        .groupBy(fn.route_id("origin", "dest").alias("route_id"), fn.route_id("origin", "dest", " → ").alias("route"))
        .agg(F.count(F.lit(1)).alias("flights"))
    )


@query
def primary_delay_cause(spark, sf):
    return (
        flights(spark, sf)
        .groupBy("origin", fn.primary_delay_cause().alias("primary_delay_cause"))
        .agg(F.count(F.lit(1)).alias("flights"), F.sum("depdelayminutes").alias("delay_minutes"))
    )


@query
def stg_positions(spark, sf):
    return op.stg_positions(positions(spark, sf))


@query
def stg_weather(spark, sf):
    return op.stg_weather(weather(spark, sf))


@query
def stg_airspace(spark, sf):
    return op.stg_airspace(airspace(spark, sf))


@query
def time_block(spark, sf):
    return (
        staged(spark, sf)
        .groupBy(fn.time_block(fn.scheduled_hour("scheduled_dep_hhmm")).alias("time_block"))
        .agg(F.count(F.lit(1)).alias("flights"), F.sum("is_dep_delayed_15").alias("delayed_flights"))
    )


@query
def trend_status(spark, sf):
    change = F.col("avg_dep_delay_min") - F.col("rolling_7day_avg_delay")
    return econ(spark, sf).select("airport", "flight_date", fn.trend_status(change).alias("trend_status"))


@query
def performance_tier(spark, sf):
    gap = F.col("avg_dep_delay_min") - F.col("avg_arr_delay_min")
    return daily(spark, sf).select("airport", "flight_date", fn.performance_tier(gap, 0.5).alias("performance_tier"))


@query
def risk_band(spark, sf):
    return econ(spark, sf).select("airport", "flight_date", "pct_delayed_15", fn.risk_band("pct_delayed_15").alias("risk"))


@query
def delay_cost_columns(spark, sf):
    cost = fn.delay_cost_columns("delayed", "mean_delay", total_flights="flights")
    hubs = flights(spark, sf).groupBy("origin", "reporting_airline").agg(
        F.count(F.lit(1)).alias("flights"),
        F.count(F.when(F.col("depdel15") == 1, 1)).alias("delayed"),
        F.round(F.avg("depdelayminutes"), 1).alias("mean_delay"),
    )
    return hubs.select(
        "origin", "reporting_airline", "delayed", "mean_delay", *[c.alias(f"{name}_cost") for name, c in cost.items()]
    )


@query
def dominant_delay_cause(spark, sf):
    performance = op.int_route_performance(staged(spark, sf))
    return performance.select("route_id", "airline_iata", fn.dominant_delay_cause().alias("dominant_delay_cause"))


@query
def flight_category_meaning(spark, sf):
    return (
        weather(spark, sf)
        .groupBy(
            fn.flight_category_meaning("flight_category").alias("meaning"),
            fn.weather_or_none("weather_string").alias("weather"),
        )
        .agg(F.count(F.lit(1)).alias("reports"))
    )


# ------------------------------------------------------------------ joins and cascades


@query
def cascade_matches(spark, sf):
    return op.cascade_matches(flights(spark, sf), 90)


@query
def cascade_impact(spark, sf):
    impact = op.cascade_impact(flights(spark, sf), DELAYS)
    return impact.withColumn("affected_destinations", F.concat_ws(",", "affected_destinations"))


@query
def cascade_impact_hub_day(spark, sf):
    impact = op.cascade_impact(
        flights(spark, sf), [60, 90, 120], hubs=["ORD", "ATL", "JFK", "XXX"], dates=["2025-10-15", "2025-11-15"]
    )
    return impact.withColumn("affected_destinations", F.concat_ws(",", "affected_destinations"))


@query
def simulate_cascade(spark, sf):
    impact = plans.simulate_cascade(flights(spark, sf), "ord", 90)
    return impact.withColumn("affected_destinations", F.concat_ws(",", "affected_destinations"))


@query
def cascade_by_destination(spark, sf):
    return op.cascade_by_destination(flights(spark, sf), 90)


@query
def cascade_chain(spark, sf):
    return op.cascade_chain(flights(spark, sf)).drop("airport", "flight_date")


@query
def cascade_chain_all_hubs(spark, sf):
    return op.cascade_chain(flights(spark, sf), hub=None, date=None)


@query
def union_all_levels(spark, sf):
    return op.cascade_chain(flights(spark, sf), hub=None, date=None, min_delay=15, gap=(20, 120))


@query
def airport_map_join(spark, sf):
    airports, _ = src.read_seeds(spark)
    return plans.airport_map_join(vulnerability(spark, sf), airports)


@query
def cascade_destination_detail(spark, sf):
    return op.cascade_destination_detail(flights(spark, sf), 90)


@query
def cascade_estimate(spark, sf):
    return op.cascade_estimate(vulnerability(spark, sf), DELAYS)


# ------------------------------------------------------------------ roll-ups, marts, portfolio


@query
def int_airport_daily(spark, sf):
    return daily(spark, sf)


@query
def int_route_performance(spark, sf):
    return op.int_route_performance(staged(spark, sf))


@query
def mart_delay_economics(spark, sf):
    return econ(spark, sf)


@query
def mart_cascade_vulnerability(spark, sf):
    return vulnerability(spark, sf)


@query
def mart_route_economics(spark, sf):
    return routes(spark, sf)


@query
def hub_vulnerability_ranking(spark, sf):
    return plans.hub_vulnerability_ranking(flights(spark, sf))


@query
def rolling_delay_trend(spark, sf):
    return plans.rolling_delay_trend(flights(spark, sf))


@query
def delay_cause_by_hour(spark, sf):
    return plans.delay_cause_by_hour(flights(spark, sf))


@query
def airline_scorecard(spark, sf):
    return plans.airline_scorecard(flights(spark, sf))


@query
def day_month_heatmap(spark, sf):
    return plans.day_month_heatmap(flights(spark, sf))


@query
def route_economic_impact(spark, sf):
    return plans.route_economic_impact(flights(spark, sf))


# ------------------------------------------------------------------ windows and top lists


@query
def rolling_7row_avg(spark, sf):
    by_day = flights(spark, sf).groupBy("origin", "flightdate").agg(F.round(F.avg("arrdelayminutes"), 1).alias("avg_arr"))
    return by_day.withColumn("rolling", op.rolling_7row_avg("avg_arr", "origin", "flightdate"))


@query
def rank_ntile(spark, sf):
    """Rank and quintile over every airport and weekday group of departures."""
    groups = flights(spark, sf).groupBy("origin", "dayofweek").agg(
        F.count(F.lit(1)).alias("flights"), fn.percent(F.count(F.when(F.col("depdel15") == 1, 1)), F.count(F.lit(1))).alias("pct")
    )
    return groups.select(
        "origin",
        "dayofweek",
        "pct",
        F.rank().over(Window.orderBy(F.col("pct").desc())).cast("long").alias("pct_rank"),
        F.ntile(5).over(Window.orderBy(F.col("pct").desc(), "origin", "dayofweek")).cast("long").alias("quintile"),
    )


@query
def partition_benchmark(spark, sf):
    return plans.partition_benchmark(airline_route_performance(flights(spark, sf)))


@query
def top_n(spark, sf):
    return op.top_n(econ(spark, sf), "est_total_economic_impact", 99, ["airport", "flight_date"]).select(
        "airport", "flight_date", "est_total_economic_impact"
    )


@query
def distinct_dates(spark, sf):
    return op.distinct_dates(econ(spark, sf), "ORD")


# ------------------------------------------------------------------ serving


@query
def airport_delay_summary(spark, sf):
    summary = plans.airport_delay_summary(econ(spark, sf), "ord")
    nested = ["delay_causes", "avg_delay_by_cause_minutes", "trends"]
    return summary.select(*[c for c in summary.columns if c not in nested], *[f"{c}.*" for c in nested])


@query
def vulnerability_top_n(spark, sf):
    return plans.vulnerability_top_n(vulnerability(spark, sf))


@query
def economic_top_n(spark, sf):
    return plans.economic_top_n(vulnerability(spark, sf)).select("airport", "total_economic_impact", "cost_m")


@query
def costliest_routes(spark, sf):
    return plans.costliest_routes(routes(spark, sf))


@query
def costliest_routes_by_cause(spark, sf):
    return plans.costliest_routes(routes(spark, sf), n=15, cause="Late Aircraft")


@query
def costliest_routes_filtered(spark, sf):
    return plans.costliest_routes(routes(spark, sf), n=30, min_flights=150, causes=["Weather", "Carrier", "NAS/ATC"])


@query
def latest_weather(spark, sf):
    return plans.latest_weather(weather(spark, sf))


@query
def latest_weather_station(spark, sf):
    return plans.latest_weather(weather(spark, sf), "jfk")


@query
def overview_kpis(spark, sf):
    return plans.overview_kpis(econ(spark, sf))


@query
def airport_trend(spark, sf):
    return plans.airport_trend(econ(spark, sf))


@query
def airport_trend_wide(spark, sf):
    return plans.airport_trend(econ(spark, sf), wide=True)


@query
def delay_rate_heatmap(spark, sf):
    return plans.delay_rate_heatmap(econ(spark, sf))


@query
def cause_distribution(spark, sf):
    return plans.cause_distribution(econ(spark, sf))


@query
def daily_impact(spark, sf):
    return plans.daily_impact(econ(spark, sf))


@query
def date_range(spark, sf):
    return plans.date_range(econ(spark, sf))


@query
def metric_query(spark, sf):
    metrics = ["total_economic_impact", "avg_delay", "total_departures"]
    by_day = plans.metric_query(econ(spark, sf), metrics, ["airport", "day_name"])
    return by_day.withColumn("avg_delay", F.round("avg_delay", 4))


# ------------------------------------------------------------------ health


def _tables(spark, sf) -> dict[str, DataFrame]:
    return {
        "raw_flights": flights(spark, sf),
        "raw_positions": positions(spark, sf),
        "raw_weather": weather(spark, sf),
        "raw_airspace_status": airspace(spark, sf),
        "stg_flights": staged(spark, sf),
        "mart_delay_economics": econ(spark, sf),
        "mart_cascade_vulnerability": vulnerability(spark, sf),
    }


def _health(spark, sf) -> DataFrame:
    return op.table_health(_tables(spark, sf), now=HEALTH_NOW)


@query
def table_health(spark, sf):
    return _health(spark, sf).withColumn("issues", F.concat_ws("; ", "issues"))


@query
def table_inventory(spark, sf):
    tables = {**_tables(spark, sf), "mart_route_economics": routes(spark, sf)}
    tables.pop("stg_flights")
    freshness = {name: expect.freshness_col for name, expect in DEFAULT_EXPECTATIONS.items()}
    kinds = {name: expect.source_type for name, expect in DEFAULT_EXPECTATIONS.items()}
    return op.table_inventory(tables, freshness, kinds)


@query
def detect_issues(spark, sf):
    return op.detect_issues(_health(spark, sf)).withColumn("problems", F.concat_ws("; ", "problems"))


@query
def health_rollup(spark, sf):
    return op.health_rollup(_health(spark, sf))


@query
def assert_non_negative_delay(spark, sf):
    return op.assert_non_negative_delay(staged(spark, sf))


@query
def assert_non_negative_early(spark, sf):
    """The same check on a column that breaks the rule: departures before their time are negative."""
    named = ["flight_date", "origin_airport", "dest_airport", "airline_iata", "flight_number"]
    return op.assert_non_negative_delay(staged(spark, sf), "dep_delay_minutes", 25, named).select("dep_delay_minutes", *named)


# ------------------------------------------------------------------ streams


def _await(stream) -> None:
    stream.awaitTermination()


@query
def stream_positions(spark, sf):
    landing = payloads.land_json(spark, payloads.position_payload(spark, sf), "positions")
    table, checkpoint = scratch_path(spark, "positions-table"), scratch_path(spark, "positions-checkpoint")
    _await(streaming.stream_positions(spark, landing, table, checkpoint, multi_line=False))
    return _without_poll(src.read_raw(spark, table, RAW_POSITIONS))


@query
def stream_weather(spark, sf):
    landing = payloads.land_json(spark, payloads.weather_payload(spark, sf), "weather")
    table, checkpoint = scratch_path(spark, "weather-table"), scratch_path(spark, "weather-checkpoint")
    _await(streaming.stream_weather(spark, landing, table, checkpoint, multi_line=False))
    return _without_poll(src.read_raw(spark, table, RAW_WEATHER))


@query
def stream_airspace(spark, sf):
    landing = payloads.land_airspace(spark, sf)
    table, checkpoint = scratch_path(spark, "airspace-table"), scratch_path(spark, "airspace-checkpoint")
    _await(streaming.stream_airspace(spark, landing, table, checkpoint))
    return _without_poll(src.read_raw(spark, table, RAW_AIRSPACE))


def _as_stream(spark, batch: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    batch.write.parquet(path)
    return spark.readStream.schema(batch.schema).parquet(path)


@query
def stream_latest_weather(spark, sf):
    landed = _as_stream(spark, weather(spark, sf), "weather-raw")
    path, checkpoint = scratch_path(spark, "latest-weather"), scratch_path(spark, "latest-weather-checkpoint")
    _await(streaming.write_latest_weather(landed, path, checkpoint))
    return streaming.read_latest_weather(spark, path)


@query
def stream_dedup_airspace(spark, sf):
    polled = airspace(spark, sf).withColumn("polled_at", F.concat(F.substring("polled_at", 1, 15), F.lit("0:00Z")))
    path, checkpoint = scratch_path(spark, "airspace-unique"), scratch_path(spark, "airspace-unique-checkpoint")
    _await(streaming.write_unique_airspace(_as_stream(spark, polled, "airspace-raw"), path, checkpoint))
    return src.read_raw(spark, path, RAW_AIRSPACE)
