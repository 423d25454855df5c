"""Seed tables: the airport dimension and the cost parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..params import COST_PARAMETER_ROWS
from ..schemas import AIRPORTS, COST_PARAMETERS

# iata_code, icao_code, airport_name, city, state, latitude, longitude, is_major_hub.
AIRPORT_ROWS = [
    ("ORD", "KORD", "Chicago O'Hare International", "Chicago", "IL", 41.98, -87.90, True),
    ("ATL", "KATL", "Hartsfield-Jackson Atlanta International", "Atlanta", "GA", 33.64, -84.43, True),
    ("DFW", "KDFW", "Dallas/Fort Worth International", "Dallas", "TX", 32.90, -97.04, True),
    ("DEN", "KDEN", "Denver International", "Denver", "CO", 39.86, -104.67, True),
    ("LAX", "KLAX", "Los Angeles International", "Los Angeles", "CA", 33.94, -118.41, True),
    ("JFK", "KJFK", "John F Kennedy International", "New York", "NY", 40.64, -73.78, True),
    ("SFO", "KSFO", "San Francisco International", "San Francisco", "CA", 37.62, -122.38, True),
    ("SEA", "KSEA", "Seattle-Tacoma International", "Seattle", "WA", 47.45, -122.31, True),
    ("MIA", "KMIA", "Miami International", "Miami", "FL", 25.79, -80.29, True),
    ("BOS", "KBOS", "Boston Logan International", "Boston", "MA", 42.36, -71.01, True),
    ("EWR", "KEWR", "Newark Liberty International", "Newark", "NJ", 40.69, -74.17, True),
    ("CLT", "KCLT", "Charlotte Douglas International", "Charlotte", "NC", 35.21, -80.94, True),
    ("PHX", "KPHX", "Phoenix Sky Harbor International", "Phoenix", "AZ", 33.44, -112.01, True),
    ("IAH", "KIAH", "George Bush Intercontinental", "Houston", "TX", 29.98, -95.34, True),
    ("MSP", "KMSP", "Minneapolis-Saint Paul International", "Minneapolis", "MN", 44.88, -93.22, True),
    ("DTW", "KDTW", "Detroit Metropolitan Wayne County", "Detroit", "MI", 42.21, -83.35, True),
    ("LGA", "KLGA", "LaGuardia", "New York", "NY", 40.77, -73.87, True),
    ("PHL", "KPHL", "Philadelphia International", "Philadelphia", "PA", 39.87, -75.24, True),
    ("DCA", "KDCA", "Ronald Reagan Washington National", "Washington", "DC", 38.85, -77.04, True),
    ("SLC", "KSLC", "Salt Lake City International", "Salt Lake City", "UT", 40.79, -111.98, True),
    ("LAS", "KLAS", "Harry Reid International", "Las Vegas", "NV", 36.08, -115.15, True),
    ("MCO", "KMCO", "Orlando International", "Orlando", "FL", 28.43, -81.31, True),
    ("BNA", "KBNA", "Nashville International", "Nashville", "TN", 36.12, -86.68, True),
    ("SAN", "KSAN", "San Diego International", "San Diego", "CA", 32.73, -117.19, False),
    ("TPA", "KTPA", "Tampa International", "Tampa", "FL", 27.98, -82.53, False),
    ("PDX", "KPDX", "Portland International", "Portland", "OR", 45.59, -122.60, False),
]


def read_seeds(
    spark: SparkSession, airports_csv: str | None = None, parameters_csv: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(airports, cost parameters): the built-in tables, or own CSV files with the same columns.

    The built-in rows are literals of the plan, so they need no file on the executors.
    """

    def table(csv, rows, schema):
        if csv is None:
            return spark.createDataFrame(rows, schema)
        return spark.read.schema(schema).csv(csv, header=True)

    return (
        table(airports_csv, AIRPORT_ROWS, AIRPORTS),
        table(parameters_csv, COST_PARAMETER_ROWS, COST_PARAMETERS),
    )
