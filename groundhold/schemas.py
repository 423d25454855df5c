"""Explicit schemas of the raw tables, the seeds and the feed payloads."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "bigint": T.LongType()}


def _struct(spec: str) -> T.StructType:
    """A flat schema from ``name type`` pairs (needs no session)."""
    pairs = [pair.split() for pair in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The flight columns kept from an on-time performance file, in file order.
FLIGHT_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "FlightDate", "Reporting_Airline", "IATA_CODE_Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Origin", "OriginCityName", "OriginState",
    "Dest", "DestCityName", "DestState",
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance",
    "CarrierDelay", "WeatherDelay", "NASDelay",
    "SecurityDelay", "LateAircraftDelay",
]

_FLIGHT_INTS = {"year", "quarter", "month", "dayofmonth", "dayofweek", "flight_number_reporting_airline"}
_FLIGHT_STRINGS = {
    "flightdate", "reporting_airline", "iata_code_reporting_airline", "origin", "origincityname",
    "originstate", "dest", "destcityname", "deststate", "cancellationcode",
}


def _flight_type(name: str) -> T.DataType:
    if name in _FLIGHT_INTS:
        return T.IntegerType()
    return T.StringType() if name in _FLIGHT_STRINGS else T.DoubleType()


RAW_FLIGHTS = T.StructType(
    [T.StructField(name.lower(), _flight_type(name.lower())) for name in FLIGHT_COLUMNS]
)

RAW_POSITIONS = _struct(
    "icao24 string, callsign string, origin_country string, longitude double, latitude double, "
    "baro_altitude double, geo_altitude double, on_ground boolean, velocity double, "
    "true_track double, vertical_rate double, snapshot_time bigint, polled_at string"
)

RAW_WEATHER = _struct(
    "station_id string, iata_code string, observation_time string, raw_metar string, "
    "wind_direction_deg double, wind_speed_kt double, wind_gust_kt double, visibility_miles double, "
    "temperature_c double, dewpoint_c double, altimeter_inhg double, cloud_cover string, "
    "ceiling_ft double, weather_string string, flight_category string, polled_at string"
)

RAW_AIRSPACE = _struct(
    "airport_code string, delay_type string, delay_reason string, avg_delay string, "
    "max_delay string, start_time string, end_time string, has_delay boolean, polled_at string"
)

AIRPORTS = _struct(
    "iata_code string, icao_code string, airport_name string, city string, state string, "
    "latitude double, longitude double, is_major_hub boolean"
)

COST_PARAMETERS = _struct("parameter_name string, value double, unit string, source string")

# Feed payloads: values arrive as numbers or text ("10+", "VRB"), so everything is
# read as text and cast tolerantly.
POSITION_PAYLOAD = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

CLOUD_LAYERS = T.ArrayType(_struct("cover string, base string"))
WEATHER_PAYLOAD = T.StructType(
    [
        *_struct(
            "icaoId string, reportTime string, rawOb string, wdir string, wspd string, wgst string, "
            "visib string, temp string, dewp string, altim string"
        ),
        T.StructField("clouds", CLOUD_LAYERS),
        *_struct("wxString string, fltcat string"),
    ]
)
