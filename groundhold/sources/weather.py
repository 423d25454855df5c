"""Airport weather snapshots: a JSON list of METAR reports per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ceiling_ft, cloud_cover, tolerant_double
from ..schemas import RAW_WEATHER, WEATHER_PAYLOAD
from .positions import file_time


def flatten_weather(payload: DataFrame) -> DataFrame:
    """Raw weather rows from payload rows that also carry ``polled_at``.

    US stations lose their leading K to give the IATA code; missing texts are
    empty strings, missing or unreadable numbers are NULL.
    """

    def text(name):
        return F.coalesce(F.col(name), F.lit(""))

    station = text("icaoId")
    fields = {
        "station_id": station,
        "iata_code": F.when(station.startswith("K"), F.substr(station, F.lit(2))).otherwise(station),
        "observation_time": text("reportTime"),
        "raw_metar": text("rawOb"),
        "wind_direction_deg": tolerant_double("wdir"),
        "wind_speed_kt": tolerant_double("wspd"),
        "wind_gust_kt": tolerant_double("wgst"),
        "visibility_miles": tolerant_double("visib"),
        "temperature_c": tolerant_double("temp"),
        "dewpoint_c": tolerant_double("dewp"),
        "altimeter_inhg": tolerant_double("altim"),
        "cloud_cover": cloud_cover("clouds"),
        "ceiling_ft": ceiling_ft("clouds"),
        "weather_string": text("wxString"),
        "flight_category": text("fltcat"),
        "polled_at": F.col("polled_at"),
    }
    return payload.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in RAW_WEATHER])


def read_weather_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw weather of all landed snapshots; ``multi_line=False`` for one report per line."""
    payload = spark.read.schema(WEATHER_PAYLOAD).json(path, multiLine=multi_line)
    return flatten_weather(payload.withColumn("polled_at", file_time()))
