"""Aircraft position snapshots: ``{"time": ..., "states": [[17 values], ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POSITION_PAYLOAD, RAW_POSITIONS

# Position of each kept field in a state array.
STATE_FIELDS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
}

# Bounding box of the continental US (degrees).
US_BOUNDS = {"lamin": 24.396308, "lamax": 49.384358, "lomin": -125.0, "lomax": -66.93457}


def iso_utc(moment: Column) -> Column:
    """Timestamp as ISO text in UTC, as the raw tables keep it."""
    utc = F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz"))
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def file_time() -> Column:
    """When the landed file was written: the moment of its poll."""
    return iso_utc(F.col("_metadata.file_modification_time"))


def flatten_positions(payload: DataFrame) -> DataFrame:
    """One row per aircraft from payload rows that also carry ``polled_at``.

    Short arrays give NULL fields, extra trailing fields are ignored, and rows
    without a position are dropped.
    """
    states = payload.select(
        F.col("time").alias("snapshot_time"), "polled_at", F.explode("states").alias("state")
    )
    fields = {name: F.get("state", F.lit(at)) for name, at in STATE_FIELDS.items()}
    fields["callsign"] = F.trim(fields["callsign"])
    fields["snapshot_time"] = F.col("snapshot_time")
    fields["polled_at"] = F.col("polled_at")
    return states.select(
        *[fields[f.name].try_cast(f.dataType).alias(f.name) for f in RAW_POSITIONS]
    ).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def read_position_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw positions of all landed snapshots; ``multi_line=False`` for one payload per line."""
    payload = spark.read.schema(POSITION_PAYLOAD).json(path, multiLine=multi_line)
    return flatten_positions(payload.withColumn("polled_at", file_time()))


def filter_bbox(
    positions: DataFrame,
    lamin: float = US_BOUNDS["lamin"],
    lamax: float = US_BOUNDS["lamax"],
    lomin: float = US_BOUNDS["lomin"],
    lomax: float = US_BOUNDS["lomax"],
) -> DataFrame:
    """Positions inside a latitude/longitude box, edges included."""
    return positions.filter(
        F.col("latitude").between(lamin, lamax) & F.col("longitude").between(lomin, lomax)
    )
