"""Polled feeds as streams over a landing folder.

A collector drops one file per poll; the stream picks up new files, flattens them
with the same code as the batch readers and appends to a raw Parquet table. The
checkpoint (offsets and, for stateful views, state) and the sink's commit log make
a restart continue without losing or repeating files. Put both in storage that all
executors share.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..plans.serving import latest_weather
from ..schemas import POSITION_PAYLOAD, RAW_AIRSPACE, WEATHER_PAYLOAD
from ..session import drop_folder, subfolders
from ..sources.airspace import ROOT_TAG, airspace_documents, flatten_airspace
from ..sources.positions import file_time, flatten_positions
from ..sources.weather import flatten_weather

# Seconds between polls.
POSITIONS_INTERVAL = 30
WEATHER_INTERVAL = 300
AIRSPACE_INTERVAL = 60


def _json_landing(
    spark: SparkSession, landing: str, schema, multi_line: bool, max_files: int | None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("multiLine", str(multi_line).lower())
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing).withColumn("polled_at", file_time())


def positions_source(
    spark: SparkSession, landing: str, multi_line: bool = True, max_files: int | None = None
) -> DataFrame:
    """Raw positions as files land."""
    return flatten_positions(_json_landing(spark, landing, POSITION_PAYLOAD, multi_line, max_files))


def weather_source(
    spark: SparkSession, landing: str, multi_line: bool = True, max_files: int | None = None
) -> DataFrame:
    """Raw weather as files land."""
    return flatten_weather(_json_landing(spark, landing, WEATHER_PAYLOAD, multi_line, max_files))


def airspace_source(
    spark: SparkSession, landing: str, root_tag: str = ROOT_TAG, max_files: int | None = None
) -> DataFrame:
    """Raw airspace status as files land, unique per poll, with a row for quiet polls."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return flatten_airspace(airspace_documents(reader, landing, root_tag))


def _trigger(writer: DataStreamWriter, once: bool, interval: int) -> DataStreamWriter:
    """Everything landed so far and stop, or a micro-batch every ``interval`` seconds."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval} seconds")


def _append(rows: DataFrame, table: str, checkpoint: str, once: bool, interval: int) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, once, interval).start(table)


def stream_positions(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    once: bool = True,
    interval: int = POSITIONS_INTERVAL,
    multi_line: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append landed position snapshots to a raw table."""
    return _append(positions_source(spark, landing, multi_line, max_files), table, checkpoint, once, interval)


def stream_weather(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    once: bool = True,
    interval: int = WEATHER_INTERVAL,
    multi_line: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append landed weather snapshots to a raw table."""
    return _append(weather_source(spark, landing, multi_line, max_files), table, checkpoint, once, interval)


def stream_airspace(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    once: bool = True,
    interval: int = AIRSPACE_INTERVAL,
    root_tag: str = ROOT_TAG,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append landed airspace documents to a raw table."""
    return _append(airspace_source(spark, landing, root_tag, max_files), table, checkpoint, once, interval)


def stream_latest_weather(weather: DataFrame) -> DataFrame:
    """Newest observation per station, kept up to date; the state is one row per station."""
    return latest_weather(weather)


KEPT_VERSIONS = 3


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in subfolders(spark, path) if name.startswith("version="))


def write_latest_weather(
    weather: DataFrame, path: str, checkpoint: str, once: bool = True, interval: int = WEATHER_INTERVAL
) -> StreamingQuery:
    """Write the newest observation of every station below ``path``, as one version per micro-batch.

    A version is whole (one row per station), so readers need one of them, and the last few are kept for readers that are
    under way. A micro-batch that is retried replaces its own version.
    """
    root = path.rstrip("/")

    def save(state: DataFrame, batch_id: int) -> None:
        spark = state.sparkSession
        state.write.mode("overwrite").parquet(f"{root}/version={batch_id}")
        for old in _versions(spark, root)[:-KEPT_VERSIONS]:
            drop_folder(spark, f"{root}/version={old}")

    writer = (
        stream_latest_weather(weather)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
    )
    return _trigger(writer, once, interval).start()


def read_latest_weather(spark: SparkSession, path: str) -> DataFrame:
    """Current state of every station: the newest version that was written to its end."""
    root = path.rstrip("/")
    for version in reversed(_versions(spark, root)):
        if "_SUCCESS" in subfolders(spark, f"{root}/version={version}"):
            return spark.read.parquet(f"{root}/version={version}")
    raise ValueError(f"no version in {path}")


_UNIQUE_KEYS = ["airport_code", "delay_type", "delay_reason", "polled_at"]

def _poll_day():
    """The day of a poll as a folder's name."""
    return F.coalesce(F.regexp_replace(F.substring("polled_at", 1, 10), "[^0-9A-Za-z-]", "_"), F.lit("none"))


def write_unique_airspace(
    status: DataFrame, path: str, checkpoint: str, once: bool = True, interval: int = AIRSPACE_INTERVAL
) -> StreamingQuery:
    """Append one row per (airport, type, reason) of a poll from a stream of flat status rows, however late rows arrive.

    What was written before is the memory: a micro-batch compares its rows with the days of the polls it holds, and with
    nothing else; the days, one short text each, are what reaches the driver. So no first occurrence is lost and none is written twice, whatever the order of the input; there is no
    state that grows, and a poll that comes days late costs the reading of its day. Of several rows of one micro-batch the
    one with the smallest remaining values is kept. A micro-batch that is retried first forgets what it wrote before.
    """
    root = path.rstrip("/")
    rest = [name for name in RAW_AIRSPACE.names if name not in _UNIQUE_KEYS]

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.groupBy(*_UNIQUE_KEYS).agg(F.min(F.struct(*rest)).alias("kept"))
        rows = rows.select(*_UNIQUE_KEYS, "kept.*").withColumn("poll_day", _poll_day()).persist()
        try:
            days = [f"{root}/poll_day={r.poll_day}" for r in rows.select("poll_day").distinct().collect()]
            for day in days:
                drop_folder(spark, f"{day}/batch_id={batch_id}")
            fresh, known = rows, [day for day in days if subfolders(spark, day)]
            if known:
                before = spark.read.schema(RAW_AIRSPACE).option("basePath", root).parquet(*known).select(*[F.col(k).alias(f"old_{k}") for k in _UNIQUE_KEYS])
                same = [F.col(k).eqNullSafe(F.col(f"old_{k}")) for k in _UNIQUE_KEYS]
                fresh = rows.join(before, reduce(and_, same), "left_anti")
            fresh = fresh.withColumn("batch_id", F.lit(batch_id)).select(*RAW_AIRSPACE.names, "poll_day", "batch_id")
            fresh.hint("rebalance", "poll_day").write.mode("append").partitionBy("poll_day", "batch_id").parquet(root)
        finally:
            rows.unpersist()

    writer = status.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return _trigger(writer, once, interval).start()
