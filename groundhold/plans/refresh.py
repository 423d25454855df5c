"""Marts by day: a full build, and a refresh of the days that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rollups import int_airport_daily, staged_cells
from ..operators.staging import stg_flights
from ..params import DEFAULT_COSTS, CostParameters
from ..session import drop_folder, subfolders
from .marts import mart_delay_economics

DAY = "flight_date"
LOOK_BACK = 6  # rows before its own that a rolling mean takes


def _write_days(rows: DataFrame, path: str, days: Sequence[str]) -> None:
    """Replaces the folders of ``days`` by ``rows``, which hold no other days; a day without rows loses its folder."""
    spark = rows.sparkSession
    rows.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    held = {r[0] for r in rows.select(F.col(DAY).cast("string")).distinct().collect()}
    for day in days:
        if day not in held and f"{DAY}={day}" in subfolders(spark, path):
            drop_folder(spark, f"{path}/{DAY}={day}")


def _cells(raw_flights: DataFrame) -> DataFrame:
    return staged_cells(stg_flights(raw_flights))


def _economics(cells: DataFrame, costs: CostParameters) -> DataFrame:
    return mart_delay_economics(int_airport_daily(cells=cells), costs)


def read_days(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table that is stored by day, with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _paths(out: str) -> tuple[str, str]:
    return f"{out.rstrip('/')}/flight_cells", f"{out.rstrip('/')}/mart_delay_economics"


def build_days(raw_flights: DataFrame, out: str, costs: CostParameters = DEFAULT_COSTS) -> DataFrame:
    """Builds the cells and the airport-day mart below ``out``, one folder per day, and returns the mart."""
    spark, (cells_path, mart_path) = raw_flights.sparkSession, _paths(out)
    cells = _cells(raw_flights)
    cells.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(cells_path)
    mart = _economics(read_days(spark, cells_path, cells), costs)
    mart.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(mart_path)
    return read_days(spark, mart_path, mart)


def refresh_days(raw_flights: DataFrame, out: str, days: Sequence[str], costs: CostParameters = DEFAULT_COSTS) -> DataFrame:
    """Brings the tables of ``build_days`` up to date after the flights of ``days`` changed, and returns the mart.

    Only the changed days' flights are read. A changed day also changes the rolling means of the next six rows of its
    airports, and those need the six rows before them. Which days that are follows from the rows' keys alone: the mart's
    airports and dates as they were and the changed days' as they are now, in order of dates. Cells of those days are read, and
    the folders of the changed days and of the rows after them are replaced; files of other days stay as they are. Days are
    what reaches the driver.
    """
    spark, (cells_path, mart_path) = raw_flights.sparkSession, _paths(out)
    days = sorted(set(days))
    if not days:
        raise ValueError("name a day that changed")
    new = _cells(raw_flights.filter(F.col("flightdate").isin(days)))
    _write_days(new, cells_path, days)
    cells = read_days(spark, cells_path, new)
    mart = _economics(cells, costs)
    before = read_days(spark, mart_path, mart).select("airport", DAY)
    flown = cells.filter((F.col("is_cancelled") == 0) & F.col(DAY).isin(days)).select(F.col("origin_airport").alias("airport"), DAY)
    in_order = Window.partitionBy("airport").orderBy(DAY)
    changed = F.col(DAY).isin(days)
    keys = before.union(flown).distinct().withColumn("stale", F.max(changed).over(in_order.rowsBetween(-LOOK_BACK, 0)))
    replaced = _days(keys.filter("stale").select(DAY))
    needed = keys.withColumn("wanted", F.max(F.col(DAY).isin(replaced)).over(in_order.rowsBetween(0, LOOK_BACK)))
    read = _days(needed.filter("wanted").select(DAY)) if replaced else []
    fresh = _economics(cells.filter(F.col(DAY).isin(read or days)), costs).filter(F.col(DAY).isin(replaced or days))
    _write_days(fresh, mart_path, replaced or days)
    return read_days(spark, mart_path, mart)


def _days(rows: DataFrame) -> list[str]:
    return sorted(str(r[0]) for r in rows.distinct().collect())
