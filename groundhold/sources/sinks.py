"""Writers of raw tables and snapshot backups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_raw(batch: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append a batch to a raw Parquet table, creating it on first use.

    With ``partition_by`` (flights: ``flightdate``) rows of one value are brought
    together first, so that each partition gets few large files; the REBALANCE
    hint lets adaptive execution split a value that holds much of the batch and
    merge small ones.
    """
    if partition_by is None:
        batch.write.mode("append").parquet(path)
        return
    batch.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A raw Parquet table; the schema keeps date partitions as the text they were."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_json_snapshots(batch: DataFrame, path: str) -> None:
    """Append a batch as JSON lines, NULL fields included."""
    batch.write.mode("append").option("ignoreNullFields", "false").json(path)
