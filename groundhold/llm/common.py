"""Helpers shared by the operators: words, intermediate tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# White space as the contracts define it, for Java's and RE2's regular expressions and for trimming.
SPACE = r"[\x20\x09-\x0D]"
SPACES = SPACE + "+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

# A side of a join is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null, empty and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared scratch folder and reads it back.

    Cuts the lineage: what is read survives the loss of executors, and later plans
    know its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a materialized table for broadcast if it was counted as small; else leaves the join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def numbered(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """Adds __row, a number that tells rows apart and orders them.

    Where all ids are there and differ, it is the id. Else the rows are written once with a number each.
    """
    ids = docs.groupBy(F.col(id_col).alias("id")).count()
    if ids.filter("id is null or count > 1").isEmpty():
        return docs.withColumn("__row", F.col(id_col).cast("long"))
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id()), name)
