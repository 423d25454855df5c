"""Exact distinct counts that merge: one bitmap of values per day, united over any range of days.

A distinct count over a range is usually made from all its rows, anew for every range. Here each day keeps which values it
has as bits, the union of days is an ``or``, and a count is the number of bits, so ranges cost days and not flights. No row
is expanded per distinct column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def code_book(rows: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """column_name, value, code: a number from 1 per value of each column, NULLs left out.

    With ``known``, a book made earlier, its codes stay and new values follow, so old bitmaps stay valid. The window runs
    over the distinct values of one column.
    """
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in columns]
    values = rows.select(F.inline(F.array(*pairs))).filter("value is not null").distinct()
    number = F.row_number().over(Window.partitionBy("column_name").orderBy("value")).cast("long")
    if known is None:
        return values.withColumn("code", number)
    last = known.groupBy("column_name").agg(F.max("code").alias("last"))
    fresh = values.join(known, ["column_name", "value"], "left_anti").withColumn("code", number)
    fresh = fresh.join(last, "column_name", "left").withColumn("code", F.col("code") + F.coalesce("last", F.lit(0))).drop("last")
    return known.select("column_name", "value", "code").unionByName(fresh)


def daily_presence(rows: DataFrame, day: str, columns: Sequence[str], book: DataFrame) -> DataFrame:
    """day, column_name, bucket, bits: which values each day has, 32,768 codes to a bucket.

    Values are made distinct per day before they meet the code book, so the join and the bitmaps see days and values only.
    """
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in columns]
    seen = rows.select(F.col(day).alias("day"), F.inline(F.array(*pairs))).filter("value is not null").distinct()
    coded = seen.join(book, ["column_name", "value"])
    return coded.groupBy("day", "column_name", F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")
    )


def distinct_over(presence: DataFrame, ranges: Mapping[str, tuple[str, str]]) -> DataFrame:
    """range_name, column_name, distinct_values for every range of days (first and last day, both included)."""
    if not ranges:
        raise ValueError("name a range")
    text = F.col("day").cast("string")
    named = [F.when(text.between(*map(F.lit, ends)), F.lit(name)) for name, ends in ranges.items()]
    within = presence.select("column_name", "bucket", "bits", F.explode(F.array(*named)).alias("range_name")).filter("range_name is not null")
    buckets = within.groupBy("range_name", "column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return buckets.groupBy("range_name", "column_name").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))
