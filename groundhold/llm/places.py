"""Exact places of rows in sorted groups of any size, without a window over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, small

# monotonically_increasing_id() holds the number of the partition above these bits and that of the row in them below.
ROW_BITS = 33


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Adds place (from 0, long) and places (rows of the group, long); ``group`` may be empty. The result is materialized rows.

    Rows are range-partitioned by group and order, so a group that holds much of the table spreads over partitions. Each
    partition sorts its rows and numbers them; what the group has in earlier partitions is added. The table of those counts
    has a row per group and one per partition boundary inside a group. Rows that tie are told apart by a number of their
    own, so even a group of equal rows is split. Nulls in ``group`` are a group.
    """
    keys = [F.asc_nulls_first(g) for g in group] + list(order)
    numbered = rows.withColumn("__tie", F.monotonically_increasing_id())
    keys.append(F.col("__tie"))
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", ROW_BITS)
    stored = stored.withColumn("__split", part)
    counts = stored.groupBy(*group, "__split").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    earlier = whole.orderBy("__split").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"__of_{g}") for g in group], F.col("__split").alias("__of_split"),
        (F.col("__first") - F.coalesce(F.sum("__n").over(earlier), F.lit(0))).alias("__shift"),
        F.sum("__n").over(whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("places"),
    )
    same = F.col("__split") == F.col("__of_split")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__of_{g}"))
    found = stored.join(small(materialize(offsets, f"{name}-offsets")), same)
    return found.select(*rows.columns, (F.col("__at") - F.col("__shift")).alias("place"), "places")
