"""Connected components by alternating large and small stars, in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of every node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    linked = both.join(least, F.col("u") == F.col("w")).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("w"))
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Loops and edges with a null end are ignored, repeated edges count once. Every
    round writes its edges to the scratch folder; a round costs two grouped minima
    and two joins, and the rounds grow with the logarithm of the longest path.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    clean = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = materialize(clean.select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    state = _state(current)
    while state[0]:
        current = materialize(_small_star(_large_star(current)), "stars")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
