"""Cloud layers: an array of (cover, base) structs per observation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cover codes from the least to the most significant.
COVER_ORDER = ["SKC", "CLR", "FEW", "SCT", "BKN", "OVC"]
CEILING_COVERS = ["BKN", "OVC"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cloud_cover(clouds: Column | str) -> Column:
    """Most significant cover of all layers; unknown codes rank lowest; ``CLR`` without layers.

    Among equally ranked layers the first one wins.
    """
    order = F.array(*[F.lit(code) for code in COVER_ORDER])
    layers = F.filter(
        F.transform(_col(clouds), lambda layer: layer["cover"]), lambda cover: F.nullif(cover, F.lit("")).isNotNull()
    )
    ranked = F.transform(
        layers,
        lambda cover, i: F.struct(
            F.greatest(F.array_position(order, cover) - 1, F.lit(0)).alias("rank"),
            (-i).alias("first"),
            cover.alias("cover"),
        ),
    )
    return F.coalesce(F.array_max(ranked)["cover"], F.lit("CLR"))


def ceiling_ft(clouds: Column | str) -> Column:
    """Base of the first broken or overcast layer that reports one, in feet."""
    layers = F.filter(
        _col(clouds), lambda layer: layer["cover"].isin(CEILING_COVERS) & layer["base"].isNotNull()
    )
    return F.get(layers, F.lit(0))["base"].try_cast("double")
