"""Aggregate and cast idioms used across the roll-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``100 * part / whole`` rounded; NULL where ``whole`` is 0.

    The factor is a double: a decimal literal would truncate the quotient.
    """
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), digits)


def mean_positive(minutes: Column | str) -> Column:
    """Mean of the values above zero, unrounded."""
    minutes = F.col(minutes) if isinstance(minutes, str) else minutes
    return F.avg(F.when(minutes > 0, minutes))


def exact_mean(
    value: Column | str, scale: int = 1, over: WindowSpec | None = None, null_as_zero: bool = False
) -> Column:
    """Mean of values already rounded to ``scale`` decimals, unrounded.

    The sum is taken in decimals: a sum of doubles depends on the order in which
    partitions arrive, which is enough to flip the rounding of a mean that lies on
    a half.
    """
    value = F.col(value) if isinstance(value, str) else value
    if null_as_zero:
        value = F.coalesce(value, F.lit(0.0))
    total, count = F.sum(value.cast(f"decimal(18,{scale})")), F.count(value)
    if over is not None:
        total, count = total.over(over), count.over(over)
    return total.cast("double") / F.nullif(count, F.lit(0))


def tolerant_double(text: Column | str) -> Column:
    """Number from feed text: ``10+`` -> 10.0, ``VRB`` -> NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.replace(text, F.lit("+"), F.lit("")).try_cast("double")
