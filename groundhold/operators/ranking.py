"""Row-based windows, top lists and the vulnerability score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact_mean


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rolling_7row_avg(
    value: Column | str, key: str | Sequence[str], order: str, rows: int = 7, digits: int = 1, scale: int | None = 1
) -> Column:
    """Mean of the current and the ``rows - 1`` rows before it, per key.

    Values are taken as rounded to ``scale`` decimals; ``None`` averages them as they are.

    The frame counts rows, not days. Feed it daily roll-ups: a key's partition is
    then as long as the calendar, however many flights there are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    mean = F.avg(_col(value)).over(frame) if scale is None else exact_mean(value, scale, over=frame)
    return F.round(mean, digits)


def top_n(
    df: DataFrame, order: str, n: int, tiebreak: Sequence[str], descending: bool = True
) -> DataFrame:
    """First ``n`` rows (at least one) by ``order``; ``tiebreak`` makes the cut repeatable."""
    first = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(max(1, n))


def distinct_dates(econ: DataFrame, airport: str, n: int = 30) -> DataFrame:
    """Newest dates on which an airport has rows."""
    dates = econ.filter(F.col("airport") == airport).select("flight_date").distinct()
    return dates.orderBy(F.col("flight_date").desc()).limit(n)


def vulnerability_score(pct: Column | str, late: Column | str, routes: Column | str, airlines: Column | str) -> Column:
    """Unrounded weighted sum of delay rate, late-aircraft minutes, routes and airlines."""
    return (
        _col(pct) * F.lit(0.3)
        + F.coalesce(_col(late), F.lit(0.0)) * F.lit(0.1)
        + _col(routes) * F.lit(0.05)
        + _col(airlines) * F.lit(2.0)
    )
