"""Route names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_id(origin: Column | str, dest: Column | str, sep: str = "-") -> Column:
    """``ORD-EWR``, or ``ORD → EWR`` with ``sep=" → "``; NULL if either end is NULL."""
    return F.concat(origin, F.lit(sep), dest)
