"""Clock and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday order, 1 = Monday.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Fixed values: (first hour, last hour, label); any other hour is "Night".
TIME_BLOCKS = [
    (5, 8, "Early Morning"),
    (9, 11, "Mid Morning"),
    (12, 14, "Afternoon"),
    (15, 17, "Late Afternoon"),
    (18, 20, "Evening"),
]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def scheduled_hour(hhmm: Column | str) -> Column:
    """Hour of an HHMM number: 1430 -> 14, 2400 -> 24."""
    return F.floor(_col(hhmm) / 100).cast("int")


def hhmm_to_minutes(hhmm: Column | str) -> Column:
    """Minutes after midnight of an HHMM number: 1430 -> 870; NULL stays NULL.

    An hour is 100 in HHMM and 60 in minutes, so 40 per hour come off.
    """
    return (_col(hhmm) - F.floor(_col(hhmm) / 100) * 40).cast("int")


def day_name(iso_weekday: Column | str) -> Column:
    """1..7 -> Monday..Sunday, anything else NULL."""
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.get(names, _col(iso_weekday).cast("int") - 1)


def is_weekend(iso_weekday: Column | str) -> Column:
    return F.coalesce(_col(iso_weekday).isin(6, 7), F.lit(False))


def time_block(hour: Column | str) -> Column:
    hour = _col(hour)
    label = F.lit("Night")
    for first, last, name in reversed(TIME_BLOCKS):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label
