"""Cost model and thresholds shared by the marts, the reports and the cascade operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published cost model (parameter_name, value, unit, source).
COST_PARAMETER_ROWS = [
    ("passenger_delay_cost_per_minute", 0.74, "USD", "FAA/NEXTOR II (2025-adjusted)"),
    ("airline_ops_cost_per_minute", 68.48, "USD", "FAA/NEXTOR II (2025-adjusted)"),
    ("avg_load_factor", 0.87, "ratio", "US domestic average 2025"),
    ("avg_seats_domestic", 160.0, "count", "US domestic average 2025"),
]


@dataclass(frozen=True)
class CostParameters:
    """Dollars per delayed minute, and how many passengers a flight carries."""

    passenger_minute: float = 0.74
    flight_minute: float = 68.48
    load_factor: float = 0.87
    seats: int = 160

    @classmethod
    def from_table(cls, parameters: DataFrame) -> "CostParameters":
        """Read the four named values from a (parameter_name, value) table."""
        names = [row[0] for row in COST_PARAMETER_ROWS]
        rows = (
            parameters.filter(parameters.parameter_name.isin(names))
            .select("parameter_name", "value")
            .groupBy("parameter_name")
            .agg(F.min("value").alias("value"), F.max("value").alias("most"))
            .collect()  # one row per name
        )
        conflicting = sorted(row.parameter_name for row in rows if row.value != row.most)
        if conflicting:
            raise ValueError(f"cost parameters with several values: {conflicting}")
        values = {row.parameter_name: row.value for row in rows}
        missing = [name for name in names if name not in values]
        if missing:
            raise ValueError(f"cost parameters missing: {missing}")
        return cls(
            passenger_minute=float(values["passenger_delay_cost_per_minute"]),
            flight_minute=float(values["airline_ops_cost_per_minute"]),
            load_factor=float(values["avg_load_factor"]),
            seats=int(values["avg_seats_domestic"]),
        )


DEFAULT_COSTS = CostParameters()
