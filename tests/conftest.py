import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from groundhold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(
        4, shuffle_partitions=4, **{"spark.checkpoint.dir": folder, "spark.ui.showConsoleProgress": "false"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_flights(spark):
    """Raw flights from partial rows; unnamed columns get plain defaults."""
    from groundhold.schemas import RAW_FLIGHTS

    defaults = {
        "year": 2025, "quarter": 4, "month": 10, "dayofmonth": 15, "dayofweek": 3, "flightdate": "2025-10-15",
        "reporting_airline": "UA", "iata_code_reporting_airline": "UA", "flight_number_reporting_airline": 1,
        "origin": "ORD", "origincityname": "Chicago", "originstate": "IL", "dest": "EWR", "destcityname": "Newark",
        "deststate": "NJ", "crsdeptime": 1200.0, "crsarrtime": 1400.0, "depdelay": 0.0, "depdelayminutes": 0.0,
        "depdel15": 0.0, "arrdelay": 0.0, "arrdelayminutes": 0.0, "arrdel15": 0.0, "cancelled": 0.0, "diverted": 0.0,
    }

    def make(rows):
        full = [tuple({**defaults, **row}.get(name) for name in RAW_FLIGHTS.names) for row in rows]
        return spark.createDataFrame(full, RAW_FLIGHTS)

    return make
