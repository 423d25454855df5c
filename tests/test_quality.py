"""Health checks, inventory and assertions."""

import pytest

from groundhold import operators as op
from groundhold.operators import Expectation

NOW = "2025-10-15T12:00:00Z"


def health(spark, rows, least=1, column="polled_at", limit=6, required=("k",), now=NOW):
    table = spark.createDataFrame(rows, "k string, polled_at string")
    expect = {"t": Expectation(least, required, column, limit)}
    row = op.table_health({"t": table}, expect, now).first()
    return row.status, row.issues


FRESH = "2025-10-15T11:00:00+00:00"


@pytest.mark.parametrize(
    "rows, more, status, issue",
    [
        ([("a", FRESH)], {}, "healthy", "no issues"),
        ([], {}, "critical", "no rows"),
        ([("a", FRESH)], {"least": 1500}, "warning", "only 1 rows, wanted at least 1,500"),
        ([("a", "2025-10-15T05:30:00Z")], {}, "stale", "newest row 6.5 hours old, limit 6h"),
        ([("a", "2025-10-15 05:30:00")], {}, "stale", "newest row 6.5 hours old, limit 6h"),
        ([("a", "2025-10-15T06:00:00")], {}, "healthy", "no issues"),
        ([("a", "2025-10-15T07:30:00+02:00")], {}, "stale", "newest row 6.5 hours old, limit 6h"),
        ([("a", "yesterday")], {}, "healthy", "unreadable time of the newest row: yesterday"),
        ([("a", FRESH)], {"required": ("k", "x", "y")}, "critical", "columns not found: ['x', 'y']"),
        ([(None, FRESH)] + [("a", FRESH)] * 4, {}, "healthy", "no issues"),
        ([(None, FRESH)] * 21 + [("a", FRESH)] * 79, {}, "warning", "Column 'k': 21.0% of values null"),
    ],
)
def test_status(spark, rows, more, status, issue):
    assert health(spark, rows, **more) == (status, [issue])


def test_null_share_overrules(spark):
    status, issues = health(spark, [(None, "2025-01-01T00:00:00Z")], required=("k", "x"))
    assert status == "warning" and len(issues) == 3


def test_rollup_and_issues(spark):
    good = spark.createDataFrame([("a", FRESH)], "k string, polled_at string")
    expect = {name: Expectation(least, ("k",)) for name, least in (("good", 1), ("small", 5), ("gone", 1))}

    def overall(*names):
        chosen = {name: expect[name] for name in names}
        return op.health_rollup(op.table_health({"good": good, "small": good}, chosen, NOW)).first().overall_status

    assert (overall("good"), overall("good", "small"), overall("good", "gone")) == ("HEALTHY", "DEGRADED", "CRITICAL")
    issues = op.detect_issues(op.table_health({"good": good, "small": good}, expect, NOW)).collect()
    assert {(r.table, r.severity) for r in issues} == {("small", "warning"), ("gone", "critical")}


def test_inventory(spark):
    full = spark.createDataFrame([("a", "2025")], "k string, d string")
    tables = {"full": full, "empty": full.limit(0)}
    rows = {r.table: r for r in op.table_inventory(tables, {"full": "d"}, {"full": "batch"}).collect()}
    assert (rows["full"].latest_record, rows["full"].source_type, rows["full"].status) == ("2025", "batch", "healthy")
    assert (rows["empty"].latest_record, rows["empty"].status, rows["empty"].overall_status) == ("N/A", "empty", "degraded")
    assert rows["full"].healthy_sources == "1/2"


def test_load_summary(make_flights):
    flights = make_flights([{}, {"dest": "LAX", "depdelayminutes": None, "cancelled": 1.0, "flightdate": "2025-11-01"}])
    row = op.load_summary(flights).first()
    assert tuple(row) == (2, 1, 2, "2025-10-15", "2025-11-01", 0.0, 0.0, 50.0)


def test_assertion(spark):
    df = spark.createDataFrame([(float(n),) for n in range(-20, 5)], "dep_delay_abs_minutes double")
    assert op.assert_non_negative_delay(df).count() == 10
    assert op.assert_non_negative_delay(df.filter("dep_delay_abs_minutes >= 0")).isEmpty()
