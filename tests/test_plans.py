"""Marts, portfolio questions and serving queries on small hand-made flights."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from groundhold import operators as op
from groundhold import plans


def delayed(minutes, **more):
    late = None if minutes is None else float(minutes >= 15)
    return dict(depdelay=minutes, depdelayminutes=minutes, depdel15=late, **more)


@pytest.fixture(scope="module")
def small(make_flights):
    rows = [
        delayed(14.0), delayed(15.0, weatherdelay=15.0), delayed(16.0, weatherdelay=16.0), delayed(None),
        delayed(None, cancelled=1.0), delayed(40.0, crsdeptime=None), delayed(55.0, lateaircraftdelay=55.0, dest="LAX"),
    ]
    return make_flights(rows)


def test_daily(small):
    (day,) = op.int_airport_daily(op.stg_flights(small)).collect()
    assert (day.total_departures, day.flights_delayed_15, day.pct_delayed_15) == (5, 3, 60.0)
    assert day.avg_dep_delay_min == 20.0  # (14 + 15 + 16 + 0 + 55) / 5: a missing delay counts as zero
    assert (day.flights_cancelled, day.pct_cancelled) == (0, 0.0)
    assert (day.weather_delays, day.late_aircraft_delays) == (1, 1)  # 15 minutes is on time for the cause
    assert (day.avg_weather_delay, day.avg_carrier_delay) == (15.5, None)
    assert (day.routes_served, day.airlines_operating) == (2, 1)


def test_cells_give_the_same_rollups(small):
    stg = op.stg_flights(small)
    cells = op.staged_cells(stg)
    assert op.int_airport_daily(stg).collect() == op.int_airport_daily(cells=cells).collect()
    both = [op.int_route_performance(s, 1, c).orderBy("route_id").collect() for s, c in ((stg, None), (None, cells))]
    assert both[0] == both[1] and [r.cancelled_flights for r in both[0]] == [1, 0]


def test_raw_questions_average_reported_delays_only(small):
    (hub,) = plans.hub_vulnerability_ranking(small, min_departures=1).collect()
    assert (hub.total_departures, hub.avg_dep_delay) == (7, 28.0)  # 140 minutes over 5 reported delays
    assert plans.hub_vulnerability_ranking(small, since="2025-10-16", min_departures=1).count() == 0


def test_mart_schemas(small):
    stg = op.stg_flights(small)
    econ = plans.mart_delay_economics(op.int_airport_daily(stg))
    assert len(econ.columns) == 26
    assert len(plans.mart_cascade_vulnerability(econ).columns) == 13
    assert len(plans.mart_route_economics(op.int_route_performance(stg)).columns) == 18


def test_materialized_marts(spark, small, tmp_path):
    paths = plans.materialize_marts(small, str(tmp_path), min_flights=1, min_departures=1)
    again = plans.materialize_marts(small, str(tmp_path), min_flights=1, min_departures=1)
    assert paths == again
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts["mart_delay_economics"] == 1 and counts["mart_route_economics"] == 2


def test_trend(make_flights):
    days = [date(2025, 10, 1) + timedelta(days=n) for n in range(20) if n != 9]
    flights = make_flights([delayed(float(10 * n), flightdate=str(day)) for n, day in enumerate(days)])
    rows = plans.rolling_delay_trend(flights).collect()
    assert [r.flightdate for r in rows] == [str(d) for d in days[7:]]
    assert rows[0].rolling_7day_avg_delay == 40.0  # the days before the cut count: (10 + ... + 70) / 7
    assert [r.wow_delay_change for r in rows[:7]] == [None] * 7
    assert {r.trend_status for r in rows[:7]} == {"STABLE"}
    assert (rows[7].wow_delay_change, rows[7].trend_status) == (70.0, "WORSENING")


def test_hours(make_flights):
    rows = [delayed(20.0, crsdeptime=t) for t in (459.0, 500.0, 2359.0, 2400.0)] + [
        delayed(0.0, crsdeptime=1200.0, carrierdelay=5.0), delayed(20.0, crsdeptime=None),
    ]
    got = {r.dep_hour: r for r in plans.delay_cause_by_hour(make_flights(rows)).collect()}
    assert set(got) == {5, 12, 23}
    assert got[12].pct_carrier_caused is None and got[12].avg_carrier_delay == 5.0


def test_scorecard_tiers(make_flights):
    rows = []
    for n in range(2):
        for airline, minutes in (("AA", 2.0), ("UA", 20.0), ("DL", 12.0)):
            rows += [delayed(minutes, dest=f"D{n}", iata_code_reporting_airline=airline)] * 2
    rows += [delayed(90.0, dest="D9", iata_code_reporting_airline="AA")] * 2  # no peer there
    got = {r.airline: r for r in plans.airline_scorecard(make_flights(rows), min_flights=2, min_routes=2).collect()}
    assert {a: r.performance_tier for a, r in got.items()} == {"AA": "OUTPERFORMER", "DL": "AVERAGE", "UA": "UNDERPERFORMER"}
    assert [got[a].performance_percentile for a in ("AA", "DL", "UA")] == [0.0, 0.5, 1.0]


def test_route_prices_count_missing_delays_as_zero(make_flights):
    flights = make_flights([delayed(60.0), delayed(15.0), delayed(None), delayed(0.0)])
    (route,) = plans.route_economic_impact(flights, min_flights=4).collect()
    assert (route.route, route.avg_delay_min) == ("ORD → EWR", 25.0)
    assert route.est_airline_ops_cost == round(2 * 15.0 * 68.48)


def test_top_n_gives_what_is_asked(spark):
    numbers = spark.range(100).withColumn("v", F.col("id") % 10)
    assert op.top_n(numbers, "v", 99, ["id"]).count() == 99
    assert op.top_n(numbers, "v", -3, ["id"]).collect()[0].id == 9


def test_kpis_with_missing_values(spark):
    econ = spark.createDataFrame(
        [("A", 1, 10.0, 20.0, 5.0), ("B", 2, None, None, 6.0)],
        "airport string, total_departures long, avg_dep_delay_min double, pct_delayed_15 double, est_total_economic_impact double",
    )
    assert tuple(plans.overview_kpis(econ).first()) == (3, 10.0, 20.0, 11.0)
    assert tuple(plans.overview_kpis(econ, null_as_zero=True).first()) == (3, 5.0, 10.0, 11.0)


def test_metric_query_rejects_unknown_names(small):
    econ = plans.mart_delay_economics(op.int_airport_daily(op.stg_flights(small)))
    with pytest.raises(ValueError):
        plans.metric_query(econ, ["profit"])
    assert plans.metric_query(econ, ["total_departures"]).first()[0] == 5


def test_hot_airport_keeps_every_flight(make_flights):
    """A third of all flights at one airport, day and airline, most of them equal."""
    hot = [delayed(30.0)] * 300
    rest = [delayed(float(n % 40), origin=f"A{n % 9}", flightdate=f"2025-10-{1 + n % 28:02}") for n in range(600)]
    days = op.int_airport_daily(op.stg_flights(make_flights(hot + rest)))
    assert days.agg(F.sum("total_departures")).first()[0] == 900
    assert days.filter("airport = 'ORD'").first().avg_dep_delay_min == 30.0


def by_day(make_flights, days, delay=20.0, **more):
    return [dict(flightdate=f"2025-10-{day:02}", **delayed(delay + day, **more)) for day in days]


def files(folder):
    return {p.relative_to(folder): (p.stat().st_mtime_ns, p.stat().st_size) for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("case", ["changed", "added", "gone", "sparse"])
def test_refresh_equals_a_full_build(spark, make_flights, tmp_path, case):
    """Days that change, appear or vanish; airports with rows on few days; files of days that no mean reaches stay as they are."""
    base = by_day(make_flights, range(1, 29)) + by_day(make_flights, [1, 2, 3, 9, 14, 15, 20, 21, 22, 27], 50.0, origin="ATL", dest="ORD")
    before, after, days = list(base), list(base), ["2025-10-10"]
    if case == "changed":
        after += by_day(make_flights, [10], 90.0)
    elif case == "added":
        before = [r for r in base if r["flightdate"] != "2025-10-10"]
    elif case == "gone":
        after, days = [r for r in base if r["flightdate"] not in ("2025-10-10", "2025-10-11")], ["2025-10-10", "2025-10-11"]
    else:
        after, days = base + by_day(make_flights, [3], 90.0, origin="ATL", dest="ORD"), ["2025-10-03"]
    plans.build_days(make_flights(before), str(tmp_path / "a"))
    held = files(tmp_path / "a")
    refreshed = plans.refresh_days(make_flights(after), str(tmp_path / "a"), days)
    full = plans.build_days(make_flights(after), str(tmp_path / "b"))
    assert sorted(map(tuple, refreshed.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    kept = {path for path, stamp in files(tmp_path / "a").items() if held.get(path) == stamp}
    first = {"2025-10-01", "2025-10-02"} | (set() if case == "sparse" else {"2025-10-08", "2025-10-28"})
    for day in first:
        assert any(f"mart_delay_economics/flight_date={day}/" in str(p) for p in kept), day
    changed = {str(p).split("=")[1][:10] for p in set(files(tmp_path / "a")) - kept if "flight_cells" in str(p)}
    assert changed <= set(days)


def test_refresh_needs_a_day(make_flights, tmp_path):
    with pytest.raises(ValueError, match="day"):
        plans.refresh_days(make_flights([{}]), str(tmp_path), [])


def test_distinct_counts_merge(spark):
    """Values beyond one bucket, nulls, a value that only a later book knows, and no expansion of rows."""
    rows = [(f"d{n % 7}", f"v{n}", None if n % 3 else n % 5) for n in range(70_000)]
    table = spark.createDataFrame(rows, "day string, a string, b int")
    old = op.code_book(table.filter("day < 'd3'"), ["a", "b"])
    book = op.code_book(table, ["a", "b"], old)
    assert book.count() == book.select("column_name", "code").distinct().count() == 70_005
    assert old.join(book, ["column_name", "value", "code"]).count() == old.count()
    found = op.distinct_over(op.daily_presence(table, "day", ["a", "b"], book), {"all": ("d0", "d9"), "two": ("d1", "d2"), "none": ("x", "y")})
    got = {(r.range_name, r.column_name): r.distinct_values for r in found.collect()}
    assert got == {("all", "a"): 70_000, ("all", "b"): 5, ("two", "a"): 20_000, ("two", "b"): 5}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
