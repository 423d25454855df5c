"""Cascade operators against brute force, also with a hot group and copies."""

import random
from collections import Counter, defaultdict

import pytest

from groundhold.operators import cascade
from groundhold.operators import (
    cascade_by_destination,
    cascade_chain,
    cascade_destination_detail,
    cascade_estimate,
    cascade_impact,
    cascade_matches,
)

DAY = "2025-10-15"


def hhmm(minute):
    return float(minute // 60 * 100 + minute % 60)


def inbound(minute, delay, airline="UA", day=DAY, number=1, hub="ORD", origin="EWR"):
    return dict(
        dest=hub, origin=origin, flightdate=day, iata_code_reporting_airline=airline, flight_number_reporting_airline=number,
        crsarrtime=None if minute is None else hhmm(minute), arrdelayminutes=delay, crsdeptime=None,
    )


def outbound(minute, delay=0.0, airline="UA", day=DAY, number=9, hub="ORD", dest="LAX", cancelled=0.0):
    return dict(
        origin=hub, dest=dest, flightdate=day, iata_code_reporting_airline=airline, flight_number_reporting_airline=number,
        crsdeptime=None if minute is None else hhmm(minute), depdelayminutes=delay, cancelled=cancelled, arrdelayminutes=None,
    )


def minutes(value):
    return None if value is None else int(value // 100 * 60 + value % 100)


def pairs(rows, limit, late=15):
    """(departure, inbound, gap) by the definition."""
    for o in rows:
        if o["cancelled"] != 0 or o["crsdeptime"] is None:
            continue
        for i in rows:
            same = all(i[a] == o[b] for a, b in (("dest", "origin"), ("flightdate", "flightdate"),
                       ("iata_code_reporting_airline", "iata_code_reporting_airline")))
            if not same or i["arrdelayminutes"] is None or i["arrdelayminutes"] < late or i["crsarrtime"] is None:
                continue
            gap = minutes(o["crsdeptime"]) - minutes(i["crsarrtime"])
            if 20 <= gap <= limit and i["arrdelayminutes"] > gap:
                yield o, i, gap


def complete(row):
    base = dict(cancelled=0.0, arrdelayminutes=None, depdelayminutes=None, crsarrtime=None, crsdeptime=None)
    return {**base, **row}


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)
    rows = []
    for n in range(420):
        hot = n % 3 == 0  # a third of all flights in one (hub, day, airline)
        where = dict(
            airline="UA" if hot else rng.choice(["UA", "AA", "DL"]),
            day=DAY if hot else rng.choice([DAY, "2025-10-16"]),
            hub="ORD" if hot else rng.choice(["ORD", "ATL"]),
            number=rng.randrange(1, 60),
        )
        if rng.random() < 0.5:
            delay = rng.choice([None, 0.0, 14.0, 15.0, 20.0, 21.0, 30.5, 50.0, 90.0, 200.0])
            rows.append(inbound(rng.choice([None, *range(300, 1439)]), delay, **where))
        else:
            delay = rng.choice([None, 0.0, 5.0, 40.0])
            rows.append(
                outbound(rng.randrange(300, 1441), delay, dest=rng.choice(["LAX", "SFO", "BOS"]),
                         cancelled=rng.choice([0.0, 0.0, 0.0, 1.0]), **where)
            )
    copies = rows[3:6] * 40  # a group of equal rows
    return [complete(r) for r in rows + copies]


def test_window_edges(make_flights):
    """Gaps 19, 20, 135, 136; delay equal to the gap; other airline; other day."""
    rows = [
        inbound(600, 200.0),
        *[outbound(600 + gap, number=gap) for gap in (19, 20, 135, 136)],
        inbound(900, 60.0, airline="AA"),
        outbound(960, airline="AA", number=60),  # delay equals the gap
        outbound(959, airline="AA", number=59),  # delay exceeds it by one
        outbound(640, airline="DL", number=77),
        outbound(640, day="2025-10-16", number=78),
    ]
    got = {(r.flight_num, r.departure_minute, r.late_inbound) for r in cascade_matches(make_flights(rows), 90).collect()}
    assert got == {(20, 620, 1), (135, 735, 1), (59, 959, 1)}


@pytest.mark.parametrize("delay", [15, 60, 240])
def test_matches(make_flights, random_rows, delay):
    rows = [dict(row, place=place) for place, row in enumerate(random_rows)]
    reached = defaultdict(list)
    for o, i, _ in pairs(rows, 45 + delay):
        reached[o["place"]].append(i["arrdelayminutes"])
    expected = Counter(
        (o["origin"], o["flightdate"], o["iata_code_reporting_airline"], o["dest"], o["flight_number_reporting_airline"],
         minutes(o["crsdeptime"]), o["depdelayminutes"], len(late), max(late))
        for place, late in reached.items() for o in [rows[place]]
    )
    got = cascade_matches(make_flights(random_rows), delay).collect()
    assert Counter(tuple(r)[:8] + (r.max_inbound_delay,) for r in got) == expected and len(got) > 10
    means = sorted(sum(late) / len(late) for late in reached.values())
    assert sorted(r.avg_inbound_delay for r in got) == pytest.approx(means, abs=0.051)


def test_hot_group_is_summed_by_minutes(make_flights):
    """Most flights in one group: windows see rows summed by minute, and no stretch is spread over its minutes."""
    rows = [complete(inbound(600 + n % 5, 200.0, number=n)) for n in range(1_000)]
    rows += [complete(outbound(700, 40.0, number=n)) for n in range(1_000)]
    got = cascade_matches(make_flights(rows), 90).collect()
    assert len(got) == 1_000 and {(r.late_inbound, r.max_inbound_delay) for r in got} == {(1_000, 200.0)}
    _, one = cascade_chain(make_flights(rows)).collect()
    assert (one.flights_affected, one.avg_delay_propagated) == (1_000, 40.0)
    text = cascade_chain(make_flights(rows), hub=None, date=None)._jdf.queryExecution().executedPlan().toString()
    assert "sequence" not in text
    reach = cascade._reach(make_flights(rows), 15, 20, 135, True, True)
    assert [tuple(r)[3:6] for r in reach.collect()] == [(700, 1_000, 200_000.0)]


@pytest.mark.parametrize("first_last", [(20, 20), (20, 21), (1, 64), (20, 200), (30, 10)])
def test_longest_delay_by_doubling(make_flights, first_last):
    """Stretches of every length from one minute on, against every inbound flight of every departure."""
    first, last = first_last
    rng = random.Random(11)
    rows = [complete(inbound(rng.randrange(200, 700), float(rng.choice([15, 18, 22, 23, 35, 60, 61, 64, 130, 300, 16.5])))) for _ in range(120)]
    rows += [complete(outbound(m)) for m in range(200, 960, 3)]
    expected = {}
    for m in range(200, 960, 3):
        found = [i["arrdelayminutes"] for i in rows if i["crsarrtime"] is not None
                 and first <= m - minutes(i["crsarrtime"]) <= last and i["arrdelayminutes"] > m - minutes(i["crsarrtime"])]
        if found:
            expected[m] = (len(found), sum(found), max(found))
    got = cascade._reach(make_flights(rows), 15, first, last, True, True).collect()
    assert {r.minute: (r.late_inbound, r.inbound_minutes, r.max_inbound_delay) for r in got} == expected


def test_by_destination(make_flights, random_rows):
    groups = defaultdict(list)
    for o, i, _ in pairs(random_rows, 135):
        groups[o["origin"], o["flightdate"], o["dest"]].append((o["depdelayminutes"], i["arrdelayminutes"]))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in cascade_by_destination(make_flights(random_rows), 90).collect()}
    assert got.keys() == groups.keys()
    for key, found in groups.items():
        timed = [d for d, _ in found if d is not None]
        count, out_mean, in_mean = got[key]
        assert count == len(found)
        assert out_mean == (pytest.approx(sum(timed) / len(timed), abs=0.051) if timed else None)
        assert in_mean == pytest.approx(sum(d for _, d in found) / len(found), abs=0.051)


def test_impact(make_flights, random_rows):
    delays = [1, 15, 60, 240]
    got = {
        (r.airport, r.flight_date, r.trigger_delay_minutes): r
        for r in cascade_impact(make_flights(random_rows), delays).collect()
    }
    days = {(r["dest"], r["flightdate"]) for r in random_rows}
    assert {k[:2] for k in got} == days and len(got) == len(days) * len(delays)
    for delay in delays:
        counts, direct = defaultdict(Counter), Counter()
        for r in random_rows:
            direct[r["dest"], r["flightdate"]] += (r["arrdelayminutes"] or 0) > 0
        for o, _, _ in pairs(random_rows, 45 + delay):
            counts[o["origin"], o["flightdate"]][o["dest"]] += 1
        for day in days:
            row = got[(*day, float(delay))]
            assert row.directly_affected_flights == direct[day]
            assert row.cascade_affected_flights == counts[day].total()
            order = sorted(counts[day].items(), key=lambda kv: (-kv[1], kv[0]))
            assert row.affected_destinations == [dest for dest, _ in order]
            assert row.total_affected_passengers == int((direct[day] + counts[day].total()) * 160 * 0.87)


def test_impact_of_many_scenarios(make_flights, random_rows):
    """Five hundred trigger delays: tiers in several rows, one job; each scenario agrees with one asked for alone."""
    flights, delays = make_flights(random_rows), [d / 2 for d in range(1, 501)]
    many = cascade_impact(flights, delays)
    got = {(r.airport, r.flight_date, r.trigger_delay_minutes): r for r in many.collect()}
    days = {(r["dest"], r["flightdate"]) for r in random_rows}
    assert len(got) == 500 * len(days)
    counts = Counter((o["origin"], o["flightdate"], gap) for o, _, gap in pairs(random_rows, 1440))
    for (hub, day, delay), r in got.items():
        limit = 45 + int(delay)
        assert r.cascade_affected_flights == sum(n for (h, d, gap), n in counts.items() if (h, d) == (hub, day) and gap <= limit)
    for delay in (0.5, 33.0, 250.0):
        for r in cascade_impact(flights, [delay]).collect():
            assert r == got[r.airport, r.flight_date, delay]


def test_impact_without_a_tier(make_flights):
    """A window that no scenario reaches: direct flights only; days with departures alone have no row."""
    flights = make_flights([inbound(600, 30.0), outbound(630, dest="ORD"), outbound(630, hub="XXX", dest="ORD")])
    (row,) = cascade_impact(flights, [1], window=cascade.ConnectionWindow(min_gap=100)).collect()
    assert (row.airport, row.directly_affected_flights, row.cascade_affected_flights, row.affected_destinations) == ("ORD", 1, 0, [])


def test_impact_of_a_day_without_flights(make_flights):
    flights = make_flights([inbound(600, 30.0)])
    (row,) = cascade_impact(flights, [90], hubs=["XXX"], dates=["2030-01-01"]).collect()
    assert (row.airport, row.total_flights_affected, row.total_economic_impact) == ("XXX", 0, 0.0)
    assert row.affected_destinations == []


def test_destination_detail(make_flights):
    rows = [inbound(600, 200.0), inbound(610, 200.0)]
    rows += [outbound(640, 10.0, dest=f"D{n:02}") for n in range(12)] + [outbound(645, 21.0, dest="D11")]
    got = {r.outbound_dest: (r.flights, r.avg_delay) for r in cascade_destination_detail(make_flights(rows), 90).collect()}
    assert set(got) == {"D11", *[f"D{n:02}" for n in range(9)]}  # D11 leads, then by name
    assert got["D11"] == (2, 16.0)


def test_chain(make_flights):
    rows = [
        inbound(600, 30.0, number=1), inbound(620, 50.0, number=2), inbound(None, 40.0, number=3), inbound(600, 29.0, number=4),
        outbound(640, 10.0, number=11, dest="LAX"),  # after both
        outbound(780, 20.0, number=12, dest="SFO"),  # after both (gaps 180 and 160)
        outbound(790, 40.0, number=13, dest="SFO"),  # after the second only
        outbound(640, 0.0, number=14), outbound(640, 9.0, number=15, cancelled=1.0),
    ]
    zero, one = cascade_chain(make_flights(rows)).collect()
    assert tuple(zero)[2:] == (0, 3, 1, 40.0, 30.0, 50.0, 3 * 160 * 0.87)
    assert tuple(one)[2:6] == (1, 3, 2, 20.0)  # (10*2 + 20*2 + 40) / 5
    (empty,) = cascade_chain(make_flights(rows), hub="XXX").collect()
    assert (empty.cascade_level, empty.flights_affected, empty.destinations_affected, empty.avg_delay_propagated) == (0, 0, 1, None)


def test_estimate_rounds_halves_up(spark):
    schema = "airport string, operating_days long, total_departures long, avg_pct_delayed double, max_routes_served long, max_airlines long"
    rows = [("A", 10, 250, 10.0, 100, 10), ("B", 0, 5, 100.0, 0, 0)]
    got = {(r.airport, r.delay_minutes): r for r in cascade_estimate(spark.createDataFrame(rows, schema), [60, 600]).collect()}
    a = got["A", 60.0]
    assert (a.directly_affected_flights, a.cascade_multiplier, a.cascade_affected_flights) == (3, 1.4, 4)
    assert got["A", 600.0].cascade_multiplier == 4.2  # the delay factor stops at 3
    assert got["B", 60.0].directly_affected_flights == 5
