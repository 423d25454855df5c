"""Cascading delays: late inbound flights and the departures they put at risk.

A departure is at risk from an inbound flight of the same airline, hub and day
when it is scheduled within a window of minutes after the inbound's scheduled
arrival, and (for cascades) when the inbound delay exceeds that gap. Minutes are
minutes of the day; windows do not wrap around midnight.

Counts and means never build the pairs. An inbound flight covers one stretch of
departure minutes, which is noted as +n where the stretch starts and -n after it
ends. A running sum over the minutes of one (hub, day, airline) then tells for every
departure minute how many inbound flights reach it. The longest delay that reaches a
minute is found by doubling: a stretch is covered by two of the largest power of two
that fits, and a minute takes the largest of one sliding maximum per power. The rows
of one (hub, day, airline) are bounded by the minutes of a day (times the hub's
destinations, where departures go by destination), whatever the number of flights, so
a hub that holds a third of the data is no slower to sum than any other. Where the
flights themselves are wanted (matches, chain), they are joined to the minutes by
equality, which adaptive execution can split where a group is hot.

Several trigger delays share one pass: the gap window is cut into tiers at the
upper ends of the scenarios, and a scenario adds up the tiers below its own end.
Tiers lie side by side in columns, a fixed number of them to a row, so that neither
expressions nor columns grow with the scenarios.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hhmm_to_minutes
from ..params import DEFAULT_COSTS, CostParameters

GROUP = ["hub", "flightdate", "airline"]


@dataclass(frozen=True)
class ConnectionWindow:
    """Which gaps, in minutes, connect an inbound flight to a departure."""

    min_gap: int = 20
    turnaround: int = 45

    def last_gap(self, delay: float) -> int:
        return self.turnaround + int(delay)


DEFAULT_WINDOW = ConnectionWindow()


def _restrict(flights: DataFrame, hub: str, hubs, dates) -> DataFrame:
    if hubs is not None:
        flights = flights.filter(F.col(hub).isin(list(hubs)))
    if dates is not None:
        flights = flights.filter(F.col("flightdate").isin(list(dates)))
    return flights


def _inbound(flights: DataFrame, hubs=None, dates=None) -> DataFrame:
    return _restrict(flights, "dest", hubs, dates).select(
        F.col("dest").alias("hub"),
        "flightdate",
        F.col("iata_code_reporting_airline").alias("airline"),
        F.col("flight_number_reporting_airline").alias("flight_num"),
        F.col("origin").alias("arrived_from"),
        hhmm_to_minutes("crsarrtime").alias("arr_minute"),
        F.col("arrdelayminutes").alias("inbound_delay"),
    )


def _outbound(flights: DataFrame, hubs=None, dates=None) -> DataFrame:
    flown = flights.filter((F.col("cancelled") == 0) & F.col("crsdeptime").isNotNull())
    return _restrict(flown, "origin", hubs, dates).select(
        F.col("origin").alias("hub"),
        "flightdate",
        F.col("iata_code_reporting_airline").alias("airline"),
        F.col("flight_number_reporting_airline").alias("flight_num"),
        F.col("dest").alias("outbound_dest"),
        hhmm_to_minutes("crsdeptime").alias("minute"),
        F.col("depdelayminutes").alias("outbound_delay"),
    )


def _longest_gap() -> Column:
    """Largest whole gap that an inbound delay still exceeds."""
    return (F.ceil("inbound_delay") - 1).cast("int")


# --------------------------------------------------------------------------- loads


def _connection_load(
    inbound: DataFrame, departures: DataFrame, tiers: list[tuple[int, int]], weights: dict[str, Column]
) -> DataFrame:
    """Departure bins with, per tier and weight, the inbound weight that reaches their minute.

    ``inbound`` holds flights with ``arr_minute`` and ``longest_gap``; a tier is an
    inclusive range of gaps. Adds columns ``<weight>_<tier>`` and drops departures
    that nothing reaches.
    """
    bins = (
        inbound.filter(F.col("arr_minute").isNotNull() & (F.col("longest_gap") >= tiers[0][0]))
        .groupBy(*GROUP, "arr_minute", "longest_gap")
        .agg(*[column.alias(name) for name, column in weights.items()])
    )
    # where a bin's stretch enters each tier it reaches (leaving the one before), and where it ends
    reaches = [F.col("longest_gap") >= first for first, _ in tiers]
    last_tier = sum((r.cast("int") for r in reaches[1:]), F.lit(0))

    def edge(minute: Column, enters: Column, leaves: Column) -> Column:
        return F.struct(minute.alias("minute"), enters.alias("enters"), leaves.alias("leaves"))

    edges = [
        F.when(reached, edge(F.col("arr_minute") + first, F.lit(tier), F.lit(tier - 1)))
        for tier, (reached, (first, _)) in enumerate(zip(reaches, tiers))
    ]
    past = F.least(F.lit(tiers[-1][1]), F.col("longest_gap")) + 1
    edges.append(edge(F.col("arr_minute") + past, F.lit(-1), last_tier))

    def change(tier: int, weight: str) -> Column:
        return F.sum(
            F.when(F.col("enters") == tier, F.col(weight)).when(F.col("leaves") == tier, -F.col(weight)).otherwise(0)
        )

    changes = bins.select("*", F.inline(F.array_compact(F.array(*edges)))).groupBy(*GROUP, "minute").agg(
        *[change(tier, name).alias(f"{name}_{tier}") for tier in range(len(tiers)) for name in weights]
    )
    so_far = W.partitionBy(*GROUP).orderBy("minute").rangeBetween(W.unboundedPreceding, W.currentRow)
    loads = [f"{name}_{tier}" for tier in range(len(tiers)) for name in weights]
    stacked = changes.withColumn("is_departure", F.lit(False)).unionByName(
        departures.withColumn("is_departure", F.lit(True)), allowMissingColumns=True
    )
    reached = stacked.withColumns({name: F.sum(name).over(so_far) for name in loads})
    counted = next(iter(weights))
    any_load = F.greatest(*[F.col(f"{counted}_{t}") for t in range(len(tiers))], F.lit(0))
    return reached.filter(F.col("is_departure") & (any_load > 0)).drop("is_departure")


def _late_ends(min_arr_delay: float) -> tuple[Column, Column]:
    """The minute at which a flight arrives late, NULL for other flights, and the longest gap that its delay exceeds."""
    delay = F.col("arrdelayminutes")
    arrival = F.when(delay >= min_arr_delay, hhmm_to_minutes("crsarrtime").cast("int"))
    return arrival, (F.ceil(delay) - 1).cast("int")


def _departure_minute(only_late: bool = False) -> Column:
    """The minute of a departure that was flown (and, if asked, left late), else NULL."""
    flown = F.col("cancelled") == 0
    return F.when(flown & (F.col("depdelayminutes") > 0) if only_late else flown, hhmm_to_minutes("crsdeptime").cast("int"))


def _either_end(flights: DataFrame, hubs, dates) -> DataFrame:
    """Flights that arrive at or depart from a hub on one of the dates."""
    if hubs is not None:
        flights = flights.filter(F.col("dest").isin(list(hubs)) | F.col("origin").isin(list(hubs)))
    return flights if dates is None else flights.filter(F.col("flightdate").isin(list(dates)))


def _ends(flights: DataFrame, min_arr_delay: float, hubs, dates, *more: Column, only_late: bool = False) -> DataFrame:
    """One row per flight that arrives late or leaves: arrival and departure are NULL where it doesn't."""
    arrival, reach = _late_ends(min_arr_delay)
    return _either_end(flights, hubs, dates).select(
        "origin", "dest", "flightdate", F.col("iata_code_reporting_airline").alias("airline"),
        F.col("arrdelayminutes").alias("delay"), arrival.alias("arrival"), reach.alias("longest_gap"),
        _departure_minute(only_late).alias("departure"), *more,
    )


def _at_hubs(notes: DataFrame, hubs) -> DataFrame:
    notes = notes.filter("hub is not null")
    return notes if hubs is None else notes.filter(F.col("hub").isin(list(hubs)))


def _reach(
    flights: DataFrame, min_arr_delay: float, first_gap: int, last_gap: int, by_delay: bool, longest: bool, hubs=None, dates=None,
    only_late: bool = False,
) -> DataFrame:
    """Per departure minute of a (hub, day, airline): late_inbound flights that reach it, and the sum of their delays.

    With ``by_delay`` a flight reaches no further than its delay exceeds the gap. ``longest`` adds max_inbound_delay, and
    ``only_late`` leaves out minutes in which all departures were on time. One
    scan: a flight notes its stretch as an arrival and its minute as a departure, and notes are summed by minute before the
    window sees them.
    """
    until = f"arrival + least(longest_gap, {last_gap})" if by_delay else f"arrival + {last_gap}"
    powers = range(max(last_gap - first_gap + 1, 1).bit_length() if longest else 0)
    power = " + ".join(["0", *[f"cast(until - start + 1 >= {1 << k} as int)" for k in powers[1:]]])
    late, nothing = "start <= until", "cast(null as int)"

    def note(condition: str, hub: str, minute: str, n: int, mark: str = nothing) -> str:
        fields = f"'hub', {hub}, 'minute', {minute}, 'n', {n}, 'power', {mark}, 'leaves', {str(hub == 'origin').lower()}"
        return f"if({condition}, named_struct({fields}), null)"

    notes = [
        note(late, "dest", "start", 1, "power"), note(late, "dest", "until + 1", -1),
        note("departure is not null", "origin", "departure", 0),
    ]
    if longest:
        notes.append(note(late, "dest", "until + 1 - shiftleft(1, power)", 0, "power"))
    stretches = _ends(flights, min_arr_delay, hubs, dates, only_late=only_late).filter("arrival is not null or departure is not null")
    stretches = stretches.selectExpr("*", f"arrival + {first_gap} as start", f"{until} as until").selectExpr("*", f"{power} as power")
    noted = stretches.selectExpr("flightdate", "airline", "delay", f"inline(array({', '.join(notes)}))").filter("minute is not null")
    minutes = _at_hubs(noted, hubs).groupBy(*GROUP, "minute").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("delay")).alias("delays"), F.max("leaves").alias("leaves"),
        *[F.max(F.when(F.col("power") == k, F.col("delay"))).alias(f"longest_{k}") for k in powers],
    )
    day = W.partitionBy(*GROUP).orderBy("minute")
    so_far = day.rangeBetween(W.unboundedPreceding, W.currentRow)
    found = {"late_inbound": F.sum("n").over(so_far), "inbound_minutes": F.sum("delays").over(so_far)}
    if longest:
        largest = [F.max(f"longest_{k}").over(day.rangeBetween(1 - (1 << k), W.currentRow)) for k in powers]
        found["max_inbound_delay"] = F.greatest(*largest) if len(largest) > 1 else largest[0]
    reached = minutes.select(*GROUP, "minute", "leaves", *[column.alias(name) for name, column in found.items()])
    return reached.filter(F.col("leaves") & (F.col("late_inbound") > 0)).drop("leaves")


def _tiers(window: ConnectionWindow, delays: Sequence[float]) -> list[tuple[int, int]]:
    """Adjacent gap ranges ending at each scenario's last gap."""
    tiers, first = [], window.min_gap
    for last in sorted({window.last_gap(delay) for delay in delays}):
        if last >= first:
            tiers.append((first, last))
            first = last + 1
    return tiers


def _destination_loads(
    flights: DataFrame, window: ConnectionWindow, delays: Sequence[float], min_arr_delay: float, hubs, dates
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Departure bins per (hub, day, destination, minute) with pair counts per tier."""
    tiers = _tiers(window, delays)
    if not tiers:
        raise ValueError(f"no gap of {window.min_gap} minutes or more fits the delays {list(delays)}")
    late = (
        _inbound(flights, hubs, dates)
        .filter(F.col("inbound_delay") >= min_arr_delay)
        .withColumn("longest_gap", F.least(_longest_gap(), F.lit(tiers[-1][1])))
    )
    departures = (
        _outbound(flights, hubs, dates)
        .groupBy(*GROUP, "minute", "outbound_dest")
        .agg(
            F.count(F.lit(1)).alias("departures"),
            F.count("outbound_delay").alias("timed_departures"),
            F.sum("outbound_delay").alias("outbound_minutes"),
        )
    )
    weights = {"inbound": F.count(F.lit(1)), "inbound_minutes": F.sum("inbound_delay")}
    return _connection_load(late, departures, tiers, weights), tiers


TIERS_PER_ROW = 16


def _tier_pairs(flights: DataFrame, tiers: list[tuple[int, int]], min_arr_delay: float, hubs, dates) -> DataFrame:
    """Per (hub, day): direct, the flights that arrive late at all; and per destination, pairs: matched pairs up to each tier.

    The tiers' counts are running sums of the notes that flights make as arrivals, at both ends of their stretch in every
    tier they reach; as departures they make one note per row of tiers. One scan, in which flights alike are counted first.
    """
    width = min(len(tiers), TIERS_PER_ROW)
    rows = -(-len(tiers) // width)
    firsts, lasts = (f"array({', '.join(str(t[end]) for t in tiers)})" for end in (0, 1))
    late = (F.coalesce("arrdelayminutes", F.lit(0.0)) > 0).cast("int").alias("late")
    ends = _ends(flights, min_arr_delay, hubs, dates, late)
    # Flights are counted by minute and gap before any tier is noted; those that reach no tier only by (hub, day, airline).
    fits = f"arrival is not null and longest_gap >= {tiers[0][0]}"
    lands = (
        f"named_struct('hub', dest, 'leaves', false, 'minute', if({fits}, arrival, null), 'longest_gap', "
        f"if({fits}, least(longest_gap, {tiers[-1][1]}), null), 'outbound_dest', cast(null as string), 'late', late)"
    )
    leaves = (
        "if(departure is null, null, named_struct('hub', origin, 'leaves', true, 'minute', departure, 'longest_gap', "
        "cast(null as int), 'outbound_dest', dest, 'late', 0))"
    )
    bins = _at_hubs(ends.selectExpr("flightdate", "airline", f"inline(array({lands}, {leaves}))"), hubs)
    bins = bins.groupBy(*GROUP, "leaves", "minute", "longest_gap", "outbound_dest").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("late").alias("late")
    )

    # An arrival steps through -1, its note of late flights, and the tiers it reaches; a departure through the rows of tiers.
    reached = f"if(minute is null, 0, size(filter({firsts}, first -> first <= longest_gap)))"
    steps = bins.selectExpr("*", f"explode(if(leaves, sequence(0, {rows - 1}), sequence(-1, {reached} - 1))) as t")

    def note(n: str, minute: str) -> str:
        """What an arrival notes of tier t."""
        return (
            f"named_struct('tier_row', cast(t div {width} as int), 'slot', cast(t % {width} as int), 'n', {n}, 'minute', {minute}, "
            "'outbound_dest', cast(null as string), 'departures', 0L, 'direct', 0L)"
        )

    once = (
        "named_struct('tier_row', t, 'slot', cast(null as int), 'n', 0L, 'minute', if(leaves, minute, null), 'outbound_dest', "
        "outbound_dest, 'departures', if(leaves, flights, 0L), 'direct', if(leaves, 0L, late))"
    )
    begin = note("flights", f"minute + get({firsts}, t)")
    end = note("-flights", f"minute + least(get({lasts}, t), longest_gap) + 1")
    notes = f"inline(array(if(leaves or t < 0, {once}, {begin}), if(leaves or t < 0, null, {end})))"
    noted = steps.selectExpr("hub", "flightdate", "airline", notes).filter("tier_row is not null")
    slots = [f"n_{i}" for i in range(width)]
    minutes = noted.groupBy(*GROUP, "tier_row", "minute", "outbound_dest").agg(
        *[F.sum(F.when(F.col("slot") == i, F.col("n"))).alias(name) for i, name in enumerate(slots)],
        F.sum("departures").alias("departures"), F.sum("direct").alias("direct"),
    )
    so_far = W.partitionBy(*GROUP, "tier_row").orderBy("minute").rangeBetween(W.unboundedPreceding, W.currentRow)
    reach = minutes.withColumns({name: F.coalesce(F.sum(name).over(so_far), F.lit(0)) for name in slots})
    # A departure has all rows of tiers, reached or not, so that the rows of a destination lie end to end below.
    counted = reach.filter("departures > 0 or tier_row < 0").groupBy("hub", "flightdate", "outbound_dest", "tier_row").agg(
        F.array(*[F.sum(F.col(name) * F.col("departures")) for name in slots]).alias("pairs"), F.sum("direct").alias("direct")
    )
    lands = F.col("tier_row") < 0
    ordered = F.array_sort(F.collect_list(F.when(~lands, F.struct("tier_row", "pairs"))))
    whole = counted.groupBy("hub", "flightdate", "outbound_dest").agg(
        F.flatten(F.transform(ordered, lambda row: row["pairs"])).alias("pairs"), F.sum("direct").alias("direct"),
        F.max(lands).alias("lands"),
    )
    so_many = "concat(sums, array(coalesce(try_element_at(sums, -1), 0L) + n))"
    fold = f"aggregate(pairs, cast(array() as array<bigint>), (sums, n) -> {so_many})"
    return whole.withColumn("pairs", F.expr(fold))


# --------------------------------------------------------------------------- operators


def cascade_matches(
    flights: DataFrame,
    delay: float = 90,
    window: ConnectionWindow = DEFAULT_WINDOW,
    min_arr_delay: float = 15,
    hubs: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """One row per departure at risk: how many late inbound flights reach it, their mean and longest delay.

    The pairs themselves grow with the square of a day's flights and are never built.
    """
    reach = _reach(flights, min_arr_delay, window.min_gap, window.last_gap(delay), True, True, hubs, dates)
    # A row per minute is hashed, so that no task sorts its flights.
    return _outbound(flights, hubs, dates).join(reach.hint("shuffle_hash"), [*GROUP, "minute"]).select(
        "hub",
        "flightdate",
        "airline",
        "outbound_dest",
        "flight_num",
        F.col("minute").alias("departure_minute"),
        F.col("outbound_delay").alias("depdelayminutes"),
        "late_inbound",
        F.round(F.col("inbound_minutes") / F.col("late_inbound"), 1).alias("avg_inbound_delay"),
        "max_inbound_delay",
    )


def cascade_by_destination(
    flights: DataFrame,
    delay: float = 90,
    window: ConnectionWindow = DEFAULT_WINDOW,
    min_arr_delay: float = 15,
    hubs: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Per hub, day and destination: matched pairs and the mean delays over them."""
    loads, _ = _destination_loads(flights, window, [delay], min_arr_delay, hubs, dates)
    pairs = F.col("inbound_0")
    timed = F.sum(pairs * F.col("timed_departures"))
    affected = F.sum(pairs * F.col("departures"))
    outbound = F.sum(pairs * F.col("outbound_minutes")) / F.nullif(timed, F.lit(0))
    inbound = F.sum(F.col("inbound_minutes_0") * F.col("departures")) / affected
    return (
        loads.groupBy("hub", "flightdate", "outbound_dest")
        .agg(
            affected.alias("affected_flights"),
            F.round(outbound, 1).alias("avg_outbound_delay"),
            F.round(inbound, 1).alias("avg_inbound_delay"),
        )
    )


def cascade_costs(
    direct: Column, cascade: Column, delay: Column, costs: CostParameters = DEFAULT_COSTS
) -> dict[str, Column]:
    """Passengers (whole people) and dollars of a scenario, priced at the trigger delay."""
    flights = direct + cascade
    passengers = F.floor(flights * F.lit(costs.seats) * F.lit(costs.load_factor))
    passenger = passengers * delay * F.lit(costs.passenger_minute)
    airline = flights * delay * F.lit(costs.flight_minute)
    return {
        "total_flights_affected": flights,
        "total_affected_passengers": passengers,
        "estimated_passenger_cost": F.round(passenger, 2),
        "estimated_airline_cost": F.round(airline, 2),
        "total_economic_impact": F.round(passenger + airline, 2),
    }


def cascade_impact(
    flights: DataFrame,
    delays: Sequence[float] = (90,),
    hubs: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
    costs: CostParameters = DEFAULT_COSTS,
    window: ConnectionWindow = DEFAULT_WINDOW,
    min_arr_delay: float = 15,
    top_dest: int = 20,
) -> DataFrame:
    """Flights, passengers and dollars for every hub x day x trigger delay, in one job.

    Direct flights arrive late at all; cascade flights are matched pairs. Without
    ``hubs`` and ``dates`` every hub and day with an arrival is covered; when both
    are given, each combination gets a row even if nothing flew.
    """
    delays = sorted({float(delay) for delay in delays})
    if not delays:
        raise ValueError("give a trigger delay")
    # Without a tier that a scenario reaches, this one keeps the columns and no scenario adds it up.
    tiers = _tiers(window, delays) or [(window.min_gap, window.min_gap)]
    days = _tier_pairs(flights, tiers, min_arr_delay, hubs, dates)
    if hubs is not None and dates is not None:
        asked = [(hub, date, 0, True) for hub, date in product(dict.fromkeys(hubs), dict.fromkeys(dates))]
        schema = "hub string, flightdate string, direct bigint, lands boolean"
        days = days.unionByName(flights.sparkSession.createDataFrame(asked, schema), allowMissingColumns=True)
    # one list entry per destination of the hub, however many flights go there
    reached = F.when(F.try_element_at("pairs", F.lit(-1)) > 0, F.struct("outbound_dest", "pairs"))
    days = days.groupBy("hub", "flightdate").agg(
        F.coalesce(F.sum("direct"), F.lit(0)).alias("direct"), F.max("lands").alias("lands"), F.collect_list(reached).alias("reach")
    ).filter("lands")
    upto = [sum(last <= window.last_gap(delay) for _, last in tiers) for delay in delays]
    each = ", ".join(f"named_struct('delay', {delay!r}D, 'upto', {n})" for delay, n in zip(delays, upto, strict=True))
    scenarios = days.selectExpr("*", f"inline(array({each}))")
    count = "if(upto = 0, 0L, get(r.pairs, upto - 1))"
    scenarios = scenarios.withColumn(
        "ranked", F.expr(f"array_sort(transform(filter(reach, r -> {count} > 0), r -> struct(-{count} as order, r.outbound_dest as dest)))")
    ).withColumn("cascade", F.aggregate("ranked", F.lit(0).cast("long"), lambda total, r: total - r["order"]))
    impact = cascade_costs(F.col("direct"), F.col("cascade"), F.col("delay"), costs)
    return scenarios.select(
        F.col("hub").alias("airport"),
        F.col("flightdate").alias("flight_date"),
        F.col("delay").alias("trigger_delay_minutes"),
        F.col("direct").alias("directly_affected_flights"),
        F.col("cascade").alias("cascade_affected_flights"),
        *[column.alias(name) for name, column in impact.items()],
        F.transform(F.slice("ranked", 1, top_dest), lambda r: r["dest"]).alias("affected_destinations"),
    )


def cascade_destination_detail(
    flights: DataFrame,
    delay: float = 90,
    n: int = 10,
    window: ConnectionWindow = DEFAULT_WINDOW,
    min_arr_delay: float = 15,
    hubs: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Late departures of a hub's day to its ``n`` most affected cascade destinations."""
    affected = cascade_by_destination(flights, delay, window, min_arr_delay, hubs, dates)
    order = W.partitionBy("hub", "flightdate").orderBy(F.col("affected_flights").desc(), F.col("outbound_dest"))
    top = affected.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
    late = (
        _restrict(flights, "origin", hubs, dates)
        .filter(F.col("depdelayminutes") > 0)
        .groupBy(F.col("origin").alias("hub"), "flightdate", F.col("dest").alias("outbound_dest"))
        .agg(F.count(F.lit(1)).alias("flights"), F.round(F.avg("depdelayminutes"), 0).alias("avg_delay"))
    )
    return late.join(top.select("hub", "flightdate", "outbound_dest"), ["hub", "flightdate", "outbound_dest"])


def cascade_chain(
    flights: DataFrame,
    hub: str | None = "ORD",
    date: str | None = "2025-10-15",
    min_delay: float = 30,
    gap: tuple[int, int] = (20, 180),
    costs: CostParameters = DEFAULT_COSTS,
) -> DataFrame:
    """Late arrivals (level 0) and the late departures they feed (level 1), per hub and day.

    Means weigh a departure by the number of late arrivals in its window. With
    ``hub=None`` or ``date=None`` all of them are covered in the same job.
    """
    hubs = None if hub is None else [hub]
    dates = None if date is None else [date]
    reach = _reach(flights, min_delay, gap[0], gap[1], False, False, hubs, dates, only_late=True).drop("inbound_minutes")
    number = F.col("flight_number_reporting_airline").alias("flight_num")
    late = (F.col("arrdelayminutes") >= min_delay).alias("late")
    ends = _ends(flights, min_delay, hubs, dates, number, F.col("depdelayminutes"), late, only_late=True)
    ends = ends.filter("late or departure is not null")
    levels = [
        "if(late, named_struct('hub', dest, 'minute', cast(null as int), 'cascade_level', 0, 'going_to', dest, 'minutes', delay), null)",
        "if(departure is not null, named_struct('hub', origin, 'minute', departure, 'cascade_level', 1, 'going_to', dest, "
        "'minutes', depdelayminutes), null)",
    ]
    both = ends.selectExpr("flightdate", "airline", "flight_num", f"inline(array({', '.join(levels)}))").filter("cascade_level is not null")
    weighed = _at_hubs(both, hubs).join(reach, [*GROUP, "minute"], "left")
    weight = F.when(F.col("cascade_level") == 0, F.lit(1)).otherwise(F.col("late_inbound"))
    levels = weighed.select("hub", "flightdate", "cascade_level", "flight_num", "going_to", "minutes", weight.alias("weight")).filter("weight is not null")
    if hubs and dates:
        asked = [(hub, date, 0, None, hub, None, 0)]
        schema = "hub string, flightdate string, cascade_level int, flight_num int, going_to string, minutes double, weight bigint"
        levels = levels.unionByName(flights.sparkSession.createDataFrame(asked, schema))
    affected = F.countDistinct("flight_num")
    mean = F.sum(F.col("minutes") * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0))
    return (
        levels.groupBy(F.col("hub").alias("airport"), F.col("flightdate").alias("flight_date"), "cascade_level")
        .agg(
            affected.alias("flights_affected"),
            F.countDistinct("going_to").alias("destinations_affected"),
            F.round(mean, 1).alias("avg_delay_propagated"),
            F.round(F.min("minutes"), 1).alias("min_delay"),
            F.round(F.max("minutes"), 1).alias("max_delay"),
            (affected * F.lit(costs.seats) * F.lit(costs.load_factor)).alias("est_passengers"),
        )
        .orderBy("airport", "flight_date", "cascade_level")
    )


def cascade_estimate(
    vulnerability: DataFrame, delays: Sequence[float] = (90,), costs: CostParameters = DEFAULT_COSTS
) -> DataFrame:
    """Closed-form cascade estimate from an airport's totals, for every trigger delay.

    Halves are rounded up.
    """
    if not delays:
        raise ValueError("give a trigger delay")

    def half_up(value: Column) -> Column:
        return F.floor(value + 0.5)

    delay = F.col("delay_minutes")
    days = F.when(F.col("operating_days") == 0, 1).otherwise(F.col("operating_days"))
    connectivity = (
        F.lit(1) + (F.col("max_routes_served") / 200) * 0.5 + (F.col("max_airlines") / 20) * 0.3
    )
    scenarios = vulnerability.withColumn(
        "delay_minutes", F.explode(F.array(*[F.lit(float(d)) for d in dict.fromkeys(delays)]))
    )
    estimate = (
        scenarios.withColumn(
            "direct", half_up((F.col("total_departures") / days) * (F.col("avg_pct_delayed") / 100))
        )
        .withColumn("multiplier", connectivity * F.least(delay / 60, F.lit(3.0)))
        .withColumn("cascade", half_up(F.col("direct") * F.col("multiplier")))
        .withColumn("flights", F.col("direct") + F.col("cascade"))
        .withColumn("passengers", half_up(F.col("flights") * (F.lit(costs.seats) * F.lit(costs.load_factor))))
        .withColumn("passenger_cost", F.col("passengers") * delay * F.lit(costs.passenger_minute))
        .withColumn("airline_cost", F.col("flights") * delay * F.lit(costs.flight_minute))
    )
    return estimate.select(
        "airport",
        "delay_minutes",
        F.col("direct").alias("directly_affected_flights"),
        F.col("cascade").alias("cascade_affected_flights"),
        F.col("passengers").alias("total_affected_passengers"),
        half_up(F.col("passenger_cost")).alias("estimated_passenger_cost"),
        half_up(F.col("airline_cost")).alias("estimated_airline_cost"),
        half_up(F.col("passenger_cost") + F.col("airline_cost")).alias("total_economic_impact"),
        (half_up(F.col("multiplier") * 10) / 10).alias("cascade_multiplier"),
    )
