"""DuckDB SQL for the same questions, written independently of the Spark plans.

Statements are assembled from common table expressions; each query names the ones
it reads and their dependencies are added in order.
"""

from __future__ import annotations

from groundhold.sources.seeds import AIRPORT_ROWS

from .frames import AIRPORTS, CATEGORIES, DUCKDB, REASONS, WEATHER, derive_sql
from .payloads import LAYER_CODES
from .queries import DELAYS, HEALTH_NOW

# ------------------------------------------------------------------ fragments


def mean(x: str, scale: int = 1) -> str:
    """Mean of values rounded to ``scale`` decimals from an exact sum."""
    return f"(cast(sum(cast({x} as decimal(18,{scale}))) as double) / nullif(count({x}), 0))"


def rolling(x: str, part: str, order: str) -> str:
    frame = f"over (partition by {part} order by {order} rows between 6 preceding and current row)"
    total = f"cast(sum(cast({x} as decimal(18,1))) {frame} as double)"
    return f"round({total} / (count({x}) {frame}), 1)"


def pct(condition: str, digits: int = 1, of: str = "count(*)") -> str:
    return f"round(cast(count(*) filter (where {condition}) as double) * 100 / nullif({of}, 0), {digits})"


def bigint(expr: str) -> str:
    return f"cast({expr} as bigint)"


def minutes(hhmm: str) -> str:
    return f"cast(floor({hhmm} / 100) * 60 + {hhmm} % 100 as integer)"


def weekday(x: str) -> str:
    return (
        f"case {x} when 1 then 'Monday' when 2 then 'Tuesday' when 3 then 'Wednesday' when 4 then 'Thursday' "
        f"when 5 then 'Friday' when 6 then 'Saturday' when 7 then 'Sunday' end"
    )


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


PAX = "160 * cast(0.87 as double)"
PASSENGER_RATE, FLIGHT_RATE = "cast(0.74 as double)", "cast(68.48 as double)"


def costs(n: str, delay: str) -> tuple[str, str]:
    return f"({n} * {PAX} * {delay} * {PASSENGER_RATE})", f"({n} * {delay} * {FLIGHT_RATE})"


def score(pct_: str, late: str, routes: str, airlines: str) -> str:
    d = "cast({} as double)".format
    return f"({pct_} * {d('0.3')} + coalesce({late}, 0) * {d('0.1')} + {routes} * {d('0.05')} + {airlines} * {d('2.0')})"


# Cause with the most minutes; list_position takes the first of equals.
_C = {"W": "coalesce(weatherdelay,0)", "N": "coalesce(nasdelay,0)", "L": "coalesce(lateaircraftdelay,0)", "C": "coalesce(carrierdelay,0)"}
_TOP = f"greatest({', '.join(_C.values())})"
FLIGHT_CAUSE = f"""
case when coalesce(cancelled, 0) = 1 then 'Cancelled'
     when coalesce(depdelayminutes, 0) <= 15 then 'On Time'
     when {_TOP} = 0 then (case when coalesce(securitydelay, 0) > 0 then 'Security' else 'Other' end)
     else ['Weather', 'NAS/ATC', 'Late Aircraft', 'Carrier'][list_position([{', '.join(_C.values())}], {_TOP})]
end
"""

ROUTE_CAUSE = (
    "['Weather', 'Late Aircraft', 'NAS/ATC', 'Carrier'][list_position("
    "[weather_count, late_aircraft_count, nas_count, carrier_count], "
    "greatest(weather_count, late_aircraft_count, nas_count, carrier_count))]"
)

TIME_BLOCK = (
    "case when {h} >= 5 and {h} <= 8 then 'Early Morning' when {h} >= 9 and {h} <= 11 then 'Mid Morning' "
    "when {h} >= 12 and {h} <= 14 then 'Afternoon' when {h} >= 15 and {h} <= 17 then 'Late Afternoon' "
    "when {h} >= 18 and {h} <= 20 then 'Evening' else 'Night' end"
)

MEANING = (
    "case flight_category when 'VFR' then 'Visual Flight Rules — clear skies, good visibility' "
    "when 'MVFR' then 'Marginal VFR — reduced visibility, some restrictions' "
    "when 'IFR' then 'Instrument Flight Rules — low visibility, potential delays' "
    "when 'LIFR' then 'Low IFR — very poor visibility, likely delays/diversions' else 'Unknown' end"
)
WEATHER_TEXT = "case when coalesce(weather_string, '') = '' then 'No significant weather' else weather_string end"

# ------------------------------------------------------------------ shared tables

STAGED = f"""
select flightdate as flight_date, reporting_airline as airline_code, iata_code_reporting_airline as airline_iata,
  flight_number_reporting_airline as flight_number, origin as origin_airport, origincityname as origin_city,
  originstate as origin_state, dest as dest_airport, destcityname as dest_city, deststate as dest_state,
  concat(origin, '-', dest) as route_id, year, quarter, month, dayofmonth as day_of_month,
  dayofweek as day_of_week, {weekday('dayofweek')} as day_name, dayofweek > 5 as is_weekend,
  cast(crsdeptime as integer) as scheduled_dep_hhmm, {minutes('crsdeptime')} as scheduled_dep_minutes,
  cast(crsarrtime as integer) as scheduled_arr_hhmm, {minutes('crsarrtime')} as scheduled_arr_minutes,
  cast(deptime as integer) as actual_dep_hhmm, cast(arrtime as integer) as actual_arr_hhmm,
  ifnull(depdelay, 0) as dep_delay_minutes, ifnull(depdelayminutes, 0) as dep_delay_abs_minutes,
  cast(ifnull(depdel15, 0) as integer) as is_dep_delayed_15,
  ifnull(arrdelay, 0) as arr_delay_minutes, ifnull(arrdelayminutes, 0) as arr_delay_abs_minutes,
  cast(ifnull(arrdel15, 0) as integer) as is_arr_delayed_15,
  ifnull(carrierdelay, 0) as carrier_delay_minutes, ifnull(weatherdelay, 0) as weather_delay_minutes,
  ifnull(nasdelay, 0) as nas_delay_minutes, ifnull(securitydelay, 0) as security_delay_minutes,
  ifnull(lateaircraftdelay, 0) as late_aircraft_delay_minutes,
  cast(cancelled as integer) as is_cancelled, cancellationcode as cancellation_reason,
  cast(diverted as integer) as is_diverted, ifnull(crselapsedtime, 0) as scheduled_elapsed_minutes,
  ifnull(actualelapsedtime, 0) as actual_elapsed_minutes, ifnull(airtime, 0) as air_time_minutes,
  ifnull(distance, 0) as distance_miles, {FLIGHT_CAUSE} as primary_delay_cause
from flights where crsdeptime is not null and crsarrtime is not null
"""


def _caused(label: str) -> str:
    return f"count(*) filter (where primary_delay_cause = '{label}')"


def _positive_mean(column: str) -> str:
    return f"round(avg({column}) filter (where {column} > 0), 1)"


DAILY = f"""
select origin_airport as airport, flight_date, day_name, is_weekend, month, count(*) as total_departures,
  round(avg(dep_delay_abs_minutes), 1) as avg_dep_delay_min, round(avg(arr_delay_abs_minutes), 1) as avg_arr_delay_min,
  count(*) filter (where is_dep_delayed_15 = 1) as flights_delayed_15, {pct('is_dep_delayed_15 = 1')} as pct_delayed_15,
  count(*) filter (where is_cancelled = 1) as flights_cancelled, {pct('is_cancelled = 1', 2)} as pct_cancelled,
  {_positive_mean('carrier_delay_minutes')} as avg_carrier_delay, {_positive_mean('weather_delay_minutes')} as avg_weather_delay,
  {_positive_mean('nas_delay_minutes')} as avg_nas_delay, {_positive_mean('late_aircraft_delay_minutes')} as avg_late_aircraft_delay,
  {_caused('Weather')} as weather_delays, {_caused('Carrier')} as carrier_delays,
  {_caused('NAS/ATC')} as nas_delays, {_caused('Late Aircraft')} as late_aircraft_delays,
  count(distinct dest_airport) as routes_served, count(distinct airline_iata) as airlines_operating
from staged where is_cancelled = 0 group by all
"""

_PAX_COST, _OPS_COST = costs("flights_delayed_15", "avg_dep_delay_min")
ECON = f"""
select airport, flight_date, day_name, is_weekend, month, total_departures, avg_dep_delay_min, pct_delayed_15,
  flights_delayed_15, flights_cancelled, pct_cancelled, round({_PAX_COST}, 0) as est_passenger_delay_cost,
  round({_OPS_COST}, 0) as est_airline_ops_cost, round({_PAX_COST} + {_OPS_COST}, 0) as est_total_economic_impact,
  avg_weather_delay, avg_carrier_delay, avg_nas_delay, avg_late_aircraft_delay,
  weather_delays, carrier_delays, nas_delays, late_aircraft_delays, routes_served, airlines_operating,
  {rolling('avg_dep_delay_min', 'airport', 'flight_date')} as rolling_7day_avg_delay,
  {rolling('pct_delayed_15', 'airport', 'flight_date')} as rolling_7day_pct_delayed
from daily
"""

_SCORE = score("avg_pct_delayed", "avg_late_aircraft_delay", "max_routes_served", "max_airlines")
VULN = f"""
select *, round({_SCORE}, 1) as cascade_vulnerability_score, rank() over (order by {_SCORE} desc) as vulnerability_rank
from (
  select airport, count(*) as operating_days, {bigint('sum(total_departures)')} as total_departures,
    round({mean('avg_dep_delay_min')}, 1) as avg_delay_min, round({mean('pct_delayed_15')}, 1) as avg_pct_delayed,
    round({mean('pct_cancelled', 2)}, 2) as avg_pct_cancelled, max(routes_served) as max_routes_served,
    max(airlines_operating) as max_airlines, round({mean('avg_late_aircraft_delay')}, 1) as avg_late_aircraft_delay,
    round(avg(est_total_economic_impact), 0) as avg_daily_economic_impact,
    round(sum(est_total_economic_impact), 0) as total_economic_impact
  from econ group by airport having sum(total_departures) >= 1000
)
"""

PERF = f"""
select route_id, origin_airport, dest_airport, origin_city, dest_city, airline_iata, count(*) as total_flights,
  round(avg(dep_delay_abs_minutes), 1) as avg_dep_delay, round(avg(arr_delay_abs_minutes), 1) as avg_arr_delay,
  count(*) filter (where is_dep_delayed_15 = 1) as delayed_flights, {pct('is_dep_delayed_15 = 1')} as pct_delayed,
  count(*) filter (where is_cancelled = 1) as cancelled_flights, {pct('is_cancelled = 1', 2)} as pct_cancelled,
  round(avg(distance_miles), 0) as avg_distance_miles, round(avg(air_time_minutes), 0) as avg_air_time_min,
  {_caused('Weather')} as weather_count, {_caused('Carrier')} as carrier_count,
  {_caused('NAS/ATC')} as nas_count, {_caused('Late Aircraft')} as late_aircraft_count
from staged group by all having count(*) >= 30
"""

_RPAX, _ROPS = costs("delayed_flights", "avg_dep_delay")
ROUTES = f"""
select route_id, origin_airport, dest_airport, origin_city, dest_city, airline_iata, total_flights, delayed_flights,
  pct_delayed, avg_dep_delay, cancelled_flights, pct_cancelled, avg_distance_miles,
  round({_RPAX}, 0) as est_passenger_cost, round({_ROPS}, 0) as est_airline_ops_cost,
  round({_RPAX} + {_ROPS}, 0) as est_total_economic_impact,
  round(({_RPAX} + {_ROPS}) / total_flights, 0) as est_cost_per_flight, {ROUTE_CAUSE} as dominant_delay_cause
from perf
"""

# Late inbound flights joined pair by pair with the departures they reach.
PAIRS = f"""
select o.origin as hub, o.flightdate, o.iata_code_reporting_airline as airline, o.dest as outbound_dest,
  o.flight_number_reporting_airline as flight_num, o.depdelayminutes, i.arrdelayminutes as inbound_delay,
  {minutes('o.crsdeptime')} - {minutes('i.crsarrtime')} as turnaround_gap, i.origin as arrived_from
from flights o join flights i
  on i.dest = o.origin and i.flightdate = o.flightdate
  and i.iata_code_reporting_airline = o.iata_code_reporting_airline
where o.cancelled = 0 and i.arrdelayminutes >= 15
  and {minutes('o.crsdeptime')} - {minutes('i.crsarrtime')} >= 20
  and i.arrdelayminutes > {minutes('o.crsdeptime')} - {minutes('i.crsarrtime')}
"""

EVENTS = "select event_id as e, user_id as u, cast(round(value * 100) as bigint) as v from events"

LAYERS = f"""
select e, i, {DUCKDB.pick(LAYER_CODES, '(v + i * e) % 7')} as cover,
  case when (v + i) % 5 = 0 then null else cast((v + i) % 50 * 100 as double) end as base
from ev, (values (0), (1), (2)) as layer(i) where e % 4 > i
"""
_COVER_RANK = "case cover when 'OVC' then 5 when 'BKN' then 4 when 'SCT' then 3 when 'FEW' then 2 when 'CLR' then 1 else 0 end"
COVERS = f"select e, first(cover order by {_COVER_RANK} desc, i) as cover from layers group by e"
CEILINGS = "select e, first(base order by i) as base from layers where cover in ('BKN', 'OVC') and base is not null group by e"

SEEDS = "select * from (values " + ", ".join(
    "('{}', '{}', '{}', '{}', '{}', cast({} as double), cast({} as double), {})".format(
        *[str(v).replace("'", "''") for v in row]
    )
    for row in AIRPORT_ROWS
) + ") as s(iata_code, icao_code, airport_name, city, state, latitude, longitude, is_major_hub)"

TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "flights": ((), derive_sql("raw_flights")),
    "weather": ((), derive_sql("raw_weather")),
    "positions": ((), derive_sql("raw_positions")),
    "airspace": ((), derive_sql("raw_airspace")),
    "staged": (("flights",), STAGED),
    "daily": (("staged",), DAILY),
    "econ": (("daily",), ECON),
    "vuln": (("econ",), VULN),
    "perf": (("staged",), PERF),
    "routes": (("perf",), ROUTES),
    "pairs": (("flights",), PAIRS),
    "ev": ((), EVENTS),
    "layers": (("ev",), LAYERS),
    "covers": (("layers",), COVERS),
    "ceilings": (("layers",), CEILINGS),
    "seeds": ((), SEEDS),
}


def statement(body: str, *reads: str, **extra: str) -> str:
    """``WITH`` the tables read (dependencies first), then own ones, then the body."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in TABLES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in reads:
        visit(name)
    ctes = [f"{name} as materialized ({TABLES[name][1]})" for name in order]
    ctes += [f"{name} as ({sql})" for name, sql in extra.items()]
    return f"with {', '.join(ctes)} {body}" if ctes else body


# ------------------------------------------------------------------ statements

ORACLE: dict[str, str] = {}

ORACLE["read_flights_csv"] = statement("select * from flights", "flights")
ORACLE["unfit_csv_values"] = statement(
    """
select 'distance' as column_name, cast(count(*) as bigint) as unfit, 'far' as example from flights
where flight_number_reporting_airline % 7 = 0
union all select 'crsdeptime', count(*), 'n/a' from flights where month = 9 and crsdeptime is null
union all select 'year', count(*), '20x5' from flights where month <> 9
""",
    "flights",
)
ORACLE["append_raw"] = statement(
    "select flightdate, count(*) as flights, sum(distance) as miles, sum(arrdelay) as arr_delay from flights group by flightdate",
    "flights",
)
_POSITIONS = """
select icao24, concat('CS', cast(baro_altitude as bigint)) as callsign, 'United States' as origin_country, longitude, latitude,
  baro_altitude, case when cast(baro_altitude as bigint) % 2 = 1 then velocity end as geo_altitude, on_ground, velocity,
  cast(180 as double) as true_track, vertical_rate, cast(baro_altitude as bigint) as snapshot_time
from positions where latitude is not null
"""
ORACLE["read_position_snapshots"] = ORACLE["stream_positions"] = statement(_POSITIONS, "positions")
ORACLE["filter_bbox"] = statement(
    "select icao24, latitude, longitude, polled_at from positions "
    "where latitude >= 24.396308 and latitude <= 49.384358 and longitude >= -125.0 and longitude <= -66.93457",
    "positions",
)
_STATION = f"case when u % 10 = 9 then 'PHNL' else concat('K', {DUCKDB.pick(AIRPORTS, 'u % 10')}) end"
_WEATHER = f"""
select {_STATION} as station_id, case when u % 10 = 9 then 'PHNL' else {DUCKDB.pick(AIRPORTS, 'u % 10')} end as iata_code,
  cast(e as varchar) as observation_time, concat('METAR ', cast(e as varchar)) as raw_metar,
  case when v % 11 <> 0 then cast((v % 36) * 10 as double) end as wind_direction_deg, cast(v % 40 as double) as wind_speed_kt,
  case when v % 4 = 0 then cast(v % 40 + 15 as double) end as wind_gust_kt,
  cast(if(v % 7 = 0, 10, e % 11) as double) as visibility_miles, cast(v % 45 - 10 as double) as temperature_c,
  case when v % 3 <> 0 then cast(v % 20 as double) end as dewpoint_c, cast(30 as double) as altimeter_inhg,
  coalesce(covers.cover, 'CLR') as cloud_cover, ceilings.base as ceiling_ft,
  case when v % 13 = 0 then '' else {DUCKDB.pick(WEATHER, 'e % 5')} end as weather_string,
  {DUCKDB.pick(CATEGORIES, 'v % 5')} as flight_category
from ev left join covers using (e) left join ceilings using (e)
"""
ORACLE["read_weather_snapshots"] = ORACLE["stream_weather"] = statement(_WEATHER, "ev", "covers", "ceilings")
ORACLE["cloud_cover"] = statement(
    "select ev.e as event_id, coalesce(cover, 'CLR') as cloud_cover from ev left join covers using (e)", "ev", "covers"
)
ORACLE["ceiling_ft"] = statement(
    "select ev.e as event_id, base as ceiling_ft from ev left join ceilings using (e)", "ev", "ceilings"
)
_PLACE, _REASON = DUCKDB.pick(AIRPORTS, "u % 10"), DUCKDB.pick(REASONS, "v % 3")


def _airspace_records(unique: bool) -> str:
    programs = "e % 4 = 0" if unique else "(e % 4 = 0 and copy = 1) or (e % 8 = 0 and copy = 2)"
    copies = "" if unique else ", (values (1), (2)) as c(copy)"
    return f"""
select {_PLACE} as airport_code, 'Ground Delay Program' as delay_type, {_REASON} as delay_reason, '1 hour' as avg_delay,
  concat(cast(v % 90 as varchar), ' minutes') as max_delay, '0100' as start_time, '' as end_time, true as has_delay
from ev{copies} where {programs}
union all
select {_PLACE}, 'Ground Stop', {_REASON}, '', '', '', '5 pm', true from ev where e % 4 < 2
union all
select {_PLACE}, 'Arrival/Departure Delay', {_REASON}, cast(v % 60 as varchar), '', '', '', true from ev where e % 4 = 2
"""


ORACLE["read_airspace_status"] = statement(_airspace_records(unique=False), "ev")
ORACLE["stream_airspace"] = statement(
    _airspace_records(unique=True)
    + "union all select 'NAS', 'No Active Delays', 'National Airspace System operating normally', '', '', '', '', false "
    "from ev where e % 4 = 3",
    "ev",
)
ORACLE["dedup_airspace_status"] = statement(
    """
select distinct airport_code, delay_type, delay_reason, '' as avg_delay, '' as max_delay, '' as start_time,
  '' as end_time, true as has_delay, poll as polled_at from polled where has_delay and airport_code is not null
union all
select 'NAS', 'No Active Delays', 'National Airspace System operating normally', '', '', '', '', false, poll
from polled group by poll having count(*) filter (where has_delay and airport_code is not null) = 0
""",
    "airspace",
    polled="select *, substr(polled_at, 1, 15) as poll from airspace",
)
ORACLE["stream_dedup_airspace"] = statement(
    "select distinct airport_code, delay_type, delay_reason, '' as avg_delay, '' as max_delay, '' as start_time, "
    "'' as end_time, delay_type <> 'No Active Delays' as has_delay, concat(substr(polled_at, 1, 15), '0:00Z') as polled_at "
    "from airspace",
    "airspace",
)
ORACLE["write_json_snapshots"] = statement("select * from weather", "weather")
ORACLE["read_seeds"] = statement(
    "select seeds.*, departures, departures * 160 as seats_offered from seeds join "
    "(select origin as iata_code, count(*) as departures from flights group by origin) using (iata_code)",
    "seeds",
    "flights",
)
ORACLE["materialize_marts"] = statement(
    "select 'mart_delay_economics' as mart, count(*) as row_count, sum(est_total_economic_impact) as total_impact from econ "
    "union all select 'mart_cascade_vulnerability', count(*), sum(total_economic_impact) from vuln "
    "union all select 'mart_route_economics', count(*), sum(est_total_economic_impact) from routes",
    "vuln",
    "routes",
)
ORACLE["refresh_days"] = statement("select * from econ", "econ")
_PRESENT = ("origin", "dest", "iata_code_reporting_airline", "flight_number_reporting_airline")
_RANGES = {
    "september": "flightdate between '2025-09-01' and '2025-09-30'",
    "one day": "flightdate = '2025-10-15'",
    "all": "true",
    "overlap": "flightdate between '2025-09-15' and '2025-10-15'",
}
ORACLE["distinct_over_ranges"] = statement(
    " union all ".join(
        f"select '{name}' as range_name, '{column}' as column_name, count(distinct {column}) as distinct_values from flights where {within}"
        for name, within in _RANGES.items()
        for column in _PRESENT
    ),
    "flights",
)
ORACLE["load_summary"] = statement(
    f"""
select count(*) as total_flights, count(distinct origin) as unique_origins, count(distinct dest) as unique_destinations,
  min(flightdate) as earliest_date, max(flightdate) as latest_date, round(avg(depdelayminutes), 1) as avg_dep_delay_min,
  {pct('depdel15 = 1')} as pct_delayed_15plus, {pct('cancelled = 1', 2)} as pct_cancelled from flights
""",
    "flights",
)

ORACLE["stg_flights"] = statement("select * from staged", "staged")
ORACLE["hhmm_to_minutes"] = statement(
    f"select crsdeptime, {minutes('crsdeptime')} as dep_minutes, count(*) as flights from flights group by all", "flights"
)
ORACLE["day_name"] = statement(
    f"select flightdate, {weekday('dayofweek')} as day_name, dayofweek >= 6 as is_weekend, count(*) as flights "
    "from flights group by all",
    "flights",
)
ORACLE["route_id"] = statement(
    "select origin || '-' || dest as route_id, origin || ' → ' || dest as route, count(*) as flights from flights group by all",
    "flights",
)
ORACLE["primary_delay_cause"] = statement(
    "select origin, cause as primary_delay_cause, count(*) as flights, sum(depdelayminutes) as delay_minutes from "
    f"(select *, {FLIGHT_CAUSE} as cause from flights) group by all",
    "flights",
)
ORACLE["stg_positions"] = statement(
    """
select icao24 as aircraft_id, callsign, origin_country, longitude, latitude, round(baro_altitude, 0) as barometric_altitude_m,
  round(geo_altitude, 0) as geometric_altitude_m, on_ground as is_on_ground, round(velocity, 1) as ground_speed_ms,
  round(velocity * cast(1.944 as double), 1) as ground_speed_knots, round(true_track, 1) as heading_degrees,
  round(vertical_rate, 1) as vertical_rate_ms, snapshot_time, polled_at,
  round(baro_altitude * cast(3.281 as double), 0) as altitude_ft,
  case when on_ground then 'Ground' when vertical_rate > 2 then 'Climbing' when vertical_rate < -2 then 'Descending'
       else 'Cruise' end as flight_phase
from positions where latitude is not null and longitude is not null and icao24 is not null
""",
    "positions",
)
ORACLE["stg_weather"] = statement(
    """
select station_id, iata_code as airport_code, observation_time, raw_metar, wind_direction_deg,
  wind_speed_kt as wind_speed_knots, wind_gust_kt as wind_gust_knots, visibility_miles, temperature_c, dewpoint_c,
  round(temperature_c * 9 / 5 + 32, 1) as temperature_f, altimeter_inhg, cloud_cover, ceiling_ft as ceiling_feet,
  weather_string, flight_category,
  flight_category in ('IFR', 'LIFR') or ifnull(visibility_miles < 3, false) or ifnull(ceiling_ft < 1000, false)
    or ifnull(wind_gust_kt > 35, false) or ifnull(regexp_matches(weather_string, 'TS|FZ|SN'), false) as is_delay_risk_weather,
  case when flight_category in ('LIFR', 'IFR', 'MVFR')
       then map {'LIFR': 'Severe', 'IFR': 'Moderate', 'MVFR': 'Marginal'}[flight_category]
       when ifnull(wind_gust_kt, 0) > 35 then 'Moderate' when contains(ifnull(weather_string, ''), 'TS') then 'Severe'
       else 'Clear' end as weather_severity,
  polled_at
from weather
""",
    "weather",
)
ORACLE["stg_airspace"] = statement(
    """
select *, case delay_type when 'Ground Stop' then 'Ground Stop' when 'Ground Delay Program' then 'GDP'
    when 'Arrival/Departure Delay' then 'Arrival Delay' when 'Departure Delay' then 'Departure Delay'
    when 'No Active Delays' then 'Normal Operations' else 'Other' end as delay_category,
  starts_with(delay_type, 'Ground ') as is_severe_program
from airspace where airport_code is not null
""",
    "airspace",
)
ORACLE["time_block"] = statement(
    f"select {TIME_BLOCK.format(h='hour')} as time_block, count(*) as flights, "
    f"{bigint('sum(is_dep_delayed_15)')} as delayed_flights "
    "from (select *, scheduled_dep_hhmm // 100 as hour from staged) group by 1",
    "staged",
)
ORACLE["trend_status"] = statement(
    "select airport, flight_date, case when avg_dep_delay_min - rolling_7day_avg_delay > 5 then 'WORSENING' "
    "when avg_dep_delay_min - rolling_7day_avg_delay < -5 then 'IMPROVING' else 'STABLE' end as trend_status from econ",
    "econ",
)
ORACLE["performance_tier"] = statement(
    "select airport, flight_date, case when avg_dep_delay_min - avg_arr_delay_min > 0.5 then 'UNDERPERFORMER' "
    "when avg_dep_delay_min - avg_arr_delay_min < -0.5 then 'OUTPERFORMER' else 'AVERAGE' end as performance_tier from daily",
    "daily",
)
ORACLE["risk_band"] = statement(
    "select airport, flight_date, pct_delayed_15, case when pct_delayed_15 > 22 then 'High (>22%)' "
    "when pct_delayed_15 > 18 then 'Moderate (18-22%)' else 'Low (<18%)' end as risk from econ",
    "econ",
)
_DPAX, _DOPS = costs("delayed", "mean_delay")
ORACLE["delay_cost_columns"] = statement(
    f"""
select origin, reporting_airline, delayed, mean_delay, round({_DPAX}, 0) as passenger_cost, round({_DOPS}, 0) as airline_cost,
  round({_DPAX} + {_DOPS}, 0) as total_cost, round(({_DPAX} + {_DOPS}) / flights, 0) as per_flight_cost
from (select origin, reporting_airline, count(*) as flights, count(*) filter (where depdel15 = 1) as delayed,
        round(avg(depdelayminutes), 1) as mean_delay from flights group by all)
""",
    "flights",
)
ORACLE["dominant_delay_cause"] = statement(
    f"select route_id, airline_iata, {ROUTE_CAUSE} as dominant_delay_cause from perf", "perf"
)
ORACLE["flight_category_meaning"] = statement(
    f"select {MEANING} as meaning, {WEATHER_TEXT} as weather, count(*) as reports from weather group by 1, 2", "weather"
)

# ------------------------------------------------------------------ cascades

ORACLE["cascade_matches"] = statement(
    f"""
select o.origin as hub, o.flightdate, o.airline, o.dest as outbound_dest, o.flight_num, o.minute as departure_minute,
  o.depdelayminutes, count(*) as late_inbound, round(avg(i.delay), 1) as avg_inbound_delay, max(i.delay) as max_inbound_delay
from departures o join arrivals i on i.dest = o.origin and i.flightdate = o.flightdate and i.airline = o.airline
where i.delay >= 15 and o.minute - i.minute between 20 and 135 and i.delay > o.minute - i.minute
group by o.place, o.origin, o.flightdate, o.airline, o.dest, o.flight_num, o.minute, o.depdelayminutes
""",
    "flights",
    departures="select row_number() over () as place, origin, dest, flightdate, iata_code_reporting_airline as airline, "
    f"flight_number_reporting_airline as flight_num, {minutes('crsdeptime')} as minute, depdelayminutes "
    "from flights where cancelled = 0 and crsdeptime is not null",
    arrivals="select dest, flightdate, iata_code_reporting_airline as airline, arrdelayminutes as delay, "
    f"{minutes('crsarrtime')} as minute from flights",
)
ORACLE["cascade_by_destination"] = statement(
    "select hub, flightdate, outbound_dest, count(*) as affected_flights, round(avg(depdelayminutes), 1) as avg_outbound_delay, "
    "round(avg(inbound_delay), 1) as avg_inbound_delay from pairs where turnaround_gap <= 135 group by all",
    "pairs",
)


def impact(days: str, delays: list[int], top: int = 20) -> str:
    """Impact per day and trigger delay; ``days`` gives the airport, date and direct flights."""
    scenarios = "(values " + ", ".join(f"(cast({d} as double))" for d in delays) + ") as s(delay)"
    return statement(
        f"""
select airport, flight_date, delay as trigger_delay_minutes, direct as directly_affected_flights,
  cascade as cascade_affected_flights, direct + cascade as total_flights_affected,
  {bigint('floor(pax)')} as total_affected_passengers,
  round(floor(pax) * delay * {PASSENGER_RATE}, 2) as estimated_passenger_cost,
  round((direct + cascade) * delay * {FLIGHT_RATE}, 2) as estimated_airline_cost,
  round(floor(pax) * delay * {PASSENGER_RATE} + (direct + cascade) * delay * {FLIGHT_RATE}, 2) as total_economic_impact,
  ifnull(dests, '') as affected_destinations
from (
  select airport, flight_date, s.delay, direct, {bigint('ifnull(n, 0)')} as cascade, dests, (direct + ifnull(n, 0)) * {PAX} as pax
  from days cross join {scenarios}
  left join reached on hub = airport and flightdate = flight_date and reached.delay = s.delay
)
""",
        "pairs",
        days=days,
        reach=(
            "select hub, flightdate, delay, outbound_dest, count(*) as n "
            f"from pairs join {scenarios} on turnaround_gap <= 45 + floor(delay) group by hub, flightdate, delay, outbound_dest"
        ),
        placed="select *, row_number() over (partition by hub, flightdate, delay order by n desc, outbound_dest) as place from reach",
        reached=(
            "select hub, flightdate, delay, sum(n) as n, "
            f"string_agg(outbound_dest, ',' order by place) filter (where place <= {top}) as dests "
            "from placed group by hub, flightdate, delay"
        ),
    )


_ALL_DAYS = (
    "select dest as airport, flightdate as flight_date, count(*) filter (where arrdelayminutes > 0) as direct "
    "from flights group by all"
)
ORACLE["cascade_impact"] = impact(_ALL_DAYS, DELAYS)
ORACLE["cascade_impact_hub_day"] = impact(
    "select h as airport, d as flight_date, count(*) filter (where arrdelayminutes > 0) as direct "
    "from (values ('ORD'), ('ATL'), ('JFK'), ('XXX')) as hubs(h) join (values ('2025-10-15'), ('2025-11-15')) as dates(d) on true "
    "left join flights on dest = h and flightdate = d group by all",
    [60, 90, 120],
)
ORACLE["simulate_cascade"] = impact(
    _ALL_DAYS.replace(
        "from flights",
        "from flights where dest = 'ORD' and flightdate = (select max(flightdate) from flights where cancelled = 0 "
        "and crsdeptime is not null and crsarrtime is not null)",
    ),
    [90],
    15,
)


def chain(hubs: str, min_delay: int, first: int, last: int, one: tuple[str, str] | None = None) -> str:
    """Both levels per hub and day; for ``one`` hub and day level 0 is a plain aggregate, so it always has its row."""
    arrivals = "hub as airport, flightdate as flight_date" if one is None else "'{}' as airport, '{}' as flight_date".format(*one)
    cols = (
        "count(distinct flight_num) as flights_affected, {dests} as destinations_affected, "
        "round(avg(delay), 1) as avg_delay_propagated, round(min(delay), 1) as min_delay, round(max(delay), 1) as max_delay, "
        f"count(distinct flight_num) * {PAX} as est_passengers"
    )
    return statement(
        f"""
select {arrivals}, 0 as cascade_level, {cols.format(dests='cast(1 as bigint)')}
from late {'group by all' if one is None else ''}
union all
select o.origin, o.flightdate, 1, {cols.format(dests='count(distinct o.dest)').replace('flight_num)', 'o.flight_number_reporting_airline)').replace('(delay)', '(o.depdelayminutes)')}
from flights o join late on late.hub = o.origin and late.flightdate = o.flightdate and late.airline = o.iata_code_reporting_airline
where o.cancelled = 0 and o.depdelayminutes > 0
  and {minutes('o.crsdeptime')} - late.arr_minute between {first} and {last}
group by all
""",
        "flights",
        late=(
            "select dest as hub, flightdate, iata_code_reporting_airline as airline, flight_number_reporting_airline as flight_num, "
            f"{minutes('crsarrtime')} as arr_minute, arrdelayminutes as delay from flights "
            f"where arrdelayminutes >= {min_delay} and {hubs}"
        ),
    )


ORACLE["cascade_chain"] = (
    "select cascade_level, flights_affected, destinations_affected, avg_delay_propagated, min_delay, max_delay, est_passengers from ("
    + chain("dest = 'ORD' and flightdate = '2025-10-15'", 30, 20, 180, one=("ORD", "2025-10-15"))
    + ")"
)
ORACLE["cascade_chain_all_hubs"] = chain("true", 30, 20, 180)
ORACLE["union_all_levels"] = chain("true", 15, 20, 120)
ORACLE["airport_map_join"] = statement(
    """
select airport, airport_name, latitude, longitude, airport || ' — ' || airport_name as label, cascade_vulnerability_score,
  avg_delay_min, avg_pct_delayed, total_economic_impact / 1e6 as cost_m,
  case when avg_pct_delayed > 22 then 'High (>22%)' when avg_pct_delayed > 18 then 'Moderate (18-22%)' else 'Low (<18%)' end as risk
from (select * from vuln order by vulnerability_rank, airport limit 26) join seeds on iata_code = airport
""",
    "vuln",
    "seeds",
)
ORACLE["cascade_destination_detail"] = statement(
    """
select f.origin as hub, f.flightdate, f.dest as outbound_dest, count(*) as flights, round(avg(depdelayminutes), 0) as avg_delay
from flights f join (
  select * from (select hub, flightdate, outbound_dest, count(*) as n from pairs where turnaround_gap <= 135 group by all)
  qualify row_number() over (partition by hub, flightdate order by n desc, outbound_dest) <= 10
) top on top.hub = f.origin and top.flightdate = f.flightdate and top.outbound_dest = f.dest
where depdelayminutes > 0 group by all
""",
    "pairs",
)
ORACLE["cascade_estimate"] = statement(
    f"""
select airport, delay as delay_minutes, {bigint('direct')} as directly_affected_flights, {bigint('cascade')} as cascade_affected_flights,
  {bigint('pax')} as total_affected_passengers,
  {bigint(f'floor(pax * delay * {PASSENGER_RATE} + 0.5)')} as estimated_passenger_cost,
  {bigint(f'floor((direct + cascade) * delay * {FLIGHT_RATE} + 0.5)')} as estimated_airline_cost,
  {bigint(f'floor(pax * delay * {PASSENGER_RATE} + (direct + cascade) * delay * {FLIGHT_RATE} + 0.5)')} as total_economic_impact,
  floor(multiplier * 10 + 0.5) / 10 as cascade_multiplier
from (select *, floor((direct + cascade) * ({PAX}) + 0.5) as pax
  from (select *, floor(direct * multiplier + 0.5) as cascade
    from (select airport, delay,
        floor((total_departures / operating_days) * (avg_pct_delayed / 100) + 0.5) as direct,
        (1 + (max_routes_served / 200) * cast(0.5 as double) + (max_airlines / 20) * cast(0.3 as double)) * least(delay / 60, 3) as multiplier
      from vuln, (values {', '.join(f'(cast({d} as double))' for d in DELAYS)}) as s(delay))))
""",
    "vuln",
)

# ------------------------------------------------------------------ roll-ups and portfolio

for _name, _table in {
    "int_airport_daily": "daily",
    "int_route_performance": "perf",
    "mart_delay_economics": "econ",
    "mart_cascade_vulnerability": "vuln",
    "mart_route_economics": "routes",
}.items():
    ORACLE[_name] = statement(f"select * from {_table}", _table)

_HUB_SCORE = score("pct_delayed_15plus", "avg_late_aircraft_delay", "route_count", "airline_count")
ORACLE["hub_vulnerability_ranking"] = statement(
    f"""
select *, round({_HUB_SCORE}, 1) as cascade_vulnerability_score, rank() over (order by {_HUB_SCORE} desc) as vulnerability_rank,
  ntile(5) over (order by pct_delayed_15plus desc, airport) as delay_quintile
from (select origin as airport, count(*) as total_departures, round(avg(depdelayminutes), 1) as avg_dep_delay,
    {pct('depdel15 = 1')} as pct_delayed_15plus, count(distinct dest) as route_count,
    count(distinct iata_code_reporting_airline) as airline_count,
    round(avg(lateaircraftdelay) filter (where lateaircraftdelay > 0), 1) as avg_late_aircraft_delay
  from flights where flightdate >= '2025-09-01' group by origin having count(*) >= 1000)
order by cascade_vulnerability_score desc, airport limit 20
""",
    "flights",
)
ORACLE["rolling_delay_trend"] = statement(
    """
select airport, flightdate, daily_avg_delay, rolling_7day_avg_delay, rolling_7day_pct_delayed,
  round(change, 1) as wow_delay_change,
  case when change > 5 then 'WORSENING' when change < -5 then 'IMPROVING' else 'STABLE' end as trend_status
from (select *, rolling_7day_avg_delay - lag(rolling_7day_avg_delay, 7) over (partition by airport order by flightdate) as change
  from rolled where flightdate >= '2025-10-08')
""",
    "flights",
    by_day=(
        "select origin as airport, flightdate, count(*) as n, round(avg(depdelayminutes), 1) as daily_avg_delay, "
        "count(*) filter (where depdel15 = 1) as late from flights "
        "where origin in ('ORD', 'ATL', 'JFK', 'DFW', 'LAX', 'DEN', 'EWR') and flightdate between '2025-10-01' and '2025-10-31' group by all"
    ),
    rolled=(
        f"select *, {rolling('daily_avg_delay', 'airport', 'flightdate')} as rolling_7day_avg_delay, "
        "round(avg(cast(late as double) * 100 / n) over (partition by airport order by flightdate "
        "rows between 6 preceding and current row), 1) as rolling_7day_pct_delayed from by_day"
    ),
)


def _share_of_late(column: str) -> str:
    return pct(f"{column} > 0", of="count(*) filter (where depdel15 = 1)")


ORACLE["delay_cause_by_hour"] = statement(
    f"""
select hour as dep_hour, {TIME_BLOCK.format(h='hour')} as time_block, count(*) as total_flights,
  count(*) filter (where depdel15 = 1) as delayed_flights, {pct('depdel15 = 1')} as pct_delayed,
  {_positive_mean('carrierdelay')} as avg_carrier_delay, {_positive_mean('weatherdelay')} as avg_weather_delay,
  {_positive_mean('nasdelay')} as avg_nas_delay, {_positive_mean('lateaircraftdelay')} as avg_late_aircraft,
  {_share_of_late('carrierdelay')} as pct_carrier_caused, {_share_of_late('weatherdelay')} as pct_weather_caused,
  {_share_of_late('nasdelay')} as pct_nas_caused, {_share_of_late('lateaircraftdelay')} as pct_late_aircraft_caused
from (select *, cast(floor(crsdeptime / 100) as integer) as hour from flights where crsdeptime >= 500)
where hour <= 23 group by hour
""",
    "flights",
)
_AIRLINE_ROUTES = (
    "select iata_code_reporting_airline as airline, origin, dest, count(*) as flights, round(avg(depdelayminutes), 1) as avg_delay, "
    f"{pct('depdel15 = 1')} as pct_delayed, {pct('cancelled = 1', 2)} as pct_cancelled from flights group by all having count(*) >= 50"
)
_PEER_DELAY = (
    "round(cast(sum(cast({x} as decimal(18,1))) over (partition by origin, dest) as double) "
    "/ count(*) over (partition by origin, dest), 1)"
)
_PEERS = (
    f"select *, {_PEER_DELAY.format(x='avg_delay')} as route_avg_delay, {_PEER_DELAY.format(x='pct_delayed')} as route_avg_pct_delayed, "
    "count(*) over (partition by origin, dest) as airlines_on_route from own"
)
ORACLE["partition_benchmark"] = statement("select * from peers", "flights", own=_AIRLINE_ROUTES, peers=_PEERS)
ORACLE["airline_scorecard"] = statement(
    f"""
select *, case when avg_delay_vs_benchmark > 3 then 'UNDERPERFORMER' when avg_delay_vs_benchmark < -3 then 'OUTPERFORMER'
    else 'AVERAGE' end as performance_tier,
  percent_rank() over (order by avg_delay_vs_benchmark) as performance_percentile
from (select airline, count(*) as routes_served, round({mean('avg_delay')}, 1) as overall_avg_delay,
    round({mean('pct_delayed')}, 1) as overall_pct_delayed, round({mean('pct_cancelled', 2)}, 2) as overall_pct_cancelled,
    {pct('avg_delay < route_avg_delay')} as pct_routes_below_avg_delay,
    round({mean('avg_delay - route_avg_delay')}, 1) as avg_delay_vs_benchmark
  from peers where airlines_on_route >= 2 group by airline having count(*) >= 10)
""",
    "flights",
    own=_AIRLINE_ROUTES,
    peers=_PEERS,
)
ORACLE["day_month_heatmap"] = statement(
    f"select {weekday('dayofweek')} as day_name, dayofweek, "
    + ", ".join(
        f"round(avg(depdelayminutes) filter (where month = {m}), 1) as {p}_avg_delay, "
        + pct(f"month = {m} and depdel15 = 1", of=f"count(*) filter (where month = {m})")
        + f" as {p}_pct_delayed"
        for m, p in ((9, "sep"), (10, "oct"), (11, "nov"))
    )
    + ", count(*) as total_flights from flights group by all",
    "flights",
)
_LPAX, _LOPS = costs("late", "long_delay")
ORACLE["route_economic_impact"] = statement(
    f"""
select route, n as total_flights, late as delayed_flights, round(cast(late as double) * 100 / n, 1) as pct_delayed,
  avg_delay_min, pax as est_passenger_cost, ops as est_airline_ops_cost, pax + ops as total_economic_impact,
  round((pax + ops) / n, 0) as cost_per_flight
from (select *, round({_LPAX}, 0) as pax, round({_LOPS}, 0) as ops
  from (select origin || ' → ' || dest as route, count(*) as n, count(*) filter (where depdel15 = 1) as late,
      round(avg(depdelayminutes), 1) as avg_delay_min, avg(if(depdelayminutes > 15, depdelayminutes, 0)) as long_delay
    from flights group by origin, dest having count(*) >= 100))
order by total_economic_impact desc, route limit 25
""",
    "flights",
)

# ------------------------------------------------------------------ windows and top lists

ORACLE["rolling_7row_avg"] = statement(
    f"select *, {rolling('avg_arr', 'origin', 'flightdate')} as rolling from "
    "(select origin, flightdate, round(avg(arrdelayminutes), 1) as avg_arr from flights group by all)",
    "flights",
)
ORACLE["rank_ntile"] = statement(
    "select *, rank() over (order by pct desc) as pct_rank, ntile(5) over (order by pct desc, origin, dayofweek) as quintile "
    f"from (select origin, dayofweek, {pct('depdel15 = 1')} as pct from flights group by all)",
    "flights",
)
ORACLE["top_n"] = statement(
    "select airport, flight_date, est_total_economic_impact from econ "
    "order by est_total_economic_impact desc, airport, flight_date limit 99",
    "econ",
)
ORACLE["distinct_dates"] = statement(
    "select distinct flight_date from econ where airport = 'ORD' order by flight_date desc limit 30", "econ"
)

# ------------------------------------------------------------------ serving

ORACLE["airport_delay_summary"] = statement(
    """
select airport, flight_date as date, total_departures, avg_dep_delay_min as avg_departure_delay_minutes,
  pct_delayed_15 as pct_flights_delayed_15plus, flights_delayed_15 as flights_delayed, pct_cancelled,
  est_total_economic_impact as estimated_economic_impact_usd, weather_delays, carrier_delays, nas_delays as nas_atc_delays,
  late_aircraft_delays, avg_weather_delay as weather, avg_carrier_delay as carrier, avg_nas_delay as nas_atc,
  avg_late_aircraft_delay as late_aircraft, rolling_7day_avg_delay, rolling_7day_pct_delayed
from econ where airport = 'ORD' and flight_date = (select max(flight_date) from econ)
""",
    "econ",
)
ORACLE["vulnerability_top_n"] = statement("select * from vuln order by vulnerability_rank, airport limit 15", "vuln")
ORACLE["economic_top_n"] = statement(
    "select airport, total_economic_impact, round(total_economic_impact / 1e6, 1) as cost_m from vuln "
    "order by total_economic_impact desc, airport limit 12",
    "vuln",
)
_COSTLIEST = "order by est_total_economic_impact desc, route_id, airline_iata limit"
ORACLE["costliest_routes"] = statement(f"select * from routes {_COSTLIEST} 20", "routes")
ORACLE["costliest_routes_by_cause"] = statement(
    f"select * from routes where dominant_delay_cause = 'Late Aircraft' {_COSTLIEST} 15", "routes"
)
ORACLE["costliest_routes_filtered"] = statement(
    "select * from routes where total_flights >= 150 and dominant_delay_cause in ('Weather', 'Carrier', 'NAS/ATC') "
    f"{_COSTLIEST} 30",
    "routes",
)


def _latest(where: str) -> str:
    return statement(
        f"select *, {WEATHER_TEXT} as weather, {MEANING} as flight_category_meaning from weather {where} "
        "qualify row_number() over (partition by station_id order by polled_at desc, observation_time desc) = 1",
        "weather",
    )


ORACLE["latest_weather"] = ORACLE["stream_latest_weather"] = _latest("")
ORACLE["latest_weather_station"] = _latest("where iata_code = 'JFK'")
ORACLE["overview_kpis"] = statement(
    f"select {bigint('sum(total_departures)')} as total_flights, round({mean('avg_dep_delay_min')}, 1) as avg_delay, "
    f"round({mean('pct_delayed_15')}, 1) as pct_delayed, round(sum(est_total_economic_impact), 0) as total_impact from econ",
    "econ",
)
_TREND = ("ORD", "ATL", "DFW", "JFK", "DEN")
ORACLE["airport_trend"] = statement(
    f"select flight_date, airport, rolling_7day_avg_delay from econ where airport in ({sql_list(_TREND)})", "econ"
)
ORACLE["airport_trend_wide"] = statement(
    "select flight_date, "
    + ", ".join(f"any_value(rolling_7day_avg_delay) filter (where airport = '{a}') as \"{a}\"" for a in _TREND)
    + f" from econ where airport in ({sql_list(_TREND)}) group by flight_date",
    "econ",
)
ORACLE["delay_rate_heatmap"] = statement(
    f"select day_name, month, round({mean('pct_delayed_15')}, 1) as value, "
    "cast(list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], day_name) as bigint) as day_order "
    "from econ group by day_name, month",
    "econ",
)
ORACLE["cause_distribution"] = statement(
    "select cause, n as count, round(cast(n as double) * 100 / sum(n) over (), 1) as share_pct from ("
    + " union all ".join(
        f"select '{label}' as cause, {bigint(f'sum({column})')} as n from econ"
        for label, column in (
            ("Weather", "weather_delays"),
            ("Carrier", "carrier_delays"),
            ("NAS/ATC", "nas_delays"),
            ("Late Aircraft", "late_aircraft_delays"),
        )
    )
    + ")",
    "econ",
)
ORACLE["daily_impact"] = statement("select flight_date, est_total_economic_impact from econ where airport = 'ORD'", "econ")
ORACLE["date_range"] = statement("select min(flight_date) as min_date, max(flight_date) as max_date from econ", "econ")
ORACLE["metric_query"] = statement(
    "select airport, day_name, sum(est_total_economic_impact) as total_economic_impact, "
    f"round({mean('avg_dep_delay_min')}, 4) as avg_delay, {bigint('sum(total_departures)')} as total_departures "
    "from econ group by airport, day_name",
    "econ",
)

# ------------------------------------------------------------------ health

# table, least rows, freshness column, age limit (hours), first required column
_EXPECTED = [
    ("raw_flights", "flights", 100000, None, None, "origin"),
    ("raw_positions", "positions", 1, "polled_at", 24, "icao24"),
    ("raw_weather", "weather", 1, "polled_at", 6, "station_id"),
    ("raw_airspace_status", "airspace", 1, "polled_at", 2, "airport_code"),
    ("stg_flights", "staged", 100000, None, None, "origin_airport"),
    ("mart_delay_economics", "econ", 1000, None, None, "airport"),
    ("mart_cascade_vulnerability", "vuln", 10, None, None, "airport"),
]
_MEASURED = " union all ".join(
    f"select '{name}' as name, {least} as least, {limit or 'null'} as hour_limit, '{first}' as first_column, count(*) as n, "
    f"{f'max({fresh})' if fresh else 'cast(null as varchar)'} as latest, count(*) filter (where {first} is null) as nulls from {table}"
    for name, table, least, fresh, limit, first in _EXPECTED
)
_AGED = (
    "select *, date_diff('microsecond', cast(latest as timestamp), "
    f"timestamp '{HEALTH_NOW[:-1].replace('T', ' ')}') / 3600e6 as age, cast(nulls as double) * 100 / nullif(n, 0) as null_pct from measured"
)
_HEALTH = """
select name, n, latest,
  case when null_pct > 20 then 'warning' when age > hour_limit then 'stale' when n = 0 then 'critical'
       when n < least then 'warning' else 'healthy' end as status,
  concat_ws('; ',
    case when n = 0 then 'no rows' end,
    case when n > 0 and n < least then format('only {:,} rows, wanted at least {:,}', n, least) end,
    case when age > hour_limit then printf('newest row %.1f hours old, limit %dh', age, hour_limit) end,
    case when null_pct > 20 then printf('Column ''%s'': %.1f%% of values null', first_column, null_pct) end) as issues
from aged
"""
_HEALTH_TABLES = dict(measured=_MEASURED, aged=_AGED, health=_HEALTH)
_READS = ("positions", "weather", "airspace", "vuln")
ORACLE["table_health"] = statement(
    "select name as table, status, if(issues = '', 'no issues', issues) as issues, n as row_count, latest as latest_record "
    "from health",
    *_READS,
    **_HEALTH_TABLES,
)
ORACLE["detect_issues"] = statement(
    "select name as table, status as severity, issues as problems, n as row_count, latest as latest_record from health "
    "where status <> 'healthy'",
    *_READS,
    **_HEALTH_TABLES,
)
ORACLE["health_rollup"] = statement(
    "select count(*) as total, "
    + ", ".join(f"count(*) filter (where status = '{s}') as {s}" for s in ("healthy", "warning", "stale", "critical"))
    + ", case when count(*) filter (where status <> 'healthy') = 0 then 'HEALTHY' "
    "when count(*) filter (where status = 'critical') = 0 then 'DEGRADED' else 'CRITICAL' end as overall_status from health",
    *_READS,
    **_HEALTH_TABLES,
)
_INVENTORY = " union all ".join(
    f"select '{name}' as name, count(*) as n, {f'max({fresh})' if fresh else 'cast(null as varchar)'} as latest, '{kind}' as kind from {table}"
    for name, table, fresh, kind in (
        ("raw_flights", "flights", "flightdate", "batch"),
        ("raw_positions", "positions", "polled_at", "streaming"),
        ("raw_weather", "weather", "polled_at", "streaming"),
        ("raw_airspace_status", "airspace", "polled_at", "streaming"),
        ("mart_delay_economics", "econ", "flight_date", "derived"),
        ("mart_cascade_vulnerability", "vuln", None, "derived"),
        ("mart_route_economics", "routes", None, "derived"),
    )
)
ORACLE["table_inventory"] = statement(
    "select name as table, n as row_count, ifnull(latest, 'N/A') as latest_record, kind as source_type, "
    "if(n > 0, 'healthy', 'empty') as status, if(min(n) over () > 0, 'healthy', 'degraded') as overall_status, "
    "concat(cast(count(*) filter (where n > 0) over () as varchar), '/', cast(count(*) over () as varchar)) as healthy_sources "
    "from listed",
    *_READS,
    "routes",
    listed=_INVENTORY,
)
ORACLE["assert_non_negative_delay"] = statement("select * from staged where dep_delay_abs_minutes < 0 limit 10", "staged")
_EARLY = "flight_date, origin_airport, dest_airport, airline_iata, flight_number"
ORACLE["assert_non_negative_early"] = statement(
    f"select dep_delay_minutes, {_EARLY} from staged where dep_delay_minutes < 0 order by dep_delay_minutes, {_EARLY} limit 25", "staged"
)
