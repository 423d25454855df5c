"""Raw tables derived from the driver's tables, for Spark and as SQL text.

One row of ``lineitem`` becomes one flight, one row of ``events`` one weather
report, one aircraft position and one airspace status. All values follow from the
source row by integer arithmetic, so both engines derive equal rows. Each table is
a chain of select lists; ``{div}`` and the pick/date helpers are the only places
where the dialects differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AIRPORTS = ["ORD", "ATL", "DFW", "DEN", "LAX", "JFK", "EWR", "BOS", "SFO", "MIA"]
STATES = ["IL", "GA", "TX", "CO", "CA", "NY", "NJ", "MA", "CA", "FL"]
AIRLINES = ["AA", "UA", "DL", "WN"]
COVERS = ["CLR", "FEW", "SCT", "BKN", "OVC"]
WEATHER = ["", "-RA", "+TSRA", "FZDZ", "-SN"]
CATEGORIES = ["VFR", "VFR", "MVFR", "IFR", "LIFR"]
DELAY_TYPES = [
    "Ground Stop", "Ground Delay Program", "Arrival/Departure Delay", "No Active Delays", "Departure Delay", "Closure",
]
REASONS = ["WX", "VOL", "EQ"]


@dataclass(frozen=True)
class Dialect:
    div: str
    array: str  # opening of an array literal
    close: str
    element: str  # 1-based element access
    flight_day: str
    iso_weekday: str
    text: str

    def pick(self, values: list[str], index: str) -> str:
        width = len(values[0])
        if width > 0 and all(len(v) == width for v in values):  # a slice of one literal is cheaper than an array
            return f"substring('{''.join(values)}', cast({index} as int) * {width} + 1, {width})"
        items = ", ".join(f"'{v}'" for v in values)
        return f"{self.element}({self.array}{items}{self.close}, cast({index} as int) + 1)"


SPARK = Dialect(
    div="div",
    array="array(",
    close=")",
    element="element_at",
    flight_day="date_add(date'2025-09-01', cast(datediff(cast(l_shipdate as date), date'1995-01-01') % 91 as int))",
    iso_weekday="weekday(fdate) + 1",
    text="string",
)
DUCKDB = Dialect(
    div="//",
    array="[",
    close="]",
    element="list_extract",
    flight_day=(
        "date '2025-09-01' + cast(date_diff('day', date '1995-01-01', cast(l_shipdate as date)) % 91 as integer)"
    ),
    iso_weekday="isodow(fdate)",
    text="varchar",
)


def _double(expr: str) -> str:
    return f"cast({expr} as double)"


def flight_layers(d: Dialect) -> list[list[str]]:
    hhmm = "(({m} {div} 60) * 100 + {m} % 60)".replace("{div}", d.div)

    def unless_cancelled(expr: str) -> str:
        return f"case when canc then null else {_double(expr)} end"

    def flag(condition: str) -> str:
        return _double(f"case when {condition} then 1 else 0 end")

    def cause(*branches: str) -> str:
        return f"case when not late then null {' '.join(branches)} else {_double('0')} end"

    def when(condition: str, expr: str) -> str:
        return f"when {condition} then {_double(expr)}"

    base = [
        "l_orderkey as ok", "l_partkey as pk", "l_suppkey as sk", "cast(l_linenumber as bigint) as ln",
        "cast(round(l_extendedprice * 100) as bigint) as p", f"{d.flight_day} as fdate",
    ]
    keys = [
        "ok", "pk", "sk", "ln", "p", "fdate",
        "(pk * 37 + ok * 11 + ln * 101) % 1440 as dm",
        "sk % 10 as oi",
        "(sk % 10 + 1 + pk % 9) % 10 as di",
        "p % 53 = 0 as canc",
        f"case when p % 5 = 0 then (p {d.div} 5) % 180 else -((p {d.div} 5) % 10) end as dd",
    ]
    delays = ["*", "(dm + 60 + pk % 240) % 1440 as am", "dd + (ln - 4) * 3 as ad"]
    lateness = ["*", "(not canc and ad >= 15) as late", f"ad {d.div} 2 as h"]
    flights = [
        "cast(year(fdate) as int) as year",
        "cast(quarter(fdate) as int) as quarter",
        "cast(month(fdate) as int) as month",
        "cast(day(fdate) as int) as dayofmonth",
        f"cast({d.iso_weekday} as int) as dayofweek",
        f"cast(fdate as {d.text}) as flightdate",
        f"{d.pick(AIRLINES, 'ok % 4')} as reporting_airline",
        f"{d.pick(AIRLINES, 'ok % 4')} as iata_code_reporting_airline",
        "cast(ok % 9000 + 1 as int) as flight_number_reporting_airline",
        f"{d.pick(AIRPORTS, 'oi')} as origin",
        f"concat({d.pick(AIRPORTS, 'oi')}, ' City') as origincityname",
        f"{d.pick(STATES, 'oi')} as originstate",
        f"{d.pick(AIRPORTS, 'di')} as dest",
        f"concat({d.pick(AIRPORTS, 'di')}, ' City') as destcityname",
        f"{d.pick(STATES, 'di')} as deststate",
        f"case when pk % 97 = 0 then null else {_double(hhmm.replace('{m}', 'dm'))} end as crsdeptime",
        f"{unless_cancelled(hhmm.replace('{m}', '((dm + dd + 1440) % 1440)'))} as deptime",
        f"{unless_cancelled('dd')} as depdelay",
        f"{unless_cancelled('greatest(dd, 0)')} as depdelayminutes",
        f"case when canc then null else {flag('dd >= 15')} end as depdel15",
        f"{_double(hhmm.replace('{m}', 'am'))} as crsarrtime",
        f"{unless_cancelled(hhmm.replace('{m}', '((am + ad + 1440) % 1440)'))} as arrtime",
        f"{unless_cancelled('ad')} as arrdelay",
        f"{unless_cancelled('greatest(ad, 0)')} as arrdelayminutes",
        f"case when canc then null else {flag('ad >= 15')} end as arrdel15",
        f"{flag('canc')} as cancelled",
        f"case when canc then {d.pick(['A', 'B', 'C'], 'pk % 3')} end as cancellationcode",
        f"{flag('not canc and p % 401 = 0')} as diverted",
        f"{_double('60 + pk % 240')} as crselapsedtime",
        f"{unless_cancelled('60 + pk % 240 + ad - dd')} as actualelapsedtime",
        f"{unless_cancelled('40 + pk % 240')} as airtime",
        f"{_double('200 + ((oi * 7 + di * 11) % 23) * 100')} as distance",
        f"{cause(when('pk % 6 = 0', 'ad'), when('pk % 6 in (4, 5)', 'h'))} as carrierdelay",
        f"{cause(when('pk % 6 = 1', 'ad'), when('pk % 6 = 4', 'ad - h'))} as weatherdelay",
        f"{cause(when('pk % 6 = 2', 'ad'))} as nasdelay",
        f"{cause(when('pk % 6 = 3 and ok % 8 = 0', 'ad'))} as securitydelay",
        f"{cause(when('pk % 6 = 3 and ok % 8 <> 0', 'ad'), when('pk % 6 = 5', 'ad - h'))} as lateaircraftdelay",
    ]
    return [base, keys, delays, lateness, flights]


def _event_base(d: Dialect) -> list[str]:
    return [
        "event_id as e", "user_id as u", "cast(round(value * 100) as bigint) as v",
        f"replace(substr(cast(ts as {d.text}), 1, 19), ' ', 'T') as polled_at",
    ]


def weather_layers(d: Dialect) -> list[list[str]]:
    null_text, null_number = f"cast(null as {d.text})", "cast(null as double)"
    return [
        _event_base(d),
        ["*", f"{d.pick(AIRPORTS, 'u % 10')} as iata"],
        [
            "concat('K', iata) as station_id",
            "iata as iata_code",
            "polled_at as observation_time",
            f"{null_text} as raw_metar",
            f"{_double('(v % 36) * 10')} as wind_direction_deg",
            f"{_double('v % 40')} as wind_speed_kt",
            f"case when v % 4 = 0 then {_double('v % 40 + 15')} end as wind_gust_kt",
            f"case when v % 11 = 0 then null else {_double('e % 11')} end as visibility_miles",
            f"{_double('v % 45 - 10')} as temperature_c",
            f"{null_number} as dewpoint_c",
            f"{null_number} as altimeter_inhg",
            f"{d.pick(COVERS, 'e % 5')} as cloud_cover",
            f"case when e % 5 >= 3 then {_double('(v % 50) * 100')} end as ceiling_ft",
            f"case when v % 13 = 0 then null else {d.pick(WEATHER, 'e % 5')} end as weather_string",
            f"{d.pick(CATEGORIES, 'v % 5')} as flight_category",
            "polled_at",
        ],
    ]


def position_layers(d: Dialect) -> list[list[str]]:
    return [
        _event_base(d),
        [
            f"concat('a', cast(u as {d.text})) as icao24",
            f"cast(null as {d.text}) as callsign",
            f"cast(null as {d.text}) as origin_country",
            f"{_double('v % 58 - 124')} as longitude",
            f"case when v % 17 = 0 then null else {_double('24 + v % 25')} end as latitude",
            f"{_double('v % 12000')} as baro_altitude",
            "cast(null as double) as geo_altitude",
            "case when e % 19 = 0 then null else v % 9 = 0 end as on_ground",
            f"{_double('v % 260')} as velocity",
            "cast(null as double) as true_track",
            f"case when v % 23 = 0 then null else {_double('e % 13 - 6')} end as vertical_rate",
            "cast(0 as bigint) as snapshot_time",
            "polled_at",
        ],
    ]


def airspace_layers(d: Dialect) -> list[list[str]]:
    return [
        _event_base(d),
        [
            f"case when v % 41 = 0 then null else {d.pick(AIRPORTS, 'u % 10')} end as airport_code",
            f"{d.pick(DELAY_TYPES, 'e % 6')} as delay_type",
            f"{d.pick(REASONS, 'v % 3')} as delay_reason",
            "'' as avg_delay",
            "'' as max_delay",
            "'' as start_time",
            "'' as end_time",
            "e % 6 <> 3 as has_delay",
            "polled_at",
        ],
    ]


TABLES = {
    "raw_flights": ("lineitem", flight_layers),
    "raw_weather": ("events", weather_layers),
    "raw_positions": ("events", position_layers),
    "raw_airspace": ("events", airspace_layers),
}


ROWS_PER_TASK = 1_000_000


def derive(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A derived raw table; a narrow projection of the source scan.

    The (narrow) base columns are spread over the cores first, as a source file may
    be one row group and thus one task; a task gets ``ROWS_PER_TASK`` rows or so at most.
    """
    source, layers = TABLES[table]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    base, *rest = layers(SPARK)
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    df = df.selectExpr(*base).repartition(tasks, base[0].split(" as ")[-1])
    for layer in rest:
        df = df.selectExpr(*layer)
    return df


def derive_sql(table: str) -> str:
    """The same table as nested SELECTs over the source view."""
    sql, layers = TABLES[table]
    for layer in layers(DUCKDB):
        sql = f"(select {', '.join(layer)} from {sql})"
    return sql[1:-1]
