"""Feed payloads and landed files built from ``events``, for the reader and stream queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundhold.schemas import CLOUD_LAYERS
from groundhold.session import scratch_path

from .frames import AIRPORTS, CATEGORIES, REASONS, SPARK, WEATHER, derive

LAYER_CODES = ["SKC", "CLR", "FEW", "SCT", "BKN", "OVC", "VV"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id as e", "user_id as u", "cast(round(value * 100) as bigint) as v"
    )


def _pick(values: list[str], index: str) -> Column:
    return F.expr(SPARK.pick(values, index))


def with_clouds(rows: DataFrame) -> DataFrame:
    """Adds ``clouds``: up to three layers, some with an unknown code or without a base."""
    layers = [
        F.when(
            F.col("e") % 4 > i,
            F.struct(
                _pick(LAYER_CODES, f"(v + {i} * e) % 7").alias("cover"),
                F.expr(f"case when (v + {i}) % 5 = 0 then null else cast((v + {i}) % 50 * 100 as string) end").alias("base"),
            ),
        )
        for i in range(3)
    ]
    return rows.withColumn("clouds", F.array_compact(F.array(*layers)).cast(CLOUD_LAYERS))


def weather_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """METAR-like reports: text numbers, ``10+``, ``VRB`` and a station without leading K."""
    rows = with_clouds(events(spark, sf_dir))
    return rows.select(
        F.expr(f"case when u % 10 = 9 then 'PHNL' else concat('K', {SPARK.pick(AIRPORTS, 'u % 10')}) end").alias("icaoId"),
        F.expr("cast(e as string)").alias("reportTime"),
        F.expr("concat('METAR ', e)").alias("rawOb"),
        F.expr("case when v % 11 = 0 then 'VRB' else cast((v % 36) * 10 as string) end").alias("wdir"),
        F.expr("v % 40").alias("wspd"),
        F.expr("case when v % 4 = 0 then v % 40 + 15 end").alias("wgst"),
        F.expr("case when v % 7 = 0 then '10+' else cast(e % 11 as string) end").alias("visib"),
        F.expr("v % 45 - 10").alias("temp"),
        F.expr("case when v % 3 = 0 then null else v % 20 end").alias("dewp"),
        F.expr("30").alias("altim"),
        "clouds",
        F.expr(f"case when v % 13 = 0 then null else {SPARK.pick(WEATHER, 'e % 5')} end").alias("wxString"),
        _pick(CATEGORIES, "v % 5").alias("fltcat"),
    )


def position_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State arrays of 12 or 18 values (the short ones miss the trailing fields)."""
    rows = derive(spark, sf_dir, "raw_positions")
    number = F.col("baro_altitude").cast("long")
    nothing = F.lit(None).cast("string")
    text = {name: F.col(name).cast("string") for name in rows.columns}
    head = [
        text["icao24"], F.concat(F.lit("  CS"), number.cast("string"), F.lit(" ")), F.lit("United States"), nothing, nothing,
        text["longitude"], text["latitude"], text["baro_altitude"], text["on_ground"], text["velocity"],
        F.lit("180"), text["vertical_rate"],
    ]
    tail = [nothing, text["velocity"], nothing, F.lit("false"), F.lit("0"), F.lit("1")]
    state = F.when(number % 2 == 0, F.array(*head)).otherwise(F.array(*head, *tail))
    return rows.select(number.alias("time"), F.array(state).alias("states"))


# Tags of the status kinds as different publishers write them, and the tags around them.
PROGRAM_TAGS = ["Ground_Delay", "GDP", "Ground_Delay_Program", "ground_delay"]
DELAY_TAGS = ["Delay", "Departure_Delay", "arrival_delay", "Arrival_Departure_Delay"]
AROUND = ["body", "Delay_type", "Ground_Delay_List"]


def airspace_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event: no, one or two records at depths 1 to 4, with other tags, cases, attributes and a duplicate."""
    rows = events(spark, sf_dir)

    def tags(form: str, around: list[tuple[int, str]]) -> list[Column]:
        return [F.expr(f"if(e div 4 % 4 > {level}, '{form.format(tag)}', '')") for level, tag in around]

    around = list(enumerate(AROUND))
    before, behind = tags("<{}>", around), tags("</{}>", around[::-1])

    def element(condition: str, tag: Column, *children: Column) -> Column:
        """An element with its airport as child or attribute; an empty text where the condition fails."""
        code = _pick(AIRPORTS, "u % 10")
        child = F.when(F.expr("e % 3 = 0"), F.concat(F.lit("><ARPT> "), code, F.lit("</ARPT>")))
        child = child.when(F.expr("e % 3 = 1"), F.concat(F.lit(' Airport="'), code, F.lit('">')))
        child = child.otherwise(F.concat(F.lit("><arpt>"), code, F.lit("</arpt>")))
        reason = F.concat(F.lit("<Reason>"), _pick(REASONS, "v % 3"), F.lit("</Reason>"))
        whole = F.concat(*before, F.lit("<"), tag, child, reason, *children, F.lit("</"), tag, F.lit(">"), *behind)
        return F.when(F.expr(condition), whole).otherwise("")

    program, delay = _pick(PROGRAM_TAGS, "e div 8 % 4"), _pick(DELAY_TAGS, "e div 8 % 4")
    times = [F.expr("concat('<Average>1 hour</Average><maximum>', v % 90, ' minutes</maximum><Adv>0100</Adv>')")]
    parts = [
        F.lit("<Update_Time>now</Update_Time>"),
        element("e % 4 = 0", program, *times),
        element("e % 8 = 0", program, *times),
        element("e % 4 in (0, 1)", F.lit("Ground_Stop"), F.lit("<End><![CDATA[5 pm]]></End><Program_Delay/>")),
        element("e % 4 = 2", delay, F.expr("concat('<Avg> </Avg><Min>', v % 60, '</Min>')")),
        F.lit("<Airport_Closure_List><Airport><ARPT>ZZZ</ARPT><Reason>closed</Reason></Airport></Airport_Closure_List>"),
    ]
    tag = "AIRPORT_STATUS_INFORMATION"
    full = F.concat(F.lit(f"<{tag}>"), *parts, F.lit(f"</{tag}>"))
    return rows.select(F.when(F.expr("e % 4 = 3 and e % 8 = 3"), f"<{tag}/>").otherwise(full).alias("value"))


def land_json(spark: SparkSession, payload: DataFrame, name: str) -> str:
    """Writes a payload as JSON lines to a fresh scratch folder."""
    path = scratch_path(spark, name)
    payload.write.option("ignoreNullFields", "false").json(path)
    return path


def land_airspace(spark: SparkSession, sf_dir: str) -> str:
    """Files of many documents each."""
    path = scratch_path(spark, "airspace-xml")
    airspace_texts(spark, sf_dir).write.text(path)
    return path
