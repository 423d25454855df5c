"""Column functions at the edges of their rules."""

import pytest
from pyspark.sql import functions as F

from groundhold import functions as fn
from groundhold.operators.cascade import cascade_costs
from groundhold.schemas import CLOUD_LAYERS


def values(spark, rows, schema, *columns):
    out = spark.createDataFrame(rows, schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    return [tuple(r) if len(columns) > 1 else r[0] for r in out.collect()]


def test_hhmm(spark):
    rows = [(v,) for v in (0.0, 59.0, 100.0, 459.0, 500.0, 2359.0, 2400.0, None)]
    got = values(spark, rows, "t double", fn.hhmm_to_minutes("t"), fn.scheduled_hour("t"))
    assert got == [(0, 0), (59, 0), (60, 1), (299, 4), (300, 5), (1439, 23), (1440, 24), (None, None)]


def test_days(spark):
    rows = [(1,), (5,), (6,), (7,), (8,), (None,)]
    got = values(spark, rows, "d int", fn.day_name("d"), fn.is_weekend("d"))
    assert got == [
        ("Monday", False), ("Friday", False), ("Saturday", True), ("Sunday", True), (None, False), (None, False),
    ]


CAUSE = "cancelled double, depdelayminutes double, weatherdelay double, nasdelay double, " \
    "lateaircraftdelay double, carrierdelay double, securitydelay double"


@pytest.mark.parametrize(
    "row, cause",
    [
        ((1.0, 90.0, 90.0, 0.0, 0.0, 0.0, 0.0), "Cancelled"),
        ((0.0, 15.0, 20.0, 0.0, 0.0, 0.0, 0.0), "On Time"),
        ((0.0, None, 20.0, 0.0, 0.0, 0.0, 0.0), "On Time"),
        ((0.0, 16.0, 8.0, 0.0, 0.0, 8.0, 0.0), "Weather"),
        ((0.0, 16.0, 0.0, 8.0, 8.0, 0.0, 0.0), "NAS/ATC"),
        ((0.0, 16.0, 0.0, 0.0, 8.0, 8.0, 0.0), "Late Aircraft"),
        ((0.0, 16.0, 1.0, 2.0, 3.0, 9.0, 0.0), "Carrier"),
        ((0.0, 16.0, 0.0, 0.0, 0.0, 0.0, 16.0), "Security"),
        ((0.0, 16.0, 0.0, 0.0, 0.0, 1.0, 16.0), "Carrier"),
        ((0.0, 16.0, None, None, None, None, None), "Other"),
        ((None, 16.0, None, 5.0, None, None, None), "NAS/ATC"),
    ],
)
def test_flight_cause(spark, row, cause):
    assert values(spark, [row], CAUSE, fn.primary_delay_cause()) == [cause]


@pytest.mark.parametrize(
    "counts, cause",
    [
        ((5, 5, 5, 5), "Weather"),
        ((0, 0, 0, 0), "Weather"),
        ((1, 5, 5, 5), "Late Aircraft"),
        ((1, 2, 5, 5), "NAS/ATC"),
        ((1, 2, 3, 5), "Carrier"),
    ],
)
def test_route_cause(spark, counts, cause):
    schema = "weather_count long, late_aircraft_count long, nas_count long, carrier_count long"
    assert values(spark, [counts], schema, fn.dominant_delay_cause()) == [cause]


def test_bands(spark):
    rows = [(5.0,), (5.1,), (-5.0,), (-5.1,), (None,), (22.0,), (22.1,), (18.0,), (18.1,), (3.1,), (-3.1,)]
    got = values(spark, rows, "x double", fn.trend_status("x"), fn.performance_tier("x"), fn.risk_band("x"))
    assert [g[0] for g in got[:5]] == ["STABLE", "WORSENING", "STABLE", "IMPROVING", "STABLE"]
    assert [g[2] for g in got[5:9]] == ["Moderate (18-22%)", "High (>22%)", "Low (<18%)", "Moderate (18-22%)"]
    assert [g[1] for g in got[9:]] == ["UNDERPERFORMER", "OUTPERFORMER"]


def test_time_blocks(spark):
    got = values(spark, [(h,) for h in (4, 5, 8, 9, 12, 15, 18, 20, 21)], "h int", fn.time_block("h"))
    assert got == [
        "Night", "Early Morning", "Early Morning", "Mid Morning", "Afternoon", "Late Afternoon", "Evening", "Evening", "Night",
    ]


def test_weather_rules(spark):
    schema = "cat string, vis double, ceil double, gust double, wx string"
    rows = [
        ("VFR", 10.0, None, 36.0, "TS"),  # gusts come before storms
        ("MVFR", 10.0, None, None, "TS"),  # the category comes before both
        ("VFR", 3.0, 1000.0, 35.0, None),
        ("VFR", 2.9, None, None, None),
        ("VFR", None, 999.0, None, ""),
        (None, None, None, None, "-SN"),
        ("LIFR", None, None, None, None),
        ("VFR", None, None, None, "+TSRA"),
    ]
    got = values(
        spark, rows, schema,
        fn.weather_severity("cat", "gust", "wx"), fn.is_delay_risk_weather("cat", "vis", "ceil", "gust", "wx"),
    )
    assert got == [
        ("Moderate", True), ("Marginal", True), ("Clear", False), ("Clear", True), ("Clear", True), ("Clear", True),
        ("Severe", True), ("Severe", True),
    ]
    assert values(spark, [(None,), ("",), ("-RA",)], "w string", fn.weather_or_none("w")) == [
        "No significant weather", "No significant weather", "-RA",
    ]
    meanings = values(spark, [("IFR",), ("X",), (None,)], "c string", fn.flight_category_meaning("c"))
    assert meanings[0].startswith("Instrument") and meanings[1:] == ["Unknown", "Unknown"]


def test_flight_phase_and_status(spark):
    rows = [(True, 9.0), (False, 2.1), (False, -2.1), (False, 2.0), (None, None), (None, 3.0)]
    got = values(spark, rows, "g boolean, r double", fn.flight_phase("g", "r"))
    assert got == ["Ground", "Climbing", "Descending", "Cruise", "Cruise", "Climbing"]
    kinds = [("Ground Stop",), ("Ground Delay Program",), ("Arrival/Departure Delay",), ("Departure Delay",),
             ("No Active Delays",), ("Closure",), (None,)]
    got = values(spark, kinds, "k string", fn.delay_category("k"), fn.is_severe_program("k"))
    assert got == [
        ("Ground Stop", True), ("GDP", True), ("Arrival Delay", False), ("Departure Delay", False),
        ("Normal Operations", False), ("Other", False), ("Other", False),
    ]


def test_clouds(spark):
    rows = [
        (None,), ([],), ([("FEW", "1000"), ("OVC", "3000"), ("BKN", "2000")],), ([("BKN", None), ("OVC", "900")],),
        ([("VV", "200")],), ([(None, "5"), ("SCT", "5")],), ([("SKC", None), ("VV", None)],), ([("", None)],),
    ]
    df = spark.createDataFrame(rows, spark.createDataFrame([], "clouds array<struct<cover:string,base:string>>").schema)
    assert df.schema["clouds"].dataType == CLOUD_LAYERS
    got = [tuple(r) for r in df.select(fn.cloud_cover("clouds"), fn.ceiling_ft("clouds")).collect()]
    assert got == [
        ("CLR", None), ("CLR", None), ("OVC", 3000.0), ("OVC", 900.0), ("VV", None), ("SCT", None), ("SKC", None), ("CLR", None),
    ]


def test_tolerant_double(spark):
    got = values(spark, [("10+",), ("VRB",), ("3",), ("-1.5",), (None,)], "t string", fn.tolerant_double("t"))
    assert got == [10.0, None, 3.0, -1.5, None]


def test_costs(spark):
    cost = fn.delay_cost_columns("n", "d", total_flights="t")
    got = values(spark, [(10, 30.0, 100), (0, 0.0, 0)], "n long, d double, t long", *cost.values())
    assert got[0] == (30902.0, 20544.0, 51446.0, 514.0)  # 10*160*0.87*30*0.74 and 10*30*68.48
    assert got[1] == (0.0, 0.0, 0.0, None)


def test_published_cascade_example(spark):
    """567 direct and 1,565 cascade flights at 90 minutes: 296,774 passengers, about $32.9M."""
    columns = cascade_costs(F.col("d"), F.col("c"), F.col("m"))
    ((_, passengers, _, _, total),) = values(spark, [(567, 1565, 90.0)], "d long, c long, m double", *columns.values())
    assert passengers == 296774 and round(total / 1e6, 1) == 32.9
