"""Readers and sinks on hand-written files."""

import json

import pytest

from groundhold import sources as src
from groundhold.params import CostParameters
from groundhold.schemas import RAW_AIRSPACE, RAW_FLIGHTS, RAW_POSITIONS, RAW_WEATHER


def test_flights_csv(spark, tmp_path):
    text = (
        " Year ,FlightDate,Origin,OriginCityName,Dest,DepDelayMinutes,CRSDepTime,Tail_Number\n"
        "2025,2025-10-15,ORD,São Paulo,EWR,12.00,1430,N1\n2025.0,2025-10-16,ORD,Chicago,EWR,,905,N2\n"
    )
    (tmp_path / "a.csv").write_bytes(text.encode("latin-1"))
    (tmp_path / "b.csv").write_bytes(text.splitlines()[0].encode("latin-1"))  # header only
    df = src.read_flights_csv(spark, str(tmp_path))
    assert df.schema.names == RAW_FLIGHTS.names
    rows = df.orderBy("flightdate").collect()
    assert [(r.year, r.flightdate, r.origincityname, r.depdelayminutes, r.crsdeptime) for r in rows] == [
        (2025, "2025-10-15", "São Paulo", 12.0, 1430.0), (2025, "2025-10-16", "Chicago", None, 905.0),
    ]


def test_flights_csv_guards(spark, tmp_path):
    for name, text in (("empty", "Year,FlightDate\n"), ("undated", "Year\n2025\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(text)
        with pytest.raises(ValueError):
            src.read_flights_csv(spark, str(tmp_path / name))


def test_csv_files_with_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'FlightDate,Origin,Distance,Year\n2025-10-01,ORD,100,2025\n2025-10-02,"A, B",far,x\n')
    (tmp_path / "b.csv").write_bytes(b'\xef\xbb\xbf"YEAR"," Tail ","Dest","FLIGHTDATE "\n"2024.0","N1","S\xe3o","2025-10-03"\n')
    (tmp_path / "c.csv").write_bytes(b" flightdate \n2025-10-04\n\n")
    (tmp_path / "d.csv").write_bytes(b"")
    (tmp_path / "e.csv").write_bytes(b"Origin,Origin,FlightDate\nLAX\nSFO,OAK,2025-10-05,more,and more\n")
    rows = src.read_flights_csv(spark, str(tmp_path)).select("flightdate", "origin", "dest", "distance", "year").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("2025-10-01", "ORD", None, 100.0, 2025), ("2025-10-02", "A, B", None, None, None), ("2025-10-03", None, "São", None, 2024),
         ("2025-10-04", None, None, None, None), (None, "LAX", None, None, None), ("2025-10-05", "SFO", None, None, None)], key=str
    )
    unfit = src.unfit_values(spark, str(tmp_path)).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.column_name, r.unfit, r.example) for r in unfit) == [
        ("a.csv", "distance", 1, "far"), ("a.csv", "year", 1, "x")
    ]
    (tmp_path / "f.csv").write_text("Origin\nORD\n")
    with pytest.raises(ValueError, match="f.csv"):
        src.read_flights_csv(spark, str(tmp_path))


def test_csv_files_split_into_blocks(spark, tmp_path):
    """Blocks behind the first have no header of their own; rows that come before others in a header still match."""
    for k, header in enumerate(("FlightDate,Distance", "Distance,FlightDate")):
        lines = [f"2025-10-{k + 1:02},{i}" if k == 0 else f"{i},2025-10-{k + 1:02}" for i in range(4000)]
        (tmp_path / f"{k}.csv").write_text("\n".join([header, *lines]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = src.read_flights_csv(spark, str(tmp_path)).groupBy("flightdate").agg({"distance": "sum", "*": "count"}).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.flightdate, r["sum(distance)"], r["count(1)"]) for r in rows) == [
        (f"2025-10-0{k}", 3999 * 2000.0, 4000) for k in (1, 2)
    ]


def test_csv_rows_carry_one_number_of_their_layout(spark, tmp_path):
    """No 37 places per row; many layouts still match, and files keep their names in the report."""
    for k, header in enumerate(("FlightDate,Distance", "Distance,FlightDate")):
        values = ("2025-10-01", "far")
        (tmp_path / f"a {k}.csv").write_text(f"{header}\n{','.join(values if k == 0 else values[::-1])}\n")
    df = src.read_flights_csv(spark, str(tmp_path))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "layout" in text and "at_distance" not in text and "_metadata" not in text
    names = spark.read.text(str(tmp_path)).select("_metadata.file_path").distinct().collect()
    found = src.unfit_values(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == sorted((r.file_path, "distance", 1, "far") for r in names)
    for k in range(20):
        (tmp_path / f"b{k}.csv").write_text(f"{'x,' * k}FlightDate,Distance\n{'0,' * k}2025-11-01,{k}\n")
    rows = src.read_flights_csv(spark, str(tmp_path)).filter("month is null and flightdate = '2025-11-01'").collect()
    assert sorted(r.distance for r in rows) == list(range(20))


def test_append_raw(spark, make_flights, tmp_path):
    path = str(tmp_path / "raw")
    src.append_raw(make_flights([{}, {"flightdate": "2025-10-16"}]), path, "flightdate")
    src.append_raw(make_flights([{}]), path, "flightdate")
    back = src.read_raw(spark, path, RAW_FLIGHTS)
    assert back.schema == RAW_FLIGHTS
    assert sorted(r.flightdate for r in back.collect()) == ["2025-10-15", "2025-10-15", "2025-10-16"]
    plan = back.filter("flightdate = '2025-10-15'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(flightdate" in plan


STATE = ["a1b2c3", " UAL12  ", "United States", 1, 2, -87.9, 41.98, 3000.5, False, 200.1, 90.0, -3.2, [7], 3100, "1200", False]


def write_positions(folder):
    states = [
        STATE,  # 16 values
        [*STATE, 0, 5],  # 18 values
        [*STATE[:5], None, 41.0],  # no longitude
        ["short", None, None, None, None, -80.0, 60.0],
    ]
    (folder / "p1.json").write_text(json.dumps({"time": 1760000000, "states": states}))
    (folder / "p2.json").write_text(json.dumps({"time": 1760000030, "states": None}))


def test_positions(spark, tmp_path):
    write_positions(tmp_path)
    df = src.read_position_snapshots(spark, str(tmp_path))
    assert df.schema.names == RAW_POSITIONS.names
    rows = df.collect()
    assert len(rows) == 3 and {r.snapshot_time for r in rows} == {1760000000}
    first = rows[0]
    assert (first.callsign, first.longitude, first.on_ground, first.vertical_rate, first.geo_altitude) == (
        "UAL12", -87.9, False, -3.2, 3100.0,
    )
    assert [(r.velocity, r.geo_altitude) for r in rows if r.icao24 == "short"] == [(None, None)]
    assert first.polled_at.endswith("+00:00") and "T" in first.polled_at
    assert src.filter_bbox(df).count() == 2 and src.filter_bbox(df, lamax=60.0).count() == 3


METARS = [
    {"icaoId": "KORD", "reportTime": "2025-10-15 12:00:00", "rawOb": "METAR KORD", "wdir": "VRB", "wspd": 5, "visib": "10+",
     "temp": 20.5, "altim": 1013, "clouds": [], "wxString": None, "fltcat": "VFR"},
    {"icaoId": "PHNL", "wdir": 90, "wgst": 36, "visib": 3, "clouds": [{"cover": "BKN", "base": None}, {"cover": "SCT", "base": 900}]},
    {"icaoId": "KJFK", "clouds": [{"cover": "FEW", "base": 1000}, {"cover": "OVC", "base": 2500}], "fltcat": "MVFR"},
]


def test_weather(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps(METARS))
    df = src.read_weather_snapshots(spark, str(tmp_path))
    assert df.schema.names == RAW_WEATHER.names
    rows = {r.station_id: r for r in df.collect()}
    ord_, hnl, jfk = rows["KORD"], rows["PHNL"], rows["KJFK"]
    assert (ord_.iata_code, hnl.iata_code) == ("ORD", "PHNL")
    assert (ord_.wind_direction_deg, ord_.wind_speed_kt, ord_.visibility_miles, ord_.weather_string) == (None, 5.0, 10.0, "")
    assert (ord_.cloud_cover, ord_.ceiling_ft) == ("CLR", None)
    assert (hnl.cloud_cover, hnl.ceiling_ft, hnl.wind_gust_kt, hnl.observation_time) == ("BKN", None, 36.0, "")
    assert (jfk.cloud_cover, jfk.ceiling_ft, jfk.flight_category) == ("OVC", 2500.0, "MVFR")


BUSY = """<AIRPORT_STATUS_INFORMATION><Update_Time>now</Update_Time>
<Delay_type><Ground_Delay_List>
 <Ground_Delay><ARPT>SFO</ARPT><Reason> low ceilings </Reason><Avg>1 hour</Avg><Max>2 hours</Max></Ground_Delay>
 <Ground_Delay><ARPT>SFO</ARPT><Reason>low ceilings</Reason><Avg>9 hours</Avg></Ground_Delay>
 <Ground_Delay Airport="LGA"><reason>wind</reason><average>10</average><Adv>0100</Adv></Ground_Delay>
 <Ground_Delay><Reason>nowhere</Reason></Ground_Delay>
</Ground_Delay_List></Delay_type>
<Ground_Stop_List><Ground_Stop><ARPT>ORD</ARPT><Reason>storms</Reason><End>5 pm</End></Ground_Stop></Ground_Stop_List>
<Delay_type><Arrival_Departure_Delay_List>
 <Delay><ARPT>BOS</ARPT><Reason>volume</Reason><Min>15</Min></Delay><Delay><ARPT>MIA</ARPT></Delay>
</Arrival_Departure_Delay_List></Delay_type></AIRPORT_STATUS_INFORMATION>"""
QUIET = "<AIRPORT_STATUS_INFORMATION><Update_Time>now</Update_Time></AIRPORT_STATUS_INFORMATION>"


def test_airspace(spark, tmp_path):
    (tmp_path / "a.xml").write_text(BUSY)
    (tmp_path / "b.xml").write_text(QUIET)
    df = src.read_airspace_status(spark, str(tmp_path))
    assert df.schema.names == RAW_AIRSPACE.names
    rows = sorted(tuple(r)[:7] for r in df.collect())
    assert rows == [
        ("BOS", "Arrival/Departure Delay", "volume", "15", "", "", ""),
        ("LGA", "Ground Delay Program", "wind", "10", "", "0100", ""),
        ("ORD", "Ground Stop", "storms", "", "", "", "5 pm"),
        ("SFO", "Ground Delay Program", "low ceilings", "1 hour", "2 hours", "", ""),
        ("SFO", "Ground Delay Program", "low ceilings", "9 hours", "", "", ""),
    ]
    unique = src.read_airspace_status(spark, str(tmp_path), unique=True).collect()
    assert sorted((r.airport_code, r.avg_delay, r.has_delay) for r in unique) == [
        ("BOS", "15", True), ("LGA", "10", True), ("NAS", "", False), ("ORD", "", True), ("SFO", "1 hour", True),
    ]


SHAPES = """<?xml version="1.0"?><feed xmlns:n="urn:n"><AIRPORT_STATUS_INFORMATION when="now"><!-- <GDP><ARPT>NO</ARPT></GDP> -->
<GDP><ARPT></ARPT><airport> DFW </airport><reason>fog &amp; rain</reason><Avg> </Avg><Average>10</Average></GDP>
<a><b><c><d><ground_delay_program arpt="IAH"><REASON><![CDATA[a < b]]></REASON></ground_delay_program></d></c></b></a>
<Departure_Delay><ARPT>BOS</ARPT><Reason>wind</Reason><Arrival_Delay><ARPT>JFK</ARPT><Reason>ice</Reason><Min>5</Min></Arrival_Delay></Departure_Delay>
<Delay_Program><ARPT>XXX</ARPT><Reason>a program is no delay</Reason></Delay_Program>
<Ground_Stop_Ground_Delay><ARPT>SEA</ARPT><Max>1</Max></Ground_Stop_Ground_Delay>
<Airport_Closure><ARPT>ZZZ</ARPT><Reason>closed</Reason></Airport_Closure>
</AIRPORT_STATUS_INFORMATION><AIRPORT_STATUS_INFORMATION/>\n<AIRPORT_STATUS_INFORMATION x="/>"/>
<AIRPORT_STATUS_INFORMATION><Airport_Closure><ARPT>ZZZ</ARPT></Airport_Closure></AIRPORT_STATUS_INFORMATION>
<AIRPORT_STATUS_INFORMATION><Delay><ARPT>ORD</ARPT><Reason>broken</Delay></AIRPORT_STATUS_INFORMATION></feed>"""


def test_airspace_of_any_shape(spark, tmp_path):
    (tmp_path / "a.xml").write_text(SHAPES)
    rows = [tuple(r)[:7] for r in src.read_airspace_status(spark, str(tmp_path)).collect()]
    assert rows == [
        ("DFW", "Ground Delay Program", "fog & rain", "10", "", "", ""),
        ("IAH", "Ground Delay Program", "a < b", "", "", "", ""),
        ("BOS", "Arrival/Departure Delay", "wind", "", "", "", ""),
        ("JFK", "Arrival/Departure Delay", "ice", "5", "", "", ""),
        ("SEA", "Ground Delay Program", "", "", "1", "", ""),
    ]
    unique = src.read_airspace_status(spark, str(tmp_path), unique=True)
    assert unique.filter("airport_code = 'NAS'").count() == 3  # the quiet polls, not the broken one
    unread = src.unread_airspace(spark, str(tmp_path)).collect()
    assert len(unread) == 1 and "broken" in unread[0].document and unread[0].polled_at.endswith("+00:00")


def test_status_kinds():
    from groundhold.sources.airspace import status_records

    def kinds(tag):
        return [r["delay_type"] for r in status_records(f"<r><{tag}><ARPT>A</ARPT><Reason>b</Reason></{tag}></r>")]

    program, stop, delay = ["Ground Delay Program"], ["Ground Stop"], ["Arrival/Departure Delay"]
    expected = {"GDP": program, "myGdpX": program, "Ground_Delay_List": program, "GROUND_STOP": stop, "Ground_Stop_List": stop,
                "Delay": delay, "Delay_type": delay, "Departure_Delay": delay, "Program_Delay": [], "Delay_Program": [], "Closure": []}
    assert {tag: kinds(tag) for tag in expected} == expected
    assert status_records("<r><Delay><ARPT>A</ARPT></Delay><GDP><Reason>b</Reason></GDP></r>") == []
    assert status_records("<r>") is None


def test_a_large_file_of_polls_is_split(spark, tmp_path):
    document = "<AIRPORT_STATUS_INFORMATION><GDP><ARPT>A{}</ARPT></GDP></AIRPORT_STATUS_INFORMATION>"
    (tmp_path / "a.xml").write_text("<polls>" + "\n".join(document.format(i) for i in range(5000)) + "</polls>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = src.read_airspace_status(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert sorted(r.airport_code for r in df.collect()) == sorted(f"A{i}" for i in range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dedup_rows(spark):
    rows = [("ORD", "Ground Stop", "WX", a, "", "", "", True, "t1") for a in ("2", "1")] + [
        ("ORD", "Ground Stop", "WX", "3", "", "", "", True, "t2"), ("ORD", "Ground Stop", "EQ", "4", "", "", "", True, "t1"),
    ]
    polls = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "polled_at string")
    got = src.dedup_airspace_status(spark.createDataFrame(rows, RAW_AIRSPACE), polls).collect()
    assert sorted((r.polled_at, r.airport_code, r.avg_delay) for r in got) == [
        ("t1", "ORD", "1"), ("t1", "ORD", "4"), ("t2", "ORD", "3"), ("t3", "NAS", ""),
    ]


def test_json_snapshots_keep_nulls(spark, tmp_path):
    path = str(tmp_path / "backup")
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    src.write_json_snapshots(df, path)
    src.write_json_snapshots(df, path)
    assert '{"k":"a","v":null}' in [r.value for r in spark.read.text(path).collect()]
    assert spark.read.json(path).count() == 4


def test_seeds(spark, tmp_path):
    airports, parameters = src.read_seeds(spark)
    assert airports.count() == 26 and airports.filter("is_major_hub").count() == 23
    assert CostParameters.from_table(parameters) == CostParameters()
    with pytest.raises(ValueError):
        CostParameters.from_table(parameters.limit(2))
    (tmp_path / "c.csv").write_text(
        "parameter_name,value,unit,source\npassenger_delay_cost_per_minute,1,USD,x\nairline_ops_cost_per_minute,2,USD,x\n"
        "avg_load_factor,0.5,ratio,x\navg_seats_domestic,100,count,x\n"
    )
    _, own = src.read_seeds(spark, parameters_csv=str(tmp_path / "c.csv"))
    assert CostParameters.from_table(own) == CostParameters(1.0, 2.0, 0.5, 100)
