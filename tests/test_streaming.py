"""Feeds as streams: once mode, restarts, stateful views."""

import json
import random
import shutil

import pytest

from groundhold import streaming
from groundhold.schemas import RAW_AIRSPACE, RAW_POSITIONS, RAW_WEATHER
from groundhold.sources import read_raw

from .test_sources import BUSY, METARS, QUIET, write_positions


def run(query):
    assert query.awaitTermination(120)


def folders(tmp_path, *names):
    made = [tmp_path / name for name in names]
    made[0].mkdir()
    return made


def test_positions_restart(spark, tmp_path):
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")
    write_positions(landing)

    def once():
        run(streaming.stream_positions(spark, str(landing), str(table), str(checkpoint)))
        return read_raw(spark, str(table), RAW_POSITIONS).count()

    assert once() == 3
    assert once() == 3  # nothing new, nothing twice
    (landing / "p3.json").write_text((landing / "p1.json").read_text())
    assert once() == 6


def test_weather_in_small_batches(spark, tmp_path):
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")
    for n, metar in enumerate(METARS):
        (landing / f"w{n}.json").write_text(json.dumps([metar]))
    run(streaming.stream_weather(spark, str(landing), str(table), str(checkpoint), max_files=1))
    rows = read_raw(spark, str(table), RAW_WEATHER).collect()
    assert sorted(r.station_id for r in rows) == ["KJFK", "KORD", "PHNL"]


def test_airspace_marks_quiet_polls(spark, tmp_path):
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")
    (landing / "a.xml").write_text(BUSY)
    (landing / "b.xml").write_text(QUIET)
    run(streaming.stream_airspace(spark, str(landing), str(table), str(checkpoint)))
    rows = read_raw(spark, str(table), RAW_AIRSPACE).collect()
    assert sorted(r.airport_code for r in rows) == ["BOS", "LGA", "NAS", "ORD", "SFO"]


def test_interval_mode_runs_until_stopped(spark, tmp_path):
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")
    write_positions(landing)
    query = streaming.stream_positions(spark, str(landing), str(table), str(checkpoint), once=False, interval=1)
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_raw(spark, str(table), RAW_POSITIONS).count() == 3


def weather_row(station, polled, temperature):
    values = {"station_id": station, "iata_code": station[1:], "polled_at": polled, "observation_time": polled,
              "temperature_c": temperature}
    return tuple(values.get(name) for name in RAW_WEATHER.names)


def test_latest_weather(spark, tmp_path):
    landing, state, checkpoint = folders(tmp_path, "landing", "state", "checkpoint")

    def step(*rows):
        spark.createDataFrame(rows, RAW_WEATHER).coalesce(1).write.mode("append").parquet(str(landing))
        stream = spark.readStream.schema(RAW_WEATHER).parquet(str(landing))
        run(streaming.write_latest_weather(stream, str(state), str(checkpoint)))
        return {r.station_id: r.temperature_c for r in streaming.read_latest_weather(spark, str(state)).collect()}

    assert step(weather_row("KORD", "t2", 2.0), weather_row("KORD", "t1", 1.0)) == {"KORD": 2.0}
    assert step(weather_row("KJFK", "t1", 9.0), weather_row("KORD", "t3", 3.0)) == {"KORD": 3.0, "KJFK": 9.0}
    assert step(weather_row("KORD", "t0", 0.0)) == {"KORD": 3.0, "KJFK": 9.0}


def test_latest_weather_keeps_few_versions(spark, tmp_path):
    """Many micro-batches: what a reader lists and reads doesn't grow, and a broken version is passed over."""
    landing, state, checkpoint = folders(tmp_path, "landing", "state", "checkpoint")
    for n in range(12):
        rows = [weather_row(f"K{s:03}", f"t{n:02}", float(n)) for s in range(n, 20)]
        spark.createDataFrame(rows, RAW_WEATHER).coalesce(1).write.mode("append").parquet(str(landing))
    stream = spark.readStream.schema(RAW_WEATHER).option("maxFilesPerTrigger", 1).parquet(str(landing))
    run(streaming.write_latest_weather(stream, str(state), str(checkpoint)))
    versions = sorted(p.name for p in state.iterdir())
    assert versions == ["version=10", "version=11", "version=9"]
    found = streaming.read_latest_weather(spark, str(state))
    assert {r.station_id: r.temperature_c for r in found.collect()} == {f"K{s:03}": float(min(s, 11)) for s in range(20)}
    assert len(found.inputFiles()) <= 4
    (state / "version=12").mkdir()
    assert streaming.read_latest_weather(spark, str(state)).count() == 20
    with pytest.raises(ValueError, match="no version"):
        streaming.read_latest_weather(spark, str(tmp_path / "nowhere"))


def status_rows(rows):
    return [(code, kind, reason, avg, "", "", "", True, poll) for code, kind, reason, avg, poll in rows]


def unique_once(spark, landing, table, checkpoint):
    stream = spark.readStream.schema(RAW_AIRSPACE).option("maxFilesPerTrigger", 1).parquet(str(landing))
    query = streaming.write_unique_airspace(stream, str(table), str(checkpoint))
    run(query)
    return query, read_raw(spark, str(table), RAW_AIRSPACE).collect()


def test_unique_airspace_in_any_order(spark, tmp_path):
    """9,998 rows of 400 polls over four days, shuffled over files that come one per micro-batch, with nulls and copies."""
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")
    rng = random.Random(3)
    polls = [f"2025-10-{day}T{hour:02}:{minute:02}:00+00:00" for day in (14, 15, 16, 17) for hour in range(20) for minute in range(0, 60, 12)]
    rows = [(rng.choice(["ORD", "JFK", "SFO", None]), rng.choice(["Ground Stop", "Delay"]), rng.choice(["WX", "VOL", None]), "", rng.choice([*polls, None]))
            for _ in range(9_998)]
    for n in range(8):
        spark.createDataFrame(status_rows(rows[n::8]), RAW_AIRSPACE).coalesce(1).write.mode("append").parquet(str(landing))
    query, found = unique_once(spark, landing, table, checkpoint)
    got = sorted(((r.airport_code, r.delay_type, r.delay_reason, "", r.polled_at) for r in found), key=str)
    assert got == sorted(set(rows), key=str)
    assert len(query.recentProgress) >= 8 and all(not p.stateOperators for p in query.recentProgress)


def test_unique_airspace_after_a_restart(spark, tmp_path):
    """A poll that arrives hours late counts, once; a micro-batch that failed half way is written anew."""
    landing, table, checkpoint = folders(tmp_path, "landing", "table", "checkpoint")

    def step(*rows):
        spark.createDataFrame(status_rows(rows), RAW_AIRSPACE).coalesce(1).write.mode("append").parquet(str(landing))
        return sorted((r.polled_at[11:16], r.avg_delay) for r in unique_once(spark, landing, table, checkpoint)[1])

    def at(time, avg=""):
        return "ORD", "Ground Stop", "WX", avg, f"2025-10-15T{time}:00+00:00"

    assert step(at("12:00", "2"), at("12:00", "1")) == [("12:00", "1")]
    assert step(at("12:00", "0"), at("12:01")) == [("12:00", "1"), ("12:01", "")]
    assert step(at("01:00"), at("01:00")) == [("01:00", ""), ("12:00", "1"), ("12:01", "")]
    half = table / "poll_day=2025-10-15" / "batch_id=3"  # what a failed attempt of the next micro-batch left
    shutil.copytree(table / "poll_day=2025-10-15" / "batch_id=1", half)
    assert step(at("12:01"), at("12:02")) == [("01:00", ""), ("12:00", "1"), ("12:01", ""), ("12:02", "")]
