"""Batches give the same models as one full build."""

import json
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from tarmac.config import Settings, durable
from tarmac.operators.versions import Conflict, FileTable
from tarmac.plans import marts, public, staging
from tarmac.schemas import LOAD_STAMP
from tarmac.sinks.models import DESCRIPTIONS, TABLES
from tarmac.sources.airports import feed_airports
from tarmac.sources.feed import movement_feed
from tarmac.sources.spine import time_spine
from tarmac.streaming.arrivals import run_arrivals
from tarmac.streaming.pipeline import Pipeline
from tests.conftest import SF, movement


def full_build(raw):
    flights = durable(staging.stg_flights(raw), "full-build")
    fact = marts.flights_performance(flights)
    return {
        "stg_flights": flights,
        "flights_performance": fact,
        "routes_metrics_daily": marts.routes_metrics_daily(fact),
        "stg_airlines": staging.stg_airlines(flights),
        "stg_aircraft": staging.stg_aircraft(flights),
        "airline_metrics": marts.airline_metrics(fact),
        "airport_operations": marts.airport_operations(fact),
        "delay_analysis": marts.delay_analysis(fact),
        "public_gates_analysis": public.public_gates_analysis(fact),
    }


def assert_same(pipeline, full):
    for name, want in full.items():
        got = pipeline.model(name).select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name


def test_batches_equal_full_build(spark, tmp_path):
    raw = movement_feed(spark, SF)
    pipeline = Pipeline(spark, str(tmp_path))
    # Split at random, so that older versions of a movement also arrive after newer ones.
    part = F.pmod(F.xxhash64("data"), F.lit(2))
    for batch in range(2):
        pipeline.apply(raw.filter(part == batch), batch)
    assert_same(pipeline, full_build(raw))
    # Only rows with the last stamp itself are read again; they change nothing.
    again = pipeline.new_deliveries(raw)
    assert again.select("_sdc_extracted_at").distinct().count() == 1
    pipeline.apply(again, 2)
    assert_same(pipeline, {"stg_flights": full_build(raw)["stg_flights"]})


def test_changes_move_between_groups(raw, tmp_path, spark):
    first = [
        (movement(id="1", atda="10:20"), 1, 11),
        (movement(id="2", matricula="LV-1"), 1, 11),
        (movement(id="3", IATAdestorig="EZE", stda="11:00"), 1, 11),
        (movement(id="4", x_date="2024-01-09"), 1, 11),
        (movement(id="5", x_fetched_at=None), 1, 11),
        (movement(id="6"), 1, 11),
    ]
    second = [
        # The airline, the route and the hour of a known movement change; a stale version comes late.
        (movement(id="1", idaerolinea="FO", aerolinea="Foehn", stda="12:00"), 3, 11),
        (movement(id="3", IATAdestorig="B1", stda="13:00"), 3, 11),
        (movement(id="2", gate="stale"), 0, 11),
        # The only valid route of its day becomes invalid.
        (movement(id="4", x_date="2024-01-09", IATAdestorig="B1"), 3, 11),
        # Equal extraction stamps: a known fetch time beats an unknown one, either way round.
        (movement(id="5", gate="G5"), 1, 11),
        (movement(id="6", gate="G6", x_fetched_at=None), 1, 11),
        (movement(id=None, gate="K2"), 3, 11),
        (movement(id=None, gate="K3", idaerolinea="FO"), 2, 11),
        (movement(id=None, gate="K1", x_date=None), 4, 11),
    ]
    third = [(movement(arpt=None, gate="K4"), 5, 11), (movement(id=None, gate="K0"), 1, 11)]
    pipeline = Pipeline(spark, str(tmp_path))
    pipeline.apply(raw(*first), 0)
    pipeline.apply(raw(*second), 1)
    assert pipeline.unkeyed(1).count() == 3
    assert {'"K1"' in r["data"] for r in pipeline.unkeyed(1).collect()} == {True, False}
    assert_same(pipeline, full_build(raw(*first, *second)))
    # A batch applied before changes nothing, and numbers never fall.
    pipeline.apply(raw(*first), 1)
    assert pipeline.model("stg_flights").count() == 7
    pipeline.apply(raw(*second), 2)
    assert pipeline.model("stg_flights").count() == 7
    assert_same(pipeline, {"delay_analysis": full_build(raw(*first, *second))["delay_analysis"]})
    pipeline.apply(raw(*third), 3)
    full = full_build(raw(*first, *second, *third))
    assert_same(pipeline, {name: full[name] for name in ("stg_flights", "stg_airlines", "delay_analysis")})
    pipeline.apply(raw(), 5)
    with pytest.raises(ValueError, match="batch 4"):
        pipeline.apply(raw(*second), 4)


def test_batches_break_off_and_readers_see_whole_batches(raw, tmp_path, spark, monkeypatch):
    first = [(movement(), 1, 11), (movement(id="3", idaerolinea="FO"), 1, 11)]
    second = [(movement(atda="10:30"), 2, 11), (movement(id="2", idaerolinea="FO"), 2, 11), (movement(id=None), 2, 11)]
    pipeline = Pipeline(spark, str(tmp_path), maintained=["airline_totals", "delay_parts"])
    pipeline.apply(raw(*first), 0)
    held = pipeline.version()
    whole, written = FileTable.write, []

    def total(version=None):
        daily = pipeline.model("delay_analysis", version).filter("analysis_type = 'daily'")
        return daily.agg(F.sum("total_flights")).first()[0]

    for last in range(100):
        calls = []

        def write(table, df, load, calls=calls, last=last):
            # Whatever is written so far, readers see the batch before.
            assert pipeline.version() == held
            if len(calls) == last:
                raise RuntimeError("driver lost")
            calls.append(table.name)
            return whole(table, df, load)

        with monkeypatch.context() as patch:
            patch.setattr(FileTable, "write", write)
            try:
                pipeline.apply(raw(*second), 1)
                break
            except RuntimeError as error:
                assert str(error) == "driver lost"
        written = calls
        if last in (2, 5):
            assert total() == 2 and pipeline.model("airline_metrics").count() == 2
    assert len(written) == last - 1 and {"stg_flights", "keyless", "flight_ids", "delay_parts"} <= set(calls)
    full = full_build(raw(*first, *second))
    assert_same(pipeline, {name: full[name] for name in ("stg_flights", "airline_metrics", "delay_analysis")})
    # A reader of the version before still reads all of it.
    assert total(held) == 2 and total() == 4
    assert pipeline.movements(version=held).count() == 2


def test_equal_deliveries_without_a_key_count_each(spark, tmp_path):
    # Movements 7 and 48007 lack their id, so these events make equal deliveries; movement 8 has its id.
    seen = [
        (14, datetime(2024, 1, 5, 10), "view"),
        (96014, datetime(2024, 1, 5, 10), "view"),
        (15, datetime(2024, 1, 5, 10), "click"),
        # With the last stamp of the first run, so the second run sees them again.
        (96015, datetime(2024, 1, 10, 12), "view"),
        (15, datetime(2024, 1, 10, 12), "view"),
        (16, datetime(2024, 1, 10, 12), "view"),
        (14, datetime(2024, 1, 25, 9), "view"),
    ]
    rows = [(event, at, 1, kind, 1.0, '{"k": 3}') for event, at, kind in seen]
    columns = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["incr_unkeyed"](spark, str(tmp_path)).collect()
    assert sorted((row.day, row.deliveries) for row in got) == [
        (date(2024, 1, 5), 3),
        (date(2024, 1, 10), 2),
        (date(2024, 1, 25), 1),
    ]


def test_two_writers_from_one_version(raw, tmp_path, spark):
    pipeline = Pipeline(spark, str(tmp_path), maintained=[])
    other = Pipeline(spark, str(tmp_path), maintained=[])
    base = pipeline.version()
    pipeline.apply(raw((movement(), 1, 11)), 0)
    with pytest.raises(Conflict, match="version 1 was committed"):
        other.log.commit(replace(base, number=1, batch=0))
    assert other.version().batch == 0 and other.model("stg_flights").count() == 1


def test_a_batch_rewrites_the_files_of_its_keys_only(raw, tmp_path, spark, monkeypatch):
    pipeline = Pipeline(spark, str(tmp_path), maintained=["airline_totals"])
    conf = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in conf}
    many = [(movement(id=f"F{i:05d}"), 1, 11) for i in range(1000)]
    many += [(movement(id=f"F{i:05d}", x_date="2024-01-08"), 1, 11) for i in range(20)]
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        pipeline.apply(raw(*many), 0)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    before = set(pipeline.flights.paths(pipeline.version()))
    day = {p for p in before if "flight_date=2024-01-10" in p}
    assert len(day) > 80
    read = []
    rows = FileTable.rows

    def reading(table, paths, file=None):
        read.extend(p for p in paths if table.name == "stg_flights")
        return rows(table, paths, file)

    ten = [(movement(id=f"F{i:05d}", idaerolinea="FO"), 2, 11) for i in range(100, 110)]
    monkeypatch.setattr(FileTable, "rows", reading)
    pipeline.apply(raw(*ten), 1)
    monkeypatch.undo()
    after = set(pipeline.flights.paths(pipeline.version()))
    # Ten neighbouring keys lie in few files; the others stay as they are.
    assert 1 <= len(before - after) <= 4
    assert all("flight_date=2024-01-10" in p for p in read)
    counts = {r.airline_code: (r.unique_flights, r.total_flight_records) for r in pipeline.model("airline_metrics").collect()}
    assert counts == {"AR": (990, 1010), "FO": (10, 10)}
    assert pipeline.model("stg_flights").count() == 1020

    pipeline.compact([date(2024, 1, 10)])
    assert len([p for p in pipeline.flights.paths(pipeline.version()) if "2024-01-10" in p]) < 10
    assert pipeline.model("stg_flights").count() == 1020
    assert pipeline.drop_old(1) > 80
    assert pipeline.model("stg_flights").count() == 1020
    # Batches applied before stay known.
    assert pipeline.apply(raw(*ten), 0).batch == 1


def test_every_model_by_its_name(raw, tmp_path, spark):
    airports = feed_airports(spark)
    deliveries = raw(*[(movement(id=str(i), gate=f"G{i % 3}", atda="10:40"), 1, 11) for i in range(9)])
    settings = Settings(as_of=date(2024, 1, 12))
    pipeline = Pipeline(spark, str(tmp_path), settings, airports=airports)
    pipeline.apply(deliveries, 0)
    fact = marts.flights_performance(staging.stg_flights(deliveries, settings))
    known = staging.stg_airports(airports)
    daily = marts.routes_metrics_daily(fact)
    want = {
        "stg_airports": known,
        "metricflow_time_spine": time_spine(spark),
        "routes_metrics": marts.routes_metrics(daily, known, settings),
        "public_headline": public.public_headline(fact, settings),
        "public_airline_breakdown": public.public_airline_breakdown(fact, settings),
        "public_bucket_distribution": public.public_bucket_distribution(fact, settings),
        "public_daily_status": public.public_daily_status(fact, known, settings),
        "public_tops": public.public_tops(fact, known, settings),
        "public_gates_analysis": public.public_gates_analysis(fact),
    }
    assert_same(pipeline, want)
    assert all(pipeline.model(name).count() for name in want)
    assert set(TABLES) == {*want, "stg_flights", "stg_airlines", "stg_aircraft", "flights_performance", "airline_metrics",
                           "airport_operations", "delay_analysis", "routes_metrics_daily"}
    begun = datetime.now() - timedelta(hours=1)
    for name in ("stg_flights", "routes_metrics_daily", "airline_metrics"):
        stamped = pipeline.stamped_model(name)
        assert stamped.columns == [*pipeline.model(name).columns, LOAD_STAMP]
        assert stamped.filter(F.col(LOAD_STAMP) < F.lit(begun)).isEmpty()
        assert stamped.schema["airline_code"].metadata["comment"] == DESCRIPTIONS["airline_code"]
    with pytest.raises(KeyError, match="no model elsewhere; there are stg_flights"):
        pipeline.model("elsewhere")


def test_arrivals(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    pipeline = Pipeline(spark, f"{tmp_path}/models", maintained=["delay_parts"])

    def arrive(name, *documents):
        (folder / name).write_text("\n".join(json.dumps(d) for d in documents) + "\n")
        run_arrivals(pipeline, str(folder)).awaitTermination()

    arrive("a.jsonl", movement(id="1", gate="G1"), movement(id="2"))
    arrive("b.jsonl", movement(id="1", gate="G2"))
    gates = {row.flight_id: row.gate for row in pipeline.model("stg_flights").collect()}
    assert gates == {"1": "G2", "2": None}
    daily = pipeline.model("delay_analysis").filter("analysis_type = 'daily'").first()
    assert daily.total_flights == 2
