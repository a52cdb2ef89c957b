"""Marts and public summaries on hand-written movements."""

from datetime import date

import pytest

from tarmac.config import Settings
from tarmac.plans import marts, public
from tarmac.plans.staging import stg_aircraft, stg_airlines, stg_airports, stg_flights
from tarmac.sources.airports import feed_airports
from tests.conftest import movement

SETTINGS = Settings(as_of=date(2024, 1, 12))


@pytest.fixture
def fact(raw):
    return lambda *documents: marts.flights_performance(stg_flights(raw(*documents)))


def test_airline_without_measured_departure_ranks_first(fact):
    rows = marts.airline_metrics(
        fact(
            movement(id="1", atda="10:20"),
            movement(id="2", idaerolinea="FO", aerolinea="Foehn"),
            movement(id="3", idaerolinea="LA", aerolinea="Llanura", atda="09:50"),
        )
    ).collect()
    got = {row.airline_code: (row.avg_departure_delay_minutes, row.avg_delay_rank) for row in rows}
    assert got == {"FO": (None, 1), "LA": (-10.0, 2), "AR": (20.0, 3)}


def test_share_of_departures_may_exceed_hundred(fact):
    documents = [movement(id=str(i), mov="A", atda="10:00") for i in range(3)]
    row = marts.airline_metrics(fact(*documents, movement(id="d", atda="10:00"))).first()
    assert row.on_time_departure_percentage == 400.0
    arrivals_only = marts.airline_metrics(fact(*documents)).first()
    assert arrivals_only.on_time_departure_percentage == 0.0


def test_renamed_airline_has_a_row_per_name(fact):
    rows = marts.airline_metrics(fact(movement(id="1"), movement(id="2", aerolinea="New"), movement(id="3", aerolinea=None))).collect()
    got = sorted((str(row.airline_name), row.unique_flights, row.total_departures) for row in rows)
    assert got == [("Andes Regional", 1, 1), ("New", 1, 1), ("None", 1, 1)]


def test_distinct_flights(fact):
    rows = marts.airline_metrics(
        fact(
            movement(id="1"),
            movement(id="1", arpt="EZE", mov="A"),
            movement(id="1", x_date="2024-01-11"),
            movement(id="2", IATAdestorig="EZE"),
        )
    ).collect()
    (row,) = rows
    assert (row.total_flight_records, row.unique_flights) == (4, 2)
    assert (row.total_departures, row.total_arrivals) == (2, 1)
    assert (row.unique_airports, row.unique_routes) == (2, 2)


def test_peak_hours(fact):
    rows = marts.airport_operations(
        fact(
            movement(id="1", stda="08:00"),
            movement(id="2", stda="08:30"),
            movement(id="3", stda="07:30"),
            movement(id="4", stda="07:10"),
            movement(id="5", stda=None),
            movement(id="6", arpt="EZE", mov="A", stda=None),
            movement(id="7", arpt="EZE", mov="A", stda=None),
            movement(id="8", arpt="EZE", mov="A", stda="03:00"),
        )
    ).collect()
    got = {row.airport_code: (row.peak_departure_hour, row.peak_arrival_hour) for row in rows}
    # The earliest of equally busy hours; an unknown hour wins if it is the most frequent.
    assert got == {"AEP": (7, None), "EZE": (None, None)}


def test_delay_analysis_has_all_grains(fact):
    table = fact(
        movement(id="1", atda="10:20"),
        movement(id="2", atda="09:50"),
        movement(id="3", mov="A", atda="11:10"),
        movement(id="4", IATAdestorig=None),
        movement(id="5", stda=None),
    )
    rows = {
        (row.analysis_type, row.dimension_1, row.dimension_2, row.dimension_3): row
        for row in marts.delay_analysis(table).collect()
    }
    assert set(rows) == {
        ("hourly", "2024-01-10", "10", None),
        ("daily", "2024-01-10", "4", None),
        ("route", "AEP", "COR", None),
        ("airline", "AR", "Andes Regional", "4"),
        ("distribution", "on_time", None, None),
        ("distribution", "minor", None, None),
        ("distribution", "severe", None, None),
    }
    assert rows[("hourly", "2024-01-10", "10", None)].total_flights == 4
    assert rows[("daily", "2024-01-10", "4", None)].min_delay_minutes is None
    route = rows[("route", "AEP", "COR", None)]
    assert (route.total_flights, route.total_delayed_flights) == (3, 1)
    assert route.first_seen_date == date(2024, 1, 10)
    severe = rows[("distribution", "severe", None, None)]
    assert (severe.total_flights, severe.avg_delay_when_delayed, severe.severe_delays) == (3, 70.0, None)


def test_delay_analysis_reads_the_fact_once(fact):
    plan = marts.delay_analysis(fact(movement()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    assert plan.count("Scan ExistingRDD") == 1


def test_route_average_weighs_all_completed_flights(fact):
    daily = marts.routes_metrics_daily(
        fact(
            movement(id="1", atda="10:30"),
            # Completed, but too far off to be averaged: adds to the weight only.
            movement(id="2", stda="00:10", atda="23:40"),
            movement(id="3", x_date="2024-01-11", atda="10:10"),
            movement(id="4", IATAdestorig="B1"),
        )
    )
    assert daily.count() == 2
    (row,) = marts.routes_metrics(daily, stg_airports(feed_airports(daily.sparkSession)), SETTINGS).collect()
    assert row.avg_delay_minutes == pytest.approx((30 * 2 + 10) / 3)
    assert (row.origin_city, row.destination_city) == ("Buenos Aires", "Cordoba")
    assert (row.window_start_date, row.window_end_date) == (date(2024, 1, 10), date(2024, 1, 11))


def test_routes_outside_the_window_drop(fact):
    daily = marts.routes_metrics_daily(fact(movement()))
    airports = stg_airports(feed_airports(daily.sparkSession))
    assert marts.routes_metrics(daily, airports, Settings(as_of=date(2024, 6, 1))).count() == 0


def test_summaries_of_nothing(fact):
    empty = fact(movement(mov="A"))
    head = public.public_headline(empty, SETTINGS).first()
    assert (head.total_flights, head.cancelled_flights, head.avg_delay_minutes) == (0, None, None)
    buckets = public.public_bucket_distribution(empty, SETTINGS).collect()
    assert [row.total_flights for row in buckets] == [0] * 6


def test_daily_top_destination_ignores_unknown_cities(fact):
    table = fact(
        *[movement(id=str(i), IATAdestorig="ZZZ", destorig=None) for i in range(3)],
        movement(id="8", IATAdestorig="GRU"),
        movement(id="9", IATAdestorig="YYY", destorig="Nowhere"),
    )
    airports = stg_airports(feed_airports(table.sparkSession))
    (row,) = public.public_daily_status(table, airports, SETTINGS).collect()
    assert (row.total_flights, row.top_destination_city, row.top_destination_country) == (5, "Nowhere", None)


def test_gates(fact):
    rows = public.public_gates_analysis(
        fact(
            movement(id="1", gate=" 5 ", atda="10:20"),
            movement(id="2", gate="5", stda="21:00"),
            movement(id="3", gate="  "),
            movement(id="4", gate="6", stda=None),
        )
    ).collect()
    assert [(row.gate, row.total_flights) for row in rows] == [("5", 2), ("6", 1)]
    # Hours are UTC: 10:20 local is 13, 21:00 local is 0.
    assert {h: n for h, n in enumerate(rows[0].time_distribution) if n} == {13: 1, 0: 1}
    assert sum(rows[1].time_distribution) == 0


def test_staging_dimensions(raw):
    flights = stg_flights(
        raw(
            movement(id="1", matricula="LV-1", acftype="B738", x_fetched_at="2024-01-11T01:00:00Z"),
            movement(id="2", matricula="LV-1", acftype="E190", idaerolinea="FO", aerolinea="Foehn",
                     x_fetched_at="2024-01-11T02:00:00Z", x_date="2024-01-11"),
            movement(id="3", matricula="LV-1", acftype="E190", idaerolinea="LA", x_fetched_at=None),
            movement(id="4", idaerolinea=None),
        )
    )
    craft = sorted((r.aircraft_type, r.total_flights, r.airline_code) for r in stg_aircraft(flights).collect())
    # A registration whose type changed has a row per type, with the same totals.
    assert craft == [("B738", 3, "FO"), ("E190", 3, "FO")]
    airlines = {row.airline_code: row.total_flights for row in stg_airlines(flights).collect()}
    assert airlines == {"AR": 1, "FO": 1, "LA": 1}


def test_airports_casts(spark):
    from tarmac.schemas import AIRPORT_SCHEMA

    rows = [
        (" aep ", "n", "c", "r", "Argentina", "-34.5", "x", "tz", "TRUE"),
        ("GRU", "n", "c", "r", "Brazil", None, "", "tz", "yes"),
        (None, "n", "c", "r", "Brazil", None, "", "tz", "true"),
    ]
    got = {row.airport_code: row for row in stg_airports(spark.createDataFrame(rows, AIRPORT_SCHEMA)).collect()}
    assert set(got) == {"AEP", "GRU"}
    assert (got["AEP"].latitude, got["AEP"].longitude, got["AEP"].is_international) == (-34.5, None, True)
    assert (got["GRU"].is_international, got["GRU"].is_argentine_airport) == (False, False)
