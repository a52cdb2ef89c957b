"""Parsing, time reconstruction, flags and deduplication of raw deliveries."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmac.plans import marts, staging
from tarmac.plans.staging import stg_flights
from tarmac.schemas import FLIGHT_COLUMNS
from tests.conftest import movement

CASES = {
    "block on wins for arrivals": (
        dict(mov="A", atda="10:05", blockon="10:10"),
        dict(delay_minutes=10, delay_category="minor", is_delayed=False),
    ),
    "only block off counts for departures": (
        dict(stda="10:00:00", atda="10:40", blockoff="10:20", blockon="11:00"),
        dict(delay_minutes=20, delay_category="minor", is_delayed=True),
    ),
    "past midnight": (dict(stda="23:30", atda="00:10"), dict(delay_minutes=40, delay_category="moderate")),
    "six hour boundaries roll over": (
        dict(stda="23:50", atda="17:55"),
        dict(delay_minutes=1085, delay_category="severe"),
    ),
    "no roll backwards": (dict(stda="00:10", atda="23:40"), dict(delay_minutes=1410)),
    "unknown delay is severe": (
        dict(),
        dict(delay_minutes=None, is_delayed=False, delay_category="severe"),
    ),
    "cancelled": (dict(estin="Cancelado"), dict(is_cancelled=True)),
    "first status key wins": (dict(estin=None, estbr="C", estes="X"), dict(flight_status="C", is_cancelled=True)),
    "no status": (dict(estin=None), dict(flight_status=None, is_cancelled=None)),
    "clock out of range": (
        dict(stda="25:10", atda="10:00"),
        dict(scheduled_timestamp=None, scheduled_hour=None, delay_minutes=None),
    ),
    "clock inside a timestamp, minutes cut off": (
        dict(stda="2024-01-10T10:30:05", atda="10:30:00"),
        dict(delay_minutes=0, delay_category="on_time"),
    ),
    "bad seconds fall back to minutes": (dict(stda="10:30:75", atda="10:31"), dict(delay_minutes=1)),
    "midnight as 24:00 is no clock": (dict(stda="24:00"), dict(scheduled_timestamp=None)),
    "code trimmed of any white space": (dict(arpt=" aep\t "), dict(airport_code="AEP")),
    "nested value is no text": (dict(gate={"a": 1}), dict(gate=None)),
    "list is no text": (dict(gate=["G1"]), dict(gate=None)),
    "text that looks nested stays": (dict(gate="[G1]", sector="{x"), dict(gate="[G1]", sector="{x")),
    "number is a text": (dict(gate=12), dict(gate="12")),
    "unknown movement uses the actual clock": (
        dict(mov="x", atda="10:07", blockon="11:00", blockoff="12:00"),
        dict(movement_type="X", flight_direction="unknown", delay_minutes=7),
    ),
    "exactly six hours roll": (dict(stda="23:00", atda="17:00"), dict(delay_minutes=1080)),
    "five boundaries stay": (dict(stda="23:59", atda="18:00"), dict(delay_minutes=-359)),
    "temperature": (dict(sdtemp="21"), dict(weather_temp=21)),
    "temperature that is no number": (dict(sdtemp="n/a"), dict(weather_temp=None)),
    "date that does not exist": (dict(x_date="2024-02-30"), dict(flight_date=None, flight_sk=None)),
    "day of week starts on Sunday": (dict(x_date="2024-01-07"), dict(day_of_week=1, month=1, year=2024)),
    "local time to instant": (
        dict(stda="22:30"),
        dict(scheduled_timestamp=datetime(2024, 1, 11, 1, 30), scheduled_hour=22),
    ),
    "estimate": (dict(etda="10:45"), dict(estimated_timestamp=datetime(2024, 1, 10, 13, 45))),
}


@pytest.fixture(scope="module")
def parsed(spark):
    """All cases in one run; the flight number tells them apart."""
    from tests.conftest import RAW_SCHEMA, json

    rows = []
    for i, (fields, _) in enumerate(CASES.values()):
        document = movement(**{"id": f"F{i}", "nro": str(i), **fields})
        rows.append((json.dumps(document), *[datetime(2024, 1, 11)] * 3, None, None, None))
    flights = stg_flights(spark.createDataFrame(rows, RAW_SCHEMA))
    return {row.flight_number: row.asDict() for row in flights.collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(parsed, name):
    got = parsed[str(list(CASES).index(name))]
    want = CASES[name][1]
    assert {key: got[key] for key in want} == want


@pytest.mark.parametrize(
    ("delay", "category"),
    [(-1, "on_time"), (0, "on_time"), (1, "minor"), (15, "minor"), (16, "minor"), (30, "minor"),
     (31, "moderate"), (60, "moderate"), (61, "severe"), (None, "severe")],
)
def test_delay_category(spark, delay, category):
    from pyspark.sql import functions as F

    from tarmac.functions import rules

    row = spark.range(1).select(rules.delay_category(F.lit(delay).cast("long"))).first()
    assert row[0] == category


def test_newest_delivery_wins(raw):
    flights = stg_flights(
        raw(
            (movement(gate="old"), 1, 11),
            (movement(gate="no fetch time", x_fetched_at=None), 2, 11),
            (movement(gate="newest"), 2, 11),
        )
    )
    assert [row.gate for row in flights.collect()] == ["newest"]


def test_all_keyless_deliveries_count_as_one(raw):
    flights = stg_flights(raw(*[(movement(id=None, nro=str(i)), i, 11) for i in range(5)], movement()))
    assert sorted(str(row.flight_sk) for row in flights.collect()) == ["F1-2024-01-10-AEP-D", "None"]


def test_broken_documents_yield_no_key(raw):
    assert [row.flight_sk for row in stg_flights(raw("no json", '{"id": ')).collect()] == [None]


def test_keyless_deliveries_are_parsed_once_and_above_the_feed(raw):
    deliveries = raw(
        (movement(), 1, 11),
        (movement(id=None, gate="K1"), 2, 11),
        (movement(id=None, gate="K1"), 2, 11),
        (movement(x_date="no day", gate="K2"), None, 11),
        ("no json", 3, 11),
    )
    got = [row["data"] for row in staging.keyless_deliveries(deliveries).collect()]
    assert sorted(json.loads(text)["gate"] for text in got if text != "no json") == ["K1", "K1", "K2"]
    assert got.count("no json") == 1
    # Below a shuffle the documents are made anew for each field that the filter reads.
    made = deliveries.repartition(2).withColumn("data", F.concat("data", F.lit(" ")))
    plan = staging.keyless_deliveries(made)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    lines = plan.splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Repartition" in line)
    assert not [line for line in lines[shuffle:] if "Filter" in line or "from_json(" in line]


def test_columns(raw):
    assert stg_flights(raw(movement())).columns == FLIGHT_COLUMNS
    assert marts.flights_performance(stg_flights(raw(movement()))).columns == marts.FACT_COLUMNS


def test_partial_dedup_runs_before_the_shuffle(raw):
    plan = stg_flights(raw(movement()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_time_of_day(raw):
    documents = [movement(id=f"F{h}", nro=str(h), stda=f"{h:02d}:00") for h in (4, 5, 11, 12, 17, 18, 21, 22)]
    fact = marts.flights_performance(stg_flights(raw(*documents, movement(id="N", nro="none", stda=None))))
    got = {row.flight_number: row.time_of_day for row in fact.collect()}
    assert got == {
        "4": "night", "5": "morning", "11": "morning", "12": "afternoon", "17": "afternoon",
        "18": "evening", "21": "evening", "22": "night", "none": "night",
    }


def test_fact_drops_rows_without_extraction_stamp(raw):
    flights = stg_flights(raw((movement(), None, 11), movement(id="F2")))
    assert [row.flight_id for row in marts.flights_performance(flights).collect()] == ["F2"]


def test_days_left_out_are_left_out_before_versions_meet(raw):
    deliveries = raw(
        (movement(id="1", x_date="2024-01-05"), 1, 11),
        (movement(id="1", x_date="2024-01-10", gate="old"), 1, 11),
        (movement(id="1", x_date="2024-01-10", gate="new"), 2, 11),
        (movement(id="2", x_date=None), 1, 11),
        (movement(id=None, x_date="2024-01-10", gate="older keyless"), 1, 11),
        (movement(id=None, x_date="2024-01-05", gate="newest keyless"), 4, 11),
        ('{"x_date": "2024-01-10"', 3, 11),
    )
    since = F.lit("2024-01-08").cast("date")
    some = staging.stg_flights(deliveries, since=since)
    want = staging.stg_flights(deliveries).filter(F.col("flight_date") >= since)
    assert sorted(map(repr, some.collect())) == sorted(map(repr, want.collect()))
    # The newest delivery without a key is of an earlier day, so none of them is left.
    assert [(r.flight_id, r.gate) for r in some.collect()] == [("1", "new")]
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if " Window " in line or "+- Window" in line)
    below = next(i for i, line in enumerate(lines) if i > window and "Filter" in line)
    # The filter stands below the window, on documents parsed once.
    assert "x_date" in lines[below] and "2024-01-08" in lines[below]
    assert plan.count("from_json(") + plan.count("jsontostructs(") == 1
