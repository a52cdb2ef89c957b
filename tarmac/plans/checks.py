"""The checks declared for each model."""

from __future__ import annotations

from tarmac.operators.quality import Checks
from tarmac.schemas import LOAD_STAMP

# Columns every movement must fill.
MOVEMENT_COLUMNS = [
    "flight_sk",
    "flight_id",
    "flight_number",
    "airline_code",
    "airport_code",
    "movement_type",
    "flight_direction",
    "origin_destination_code",
    "scheduled_timestamp",
    "flight_date",
    "is_cancelled",
    "is_delayed",
    "delay_category",
    "fetched_at",
]

# Model -> declared checks.
DECLARED = {
    "stg_flights": Checks(MOVEMENT_COLUMNS, unique=["flight_sk"]),
    "stg_airports": Checks(["airport_code", "city", "country"], unique=["airport_code"]),
    "stg_airlines": Checks(
        [
            "airline_code",
            "total_flights",
            "unique_flights",
            "unique_airports",
            "total_arrivals",
            "total_departures",
            "total_cancelled",
            "total_delayed",
            "total_on_time",
            "on_time_percentage",
            "cancellation_rate",
            "delayed_percentage",
        ],
        unique=["airline_code"],
    ),
    "stg_aircraft": Checks(["aircraft_registration", "total_flights"], unique=["aircraft_registration"]),
    "flights_performance": Checks(
        [*MOVEMENT_COLUMNS, "time_of_day", LOAD_STAMP], unique=["flight_sk"]
    ),
    "airline_metrics": Checks(
        [
            "airline_code",
            "total_flight_records",
            "unique_flights",
            "total_departures",
            "total_arrivals",
            "unique_airports",
            "unique_routes",
            "total_cancelled_flights",
            "total_delayed_flights",
            "total_on_time_flights",
            "total_severely_delayed_flights",
            "total_moderately_delayed_flights",
            "on_time_departure_percentage",
            "delayed_departure_percentage",
            "cancellation_rate",
            "severe_delay_rate",
            "on_time_rank",
            "avg_delay_rank",
            "volume_rank",
            LOAD_STAMP,
        ],
        unique=["airline_code"],
    ),
    "airport_operations": Checks(
        [
            "airport_code",
            "total_departures",
            "total_arrivals",
            "total_cancelled_flights",
            "total_delayed_flights",
            "total_on_time_flights",
            "unique_airlines",
            "unique_destinations",
            "on_time_departure_percentage",
            "delayed_departure_percentage",
            "cancellation_rate",
            "on_time_rank",
            "avg_delay_rank",
            "volume_rank",
            LOAD_STAMP,
        ],
        unique=["airport_code"],
    ),
    "delay_analysis": Checks(["analysis_type", "total_flights", LOAD_STAMP]),
    "routes_metrics_daily": Checks(
        [
            "route_day_sk",
            "flight_date",
            "origin_airport_code",
            "destination_airport_code",
            "airline_code",
        ],
        unique=["route_day_sk"],
    ),
    "routes_metrics": Checks(
        ["origin_airport_code", "destination_airport_code", "airline_code"],
        unique_together=[["origin_airport_code", "destination_airport_code", "airline_code"]],
    ),
    "public_headline": Checks(["total_flights"]),
    "public_bucket_distribution": Checks(["bucket"], unique=["bucket"]),
    "public_airline_breakdown": Checks(["airline_name"]),
    "public_tops": Checks(["record_type", "rank"]),
    "public_daily_status": Checks(["flight_date"], unique=["flight_date"]),
    "public_gates_analysis": Checks(
        [
            "gate",
            "total_flights",
            "delayed_flights",
            "on_time_flights",
            "on_time_percentage",
            "time_distribution",
        ],
        unique=["gate"],
    ),
}
