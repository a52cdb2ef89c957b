"""Write a model as a table, with its load stamp and descriptions, or register it as a view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.schemas import LOAD_STAMP

# What each model holds; stored with its table.
TABLES = {
    "stg_flights": "One row per movement, the newest delivery of each, with typed and derived columns",
    "stg_airports": "Airports with coordinates as numbers and flags",
    "stg_airlines": "Totals per airline code over all movements",
    "stg_aircraft": "Aircraft by registration and type, with the airline that flew them last",
    "metricflow_time_spine": "One row per day from 2020 to 2030",
    "flights_performance": "Movements with the time of day and the gap from schedule to movement",
    "airline_metrics": "Totals, shares and ranks per airline",
    "airport_operations": "Totals, shares, peak hours and ranks per reporting airport",
    "delay_analysis": "Delay figures by hour, day, route, airline and category in one tall table",
    "routes_metrics_daily": "Figures per route, airline and day",
    "routes_metrics": "Figures per route and airline over the last days, with both ends' places",
    "public_headline": "Key figures of departures of the last days, one row",
    "public_airline_breakdown": "Departures per airline by how late they were",
    "public_bucket_distribution": "Departures per delay bucket and their share",
    "public_daily_status": "Departures per day with the day's top destination",
    "public_tops": "The longest delays, the busiest routes and the like, ranked",
    "public_gates_analysis": "The busiest gates and their hours",
}

# Column -> description, stored with each table that has the column.
DESCRIPTIONS = {
    "flight_sk": "Key of a movement: flight id, day, reporting airport and movement type",
    "flight_id": "Identifier of the flight as delivered",
    "flight_number": "Flight number as published",
    "airline_code": "Code of the airline, in capitals",
    "airline_name": "Name of the airline as delivered",
    "airport_code": "Airport that reported the movement",
    "movement_type": "A for an arrival, D for a departure at the reporting airport",
    "flight_direction": "The movement type in a word: arrival, departure or unknown",
    "origin_destination_code": "The other airport: destination of a departure, origin of an arrival",
    "origin_destination_city": "City of the other airport as delivered",
    "scheduled_timestamp": "Scheduled instant, from the local clock of the day",
    "estimated_timestamp": "Estimated instant, moved past midnight where the clock says so",
    "actual_timestamp": "Actual instant, moved past midnight where the clock says so",
    "block_on_timestamp": "Instant of arrival at the gate",
    "block_off_timestamp": "Instant of departure from the gate",
    "movement_actual_timestamp": "Block-on or block-off instant, else the actual one",
    "delay_minutes": "Whole minutes from schedule to movement; negative if early",
    "flight_date": "Local day of the schedule",
    "scheduled_hour": "Local hour of the schedule, 0 to 23",
    "day_of_week": "1 for Sunday to 7 for Saturday",
    "month": "Month of the day, 1 to 12",
    "year": "Year of the day",
    "flight_status": "Status as delivered, the first of three fields that is filled",
    "is_cancelled": "Whether the status says that the flight was cancelled",
    "is_delayed": "Delay above 15 minutes; false if the delay is unknown",
    "delay_category": "on_time, minor (up to 30), moderate (up to 60), severe (above, or unknown)",
    "aircraft_type": "Type of the aircraft as delivered",
    "aircraft_registration": "Registration of the aircraft",
    "gate": "Gate as delivered",
    "sector": "Sector of the terminal",
    "terminal": "Terminal as delivered",
    "baggage_belt": "Belt on which baggage arrives",
    "weather_temp": "Temperature at the other airport, whole degrees",
    "weather_description": "Weather at the other airport in words",
    "time_of_day": "morning from 5, afternoon from 12, evening from 18, night from 22",
    "flight_duration_minutes": "Gap between schedule and movement, the same as delay_minutes",
    "fetched_at": "When the extractor asked the airport",
    "_sdc_extracted_at": "When the delivery was extracted; batches start from its newest value",
    "_sdc_received_at": "When the delivery was received",
    "_sdc_batched_at": "When the delivery's batch was written",
    "total_flights": "Number of flights",
    "total_flight_records": "Number of movements",
    "unique_flights": "Number of different flight ids",
    "total_departures": "Number of different flight ids among departures",
    "total_arrivals": "Number of different flight ids among arrivals",
    "unique_airports": "Number of different reporting airports",
    "unique_routes": "Number of different airports at the other end",
    "unique_airlines": "Number of different airlines",
    "unique_destinations": "Number of different airports at the other end",
    "avg_delay_minutes": "Mean delay of flights whose delay lies between -180 and 600 minutes",
    "avg_departure_delay_minutes": "Mean delay of departures that were flown",
    "avg_arrival_delay_minutes": "Mean delay of arrivals that were flown",
    "avg_overall_delay_minutes": "Mean delay of all movements that were flown",
    "total_cancelled_flights": "Number of cancelled flights",
    "total_delayed_flights": "Number of flights delayed by more than 15 minutes",
    "total_on_time_flights": "Number of flights neither cancelled nor delayed",
    "total_severely_delayed_flights": "Number of flights in the category severe",
    "total_moderately_delayed_flights": "Number of flights in the category moderate",
    "on_time_departure_percentage": "Movements on time, as a percentage of departures",
    "delayed_departure_percentage": "Delayed movements, as a percentage of departures",
    "cancellation_rate": "Cancelled movements, as a percentage of departures",
    "severe_delay_rate": "Severely delayed movements, as a percentage of departures",
    "on_time_rank": "1 for the highest share on time",
    "avg_delay_rank": "1 for the smallest mean departure delay",
    "volume_rank": "1 for the most flights",
    "peak_departure_hour": "Scheduled hour with most departures, the earliest of several",
    "peak_arrival_hour": "Scheduled hour with most arrivals, the earliest of several",
    "first_flight_date": "First day with a movement",
    "last_flight_date": "Last day with a movement",
    "first_seen_date": "First day with a movement",
    "last_seen_date": "Last day with a movement",
    "analysis_type": "The grain of a row: hourly, daily, route, airline or distribution",
    "origin_airport_code": "Airport of departure",
    "destination_airport_code": "Airport of arrival",
    "date_day": "Day of the spine",
    LOAD_STAMP: "When the row was written",
}


def with_load_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn(LOAD_STAMP, F.current_timestamp())


def described(df: DataFrame) -> DataFrame:
    """Attach column comments; they are stored in the table's schema."""
    for name in df.columns:
        if name in DESCRIPTIONS:
            df = df.withMetadata(name, {"comment": DESCRIPTIONS[name]})
    return df


def save(df: DataFrame, path: str) -> None:
    described(with_load_stamp(df)).write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, name: str, about: str = "") -> None:
    """A catalog table with its own description and those of its columns."""
    described(with_load_stamp(df)).write.mode("overwrite").format("parquet").saveAsTable(name)
    about = about or TABLES.get(name.rpartition(".")[2], "")
    if about:
        escaped = about.replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{escaped}'")


def publish_view(df: DataFrame, name: str) -> None:
    """A model that is computed when read."""
    with_load_stamp(df).createOrReplaceTempView(name)
