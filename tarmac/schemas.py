"""Column contracts of the raw feed and of the stored models."""

from __future__ import annotations

from pyspark.sql import types as T

EXTRACT_STAMPS = ["_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at"]

RAW_SCHEMA = T.StructType(
    [T.StructField("data", T.StringType())]
    + [T.StructField(name, T.TimestampType()) for name in EXTRACT_STAMPS]
    + [
        T.StructField("_sdc_deleted_at", T.TimestampType()),
        T.StructField("_sdc_sequence", T.LongType()),
        T.StructField("_sdc_table_version", T.LongType()),
    ]
)

# The keys of one movement document.
PAYLOAD_KEYS = [
    "acftype",
    "aerolinea",
    "arpt",
    "atda",
    "belt",
    "blockoff",
    "blockon",
    "destorig",
    "estbr",
    "estin",
    "estes",
    "etda",
    "fetched_at",
    "gate",
    "IATAdestorig",
    "idaerolinea",
    "id",
    "matricula",
    "mov",
    "nro",
    "sdphrase",
    "sdtemp",
    "sector",
    "stda",
    "termsec",
    "x_airport_iata",
    "x_date",
    "x_fetched_at",
    "x_movtp",
]

PAYLOAD_SCHEMA = T.StructType([T.StructField(key, T.StringType()) for key in PAYLOAD_KEYS])

AIRPORT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "airport_code",
            "airport_name",
            "city",
            "region",
            "country",
            "latitude",
            "longitude",
            "timezone",
            "is_international",
        )
    ]
)

# Output columns of the movement table, in order.
FLIGHT_COLUMNS = [
    "flight_id",
    "flight_number",
    "airline_code",
    "airline_name",
    "airport_code",
    "movement_type",
    "flight_direction",
    "origin_destination_code",
    "origin_destination_city",
    "scheduled_timestamp",
    "estimated_timestamp",
    "actual_timestamp",
    "block_on_timestamp",
    "block_off_timestamp",
    "movement_actual_timestamp",
    "delay_minutes",
    "flight_date",
    "scheduled_hour",
    "day_of_week",
    "month",
    "year",
    "flight_status",
    "is_cancelled",
    "is_delayed",
    "delay_category",
    "aircraft_type",
    "aircraft_registration",
    "gate",
    "sector",
    "terminal",
    "baggage_belt",
    "weather_temp",
    "weather_description",
    *EXTRACT_STAMPS,
    "fetched_at",
    "flight_sk",
]

# Fixed value: name of the column that records when a table was written.
LOAD_STAMP = "dbt_updated_at"
