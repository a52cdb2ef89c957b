"""Typed, deduplicated tables: movements, airports, airlines, aircraft."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import Settings
from tarmac.functions import clocks, rules, text
from tarmac.functions.measures import mean, share_or_zero
from tarmac.operators.latest import keep_latest
from tarmac.schemas import EXTRACT_STAMPS, FLIGHT_COLUMNS, PAYLOAD_SCHEMA

# Breaks ties between two deliveries with equal stamps.
DELIVERY_HASH = "_delivery_hash"

# Document key -> output column, taken over as text.
PLAIN_FIELDS = {
    "id": "flight_id",
    "nro": "flight_number",
    "aerolinea": "airline_name",
    "destorig": "origin_destination_city",
    "acftype": "aircraft_type",
    "matricula": "aircraft_registration",
    "gate": "gate",
    "sector": "sector",
    "termsec": "terminal",
    "belt": "baggage_belt",
    "sdphrase": "weather_description",
}
# Document key -> output column, taken over as a code.
CODE_FIELDS = {
    "idaerolinea": "airline_code",
    "arpt": "airport_code",
    "mov": "movement_type",
    "IATAdestorig": "origin_destination_code",
}
# Document key -> local time it stands for.
CLOCK_FIELDS = {
    "stda": "scheduled",
    "etda": "estimated",
    "atda": "actual",
    "blockon": "block_on",
    "blockoff": "block_off",
}
# Keys that may hold the status, the first one filled wins.
STATUS_FIELDS = ["estin", "estbr", "estes"]


def newest_delivery_first() -> list:
    return [
        F.col("_sdc_extracted_at").desc_nulls_last(),
        F.col("fetched_at").desc_nulls_last(),
        F.col(DELIVERY_HASH).desc(),
    ]


def keyless_deliveries(raw: DataFrame) -> DataFrame:
    """Every delivery that lacks a part of its movement's key, as it came."""
    return _parsed(raw, "data", filtered=True).filter(F.col("flight_sk").isNull()).select("data", *EXTRACT_STAMPS)


def _parsed(raw: DataFrame, *carried: str, filtered: bool = False) -> DataFrame:
    """The documents' fields, still as text where a clock is involved.

    ``filtered`` tells that a filter on fields follows. It would be moved below the parse and parse
    once more per field it reads; it cannot pass a generator.
    """
    document = F.from_json(text.scalars_only(F.col("data")), PAYLOAD_SCHEMA)
    document = F.explode(F.array(document)) if filtered else document
    parsed = raw.select("data", *EXTRACT_STAMPS, document.alias("document"))

    def field(key: str):
        return F.col("document")[key]

    fields = parsed.select(
        *carried,
        *EXTRACT_STAMPS,
        *[field(key).alias(name) for key, name in PLAIN_FIELDS.items()],
        *[text.code(field(key)).alias(name) for key, name in CODE_FIELDS.items()],
        *[field(key).alias(f"{name}_clock") for key, name in CLOCK_FIELDS.items()],
        F.coalesce(*[field(key) for key in STATUS_FIELDS]).alias("flight_status"),
        F.try_to_date(field("x_date"), "yyyy-MM-dd").alias("flight_date"),
        F.try_to_timestamp(field("x_fetched_at"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("fetched_at"),
        field("sdtemp").try_cast("long").alias("weather_temp"),
        F.xxhash64("data").alias(DELIVERY_HASH),
    )
    key_parts = ["flight_id", "flight_date", "airport_code", "movement_type"]
    joined = [part for name in key_parts for part in (F.lit("-"), F.col(name).cast("string"))][1:]
    return fields.withColumn("flight_sk", F.concat(*joined))


def latest_movements(raw: DataFrame, settings: Settings = Settings(), since: Column | None = None) -> DataFrame:
    """The newest delivery of each movement with all derived columns, plus the tie-break hash.

    Versions are dropped before the time arithmetic, so it runs once per movement.

    With ``since``, movements of earlier days are left out, and before versions are told apart: a
    movement's key contains its day, so all its versions go or stay together. Deliveries without a
    key are one movement whatever their days; they are compared first and judged by the newest's day.
    """
    deliveries, day = _parsed(raw, filtered=since is not None), F.col("flight_date")
    if since is not None:
        deliveries = deliveries.filter(F.col("flight_sk").isNull() | (day >= since))
    newest = keep_latest(deliveries, ["flight_sk"], newest_delivery_first())
    if since is not None:
        newest = newest.filter(day >= since)
    # One lambda for all clocks keeps the generated method small enough for the JIT.
    names = list(CLOCK_FIELDS.values())
    local = F.transform(
        F.array(*[F.col(f"{name}_clock") for name in names]),
        lambda clock: clocks.local_datetime(F.col("flight_date"), clock),
    )
    dated = newest.withColumn("_local", local).withColumns(
        {f"{name}_local": F.col("_local")[i] for i, name in enumerate(names)}
    )
    scheduled = F.col("scheduled_local")
    instants = {"scheduled_timestamp": clocks.instant(scheduled, settings.local_timezone)}
    for name in names[1:]:
        moved = clocks.after_midnight(
            F.col(f"{name}_local"), scheduled, settings.rollover_threshold_hours
        )
        instants[f"{name}_timestamp"] = clocks.instant(moved, settings.local_timezone)
    movement, delay, day = F.col("movement_type"), F.col("delay_minutes"), F.col("flight_date")
    return (
        dated.withColumns(instants)
        .withColumn(
            "movement_actual_timestamp",
            rules.actual_movement(
                movement,
                F.col("block_on_timestamp"),
                F.col("block_off_timestamp"),
                F.col("actual_timestamp"),
            ),
        )
        .withColumn(
            "delay_minutes",
            clocks.minutes_between(F.col("scheduled_timestamp"), F.col("movement_actual_timestamp")),
        )
        .withColumns(
            {
                "flight_direction": rules.direction(movement),
                "scheduled_hour": F.hour(scheduled).cast("long"),
                "day_of_week": F.dayofweek(day).cast("long"),
                "month": F.month(day).cast("long"),
                "year": F.year(day).cast("long"),
                "is_cancelled": F.col("flight_status").isin(rules.CANCELLED_STATES),
                "is_delayed": F.coalesce(delay > rules.DELAYED_ABOVE, F.lit(False)),
                "delay_category": rules.delay_category(delay),
            }
        )
        .select(*FLIGHT_COLUMNS, DELIVERY_HASH)
    )


def stg_flights(raw: DataFrame, settings: Settings = Settings(), since: Column | None = None) -> DataFrame:
    """One row per movement, of all days or those from ``since`` on."""
    return latest_movements(raw, settings, since).drop(DELIVERY_HASH)


def stg_airports(airports: DataFrame) -> DataFrame:
    """Airports with typed coordinates and flags; rows without a code are dropped."""
    return airports.filter(F.col("airport_code").isNotNull()).select(
        text.code(F.col("airport_code")).alias("airport_code"),
        "airport_name",
        "city",
        "region",
        "country",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        "timezone",
        F.coalesce(text.strict_boolean(F.col("is_international")), F.lit(False)).alias("is_international"),
        (F.col("country") == "Argentina").alias("is_argentine_airport"),
    )


def airline_parts(flights: DataFrame, *more: str) -> DataFrame:
    """What airlines add up from, per airline and airport, and per ``more``."""
    known = flights.filter(F.col("airline_code").isNotNull())
    delay = rules.measured(F.col("delay_minutes"))
    cancelled, late, movement = F.col("is_cancelled"), F.col("is_delayed"), F.col("movement_type")
    return known.groupBy(*more, "airline_code", "airline_name", "airport_code").agg(
        F.max("_sdc_extracted_at").alias("extracted"),
        F.count("*").alias("flights"),
        F.count_if(movement == "A").alias("arrivals"),
        F.count_if(movement == "D").alias("departures"),
        F.sum(delay).alias("delay_sum"),
        F.count(delay).alias("delay_n"),
        F.count_if(cancelled).alias("cancelled"),
        F.count_if(late).alias("late"),
        F.count_if(~cancelled & ~late).alias("on_time"),
        F.min("flight_date").alias("first"),
        F.max("flight_date").alias("last"),
    )


def stg_airlines(flights: DataFrame) -> DataFrame:
    """Totals per airline code.

    Two narrow aggregates instead of one with two distinct counts: the first
    collapses to a few rows per airline and airport before its shuffle, the
    second shuffles flight ids once.
    """
    ids = (
        flights.filter(F.col("airline_code").isNotNull() & F.col("flight_id").isNotNull())
        .select("airline_code", "flight_id")
        .distinct()
        .groupBy("airline_code")
        .agg(F.count("*").alias("unique_flights"))
    )
    return stg_airlines_of(airline_parts(flights), ids)


def stg_airlines_of(parts: DataFrame, ids: DataFrame) -> DataFrame:
    """The same from parts, of all days together or day by day, and the numbers of distinct ids."""
    totals = parts.groupBy("airline_code").agg(
        F.max("extracted").alias("_sdc_extracted_at"),
        F.max("airline_name").alias("airline_name"),
        F.sum("flights").alias("total_flights"),
        F.count_distinct("airport_code").alias("unique_airports"),
        F.sum("arrivals").alias("total_arrivals"),
        F.sum("departures").alias("total_departures"),
        mean(F.sum("delay_sum"), F.sum("delay_n")).alias("avg_delay_minutes"),
        F.sum("cancelled").alias("total_cancelled"),
        F.sum("late").alias("total_delayed"),
        F.sum("on_time").alias("total_on_time"),
        F.min("first").alias("first_seen_date"),
        F.max("last").alias("last_seen_date"),
    )
    departures = F.col("total_departures")
    return totals.join(ids, "airline_code", "left").select(
        "airline_code",
        "_sdc_extracted_at",
        "airline_name",
        "total_flights",
        F.coalesce("unique_flights", F.lit(0)).alias("unique_flights"),
        "unique_airports",
        "total_arrivals",
        "total_departures",
        "avg_delay_minutes",
        "total_cancelled",
        "total_delayed",
        "total_on_time",
        share_or_zero(F.col("total_on_time"), departures).alias("on_time_percentage"),
        share_or_zero(F.col("total_cancelled"), departures).alias("cancellation_rate"),
        share_or_zero(F.col("total_delayed"), departures).alias("delayed_percentage"),
        "first_seen_date",
        "last_seen_date",
    )


AIRCRAFT = ["aircraft_registration", "aircraft_type", "airline_code", "airline_name"]


def aircraft_parts(flights: DataFrame, *more: str) -> DataFrame:
    """What aircraft add up from, per registration, type and airline, and per ``more``."""
    return (
        flights.filter(F.col("aircraft_registration").isNotNull())
        .groupBy(*more, *AIRCRAFT)
        .agg(
            F.min("flight_date").alias("first"),
            F.max("flight_date").alias("last"),
            F.count("*").alias("flights"),
            F.max("_sdc_extracted_at").alias("extracted"),
            F.max("fetched_at").alias("fetched"),
        )
    )


def stg_aircraft(flights: DataFrame) -> DataFrame:
    """Per registration and aircraft type: totals of the registration and its latest airline.

    The fact is first reduced to one row per registration, type and airline;
    the windows run over that.
    """
    return stg_aircraft_of(aircraft_parts(flights))


def stg_aircraft_of(reduced: DataFrame) -> DataFrame:
    """The same from parts of which there is one per registration, type and airline."""
    one = Window.partitionBy("aircraft_registration")
    latest = F.max_by(
        F.struct("airline_code", "airline_name"),
        F.struct("fetched", "airline_code", "airline_name"),
    ).over(one)
    totals = reduced.select(
        "aircraft_registration",
        "aircraft_type",
        F.min("first").over(one).alias("first_seen_date"),
        F.max("last").over(one).alias("last_seen_date"),
        F.sum("flights").over(one).alias("total_flights"),
        latest.alias("airline"),
        F.max("extracted").over(one).alias("_sdc_extracted_at"),
    )
    # Rows without any extraction stamp lie before every high-water mark and are never loaded.
    return (
        totals.filter(F.col("_sdc_extracted_at").isNotNull())
        .select(
            "aircraft_registration",
            "aircraft_type",
            "first_seen_date",
            "last_seen_date",
            "total_flights",
            "airline.airline_code",
            "airline.airline_name",
            "_sdc_extracted_at",
        )
        .distinct()
    )
