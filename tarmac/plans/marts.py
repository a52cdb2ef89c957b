"""The movement fact and the marts built on it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import Settings
from tarmac.functions import clocks, rules, text
from tarmac.functions.measures import mean, scaled_share_or_zero, share_or_zero, tally
from tarmac.operators.ranks import add_ranks, descending
from tarmac.schemas import EXTRACT_STAMPS

def _measured() -> Column:
    return rules.measured(rules.delay())


# Output columns of the fact, in order.
FACT_COLUMNS = [
    "flight_sk",
    "flight_id",
    "flight_number",
    "airline_code",
    "airline_name",
    "airport_code",
    "origin_destination_code",
    "origin_destination_city",
    "movement_type",
    "flight_direction",
    "scheduled_timestamp",
    "estimated_timestamp",
    "actual_timestamp",
    "movement_actual_timestamp",
    "block_on_timestamp",
    "block_off_timestamp",
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
    "time_of_day",
    "flight_duration_minutes",
    "fetched_at",
    *EXTRACT_STAMPS,
]


def in_fact() -> Column:
    """Rows without any extraction stamp lie before every high-water mark and are never loaded."""
    return F.col("_sdc_extracted_at") > F.lit("1970-01-01").cast("timestamp")


def flights_performance(flights: DataFrame) -> DataFrame:
    """Movements with time of day and the gap between schedule and movement."""
    gap = clocks.minutes_between(F.col("scheduled_timestamp"), F.col("movement_actual_timestamp"))
    return (
        flights.filter(in_fact())
        .withColumn("time_of_day", rules.time_of_day(F.col("scheduled_hour")))
        .withColumn("flight_duration_minutes", gap)
        .select(FACT_COLUMNS)
    )


# --- airlines and airports -----------------------------------------------------------------


def _additive() -> list[Column]:
    """Sums that one reduction stores and the next one adds up; all of fixed width."""
    by_side = []
    for side, condition in (("dep", rules.departs()), ("arr", rules.arrives()), ("all", F.lit(True))):
        value = F.when(condition & rules.flown(), _measured())
        by_side += [F.sum(value).alias(f"{side}_sum"), F.count(value).alias(f"{side}_n")]
    return [
        *by_side,
        F.count("*").alias("records"),
        F.count_if(rules.cancelled()).alias("cancelled"),
        F.count_if(rules.late()).alias("late"),
        F.count_if(rules.on_time()).alias("on_time"),
        F.count_if(F.col("delay_category") == "severe").alias("severe"),
        F.count_if(F.col("delay_category") == "moderate").alias("moderate"),
        F.min("flight_date").alias("first"),
        F.max("flight_date").alias("last"),
        *[F.max(name).alias(name) for name in EXTRACT_STAMPS],
    ]


def _averages() -> list[Column]:
    names = {"dep": "departure", "arr": "arrival", "all": "overall"}
    return [
        mean(F.sum(f"{side}_sum"), F.sum(f"{side}_n")).alias(f"avg_{name}_delay_minutes")
        for side, name in names.items()
    ]


def _ends() -> list[Column]:
    return [
        F.min("first").alias("first_flight_date"),
        F.max("last").alias("last_flight_date"),
        *[F.max(name).alias(name) for name in EXTRACT_STAMPS],
    ]


def _distinct_ids(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct flight ids per key: all, departing, arriving, with one shuffle of the ids."""
    per_id = (
        fact.filter(F.col("flight_id").isNotNull())
        .groupBy(*keys, "flight_id")
        .agg(
            F.max(F.coalesce(rules.departs(), F.lit(False))).alias("departs"),
            F.max(F.coalesce(rules.arrives(), F.lit(False))).alias("arrives"),
        )
    )
    return per_id.groupBy(*[F.col(key).alias(f"_{key}") for key in keys]).agg(
        F.count("*").alias("unique_flights"),
        F.count_if("departs").alias("total_departures"),
        F.count_if("arrives").alias("total_arrivals"),
    )


def _with_ids(totals: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    same = [totals[key].eqNullSafe(ids[f"_{key}"]) for key in keys]
    counts = ["unique_flights", "total_departures", "total_arrivals"]
    return totals.join(ids, same, "left").fillna(0, counts).drop(*[f"_{key}" for key in keys])


AIRLINE = ["airline_code", "airline_name"]


def airline_parts(fact: DataFrame, *more: str) -> DataFrame:
    """What airline totals add up from, per airline, airport and route, and per ``more``."""
    known = fact.filter(F.col("airline_code").isNotNull())
    return known.groupBy(*more, *AIRLINE, "airport_code", "origin_destination_code").agg(*_additive())


def airline_totals(fact: DataFrame) -> DataFrame:
    """Totals per airline code and name, before percentages and ranks."""
    known = fact.filter(F.col("airline_code").isNotNull())
    return airline_totals_of(airline_parts(fact), _distinct_ids(known, AIRLINE))


def airline_totals_of(parts: DataFrame, ids: DataFrame) -> DataFrame:
    """The same from parts, of all days together or day by day, and the numbers of distinct ids."""
    totals = parts.groupBy(*AIRLINE).agg(
        F.sum("records").alias("total_flight_records"),
        F.count_distinct("airport_code").alias("unique_airports"),
        F.count_distinct("origin_destination_code").alias("unique_routes"),
        *_averages(),
        F.sum("cancelled").alias("total_cancelled_flights"),
        F.sum("late").alias("total_delayed_flights"),
        F.sum("on_time").alias("total_on_time_flights"),
        F.sum("severe").alias("total_severely_delayed_flights"),
        F.sum("moderate").alias("total_moderately_delayed_flights"),
        *_ends(),
    )
    return _with_ids(totals, ids, AIRLINE)


def _departure_shares(names: dict[str, str]) -> dict[str, Column]:
    departures = F.col("total_departures")
    return {new: scaled_share_or_zero(F.col(part), departures) for new, part in names.items()}


def rank_airlines(totals: DataFrame) -> DataFrame:
    """Percentages of departures and the three ranks over all airlines."""
    shares = _departure_shares(
        {
            "on_time_departure_percentage": "total_on_time_flights",
            "delayed_departure_percentage": "total_delayed_flights",
            "cancellation_rate": "total_cancelled_flights",
            "severe_delay_rate": "total_severely_delayed_flights",
        }
    )
    ranked = add_ranks(
        totals.withColumns(shares),
        {
            "on_time_rank": descending(F.col("on_time_departure_percentage")),
            "avg_delay_rank": F.col("avg_departure_delay_minutes"),
            "volume_rank": descending(F.col("unique_flights")),
        },
    )
    return ranked.select(
        "airline_code",
        "airline_name",
        "total_flight_records",
        "unique_flights",
        "total_departures",
        "total_arrivals",
        "unique_airports",
        "unique_routes",
        "avg_departure_delay_minutes",
        "avg_arrival_delay_minutes",
        "avg_overall_delay_minutes",
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
        "first_flight_date",
        "last_flight_date",
        *EXTRACT_STAMPS,
    ).orderBy(F.desc("total_departures"), "airline_code", "airline_name")


def airline_metrics(fact: DataFrame) -> DataFrame:
    return rank_airlines(airline_totals(fact))


def _peak_hours(reduced: DataFrame) -> DataFrame:
    """Per airport the scheduled hour with most departures and with most arrivals.

    The earliest of several; an unknown hour counts as one, and wins only with more.
    """
    slots = (
        reduced.filter(F.col("movement_type").isin("D", "A"))
        .groupBy("airport_code", "movement_type", "scheduled_hour")
        .agg(F.sum("records").alias("n"))
    )
    hour = F.struct(F.col("n"), (-F.col("scheduled_hour")).alias("minus_hour"))
    best = {kind: F.max(F.when(F.col("movement_type") == kind, hour)) for kind in ("D", "A")}
    return slots.groupBy(F.col("airport_code").alias("_peak_airport")).agg(
        (-best["D"]["minus_hour"]).cast("long").alias("peak_departure_hour"),
        (-best["A"]["minus_hour"]).cast("long").alias("peak_arrival_hour"),
    )


def airport_parts(fact: DataFrame, *more: str) -> DataFrame:
    """What airport totals add up from, the hour histogram included, per ``more``."""
    known = fact.filter(F.col("airport_code").isNotNull())
    keys = ["airport_code", "airline_code", "origin_destination_code", "movement_type", "scheduled_hour"]
    return known.groupBy(*more, *keys).agg(*_additive())


def airport_totals(fact: DataFrame) -> DataFrame:
    """Totals per airport, before percentages and ranks.

    One reduction of the fact carries the sums, the two small distinct counts
    and the hour histogram; flight ids go through a second, narrow one.
    """
    known = fact.filter(F.col("airport_code").isNotNull())
    return airport_totals_of(airport_parts(fact), _distinct_ids(known, ["airport_code"]))


def airport_totals_of(reduced: DataFrame, ids: DataFrame) -> DataFrame:
    """The same from parts, of all days together or day by day, and the numbers of distinct ids."""
    totals = reduced.groupBy("airport_code").agg(
        *_averages(),
        F.sum("cancelled").alias("total_cancelled_flights"),
        F.sum("late").alias("total_delayed_flights"),
        F.sum("on_time").alias("total_on_time_flights"),
        F.count_distinct("airline_code").alias("unique_airlines"),
        F.count_distinct("origin_destination_code").alias("unique_destinations"),
        *_ends(),
    )
    peaks = _peak_hours(reduced)
    totals = totals.join(peaks, totals["airport_code"] == peaks["_peak_airport"], "left").drop("_peak_airport")
    return _with_ids(totals, ids, ["airport_code"])


def rank_airports(totals: DataFrame) -> DataFrame:
    """Percentages of departures and the three ranks over all airports."""
    volume = F.col("total_departures") + F.col("total_arrivals")
    shares = _departure_shares(
        {
            "on_time_departure_percentage": "total_on_time_flights",
            "delayed_departure_percentage": "total_delayed_flights",
            "cancellation_rate": "total_cancelled_flights",
        }
    )
    ranked = add_ranks(
        totals.withColumns(shares),
        {
            "on_time_rank": descending(F.col("on_time_departure_percentage")),
            "avg_delay_rank": F.col("avg_departure_delay_minutes"),
            "volume_rank": descending(volume),
        },
    )
    return ranked.select(
        "airport_code",
        "total_departures",
        "total_arrivals",
        "avg_departure_delay_minutes",
        "avg_arrival_delay_minutes",
        "avg_overall_delay_minutes",
        "total_cancelled_flights",
        "total_delayed_flights",
        "total_on_time_flights",
        "unique_airlines",
        "unique_destinations",
        "peak_departure_hour",
        "peak_arrival_hour",
        "on_time_departure_percentage",
        "delayed_departure_percentage",
        "cancellation_rate",
        "on_time_rank",
        "avg_delay_rank",
        "volume_rank",
        "first_flight_date",
        "last_flight_date",
        *EXTRACT_STAMPS,
    ).orderBy(volume.desc(), "airport_code")


def airport_operations(fact: DataFrame) -> DataFrame:
    return rank_airports(airport_totals(fact))


# --- delays ----------------------------------------------------------------------------------


def _severity(category: str) -> Column:
    return tally(F.col("delay_category") == category)


def _delay_measures() -> dict[str, Column]:
    return {
        "total_flights": F.count("*"),
        "total_delayed_flights": tally(rules.late()),
        "avg_delay_minutes": F.avg(_measured()),
        "avg_delay_when_delayed": F.avg(F.when(rules.late(), _measured())),
        "severe_delays": _severity("severe"),
        "moderate_delays": _severity("moderate"),
        "minor_delays": _severity("minor"),
    }


def _extremes() -> dict[str, Column]:
    return {"min_delay_minutes": F.min(rules.delay()), "max_delay_minutes": F.max(rules.delay())}


def _season() -> dict[str, Column]:
    return {"first_seen_date": F.min("flight_date"), "last_seen_date": F.max("flight_date")}


def _by(fact: DataFrame, keys: list[str], *measures: dict[str, Column]) -> DataFrame:
    """Aggregate the rows whose keys are all filled."""
    for key in keys:
        fact = fact.filter(F.col(key).isNotNull())
    columns = {name: value for group in measures for name, value in group.items()}
    columns["_sdc_extracted_at"] = F.max("_sdc_extracted_at")
    return fact.groupBy(*keys).agg(*[value.alias(name) for name, value in columns.items()])


def hourly_delays(fact: DataFrame) -> DataFrame:
    return _by(fact, ["flight_date", "scheduled_hour"], _delay_measures(), _extremes())


def daily_delays(fact: DataFrame) -> DataFrame:
    return _by(fact, ["flight_date", "day_of_week"], _delay_measures())


def route_delays(fact: DataFrame) -> DataFrame:
    departures = fact.filter(rules.departs()).withColumnRenamed(
        "origin_destination_code", "destination_code"
    )
    return _by(departures, ["airport_code", "destination_code"], _delay_measures(), _season())


def airline_delays(fact: DataFrame) -> DataFrame:
    return _by(fact, ["airline_code", "airline_name", "day_of_week"], _delay_measures())


def delay_distribution(fact: DataFrame) -> DataFrame:
    """Per delay category (at most four rows), with its share of all movements."""
    grouped = _by(
        fact,
        ["delay_category"],
        {
            "total_flights": F.count("*"),
            "avg_delay_minutes": F.avg(_measured()),
            "avg_delay_when_delayed": F.avg(F.when(rules.delay() > 0, _measured())),
        },
        _extremes(),
    )
    return with_share(grouped, "percentage", 2, scaled_share_or_zero)


def with_share(categories: DataFrame, name: str, digits: int, ratio) -> DataFrame:
    """Add each delay category's share of all rows; the window sees at most four rows."""
    total = F.sum("total_flights").over(Window.partitionBy())
    return categories.withColumn(name, F.round(ratio(F.col("total_flights"), total), digits))


# Grain -> its key columns, in the order of dimension_1 to dimension_3.
DELAY_GRAINS = {
    "hourly": ["flight_date", "scheduled_hour"],
    "daily": ["flight_date", "day_of_week"],
    "route": ["airport_code", "origin_destination_code"],
    "airline": ["airline_code", "airline_name", "day_of_week"],
    "distribution": ["delay_category"],
}
# Measures that only some grains report.
GRAIN_ONLY = {
    "total_delayed_flights": ["hourly", "daily", "route", "airline"],
    "severe_delays": ["hourly", "daily", "route", "airline"],
    "moderate_delays": ["hourly", "daily", "route", "airline"],
    "minor_delays": ["hourly", "daily", "route", "airline"],
    "min_delay_minutes": ["hourly", "distribution"],
    "max_delay_minutes": ["hourly", "distribution"],
    "first_seen_date": ["route"],
    "last_seen_date": ["route"],
}


def delay_parts(fact: DataFrame) -> DataFrame:
    """Sums per day for all delay grains, from one pass over the fact.

    Grouping sets give every row to each grain inside the map task, where
    partial aggregation collapses it, so there is one scan and one shuffle of
    already small groups instead of five of each. The parts of a day depend on
    that day's movements only.
    """
    # The routes take departures only; elsewhere their keys stay empty and the group is dropped.
    route = {
        name: F.when(rules.departs(), F.col(name)).alias(name)
        for name in ("airport_code", "origin_destination_code")
    }
    keyed = fact.select(
        *["flight_date", "scheduled_hour", "day_of_week", "airline_code", "airline_name"],
        *["delay_category", "delay_minutes", "is_delayed", "_sdc_extracted_at"],
        *route.values(),
    )
    keys = list(dict.fromkeys(["flight_date", *(key for own in DELAY_GRAINS.values() for key in own)]))
    sets = {grain: list(dict.fromkeys(["flight_date", *own])) for grain, own in DELAY_GRAINS.items()}
    averaged = {
        "measured": _measured(),
        "late": F.when(rules.late(), _measured()),
        "positive": F.when(rules.delay() > 0, _measured()),
    }
    sums = keyed.groupingSets(list(sets.values()), *keys).agg(
        F.grouping_id().alias("_grain"),
        F.count("*").alias("flights"),
        F.count_if(rules.late()).alias("late"),
        *[F.sum(value).alias(f"{name}_sum") for name, value in averaged.items()],
        *[F.count(value).alias(f"{name}_n") for name, value in averaged.items()],
        *[
            F.count_if(F.col("delay_category") == category).alias(category)
            for category in ("severe", "moderate", "minor")
        ],
        F.min("delay_minutes").alias("shortest"),
        F.max("delay_minutes").alias("longest"),
        F.max("_sdc_extracted_at").alias("_sdc_extracted_at"),
    )
    # grouping_id has a bit per key, the first key highest; 1 means the grain lacks the key.
    ids = {
        grain: sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in own)
        for grain, own in sets.items()
    }

    def per_grain(choose: Callable[[str], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("_grain") == ids[grain], choose(grain)) for grain in sets])

    def all_filled(grain: str) -> Column:
        return reduce(and_, [F.col(key).isNotNull() for key in DELAY_GRAINS[grain]])

    def dimension(position: int) -> Column:
        def nth(grain: str) -> Column:
            own = DELAY_GRAINS[grain]
            value = F.col(own[position]) if position < len(own) else F.lit(None)
            return value.cast("string")

        return per_grain(nth).alias(f"dimension_{position + 1}")

    numbers = [name for name in sums.columns if name not in (*keys, "_grain")]
    return sums.filter(per_grain(all_filled)).select(
        "flight_date",
        per_grain(F.lit).alias("analysis_type"),
        *[dimension(position) for position in range(3)],
        *numbers,
    )


def delays_of(parts: DataFrame) -> DataFrame:
    """All delay grains in one tall table, added up from the days' parts."""
    kind = F.col("analysis_type")
    distribution = kind == "distribution"

    def average(name: str) -> Column:
        return mean(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    def reported(name: str, value: Column) -> Column:
        return F.when(kind.isin(GRAIN_ONLY[name]), value).alias(name)

    return parts.groupBy("analysis_type", "dimension_1", "dimension_2", "dimension_3").agg(
        F.sum("flights").alias("total_flights"),
        reported("total_delayed_flights", F.sum("late")),
        average("measured").alias("avg_delay_minutes"),
        F.when(distribution, average("positive"))
        .otherwise(average("late"))
        .alias("avg_delay_when_delayed"),
        reported("severe_delays", F.sum("severe")),
        reported("moderate_delays", F.sum("moderate")),
        reported("minor_delays", F.sum("minor")),
        reported("min_delay_minutes", F.min("shortest")),
        reported("max_delay_minutes", F.max("longest")),
        reported("first_seen_date", F.min("flight_date")),
        reported("last_seen_date", F.max("flight_date")),
        F.max("_sdc_extracted_at").alias("_sdc_extracted_at"),
    )


def delay_analysis(fact: DataFrame) -> DataFrame:
    return delays_of(delay_parts(fact))


# --- routes ----------------------------------------------------------------------------------


def _route_shares() -> dict[str, Column]:
    flights = F.col("total_flights")
    return {
        "on_time_percentage": share_or_zero(F.col("total_on_time_flights"), flights),
        "delayed_percentage": share_or_zero(F.col("total_delayed_flights"), flights),
        "cancellation_rate": share_or_zero(F.col("total_cancelled_flights"), flights),
    }


def routes_metrics_daily(fact: DataFrame) -> DataFrame:
    """Departures per day, route and airline, valid airport codes only."""
    routes = fact.filter(rules.departs()).withColumns(
        {
            "origin_airport_code": text.code(F.col("airport_code")),
            "destination_airport_code": text.code(F.col("origin_destination_code")),
        }
    )
    valid = (
        routes.filter(F.col("flight_date").isNotNull() & F.col("airline_code").isNotNull())
        .filter(rules.is_airport_code(F.col("origin_airport_code")))
        .filter(rules.is_airport_code(F.col("destination_airport_code")))
    )
    keys = ["flight_date", "origin_airport_code", "destination_airport_code", "airline_code"]
    daily = valid.groupBy(*keys, "airline_name").agg(
        F.count("*").alias("total_flights"),
        tally(rules.flown()).alias("total_completed_flights"),
        tally(rules.cancelled()).alias("total_cancelled_flights"),
        tally(rules.late()).alias("total_delayed_flights"),
        tally(rules.on_time()).alias("total_on_time_flights"),
        F.avg(F.when(rules.flown(), _measured())).alias("avg_delay_minutes"),
        *[F.max(name).alias(name) for name in EXTRACT_STAMPS],
    )
    return daily.withColumns(_route_shares()).select(
        F.concat_ws("-", *[F.col(key).cast("string") for key in keys]).alias("route_day_sk"),
        *keys,
        "airline_name",
        "total_flights",
        "total_completed_flights",
        "total_cancelled_flights",
        "total_delayed_flights",
        "total_on_time_flights",
        "avg_delay_minutes",
        "on_time_percentage",
        "delayed_percentage",
        "cancellation_rate",
        *EXTRACT_STAMPS,
    )


def routes_metrics(
    daily: DataFrame, airports: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Routes over the last days, with both airports' details.

    The days are added up first and the airports joined to the result, which
    is the same as the airport code is unique, and joins far fewer rows.
    """
    window = daily.filter(
        F.col("flight_date") >= F.date_sub(settings.today(), settings.route_window_days)
    )
    totals = window.groupBy(
        "origin_airport_code", "destination_airport_code", "airline_code", "airline_name"
    ).agg(
        F.min("flight_date").alias("window_start_date"),
        F.max("flight_date").alias("window_end_date"),
        F.sum("total_flights").alias("total_flights"),
        F.sum("total_completed_flights").alias("total_completed_flights"),
        F.sum("total_cancelled_flights").alias("total_cancelled_flights"),
        F.sum("total_delayed_flights").alias("total_delayed_flights"),
        F.sum("total_on_time_flights").alias("total_on_time_flights"),
        mean(
            F.sum(F.col("avg_delay_minutes") * F.col("total_completed_flights")),
            F.sum("total_completed_flights"),
        ).alias("avg_delay_minutes"),
    )

    def described(role: str) -> DataFrame:
        details = ["airport_code", "airport_name", "city", "region", "country"]
        return airports.select(
            *[
                F.col(name).alias(f"{role}_{name if name.startswith('airport') else name}")
                for name in details
            ]
        )

    return (
        totals.join(described("origin"), "origin_airport_code", "left")
        .join(described("destination"), "destination_airport_code", "left")
        .withColumns(_route_shares())
        .select(
            *[
                f"{role}_{name}"
                for role in ("origin", "destination")
                for name in ("airport_code", "airport_name", "city", "region", "country")
            ],
            "airline_code",
            "airline_name",
            "window_start_date",
            "window_end_date",
            "total_flights",
            "total_completed_flights",
            "total_cancelled_flights",
            "total_delayed_flights",
            "total_on_time_flights",
            "avg_delay_minutes",
            "on_time_percentage",
            "delayed_percentage",
            "cancellation_rate",
        )
    )
