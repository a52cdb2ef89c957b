"""Published summaries over the last days of departures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import Settings
from tarmac.functions import rules, text
from tarmac.functions.measures import mean, share, tally

def _departed() -> Column:
    return F.col("actual_departure_time").isNotNull()


def _measured() -> Column:
    return F.when(_departed(), rules.measured(rules.delay()))


def first_day(settings: Settings = Settings()) -> Column:
    """The first day the summaries of departures look at; ``stg_flights`` takes it as ``since``."""
    return F.date_sub(settings.today(), settings.lookback_days)


def departures(fact: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Departures of the last days.

    The airport is joined later and only where a summary shows it: its code
    is unique, so the join changes no count, and after the aggregation or the
    top-k few rows are left to join.
    """
    return fact.filter(
        (F.col("flight_date") >= first_day(settings))
        & (F.col("movement_type") == "D")
    ).select(
        "flight_sk",
        "flight_date",
        "airline_name",
        "flight_number",
        F.col("airport_code").alias("origin_airport_code"),
        F.col("origin_destination_code").alias("destination_airport_code"),
        F.col("origin_destination_city").alias("feed_city"),
        "delay_minutes",
        "is_cancelled",
        F.col("scheduled_timestamp").alias("scheduled_departure_time"),
        F.col("movement_actual_timestamp").alias("actual_departure_time"),
    )


def _with_destination(df: DataFrame, airports: DataFrame) -> DataFrame:
    places = airports.select(
        F.col("airport_code").alias("destination_airport_code"),
        F.col("city").alias("_city"),
        F.col("country").alias("destination_country"),
    )
    city = F.coalesce("_city", "feed_city")
    return (
        df.join(places, "destination_airport_code", "left")
        .withColumn("destination_city", city)
        .drop("_city", "feed_city")
    )


def _rounded_average() -> Column:
    return F.round(F.avg(_measured()), 1)


def public_headline(fact: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return departures(fact, settings).agg(
        F.count("*").alias("total_flights"),
        tally(rules.cancelled()).alias("cancelled_flights"),
        tally(rules.delay() > 30).alias("delayed_over_30min"),
        tally(rules.delay() > 45).alias("delayed_over_45min"),
        _rounded_average().alias("avg_delay_minutes"),
        F.lit(settings.lookback_days).cast("long").alias("lookback_days"),
    )


def public_airline_breakdown(fact: DataFrame, settings: Settings = Settings()) -> DataFrame:
    lost = F.sum(F.when(rules.delay() > 0, rules.delay()).otherwise(0)).cast("double") / F.lit(60.0)
    return (
        departures(fact, settings)
        .groupBy("airline_name")
        .agg(
            F.count("*").alias("total_flights"),
            tally(rules.cancelled()).alias("cancelled_flights"),
            _rounded_average().alias("avg_delay_minutes"),
            F.round(lost, 1).alias("hours_lost"),
            *[
                F.count_if(condition).alias(name)
                for name, condition in rules.delay_buckets(rules.cancelled(), rules.delay()).items()
            ],
        )
        .orderBy(F.desc("total_flights"), "airline_name")
    )


def public_bucket_distribution(fact: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Six buckets as rows, counted in one pass."""
    buckets = {"cancelled": rules.cancelled(), **rules.delay_buckets(rules.cancelled(), rules.delay())}
    counts = departures(fact, settings).agg(
        *[F.count_if(condition).alias(name) for name, condition in buckets.items()]
    )
    return counts.unpivot([], list(buckets), "bucket", "total_flights")


def public_daily_status(
    fact: DataFrame, airports: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Per day: totals and the destination most flights went to.

    The fact is reduced to day and destination once; both the totals and the
    top destination come from that.
    """
    reduced = (
        departures(fact, settings)
        .groupBy("flight_date", "destination_airport_code", "feed_city")
        .agg(
            F.count("*").alias("flights"),
            F.count_if(rules.cancelled()).alias("cancelled"),
            F.count_if(rules.delay() > 30).alias("late"),
            F.sum(_measured()).alias("delay_sum"),
            F.count(_measured()).alias("delay_n"),
        )
    )
    per_city = (
        _with_destination(reduced, airports)
        .groupBy("flight_date", "destination_city", "destination_country")
        .agg(*[F.sum(name).alias(name) for name in ("flights", "cancelled", "late", "delay_sum", "delay_n")])
    )
    named = F.col("destination_city").isNotNull()
    best_first = Window.partitionBy("flight_date").orderBy(
        named.desc(), F.desc("flights"), "destination_city", F.asc_nulls_last("destination_country")
    )
    # One value per day marks its best city, so the totals need no second pass.
    marked = per_city.withColumn("_best", named & (F.row_number().over(best_first) == 1))
    return marked.groupBy("flight_date").agg(
        F.sum("flights").alias("total_flights"),
        F.sum("cancelled").alias("cancelled_flights"),
        F.sum("late").alias("delayed_over_30min"),
        F.round(mean(F.sum("delay_sum"), F.sum("delay_n")), 1).alias("avg_delay_minutes"),
        F.max(F.when(F.col("_best"), F.col("destination_city"))).alias("top_destination_city"),
        F.max(F.when(F.col("_best"), F.col("destination_country"))).alias("top_destination_country"),
    )


TOP = 10


def _numbered(top: DataFrame, order: list[Column]) -> DataFrame:
    """Number the rows of a result already cut to the top few."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def _top(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(TOP)


def public_tops(
    fact: DataFrame, airports: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Ten busiest destinations, longest delays and earliest departures."""
    base = departures(fact, settings)
    reduced = base.groupBy("destination_airport_code", "feed_city").agg(
        F.count("*").alias("flights"),
        F.sum(_measured()).alias("delay_sum"),
        F.count(_measured()).alias("delay_n"),
    )
    cities = (
        _with_destination(reduced, airports)
        .filter(F.col("destination_city").isNotNull())
        .groupBy("destination_city", "destination_country")
        .agg(
            F.sum("flights").alias("total_flights"),
            F.round(mean(F.sum("delay_sum"), F.sum("delay_n")), 1).alias("avg_delay_minutes"),
        )
    )
    busiest = [
        F.desc("total_flights"),
        F.asc("destination_city"),
        F.asc_nulls_last("destination_country"),
    ]
    top_cities = _numbered(_top(cities, busiest), busiest)

    known = base.filter(_departed() & rules.delay().isNotNull())
    same_delay = [
        F.asc_nulls_last("flight_number"),
        F.asc("scheduled_departure_time"),
        F.asc("flight_sk"),
    ]
    latest = [rules.delay().desc(), *same_delay]
    earliest = [rules.delay().asc(), *same_delay]
    top_late = _numbered(_with_destination(_top(known, latest), airports), latest)
    top_early = _numbered(
        _with_destination(_top(known.filter(rules.delay() < 0), earliest), airports), earliest
    )

    flight = {
        "flight_number": "string",
        "origin_airport_code": "string",
        "destination_airport_code": "string",
        "scheduled_departure_time": "timestamp",
        "actual_departure_time": "timestamp",
        "delay_minutes": "double",
    }
    city = {"total_flights": "long", "avg_delay_minutes": "double"}

    def record(df: DataFrame, kind: str, own: dict[str, str]) -> DataFrame:
        return df.select(
            F.lit(kind).alias("record_type"),
            "rank",
            "destination_city",
            "destination_country",
            *[
                (F.col(name) if name in own else F.lit(None)).cast(type_).alias(name)
                for name, type_ in {**city, **flight}.items()
            ],
        )

    return (
        record(top_cities, "top_destination", city)
        .unionByName(record(top_late, "top_delay", flight))
        .unionByName(record(top_early, "top_early", flight))
    )


def gate_parts(fact: DataFrame, *more: str) -> DataFrame:
    """What gates add up from, per gate and UTC hour (NULL if no instant is known), and per ``more``."""
    moment = F.coalesce("movement_actual_timestamp", "estimated_timestamp", "scheduled_timestamp")
    measured = rules.measured(rules.delay())
    return (
        fact.select(*more, text.filled(F.col("gate")).alias("gate"), "delay_minutes", F.hour(moment).alias("hour"))
        .filter(F.col("gate").isNotNull())
        .groupBy(*more, "gate", "hour")
        .agg(
            F.count("*").alias("flights"),
            F.sum(measured).alias("delay_sum"),
            F.count(measured).alias("delay_n"),
            F.count_if(rules.delay() > 0).alias("late"),
            F.count_if(rules.delay() <= 0).alias("on_time"),
            F.max(rules.delay()).alias("longest"),
        )
    )


def public_gates_analysis(fact: DataFrame, gates: int = 20) -> DataFrame:
    """Busiest gates over all movements, with a histogram of 24 UTC hours.

    The fact is reduced to gate and hour first; the histogram is laid out from
    at most 25 rows per gate.
    """
    return gates_of(gate_parts(fact), gates)


def gates_of(per_hour: DataFrame, gates: int = 20) -> DataFrame:
    """The same from parts, of all days together or day by day: histograms add up hour by hour."""
    at_hour = [F.sum(F.when(F.col("hour") == h, F.col("flights")).otherwise(0)) for h in range(24)]
    return (
        per_hour.groupBy("gate")
        .agg(
            F.sum("flights").alias("total_flights"),
            F.round(mean(F.sum("delay_sum"), F.sum("delay_n")), 1).alias("avg_delay_minutes"),
            F.sum("late").alias("delayed_flights"),
            F.sum("on_time").alias("on_time_flights"),
            F.round(share(F.sum("on_time"), F.sum("flights")), 1).alias("on_time_percentage"),
            F.max("longest").alias("max_delay_minutes"),
            F.array(*at_hour).alias("time_distribution"),
        )
        .orderBy(F.desc("total_flights"), "gate")
        .limit(gates)
    )
