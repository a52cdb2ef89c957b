"""The twelve dashboard queries over the movement fact, with optional filters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import rules, text
from tarmac.functions.measures import share
from tarmac.plans.marts import with_share

Choice = str | Sequence[str] | None


@dataclass(frozen=True)
class Filters:
    """Dashboard variables; an unset one lets everything pass."""

    date_range: tuple[date | None, date | None] = (None, None)
    airline: Choice = None
    airport: Choice = None
    direction: Choice = None
    time_of_day: Choice = None
    delay_category: Choice = None

    # Variable -> column it filters.
    COLUMNS = {
        "airline": "airline_name",
        "airport": "airport_code",
        "direction": "flight_direction",
        "time_of_day": "time_of_day",
        "delay_category": "delay_category",
    }

    def apply(self, fact: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
        """Rows that pass; plain comparisons, so they reach the Parquet scan."""
        first, last = self.date_range
        conditions = []
        if first is not None:
            conditions.append(F.col("flight_date") >= F.lit(first))
        if last is not None:
            conditions.append(F.col("flight_date") <= F.lit(last))
        for variable, column in self.COLUMNS.items():
            chosen = getattr(self, variable)
            if chosen and variable not in ignore:
                values = [chosen] if isinstance(chosen, str) else list(chosen)
                conditions.append(F.col(column).isin(values))
        return fact.filter(reduce(and_, conditions)) if conditions else fact


def _average(where: Column | None = None) -> Column:
    measured = rules.measured(rules.delay())
    return F.round(F.avg(measured if where is None else F.when(where, measured)), 1)


def _percent(condition: Column) -> Column:
    return F.round(share(F.count_if(condition), F.count("*")), 1)


def _heavy() -> Column:
    return ~rules.cancelled() & (rules.delay() > 45)


# Measures the queries pick from, by output name.
MEASURES: dict[str, Callable[[], Column]] = {
    "total_flights": lambda: F.count("*"),
    "unique_flights": lambda: F.count_distinct("flight_id"),
    "cancelled_flights": lambda: F.count_if(rules.cancelled()),
    "delayed_flights": lambda: F.count_if(rules.late()),
    "on_time_flights": lambda: F.count_if(rules.punctual()),
    "on_time_pct": lambda: _percent(rules.punctual()),
    "avg_delay_minutes": lambda: _average(),
    "heavy_delay_pct": lambda: _percent(_heavy()),
    "cancellation_pct": lambda: _percent(rules.cancelled()),
    "delayed_pct": lambda: _percent(rules.late()),
    "departures": lambda: F.count_if(rules.departs()),
    "arrivals": lambda: F.count_if(rules.arrives()),
    "avg_departure_delay": lambda: _average(rules.departs()),
    "avg_arrival_delay": lambda: _average(rules.arrives()),
    "max_delay_minutes": lambda: F.max(rules.delay()),
    "first_date": lambda: F.min("flight_date"),
    "last_date": lambda: F.max("flight_date"),
}


def _measures(*names: str) -> list[Column]:
    return [MEASURES[name]().alias(name) for name in names]


def _options(fact: DataFrame, column: str) -> DataFrame:
    return fact.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def filter_airlines(fact: DataFrame, filters: Filters) -> DataFrame:
    return _options(fact, "airline_name")


def filter_airports(fact: DataFrame, filters: Filters) -> DataFrame:
    return _options(fact, "airport_code")


def kpis(fact: DataFrame, filters: Filters) -> DataFrame:
    return filters.apply(fact).agg(
        *_measures(
            "total_flights",
            "unique_flights",
            "cancelled_flights",
            "delayed_flights",
            "on_time_flights",
            "on_time_pct",
            "avg_delay_minutes",
            "heavy_delay_pct",
            "cancellation_pct",
            "first_date",
            "last_date",
        )
    )


def daily_trend(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures(
        "total_flights", "delayed_flights", "cancelled_flights", "avg_delay_minutes", "on_time_pct"
    )
    return filters.apply(fact).groupBy("flight_date").agg(*shown).orderBy("flight_date")


def airline_perf(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures(
        "total_flights",
        "cancelled_flights",
        "avg_delay_minutes",
        "on_time_pct",
        "cancellation_pct",
        "heavy_delay_pct",
    )
    grouped = filters.apply(fact).groupBy("airline_name").agg(*shown)
    return _busiest(grouped.filter("total_flights >= 20"), 20, "airline_name")


def airport_perf(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures(
        "departures",
        "arrivals",
        "avg_departure_delay",
        "avg_arrival_delay",
        "on_time_pct",
        "cancellation_pct",
    )
    grouped = filters.apply(fact).groupBy("airport_code").agg(*shown)
    return grouped.orderBy((F.col("departures") + F.col("arrivals")).desc(), "airport_code")


def delay_distribution(fact: DataFrame, filters: Filters) -> DataFrame:
    grouped = (
        filters.apply(fact, ignore=["delay_category"])
        .filter(F.col("delay_category").isNotNull())
        .groupBy("delay_category")
        .agg(F.count("*").alias("total_flights"), F.round(F.avg(rules.delay()), 1).alias("avg_delay_minutes"))
    )
    shown = ["delay_category", "total_flights", "pct", "avg_delay_minutes"]
    return with_share(grouped, "pct", 1, share).select(shown).orderBy(F.desc("total_flights"))


def hourly_profile(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures("total_flights", "avg_delay_minutes", "delayed_pct", "cancellation_pct")
    rows = filters.apply(fact).filter(F.col("scheduled_hour").isNotNull())
    return rows.groupBy("scheduled_hour").agg(*shown).orderBy("scheduled_hour")


def weekday_profile(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures("total_flights", "avg_delay_minutes", "on_time_pct", "cancellation_pct")
    rows = filters.apply(fact).filter(F.col("day_of_week").isNotNull())
    return rows.groupBy("day_of_week").agg(*shown).orderBy("day_of_week")


def top_routes(fact: DataFrame, filters: Filters) -> DataFrame:
    """Routes oriented by the movement: an arrival's reporting airport is its destination."""
    departs = rules.departs()
    here, there = F.col("airport_code"), F.col("origin_destination_code")
    keys = ["origin_airport_code", "destination_airport_code", "airline_name"]
    shown = ["total_flights", "cancelled_flights", "avg_delay_minutes", "on_time_pct", "cancellation_pct"]
    grouped = (
        filters.apply(fact)
        .withColumn("origin_airport_code", F.when(departs, here).otherwise(there))
        .withColumn("destination_airport_code", F.when(departs, there).otherwise(here))
        .groupBy(*keys)
        .agg(*_measures(*shown), F.count(rules.measured(rules.delay())).alias("_measured"))
    )
    return _busiest(grouped.filter("_measured >= 5"), 15, *keys).select(*keys, *shown)


def gate_perf(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures("total_flights", "avg_delay_minutes", "on_time_pct", "max_delay_minutes")
    rows = filters.apply(fact, ignore=["time_of_day", "delay_category"])
    named = rows.filter(text.filled(F.col("gate")).isNotNull())
    return _busiest(named.groupBy("gate").agg(*shown).filter("total_flights >= 20"), 15, "gate")


def terminal_perf(fact: DataFrame, filters: Filters) -> DataFrame:
    shown = _measures("total_flights", "avg_delay_minutes", "on_time_pct")
    rows = filters.apply(fact, ignore=["delay_category"]).withColumn(
        "terminal", F.coalesce(text.filled(F.col("terminal")), F.lit("sin terminal"))
    )
    return _busiest(rows.groupBy("terminal").agg(*shown).filter("total_flights >= 20"), 12, "terminal")


def _busiest(grouped: DataFrame, n: int, *ties: str) -> DataFrame:
    return grouped.orderBy(F.desc("total_flights"), *ties).limit(n)


QUERIES: dict[str, Callable[[DataFrame, Filters], DataFrame]] = {
    "filter_airlines": filter_airlines,
    "filter_airports": filter_airports,
    "kpis": kpis,
    "daily_trend": daily_trend,
    "airline_perf": airline_perf,
    "airport_perf": airport_perf,
    "delay_distribution": delay_distribution,
    "hourly_profile": hourly_profile,
    "weekday_profile": weekday_profile,
    "top_routes": top_routes,
    "gate_perf": gate_perf,
    "terminal_perf": terminal_perf,
}

# Labels shown instead of stored values.
WEEKDAY_LABELS = {1: "Dom", 2: "Lun", 3: "Mar", 4: "Mié", 5: "Jue", 6: "Vie", 7: "Sáb"}
CATEGORY_LABELS = {
    "on_time": "En hora / adelantado",
    "minor": "Leve (≤30 min)",
    "moderate": "Moderada (30-60 min)",
    "severe": "Severa (>60 min)",
}


def _lookup(labels: dict, value: Column) -> Column:
    found = F.coalesce(*[F.when(value == key, label) for key, label in labels.items()])
    return F.coalesce(found, value.cast("string"))


# Query -> chart label of its rows.
LABELS: dict[str, Callable[[], Column]] = {
    "daily_trend": lambda: F.date_format("flight_date", "MM-dd"),
    "delay_distribution": lambda: _lookup(CATEGORY_LABELS, F.col("delay_category")),
    "hourly_profile": lambda: F.concat(F.lpad(F.col("scheduled_hour").cast("string"), 2, "0"), F.lit("h")),
    "weekday_profile": lambda: _lookup(WEEKDAY_LABELS, F.col("day_of_week")),
}


def run(
    name: str, fact: DataFrame, filters: Filters | None = None, labelled: bool = False
) -> DataFrame:
    """One dashboard query, with a ``label`` column if asked and the chart has one."""
    rows = QUERIES[name](fact, filters or Filters())
    return rows.withColumn("label", LABELS[name]()) if labelled and name in LABELS else rows
