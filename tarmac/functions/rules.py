"""Business rules on a movement, each in one place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# States that mean a cancelled flight.
CANCELLED_STATES = ["Cancelado", "Cancelled", "C"]
# A delay in minutes counts as delayed above the first; averages take the range.
DELAYED_ABOVE = 15
MEASURED_RANGE = (-180, 600)


def actual_movement(movement: Column, on: Column, off: Column, actual: Column) -> Column:
    """Gate time of the movement: block-on for arrivals, block-off for departures."""
    at_gate = F.when(movement == "A", on).when(movement == "D", off)
    return F.coalesce(at_gate, actual)


def direction(movement: Column) -> Column:
    return F.when(movement == "A", "arrival").when(movement == "D", "departure").otherwise("unknown")


def delay_category(delay: Column) -> Column:
    """An unknown delay counts as severe, as published."""
    return (
        F.when(delay <= 0, "on_time")
        .when(delay <= 30, "minor")
        .when(delay <= 60, "moderate")
        .otherwise("severe")
    )


def time_of_day(hour: Column) -> Column:
    """An unknown hour counts as night, as published."""
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 21), "evening")
        .otherwise("night")
    )


def measured(delay: Column) -> Column:
    """The delay if it is plausible, else NULL."""
    return F.when(delay.between(*MEASURED_RANGE), delay)


def is_airport_code(text: Column) -> Column:
    return text.rlike(r"\A[A-Z]{3}\z")


def delay_buckets(cancelled: Column, delay: Column) -> dict[str, Column]:
    """Exclusive delay buckets of flights known not to be cancelled."""
    flown = ~cancelled
    return {
        "delay_over_45": flown & (delay > 45),
        "delay_45_30": flown & (delay > 30) & (delay <= 45),
        "delay_30_15": flown & (delay > 15) & (delay <= 30),
        "delay_15_0": flown & (delay > 0) & (delay <= 15),
        "on_time_or_early": flown & (delay <= 0),
    }


# Expressions over the fact's columns; functions, as a column needs a running session.


def delay() -> Column:
    return F.col("delay_minutes")


def cancelled() -> Column:
    return F.col("is_cancelled")


def late() -> Column:
    return F.col("is_delayed")


def on_time() -> Column:
    """Known not to be cancelled, and not late or of unknown delay."""
    return ~cancelled() & ~late()


def punctual() -> Column:
    """Known not to be cancelled, and not a minute late."""
    return ~cancelled() & (delay() <= 0)


def flown() -> Column:
    return F.col("movement_actual_timestamp").isNotNull()


def departs() -> Column:
    return F.col("movement_type") == "D"


def arrives() -> Column:
    return F.col("movement_type") == "A"
