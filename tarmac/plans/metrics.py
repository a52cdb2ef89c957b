"""Named measures and metrics over any dimensions and day, week, month, quarter or year."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.sources.spine import spine_of

from tarmac.functions import rules
from tarmac.functions.measures import tally

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Model:
    """A table with measures, dimensions and one time dimension."""

    name: str
    measures: dict[str, Callable[[], Column]]
    dimensions: dict[str, str]
    time: str = "flight_date"


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


FLIGHTS = Model(
    "flights_performance",
    measures={
        "flights_count": lambda: F.sum(F.lit(1)),
        "cancelled_flights": lambda: tally(rules.cancelled()),
        "delayed_flights": lambda: tally(rules.late()),
        "on_time_flights": lambda: tally(rules.on_time()),
        "delay_minutes": lambda: F.sum("delay_minutes"),
        "avg_delay_minutes": lambda: F.avg("delay_minutes"),
    },
    dimensions={
        **_same(
            "flight_date",
            "airline_code",
            "airline_name",
            "airport_code",
            "movement_type",
            "flight_direction",
            "is_cancelled",
            "is_delayed",
            "delay_category",
            "time_of_day",
            "day_of_week",
            "aircraft_type",
            "gate",
        ),
        "month_num": "month",
        "year_num": "year",
    },
)

ROUTES = Model(
    "routes_metrics_daily",
    measures={
        "route_total_flights": lambda: F.sum("total_flights"),
        "route_cancelled_flights": lambda: F.sum("total_cancelled_flights"),
        "route_delayed_flights": lambda: F.sum("total_delayed_flights"),
        "route_on_time_flights": lambda: F.sum("total_on_time_flights"),
        "route_avg_delay_minutes": lambda: F.avg("avg_delay_minutes"),
    },
    dimensions=_same(
        "flight_date",
        "origin_airport_code",
        "destination_airport_code",
        "airline_code",
        "airline_name",
    ),
)


@dataclass(frozen=True)
class Metric:
    """A measure, or the ratio (0 to 1) of two measures of one model."""

    model: Model = field(repr=False)
    measure: str
    of: str | None = None

    def column(self) -> Column:
        value = self.model.measures[self.measure]()
        if self.of is None:
            return value
        whole = F.nullif(self.model.measures[self.of]().cast("double"), F.lit(0.0))
        return F.try_divide(value.cast("double"), whole)


# Metric name -> definition.
METRICS = {
    "total_flights": Metric(FLIGHTS, "flights_count"),
    "total_cancelled": Metric(FLIGHTS, "cancelled_flights"),
    "total_delayed": Metric(FLIGHTS, "delayed_flights"),
    "total_on_time": Metric(FLIGHTS, "on_time_flights"),
    "total_delay_minutes": Metric(FLIGHTS, "delay_minutes"),
    "avg_delay_minutes": Metric(FLIGHTS, "avg_delay_minutes"),
    "on_time_percentage": Metric(FLIGHTS, "on_time_flights", of="flights_count"),
    "cancellation_rate": Metric(FLIGHTS, "cancelled_flights", of="flights_count"),
    "delayed_percentage": Metric(FLIGHTS, "delayed_flights", of="flights_count"),
    "route_total_flights": Metric(ROUTES, "route_total_flights"),
    "route_avg_delay_minutes": Metric(ROUTES, "route_avg_delay_minutes"),
}


def metric(
    table: DataFrame,
    names: str | Sequence[str],
    by: Sequence[str] = (),
    grain: str = "day",
    where: Column | None = None,
) -> DataFrame:
    """Metrics or bare measures of one model, grouped by dimensions, in one aggregation.

    ``table`` holds the model's rows; ``grain`` truncates the time dimension
    where it is among ``by``.
    """
    names = [names] if isinstance(names, str) else list(names)
    chosen = {name: _find(name) for name in names}
    models = {id(entry.model): entry.model for entry in chosen.values()}
    if len(models) != 1:
        raise ValueError(f"metrics of different models, see metrics_of: {names}")
    (model,) = models.values()
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    unknown = [name for name in by if name not in model.dimensions]
    if unknown:
        raise ValueError(f"{model.name} has no dimension {unknown}")
    if where is not None:
        table = table.filter(where)
    keys = []
    for name in by:
        value = F.col(model.dimensions[name])
        if name == model.time and grain != "day":
            value = F.trunc(value, grain)
        keys.append(value.alias(name))
    return table.groupBy(*keys).agg(*[entry.column().alias(name) for name, entry in chosen.items()])


def metrics_of(
    tables: Mapping[str, DataFrame],
    names: Sequence[str],
    by: Sequence[str] = (),
    grain: str = "day",
    fill: bool = False,
) -> DataFrame:
    """Metrics of several models in one table, by dimensions that all of them have.

    ``tables`` holds the rows of each model by its name. Each model is aggregated by itself, and rows of
    the same dimensions are brought together, an unknown value being one like any other; where a model has no
    such row its metrics are NULL. With ``fill``, and the day as the only dimension, there is a row
    for every period between the first and the last.
    """
    chosen = {name: _find(name).model for name in names}
    models = list({id(model): model for model in chosen.values()}.values())
    for model in models:
        if model.name not in tables:
            raise ValueError(f"the rows of {model.name} are missing")
    if fill and (not by or any(list(by) != [model.time] for model in models)):
        raise ValueError("only a single time dimension can be filled")
    parts = []
    for model in models:
        own = [name for name in names if chosen[name] is model]
        parts.append(metric(tables[model.name], own, by, grain))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # Each model has one row per dimensions at most, so the largest is the only one.
    result = together.groupBy(*by).agg(*[F.max(name).alias(name) for name in names])
    if not fill:
        return result
    (time,) = by
    day = F.col("date_day") if grain == "day" else F.trunc("date_day", grain)
    periods = spine_of(together, time).select(day.alias("_period")).distinct()
    filled = periods.join(result, F.col("_period") == F.col(time), "left")
    return filled.select(F.col("_period").alias(time), *names)


def _find(name: str) -> Metric:
    if name in METRICS:
        return METRICS[name]
    for model in (FLIGHTS, ROUTES):
        if name in model.measures:
            return Metric(model, name)
    raise KeyError(f"no metric or measure {name!r}")
