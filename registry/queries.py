"""Every query as ``(spark, sf_dir) -> DataFrame``; the SQL twins are in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.config import Settings, durable, prepare, scratch_path
from tarmac.operators.latest import keep_latest
from tarmac.operators.quality import Checks, report
from tarmac.operators.ranks import add_ranks, descending
from tarmac.plans import dashboard, marts, metrics, public, staging
from tarmac.plans.checks import DECLARED
from tarmac.schemas import EXTRACT_STAMPS
from tarmac.sinks.export import export_all, json_rows, manifest, targets
from tarmac.sinks.models import with_load_stamp
from tarmac.sources.airports import feed_airports
from tarmac.sources.feed import airport_feed, movement_feed
from tarmac.sources.landed import Landed
from tarmac.sources.spine import spine_of
from tarmac.streaming.pipeline import Pipeline

# The feed covers January 2024; a window of 20 days leaves rows outside.
SETTINGS = Settings(as_of=date(2024, 1, 31), lookback_days=20, route_window_days=20)
GATE_DAYS = dashboard.Filters(date_range=(date(2024, 1, 10), date(2024, 1, 13)))
CHOSEN = dashboard.Filters(
    date_range=(date(2024, 1, 5), None),
    airline=["Foehn", "Garza", "Andes Regional"],
    direction="departure",
    time_of_day=["morning", "evening", "night"],
)

# What the summaries of departures read.
SUMMARY_COLUMNS = """flight_sk flight_date airline_name flight_number airport_code movement_type
origin_destination_code origin_destination_city delay_minutes is_cancelled scheduled_timestamp
movement_actual_timestamp""".split()
# What the totals per airline and airport read.
GROUPED_COLUMNS = [
    *"""flight_id flight_date airline_code airline_name airport_code origin_destination_code
    movement_type movement_actual_timestamp scheduled_hour delay_minutes is_cancelled is_delayed
    delay_category""".split(),
    *EXTRACT_STAMPS,
]

Query = Callable[[SparkSession, str], DataFrame]


class Feed:
    """The models of one data folder; each is planned on use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir

    def flights(self) -> DataFrame:
        return staging.stg_flights(movement_feed(self.spark, self.sf_dir), SETTINGS)

    def fact(self) -> DataFrame:
        return marts.flights_performance(self.flights())

    def recent(self) -> DataFrame:
        """The fact of the days the summaries of departures look at."""
        flights = staging.stg_flights(
            movement_feed(self.spark, self.sf_dir), SETTINGS, public.first_day(SETTINGS)
        )
        return marts.flights_performance(flights)

    def stored_flights(self) -> DataFrame:
        """The movements as a written table, for queries that read them more than once."""
        return durable(self.flights().select(GROUPED_COLUMNS), "flights")

    def stored_fact(self, columns: list[str]) -> DataFrame:
        """The fact's columns that a query needs, as a written table."""
        return durable(self.fact().select(columns), "fact")

    def routes_daily(self) -> DataFrame:
        return marts.routes_metrics_daily(self.fact())

    def airports(self) -> DataFrame:
        return staging.stg_airports(feed_airports(self.spark))


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC, as the given tables hold them."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names}) if names else df


def six_digits(df: DataFrame, name: str) -> DataFrame:
    """Round a sum of fractions, whose last digits depend on the order of adding."""
    return df.withColumn(name, F.round(name, 6)) if name in df.columns else df


def over_feed(build: Callable[[Feed], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(Feed(spark, sf_dir)))


def gates_as_text(feed: Feed) -> DataFrame:
    return with_hours_as_text(public.public_gates_analysis(feed.fact()))


def with_hours_as_text(gates: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("time_distribution").cast("array<string>"), ",")
    return gates.withColumn("time_distribution", listed)


def flights_per_day(feed: Feed) -> DataFrame:
    """The day spine of the feed with the flights of each day, 0 where none flew."""
    daily = durable(metrics.metric(feed.fact(), "total_flights", ["flight_date"]), "daily")
    days = spine_of(daily, "flight_date")
    return days.join(daily, days["date_day"] == daily["flight_date"], "left").select(
        "date_day", F.coalesce("total_flights", F.lit(0)).alias("total_flights")
    )


def dash(name: str, filters: dashboard.Filters, labelled: bool = False) -> Query:
    return over_feed(lambda feed: dashboard.run(name, feed.fact(), filters, labelled))


FLIGHT_METRICS = {
    "total_flights": (["airline_code", "flight_date"], "month"),
    "total_cancelled": (["airport_code", "time_of_day"], "day"),
    "total_delayed": (["flight_date"], "week"),
    "total_on_time": (["movement_type", "day_of_week"], "day"),
    "total_delay_minutes": (["aircraft_type", "delay_category"], "day"),
    "avg_delay_minutes": (["airline_name", "flight_direction"], "day"),
    "on_time_percentage": (["month_num", "year_num", "airline_code"], "day"),
    "cancellation_rate": (["gate"], "day"),
    "delayed_percentage": (["flight_date"], "quarter"),
}
ROUTE_METRICS = {
    "route_total_flights": (["origin_airport_code", "destination_airport_code"], "day"),
    "route_avg_delay_minutes": (["airline_code", "flight_date"], "month"),
}
ROUTE_MEASURES = ["route_cancelled_flights", "route_delayed_flights", "route_on_time_flights"]


def flight_metric(name: str) -> Query:
    by, grain = FLIGHT_METRICS[name]
    return over_feed(lambda feed: metrics.metric(feed.fact(), name, by, grain))


def route_metric(name: str, by: list[str], grain: str) -> Query:
    return over_feed(
        lambda feed: six_digits(
            metrics.metric(feed.routes_daily(), name, by, grain), "route_avg_delay_minutes"
        )
    )


def metrics_of_both(names: list[str], by: list[str], grain: str, fill: bool = False) -> Query:
    """Metrics of movements and of routes side by side."""

    def build(feed: Feed) -> DataFrame:
        fact = durable(feed.fact(), "fact")
        tables = {"flights_performance": fact, "routes_metrics_daily": marts.routes_metrics_daily(fact)}
        return metrics.metrics_of(tables, names, by, grain, fill)

    return over_feed(build)


def landed_deliveries(feed: Feed) -> DataFrame:
    """What a run after the second one reads from the landed table: deliveries per day, and their bytes."""
    landed = Landed(feed.spark, scratch_path(feed.spark, "landed"))
    raw = movement_feed(feed.spark, feed.sf_dir)
    at = F.col("_sdc_extracted_at")
    # The first half of the month comes last.
    landed.land(raw.filter(at >= F.lit(RUNS[0])))
    landed.land(raw.filter(at < F.lit(RUNS[0])))
    new = landed.since(RUNS[1])
    return new.groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("deliveries"))


def export_rows(feed: Feed) -> DataFrame:
    """The rows of two exported documents, as JSON texts."""
    fact = feed.stored_fact(SUMMARY_COLUMNS)
    exported = {
        "public_daily_status": public.public_daily_status(fact, feed.airports(), SETTINGS),
        "public_airline_breakdown": public.public_airline_breakdown(fact, SETTINGS),
    }
    parts = [
        json_rows(model).select(F.lit(name).alias("table_name"), F.col("value").alias("record"))
        for name, model in exported.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def quality_report(feed: Feed) -> DataFrame:
    """All declared checks on all models, each model written once and then checked."""
    flights = durable(feed.flights(), "flights")
    fact = durable(marts.flights_performance(flights), "fact")
    airports = staging.stg_airports(airport_feed(feed.spark, feed.sf_dir))
    daily = durable(marts.routes_metrics_daily(fact), "routes")
    models = {
        "stg_flights": flights,
        "stg_airports": airports,
        "stg_airlines": staging.stg_airlines(flights),
        "stg_aircraft": staging.stg_aircraft(flights),
        "flights_performance": with_load_stamp(fact),
        "airline_metrics": with_load_stamp(marts.airline_metrics(fact)),
        "airport_operations": with_load_stamp(marts.airport_operations(fact)),
        "delay_analysis": with_load_stamp(marts.delay_analysis(fact)),
        "routes_metrics_daily": daily,
        "routes_metrics": marts.routes_metrics(daily, feed.airports(), SETTINGS),
        "public_headline": public.public_headline(fact, SETTINGS),
        "public_bucket_distribution": public.public_bucket_distribution(fact, SETTINGS),
        "public_airline_breakdown": public.public_airline_breakdown(fact, SETTINGS),
        "public_tops": public.public_tops(fact, feed.airports(), SETTINGS),
        "public_daily_status": public.public_daily_status(fact, feed.airports(), SETTINGS),
        "public_gates_analysis": public.public_gates_analysis(fact),
    }
    return report(models, DECLARED)


def ranked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks over a whole table."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    ranks = {"balance_rank": descending(balance), "debt_rank": balance, "nation_rank": nation}
    ranked = add_ranks(customers, ranks)
    return ranked.select("c_custkey", *ranks)


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of each customer."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    newest = keep_latest(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled and unique keys of the order tables."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ORDER_CHECKS}
    return report(tables, ORDER_CHECKS)


ORDER_CHECKS = {
    "orders": Checks(["o_orderkey", "o_custkey"], unique=["o_orderkey", "o_custkey"]),
    "lineitem": Checks(["l_orderkey"], unique_together=[["l_orderkey", "l_linenumber"]]),
    "customer": Checks(["c_custkey", "c_name"], unique=["c_custkey"]),
}

# What had been extracted when each scheduled run began; the last run sees all.
RUNS = [datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2100, 1, 1)]
KEYLESS_EVERY = 50


def _maintained(feed: Feed, maintained: list[str], keyless_every: int | None = None) -> Pipeline:
    """The models after three runs, each of which takes what is new since the last one's high-water mark."""
    raw = movement_feed(feed.spark, feed.sf_dir, keyless_every)
    pipeline = Pipeline(feed.spark, scratch_path(feed.spark, "pipeline"), SETTINGS, maintained)
    for batch, until in enumerate(RUNS):
        landed = raw.filter(F.col("_sdc_extracted_at") <= F.lit(until))
        pipeline.apply(pipeline.new_deliveries(landed), batch)
    return pipeline


def incremental(model: str, *maintained: str, keyless_every: int | None = None) -> Query:
    """A model after the deliveries arrived in batches."""
    return over_feed(lambda feed: _maintained(feed, list(maintained), keyless_every).model(model))


def unkeyed(feed: Feed) -> DataFrame:
    """Deliveries set aside for lack of a key, per day; a delivery that two runs saw counts once."""
    pipeline = _maintained(feed, [], KEYLESS_EVERY)
    runs = [pipeline.unkeyed(batch).withColumn("run", F.lit(batch)) for batch in range(len(RUNS))]
    aside = reduce(DataFrame.unionByName, runs)
    # Without a key, deliveries may be equal and each counts; a run that sees one again sees all its equals again.
    seen = aside.groupBy("run", "data", *EXTRACT_STAMPS).agg(F.count("*").alias("equal"))
    once = seen.groupBy("data", *EXTRACT_STAMPS).agg(F.max("equal").alias("equal"))
    day = F.to_date("_sdc_extracted_at").alias("day")
    return once.groupBy(day).agg(F.sum("equal").alias("deliveries"))


def export_documents(feed: Feed) -> DataFrame:
    """All default exports, written and read back: what the metadata says and what the data holds."""
    spark, fact = feed.spark, feed.fact()
    models = {
        "public_headline": public.public_headline(fact, SETTINGS),
        "public_airline_breakdown": public.public_airline_breakdown(fact, SETTINGS),
        "public_tops": public.public_tops(fact, feed.airports(), SETTINGS),
        "public_bucket_distribution": public.public_bucket_distribution(fact, SETTINGS),
        "public_daily_status": public.public_daily_status(fact, feed.airports(), SETTINGS),
        "public_gates_analysis": public.public_gates_analysis(fact),
        "routes_metrics": marts.routes_metrics(feed.routes_daily(), feed.airports(), SETTINGS),
    }
    root, paths = scratch_path(spark, "exports"), targets()
    done = export_all(models, root, paths)
    listed = manifest(spark, done).select("name", "record_count")

    parts = []
    for table, path in paths.items():
        # A document of any size, read by line: each record is one, the first has the metadata before it.
        head = F.regexp_extract("value", r'^\{"metadata": (\{[^}]*\}), "data": \[', 1)
        lines = spark.read.text(f"{root}/{path}").select(head.alias("head"))
        file = F.lit(path.rpartition("/")[2].removesuffix(".json"))
        parts.append(
            lines.agg(
                F.lit(table).alias("table_name"),
                F.max(F.get_json_object("head", "$.total_records")).cast("long").alias("total_records"),
                F.count("*").alias("records"),
                file.alias("name"),
            )
        )
    return reduce(DataFrame.unionByName, parts).join(listed, "name").drop("name")


QUERIES: dict[str, Query] = {
    "stg_flights": over_feed(Feed.flights),
    "stg_airports": lambda spark, sf_dir: staging.stg_airports(airport_feed(prepare(spark), sf_dir)),
    "stg_airlines": over_feed(lambda feed: staging.stg_airlines(feed.stored_flights())),
    "stg_aircraft": over_feed(lambda feed: staging.stg_aircraft(feed.flights())),
    "flights_performance": over_feed(Feed.fact),
    "airline_metrics": over_feed(lambda feed: marts.airline_metrics(feed.stored_fact(GROUPED_COLUMNS))),
    "airport_operations": over_feed(lambda feed: marts.airport_operations(feed.stored_fact(GROUPED_COLUMNS))),
    "delay_hourly": over_feed(lambda feed: marts.hourly_delays(feed.fact())),
    "delay_daily": over_feed(lambda feed: marts.daily_delays(feed.fact())),
    "delay_route": over_feed(lambda feed: marts.route_delays(feed.fact())),
    "delay_airline": over_feed(lambda feed: marts.airline_delays(feed.fact())),
    "delay_distribution": over_feed(lambda feed: marts.delay_distribution(feed.fact())),
    "delay_analysis": over_feed(lambda feed: marts.delay_analysis(feed.fact())),
    "routes_metrics_daily": over_feed(Feed.routes_daily),
    "routes_metrics": over_feed(
        lambda feed: six_digits(
            marts.routes_metrics(feed.routes_daily(), feed.airports(), SETTINGS), "avg_delay_minutes"
        )
    ),
    "public_headline": over_feed(lambda feed: public.public_headline(feed.recent(), SETTINGS)),
    "public_airline_breakdown": over_feed(
        lambda feed: public.public_airline_breakdown(feed.recent(), SETTINGS)
    ),
    "public_tops": over_feed(
        lambda feed: public.public_tops(durable(feed.recent().select(SUMMARY_COLUMNS), "recent"), feed.airports(), SETTINGS)
    ),
    "public_daily_status": over_feed(
        lambda feed: public.public_daily_status(feed.recent(), feed.airports(), SETTINGS)
    ),
    "public_bucket_distribution": over_feed(
        lambda feed: public.public_bucket_distribution(feed.recent(), SETTINGS)
    ),
    "public_gates_analysis": over_feed(gates_as_text),
    "time_spine": over_feed(flights_per_day),
    **{f"dash_{name}": dash(name, dashboard.Filters()) for name in dashboard.QUERIES},
    "dash_gate_perf_filtered": dash("gate_perf", GATE_DAYS),
    "dash_kpis_filtered": dash("kpis", CHOSEN),
    "dash_delay_distribution_filtered": dash("delay_distribution", CHOSEN),
    **{f"dash_{name}_labelled": dash(name, dashboard.Filters(), labelled=True) for name in dashboard.LABELS},
    "dash_daily_trend_labelled_filtered": dash("daily_trend", CHOSEN, labelled=True),
    "dash_weekday_profile_labelled_filtered": dash("weekday_profile", CHOSEN, labelled=True),
    "dash_hourly_profile_labelled_filtered": dash("hourly_profile", CHOSEN, labelled=True),
    **{f"metric_{name}": flight_metric(name) for name in FLIGHT_METRICS},
    **{f"metric_{name}": route_metric(name, *entry) for name, entry in ROUTE_METRICS.items()},
    **{f"measure_{name}": route_metric(name, ["airline_name"], "day") for name in ROUTE_MEASURES},
    "metrics_by_airline_and_week": metrics_of_both(
        ["total_flights", "total_cancelled", "route_total_flights"], ["airline_code", "flight_date"], "week"
    ),
    "metrics_by_day_filled": metrics_of_both(
        ["total_flights", "route_total_flights", "total_delayed"], ["flight_date"], "day", fill=True
    ),
    "landed_deliveries": over_feed(landed_deliveries),
    "ranked_customers": ranked_customers,
    "latest_orders": latest_orders,
    "key_checks": key_checks,
    "export_rows": over_feed(export_rows),
    "export_documents": over_feed(export_documents),
    "dq_report": over_feed(quality_report),
    "incr_routes_daily": incremental("routes_metrics_daily", "routes_metrics_daily"),
    "incr_airline_metrics": incremental("airline_metrics", "airline_totals"),
    "incr_delay_analysis": incremental("delay_analysis", "delay_parts"),
    "incr_airport_operations": incremental("airport_operations", "airport_totals"),
    "incr_gates_analysis": over_feed(
        lambda feed: with_hours_as_text(_maintained(feed, ["public_gates_analysis"]).model("public_gates_analysis"))
    ),
    "incr_stg_airlines": incremental("stg_airlines", "stg_airlines"),
    "incr_stg_aircraft": incremental("stg_aircraft", "stg_aircraft"),
    "incr_stg_flights": incremental("stg_flights", keyless_every=KEYLESS_EVERY),
    "incr_unkeyed": over_feed(unkeyed),
}
