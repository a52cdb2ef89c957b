"""Keep all models current, batch by batch; the result equals one full build.

A batch reads and writes what it touches only:

* Movements are stored by day and sorted by their key, and the log knows each file's range of keys. A
  movement's key contains its day, so a batch reads the files of its days whose range takes in one of
  its keys, and rewrites those that hold a version it replaces.
* What models add up from (``PARTS``) is kept per day and computed anew for the batch's days.
* Distinct flight ids do not add up over days. For each airline and airport the pipeline keeps how many
  movements have an id (``MEMBERS``). A batch adds its new versions and takes away those
  they replace; where a number leaves or reaches zero, the group's count of distinct ids changes.

All tables of a batch become visible in one step (``operators.versions``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.config import Settings
from tarmac.functions import rules
from tarmac.operators.versions import FileTable, Log, Version, discard
from tarmac.plans import marts, public, staging
from tarmac.schemas import AIRPORT_SCHEMA, LOAD_STAMP, RAW_SCHEMA
from tarmac.sinks.models import described, with_load_stamp
from tarmac.sources.landed import Landed
from tarmac.sources.spine import time_spine

DAY = "flight_date"
# What makes a delivery newer than another; NULL is older than any value.
ORDER_COLUMNS = ["_sdc_extracted_at", "fetched_at", staging.DELIVERY_HASH]
# Of a version that comes or goes: what decides the groups it counts in.
COUNTED_COLUMNS = ["airline_code", "airline_name", "airport_code", "flight_id", "movement_type", "_sdc_extracted_at"]


@dataclass(frozen=True)
class Parts:
    """Rows kept per day: how they come from the day's movements, and for which model."""

    build: Callable[[DataFrame], DataFrame]
    of_fact: bool
    model: str


PARTS = {
    "routes_metrics_daily": Parts(marts.routes_metrics_daily, True, "routes_metrics_daily"),
    "delay_parts": Parts(marts.delay_parts, True, "delay_parts"),
    "airline_parts": Parts(lambda fact: marts.airline_parts(fact, DAY), True, "airline_totals"),
    "airport_parts": Parts(lambda fact: marts.airport_parts(fact, DAY), True, "airport_totals"),
    "gate_parts": Parts(lambda fact: public.gate_parts(fact, DAY), True, "public_gates_analysis"),
    "stg_airline_parts": Parts(lambda flights: staging.airline_parts(flights, DAY), False, "stg_airlines"),
    "stg_aircraft_parts": Parts(lambda flights: staging.aircraft_parts(flights, DAY), False, "stg_aircraft"),
}


@dataclass(frozen=True)
class Members:
    """Groups whose distinct flight ids are counted: their columns, and whether the fact's filter holds."""

    keys: Sequence[str]
    of_fact: bool


MEMBERS = {
    "airline_totals": Members(marts.AIRLINE, True),
    "airport_totals": Members(["airport_code"], True),
    "stg_airlines": Members(["airline_code"], False),
}
MAINTAINED = tuple(dict.fromkeys(parts.model for parts in PARTS.values()))

# Buckets by group; a large group's ids fill several files of its bucket.
BUCKETS = 64
COUNTS = ["movements", "departures", "arrivals"]
_GROUP = [T.StructField(name, T.StringType()) for name in ("kind", "key_1", "key_2")]
_NUMBERS = [T.StructField(name, T.LongType()) for name in COUNTS]
MEMBER_SCHEMA = T.StructType(
    [*_GROUP, T.StructField("member", T.StringType()), *_NUMBERS, T.StructField("bucket", T.IntegerType())]
)
GROUP_SCHEMA = T.StructType([*_GROUP, *_NUMBERS])


class Pipeline:
    """The stored models below one folder of the cluster's shared storage."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        settings: Settings = Settings(),
        maintained: Sequence[str] = MAINTAINED,
        airports: DataFrame | None = None,
    ):
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings
        self.maintained = set(maintained)
        self.airports = airports
        self.log = Log(spark, f"{self.root}/_log")
        stored = staging.latest_movements(spark.createDataFrame([], RAW_SCHEMA), settings)
        self.flights = self._table("stg_flights", stored.schema, DAY, "flight_sk")
        fact = marts.flights_performance(stored)
        self.parts = {
            name: self._table(name, p.build(fact if p.of_fact else stored).schema, DAY) for name, p in PARTS.items()
        }
        self.keyless = self._table("keyless", stored.schema)
        self.aside = self._table("unkeyed", staging.keyless_deliveries(spark.createDataFrame([], RAW_SCHEMA)).schema)
        self.members = self._table("flight_ids", MEMBER_SCHEMA, "bucket", "member")
        self.groups = self._table("flight_id_counts", GROUP_SCHEMA)

    def _table(self, name: str, schema: T.StructType, part: str | None = None, key: str | None = None) -> FileTable:
        return FileTable(self.spark, f"{self.root}/{name}", schema, part, key)

    def tables(self) -> list[FileTable]:
        return [self.flights, *self.parts.values(), self.keyless, self.aside, self.members, self.groups]

    # --- what readers see

    def version(self, number: int | None = None) -> Version:
        """The last version, or a given one, to be passed to the readers below."""
        return self.log.read(number)

    def fact(self, days: Sequence[date | None] | None = None, version: Version | None = None) -> DataFrame:
        """The movement fact: two cheap expressions over the stored movements, so not stored again."""
        return marts.flights_performance(self.movements(days, version))

    def movements(self, days: Sequence[date | None] | None = None, version: Version | None = None) -> DataFrame:
        """The stored movements of some days or all; deliveries without a key are one movement."""
        version = version or self.version()
        keyless = self.keyless.read(version)
        if days is not None:
            known = F.col(DAY).isin([day for day in days if day is not None])
            keyless = keyless.filter(known | F.col(DAY).isNull() if None in days else known)
        return self.flights.read(version, days).unionByName(keyless)

    def _ids(self, kind: str, version: Version) -> DataFrame:
        """Numbers of distinct flight ids per group."""
        keys = MEMBERS[kind].keys
        named = [F.col(f"key_{i + 1}").alias(f"_{key}") for i, key in enumerate(keys)]
        return self.groups.read(version).filter(F.col("kind") == kind).select(
            *named,
            F.col("movements").alias("unique_flights"),
            F.col("departures").alias("total_departures"),
            F.col("arrivals").alias("total_arrivals"),
        )

    def model(self, name: str, version: Version | None = None) -> DataFrame:
        """A model by its name, as of a version; ranks and sums over days are taken when it is read."""
        version = version or self.version()

        def parts(table: str) -> DataFrame:
            return self.parts[table].read(version)

        def fact() -> DataFrame:
            return self.fact(None, version)

        def airports() -> DataFrame:
            raw = self.airports if self.airports is not None else self.spark.createDataFrame([], AIRPORT_SCHEMA)
            return staging.stg_airports(raw)

        def stg_airlines() -> DataFrame:
            ids = self._ids("stg_airlines", version).select(F.col("_airline_code").alias("airline_code"), "unique_flights")
            return staging.stg_airlines_of(parts("stg_airline_parts"), ids)

        def stg_aircraft() -> DataFrame:
            daily = parts("stg_aircraft_parts")
            ends = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("flights").alias("flights")]
            latest = [F.max("extracted").alias("extracted"), F.max("fetched").alias("fetched")]
            return staging.stg_aircraft_of(daily.groupBy(*staging.AIRCRAFT).agg(*ends, *latest))

        def airlines() -> DataFrame:
            return marts.airline_totals_of(parts("airline_parts"), self._ids("airline_totals", version))

        def airport_totals() -> DataFrame:
            return marts.airport_totals_of(parts("airport_parts"), self._ids("airport_totals", version))

        settings = self.settings
        models: dict[str, Callable[[], DataFrame]] = {
            "stg_flights": lambda: self.movements(None, version).drop(staging.DELIVERY_HASH),
            "stg_airports": airports,
            "stg_airlines": stg_airlines,
            "stg_aircraft": stg_aircraft,
            "metricflow_time_spine": lambda: time_spine(self.spark),
            "flights_performance": fact,
            "airline_metrics": lambda: marts.rank_airlines(airlines()),
            "airport_operations": lambda: marts.rank_airports(airport_totals()),
            "delay_analysis": lambda: marts.delays_of(parts("delay_parts")),
            "routes_metrics_daily": lambda: parts("routes_metrics_daily"),
            "routes_metrics": lambda: marts.routes_metrics(parts("routes_metrics_daily"), airports(), settings),
            "public_headline": lambda: public.public_headline(fact(), settings),
            "public_airline_breakdown": lambda: public.public_airline_breakdown(fact(), settings),
            "public_bucket_distribution": lambda: public.public_bucket_distribution(fact(), settings),
            "public_daily_status": lambda: public.public_daily_status(fact(), airports(), settings),
            "public_tops": lambda: public.public_tops(fact(), airports(), settings),
            "public_gates_analysis": lambda: public.gates_of(parts("gate_parts")),
        }
        if name not in models:
            raise KeyError(f"no model {name}; there are {', '.join(models)}")
        return models[name]()

    def stamped_model(self, name: str, version: Version | None = None) -> DataFrame:
        """A model with the load stamp and the descriptions of its columns.

        Rows of models that are stored as they are carry the time their file was written; a model
        that is computed when it is read carries the time it is read.
        """
        version = version or self.version()
        if name == "routes_metrics_daily":
            df = self.parts[name].read(version, stamp=LOAD_STAMP)
        elif name == "stg_flights":
            tables = (self.flights, self.keyless)
            df = reduce(DataFrame.unionByName, [t.read(version, stamp=LOAD_STAMP) for t in tables])
            df = df.drop(staging.DELIVERY_HASH)
        else:
            df = with_load_stamp(self.model(name, version))
        return described(df)

    def high_water(self, version: Version | None = None) -> datetime | None:
        """The newest extraction stamp of any batch so far."""
        text = (version or self.version()).facts.get("high_water")
        return None if text is None else datetime.fromisoformat(text)

    def new_deliveries(self, raw: DataFrame | Landed, lookback: timedelta = timedelta(0)) -> DataFrame:
        """Raw rows extracted since the last batch; all rows if there was none.

        Rows with the last batch's own stamp are read again, as more of them may have
        arrived since, and with ``lookback`` rows that much older; rows delivered twice
        change nothing. Of a ``Landed`` table only the files that hold such rows are opened.
        """
        mark = self.high_water()
        if isinstance(raw, Landed):
            return raw.deliveries() if mark is None else raw.since(mark - lookback)
        return raw if mark is None else raw.filter(F.col("_sdc_extracted_at") >= F.lit(mark - lookback))

    def unkeyed(self, batch: int, version: Version | None = None) -> DataFrame:
        """All deliveries of a batch that lack a part of their key, with their documents."""
        own = f"load={batch:09d}-"
        return self.aside.rows([p for p in self.aside.paths(version or self.version()) if p.startswith(own)])

    # --- one batch

    def apply(self, raw: DataFrame, batch: int) -> Version:
        """Merge one batch. Numbers rise; a batch applied before may come again and changes nothing.

        A run that breaks off has changed nothing that readers see. Of two runs at the same time one
        ends in ``versions.Conflict`` and may come again.
        """
        base = self.version()
        if base.batch is not None and batch <= base.batch:
            if self.log.applied(batch):
                return base
            raise ValueError(f"batch {batch} comes after batch {base.batch}")
        load = f"{batch:09d}"
        work = f"{self.root}/_work/{load}-{uuid.uuid4().hex[:12]}"
        try:
            coming = self._written(base, raw, batch, load, work)
            self.log.commit(coming)
        finally:
            discard(self.spark, work)
        return coming

    def _written(self, base: Version, raw: DataFrame, batch: int, load: str, work: str) -> Version:
        """Write all files of a batch; returns the version that will name them."""
        delta = self._kept(staging.latest_movements(raw, self.settings), f"{work}/delta")
        coming = replace(base, number=base.number + 1, batch=batch, lists=dict(base.lists), facts=dict(base.facts))
        changes = self._keep_keyless(base, coming, raw, delta.filter(F.col("flight_sk").isNull()), load)
        keyed = delta.filter(F.col("flight_sk").isNotNull())
        # The days are partitions, so the driver knows them anyway; of keyless versions there are two.
        days = [row[0] for row in keyed.select(DAY).distinct().collect()]
        if changes is not None:
            days += [row[0] for row in changes.select(DAY).distinct().collect() if row[0] not in days]
        met = self._merge(base, coming, keyed, days, load, work)
        changes = met if changes is None else met.unionByName(changes.select(met.columns))
        if days:
            self._refresh(base, coming, days, changes, load, work)
        newest = delta.agg(F.max("_sdc_extracted_at")).first()[0]
        marks = [mark for mark in (self.high_water(base), newest) if mark is not None]
        if marks:
            coming.facts["high_water"] = max(marks).isoformat()
        return coming

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _keep_keyless(
        self, base: Version, coming: Version, raw: DataFrame, arrived: DataFrame, load: str
    ) -> DataFrame | None:
        """Store deliveries without a key; returns what goes (-1) and comes (1) for them, if any came.

        They cannot be told apart: all are set aside as they came, and the newest stands for them
        among the movements, as in a full build.
        """
        if arrived.isEmpty():
            return None
        coming.lists["unkeyed"] = self.aside.added(base, [self.aside.write(staging.keyless_deliveries(raw), load)])
        before = self.keyless.read(base)
        newest = before.unionByName(arrived).orderBy(*staging.newest_delivery_first()).limit(1)
        coming.lists["keyless"] = self.keyless.replaced(self.keyless.write(newest, load))
        after = self.keyless.read(coming)
        return _signed(before, -1, DAY).unionByName(_signed(after, 1, DAY))

    def _merge(self, base: Version, coming: Version, delta: DataFrame, days: list[date], load: str, work: str) -> DataFrame:
        """Store the movements that are newer than what they meet; returns what goes and what comes."""
        near = self.flights.holding(base, delta, days) if days else []
        order = F.struct(*ORDER_COLUMNS)
        arriving = delta.select("flight_sk", order.alias("_arriving"))
        stored = self.flights.rows(near, "_file").select("flight_sk", *COUNTED_COLUMNS, "_file", order.alias("_stored"))
        stale = (F.col("_stored") >= F.col("_arriving")).alias("_stale")
        met = stored.join(arriving, "flight_sk").select("flight_sk", *COUNTED_COLUMNS, "_file", stale)
        met = self._kept(met, f"{work}/met")
        gone = sorted(row[0] for row in met.filter("NOT _stale").select("_file").distinct().collect())
        newer = delta.join(met.filter("_stale"), "flight_sk", "left_anti")
        # Rows of the rewritten files that stay; other files of the days are left as they are.
        kept = self.flights.rows(gone).join(newer.select("flight_sk"), "flight_sk", "left_anti")
        folder = self.flights.write(kept.unionByName(newer), load)
        coming.lists["stg_flights"] = self.flights.added(base, [folder], gone)
        return _signed(newer, 1).unionByName(_signed(met.filter("NOT _stale"), -1))

    def _refresh(self, base: Version, coming: Version, days: list[date], changes: DataFrame, load: str, work: str) -> None:
        """What models add up from, for the days of the batch; the tables do not depend on each other."""
        fact, flights = self.fact(days, coming), self.movements(days, coming)

        def parts(name: str) -> None:
            table = self.parts[name]
            folder = table.write(PARTS[name].build(fact if PARTS[name].of_fact else flights), load)
            coming.lists[name] = table.added(base, [folder], parts=days)

        wanted = [name for name in PARTS if PARTS[name].model in self.maintained]
        with ThreadPoolExecutor(len(wanted) + 1) as pool:
            running = [pool.submit(parts, name) for name in wanted]
            running.append(pool.submit(self._count_ids, base, coming, changes, load, work))
        for one in running:
            one.result()

    # --- distinct flight ids

    def _count_ids(self, base: Version, coming: Version, changes: DataFrame, load: str, work: str) -> None:
        kinds = [kind for kind in MEMBERS if kind in self.maintained]
        if not kinds:
            return
        delta = self._kept(_member_changes(changes, kinds), f"{work}/members")
        near = self.members.holding(base, delta)
        old = self.members.rows(near, "_file")
        before = [F.col(name).alias(f"_{name}") for name in COUNTS]
        touched = self._kept(
            delta.join(old.select("member", *before, "_file"), "member", "left").withColumns(
                {f"_{name}": F.coalesce(f"_{name}", F.lit(0)) for name in COUNTS}
            ),
            f"{work}/touched",
        )
        gone = sorted(row[0] for row in touched.filter("_file IS NOT NULL").select("_file").distinct().collect())
        now = {name: F.col(name) + F.col(f"_{name}") for name in COUNTS}
        fresh = touched.withColumns(now).filter("movements > 0").select(MEMBER_SCHEMA.names)
        kept = self.members.rows(gone).join(delta.select("member"), "member", "left_anti")
        folder = self.members.write(kept.unionByName(fresh), load)
        coming.lists["flight_ids"] = self.members.added(base, [folder], gone)

        # An id counts in its group while any movement has it.
        steps = [
            (((now[name] > 0).cast("long")) - (F.col(f"_{name}") > 0).cast("long")).alias(name) for name in COUNTS
        ]
        moved = touched.select("kind", "key_1", "key_2", *steps)
        counts = self.groups.read(base).unionByName(moved).groupBy("kind", "key_1", "key_2")
        counts = counts.agg(*[F.sum(name).alias(name) for name in COUNTS]).filter("movements > 0")
        coming.lists["flight_id_counts"] = self.groups.replaced(self.groups.write(counts, load))

    # --- upkeep

    def compact(self, days: Sequence[date | None]) -> Version:
        """Write the movements of some days into fresh files, as few as their size asks for."""
        base = self.version()
        coming = replace(base, number=base.number + 1, lists=dict(base.lists))
        old = self.flights.paths(base, days)
        folder = self.flights.write(self.flights.rows(old), f"{base.batch or 0:09d}")
        coming.lists["stg_flights"] = self.flights.added(base, [folder], old)
        self.log.commit(coming)
        return coming

    def drop_old(self, kept: int) -> int:
        """Delete all files but those of the last ``kept`` versions, and those versions' forerunners.

        To be called when no reader holds an older version and no batch is being written.
        """
        numbers = self.log.numbers()
        versions = [self.log.read(number) for number in numbers[-kept:]]
        # The numbers of applied batches stay known.
        return sum(table.drop_unused(versions) for table in self.tables())


def _signed(rows: DataFrame, sign: int, *more: str) -> DataFrame:
    return rows.select(*COUNTED_COLUMNS, *more, F.lit(sign).cast("long").alias("sign"))


def _member_changes(changes: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """For each (group, flight id) that a batch touches, by how much its numbers change."""

    def entry(kind: str) -> Column:
        members = MEMBERS[kind]
        keys = [F.col(key) for key in members.keys] + [F.lit(None).cast("string")] * (2 - len(members.keys))
        counts = keys[0].isNotNull()
        if members.of_fact:
            counts = counts & F.coalesce(marts.in_fact(), F.lit(False))
        return F.when(counts, F.struct(F.lit(kind).alias("kind"), keys[0].alias("key_1"), keys[1].alias("key_2")))

    departs, arrives = (F.coalesce(side, F.lit(False)).cast("long") for side in (rules.departs(), rules.arrives()))
    rows = changes.filter(F.col("flight_id").isNotNull()).select(
        F.explode(F.array(*[entry(kind) for kind in kinds])).alias("of"),
        "flight_id",
        F.col("sign").alias("movements"),
        (F.col("sign") * departs).alias("departures"),
        (F.col("sign") * arrives).alias("arrivals"),
    )
    rows = rows.filter("of IS NOT NULL").select("of.*", "flight_id", *COUNTS)
    sums = rows.groupBy("kind", "key_1", "key_2", "flight_id").agg(*[F.sum(name).alias(name) for name in COUNTS])
    changed = sums.filter(" OR ".join(f"{name} <> 0" for name in COUNTS))
    return changed.select(
        "kind",
        "key_1",
        "key_2",
        # One text per (group, id), NULLs told apart from texts.
        F.to_json(F.struct("kind", "key_1", "key_2", "flight_id")).alias("member"),
        *COUNTS,
        F.pmod(F.xxhash64("kind", "key_1", "key_2"), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
