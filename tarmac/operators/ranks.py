"""Ranks over a whole table, without one task that sorts all of it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import durable


@dataclass(frozen=True)
class Descending:
    """The largest value first and NULL last."""

    value: Column


def descending(value: Column) -> Descending:
    return Descending(value)


def add_ranks(df: DataFrame, ranks: dict[str, Column | Descending]) -> DataFrame:
    """Add a rank column per entry; equal values share a rank, gaps follow.

    ``ranks`` maps the new column to the value to rank by, of any type that sorts:
    smallest first and NULL before all, or ``descending(value)``. Values are compared in
    their own type, so whole numbers of any size stay apart.

    All ranks are taken in one pass. The rows are written once with their values; the distinct
    values of all ranks are counted together and written in ranges, each of which knows how many
    rows lie in the ranges below. So a value that most rows share costs one row, no task sees all
    values, and the plan grows by a few expressions per rank. Both copies are made when this is called.
    """
    if not ranks:
        return df
    values = {name: r.value if isinstance(r, Descending) else r for name, r in ranks.items()}
    columns = {name: f"_value{i}" for i, name in enumerate(ranks)}
    number = F.monotonically_increasing_id().alias("_number")
    rows = df.select("*", *[values[n].alias(c) for n, c in columns.items()], number)
    # Written, so both readers below see the same numbers.
    rows = durable(rows, "ranked-rows")
    slots = _slots(rows, list(columns.values()))
    long = _unpivoted(rows, list(columns.values()), slots)
    positions = _positions(long, list(dict.fromkeys(slots.values())))
    turned = [isinstance(r, Descending) for r in ranks.values()]
    down = F.col("_total") - F.col("_below") - F.col("_rows") + 1
    position = F.when(F.array(*map(F.lit, turned))[F.col("_rank")], down).otherwise(F.col("_below") + 1)
    per_row = _matched(long, positions.withColumn("_position", position.cast("long")), slots)
    found = per_row.groupBy(F.col("_number").alias("_of")).agg(
        *[F.max(F.when(F.col("_rank") == i, F.col("_position"))).alias(n) for i, n in enumerate(ranks)]
    )
    kept = [rows[name] for name in df.columns if name not in ranks]
    return rows.join(found, rows["_number"] == found["_of"]).select(*kept, *[found[n] for n in ranks])


def _slots(rows: DataFrame, columns: list[str]) -> dict[str, str]:
    """For each value column the slot that holds it: one slot per type."""
    types = {name: rows.schema[name].dataType.simpleString() for name in columns}
    names = {kind: f"_slot{i}" for i, kind in enumerate(dict.fromkeys(types.values()))}
    return {name: names[kind] for name, kind in types.items()}


def _unpivoted(rows: DataFrame, columns: list[str], slots: dict[str, str]) -> DataFrame:
    """One row per row and rank: the row's number, the rank's number, the value in the slot of its type."""
    kinds = {slots[name]: rows.schema[name].dataType for name in columns}

    def entry(i: int, name: str) -> Column:
        held = [F.col(name) if slot == slots[name] else F.lit(None).cast(kind) for slot, kind in kinds.items()]
        return F.struct(F.lit(i).alias("_rank"), *[v.alias(slot) for v, slot in zip(held, kinds)])

    entries = F.explode(F.array(*[entry(i, name) for i, name in enumerate(columns)])).alias("_entry")
    return rows.select("_number", entries).select("_number", "_entry.*")


def _positions(long: DataFrame, slots: list[str]) -> DataFrame:
    """Per distinct value of a rank: its rows, the rows below it, and all rows."""
    values = long.groupBy("_rank", *slots).agg(F.count("*").alias("_rows"))
    ranges = values.repartitionByRange("_rank", *slots).withColumn("_range", F.spark_partition_id())
    # Ranges are what one run of the sort made of them; written, every reader sees the same.
    ranges = durable(ranges, "ranked-values")
    lower = Window.partitionBy("_rank").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.groupBy("_rank", "_range").agg(F.sum("_rows").alias("_inside"))
    before = inside.select(
        "_rank",
        "_range",
        F.coalesce(F.sum("_inside").over(lower), F.lit(0)).alias("_before"),
        F.sum("_inside").over(Window.partitionBy("_rank")).alias("_total"),
    )
    smaller = Window.partitionBy("_rank", "_range").orderBy(*slots).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.join(before, ["_rank", "_range"]).select(
        "_rank",
        *slots,
        "_rows",
        "_total",
        (F.col("_before") + F.coalesce(F.sum("_rows").over(smaller), F.lit(0))).alias("_below"),
    )


def _matched(long: DataFrame, positions: DataFrame, slots: dict[str, str]) -> DataFrame:
    names = list(dict.fromkeys(slots.values()))
    right = positions.select(F.col("_rank").alias("_r"), *[F.col(n).alias(f"_r{n}") for n in names], "_position")
    same = [long["_rank"] == right["_r"], *[long[n].eqNullSafe(right[f"_r{n}"]) for n in names]]
    return long.join(right, reduce(and_, same)).select("_number", "_rank", "_position")
