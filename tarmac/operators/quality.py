"""Declared checks on models: filled columns, unique keys, unique combinations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Checks:
    """What must hold for one model."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_together: Sequence[Sequence[str]] = ()

    def __len__(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.unique_together)


    def named(self) -> list[tuple[str, list[str]]]:
        """(test, columns) of each check."""
        return [
            *[("not_null", [name]) for name in self.not_null],
            *[("unique", [name]) for name in self.unique],
            *[("unique_combination", list(names)) for names in self.unique_together],
        ]


def _entry(position: int, test: str, columns: Sequence[str]) -> Column:
    """What a row adds to a check: its key, or for ``not_null`` itself if it has no value."""
    filled = reduce(and_, [F.col(name).isNotNull() for name in columns])
    number = F.lit(position).alias("check")
    if test == "not_null":
        return F.when(~filled, F.struct(number, F.lit(None).cast("string").alias("key")))
    # NULLs of a combination are values like any others: the text lacks the field.
    entry = F.struct(number, F.to_json(F.struct(*columns)).alias("key"))
    return F.when(filled, entry) if test == "unique" else entry


def _failures(df: DataFrame, checks: Checks) -> DataFrame:
    """check (its position) and failures, 0 left out: rows without a value, or keys that repeat.

    One scan for all checks of a model: every row goes to each check it matters to, and rows of one
    key of one check meet in a single shuffle, after map tasks have counted their own.
    """
    named = checks.named()
    entries = F.filter(F.array(*[_entry(i, *check) for i, check in enumerate(named)]), lambda e: e.isNotNull())
    keys = df.select(F.explode(entries).alias("e")).select("e.*")
    counted = keys.groupBy("check", "key").agg(F.count("*").alias("n"))
    by_rows = F.col("check") < len(checks.not_null)
    return counted.groupBy("check").agg(
        F.sum(F.when(by_rows, F.col("n")).otherwise((F.col("n") > 1).cast("long"))).alias("failures")
    )


def report(models: dict[str, DataFrame], declared: dict[str, Checks]) -> DataFrame:
    """One row per check: model, test, checked columns, failing rows or keys, and the verdict."""
    schema = "model string, check int, test string, checked string"
    rows, parts = [], []
    for name, df in models.items():
        named = declared[name].named()
        rows += [(name, i, test, ",".join(columns)) for i, (test, columns) in enumerate(named)]
        if named:
            parts.append(_failures(df, declared[name]).withColumn("model", F.lit(name)))
    listed = next(iter(models.values())).sparkSession.createDataFrame(rows, schema)
    found = reduce(DataFrame.unionByName, parts)
    return listed.join(found, ["model", "check"], "left").select(
        "model",
        "test",
        "checked",
        F.coalesce("failures", F.lit(0)).alias("failures"),
        (F.coalesce("failures", F.lit(0)) == 0).alias("passed"),
    )


def failing_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows a ``not_null`` check counts."""
    return df.filter(F.col(column).isNull())
