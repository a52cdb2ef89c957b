"""One row per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last day of the published spine.
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 31)


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("date_day")


def time_spine(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """All days from ``first`` to ``last``, both included."""
    return spark.range(1).select(_days(F.lit(first), F.lit(last)))


def spine_of(df: DataFrame, day: str) -> DataFrame:
    """All days between the first and the last one in ``df``."""
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.filter(F.col("first").isNotNull()).select(_days(F.col("first"), F.col("last")))
