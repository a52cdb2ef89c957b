"""Keep the newest version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key, the first in the given order; NULL is a key like any other.

    Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key with very many copies does not pile up in the
    task that owns it.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
