"""Aggregate building blocks shared by marts, dashboard and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def tally(condition: Column) -> Column:
    """Rows where the condition holds; NULL over no rows, like a plain sum."""
    return F.sum(flag(condition))


def share(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def share_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, share(part, whole)).otherwise(F.lit(0.0))


def scaled_share_or_zero(part: Column, whole: Column) -> Column:
    """As ``share_or_zero``, scaling by 100 before the division (last digit differs)."""
    ratio = part.cast("double") * F.lit(100.0) / whole.cast("double")
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def mean(total: Column, count: Column) -> Column:
    """Average from its stored sum and count; NULL over none."""
    return F.try_divide(total.cast("double"), count.cast("double"))
