"""Mixing sources to target weights: rates from token sums, whole copies plus one drawn copy.

Every source gets a share of a common budget by its weight, at most ``cap``
times what it holds; what a capped source cannot take is shared among the
others by weight, until none is above its cap. With the sources in the order of
their cap per weight, the level (budget per weight) that solves this is the
largest of ``(budget - caps of the sources before) / weights from here on``, so
one ordered pass over the table of sources finds it. A document of a source
with rate ``target / size`` is then emitted ``floor(rate)`` times, plus once
more if a number drawn from a hash of its id falls below the fraction.

Documents are summed per source before anything is shuffled, so a hot source
costs one row per task. The table of sources (one row per distinct source) is
written out; it is joined back by broadcast only while its size on disk is
below Spark's threshold, else by a shuffle join that splits hot sources.

Defined results: NULL or empty text has size 0; a NULL source is a source of
its own, last in order; a source without words has target 0 and its documents
are emitted once, at no cost; NULL ids share one draw; repeated rows draw
alike, as the draw depends on the id only; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import durable
from tarmac.llm.common import fresh, uniform, words

WEIGHTS = (1, 2, 3)
CAP = 3.0
SEED = "mix"


def text_size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """From (source, source_size): the same with ``target``. Sources are ordered by code point."""
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    weighed = sizes.withColumn("_weight", weight).withColumn("_cap", cap * F.col("source_size"))
    by_need = Window.partitionBy().orderBy(
        F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()
    )
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything).cast("double")
        - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(onward)
    return (
        weighed.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("_cap"), F.col("_weight") * F.col("_level")).alias("target"),
        )
    )


def copies(rate: Column, seed: str, doc_id: Column) -> Column:
    """Whole copies, plus one with the fraction of the rate as its probability."""
    whole_part = F.floor(rate)
    return (whole_part + (uniform(seed, doc_id) < rate - whole_part).cast("long")).cast("long")


def plan(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: float = CAP,
    seed: str = SEED,
) -> DataFrame:
    """From (doc_id, source, size, ...): the same with source_size, target and copies."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = durable(targets(sums, weights, cap), "sources").withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    return (
        sized.join(table, sized["source"].eqNullSafe(table["_source"]))
        .drop("_source")
        .withColumn("copies", copies(rate, seed, F.col("doc_id")))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, with the same columns."""
    kept = fresh(docs, "_row")
    sized = docs.select(
        "doc_id", "source", text_size(F.col("text")).alias("size"), F.struct(*docs.columns).alias(kept)
    )
    taken = plan(sized, **options).where("copies > 0")
    repeated = taken.select(kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_n"))
    return repeated.select(*[F.col(kept)[c].alias(c) for c in docs.columns])
