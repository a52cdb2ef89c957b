"""Connected groups of linked ids, by contraction: each round is two joins over what is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.config import durable


def groups(links: DataFrame) -> DataFrame:
    """From links (a, b): (id, smallest) with the smallest id that each linked id can reach.

    In each round every node moves to the neighbour (or itself) with the smallest hash, drawn
    anew per round, so chains halve whatever the order of the ids. Links between nodes
    that moved to one place vanish. No node's neighbours are ever gathered in a list.
    """
    edges = links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()
    moves: list[DataFrame] = []
    while True:
        # Both directions of a link from one reading of it.
        ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        edges = durable(edges.select(ends.alias("e")).select("e.*"), "links")
        if edges.isEmpty():
            break
        rank = lambda c, n=len(moves): F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.col(c).alias("node"))
        nearest = edges.groupBy("a").agg(F.min(rank("b")).alias("near"))
        moved = durable(
            nearest.select(F.col("a").alias("id"), F.least("near", rank("a"))["node"].alias("to")), "moves"
        )
        moves.append(moved)
        a_to = moved.select(F.col("id").alias("a"), F.col("to").alias("a_to"))
        b_to = moved.select(F.col("id").alias("b"), F.col("to").alias("b_to"))
        edges = (
            edges.join(a_to, "a")
            .join(b_to, "b")
            .where("a_to < b_to")
            .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .distinct()
        )
    if not moves:
        return links.sparkSession.createDataFrame([], "id long, smallest long")

    def through(later: DataFrame, earlier: DataFrame) -> DataFrame:
        """Where the nodes of an earlier round end: where the node they moved to ends, if it moved on."""
        ends = later.select(F.col("id").alias("to"), F.col("to").alias("end"))
        joined = earlier.join(ends, "to", "left")
        return durable(joined.select("id", F.coalesce("end", "to").alias("to")), "ends")

    ends = reduce(through, reversed(moves))
    smallest = durable(ends.groupBy("to").agg(F.min("id").alias("smallest")), "smallest")
    return ends.join(smallest, "to").select("id", "smallest")
