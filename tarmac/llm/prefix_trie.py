"""A trie over the turns of conversations, built by recursive halving of their lengths.

The plan is that of van Emde Boas: a trie of height H is an upper trie of height H/2 with one lower
trie below each of its leaves at the cut. Sequences are cut at half depth; equal cut prefixes of one
trie get one name; the upper parts stay in their trie, the lower parts go to the trie that the name
of their prefix stands for, and all tries of a level are cut in the same step. After log2(H) steps each part is a single
turn, and (trie, turn) is a node. Totals take the same way back: the sums of a lower trie's top nodes
are grafted onto all nodes of the upper trie above them, level by level.

* A part's content is compared by its name, a hash of the names of its two halves, made bottom-up
  (128 bits of SHA-256 over role and text at the bottom), so texts are hashed once and never move.
* A prefix is named by the smallest conversation that has it, which is what the result reports.
* Equal conversations are counted once at the start and go on as one with a weight.

All state is rows of (conversation, place), so one conversation with very many turns, or very many
conversations with one beginning, spread over tasks like any others; every level is written, and
there are about 3 * log2(longest) of them. The one step that is sequential by nature is the hash
over the ids of equal conversations: it runs over sorted chunks of ``CHUNK`` ids in a stream.

Results in odd cases: rows with a NULL conv_id belong to no conversation and are left out; NULL turns
come first; NULL role or text is empty; equal turn numbers are ordered by the hash of role and text,
and repeated rows are turns of their own. A table without conversations has no nodes. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import durable
from tarmac.llm.common import whole

# Ids that one row of a sorted stream holds.
CHUNK = 1000
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _name(content: Column) -> Column:
    return F.substring(F.unhex(F.sha2(content, 256)), 1, 16)


# --- turns


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), symbol (a hash of role and text), size (bytes of the text).

    Turns are sorted in ranges over the whole table; a range knows how many turns of its first
    conversation lie in earlier ranges, so a conversation of any length is numbered side by side.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        _name(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("symbol"),
        F.octet_length(text).cast("long").alias("size"),
        # Splits repeated rows over ranges, too.
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["turn", "symbol", "tie"]
    ranged = rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    ranged = durable(ranged, "turns")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = before.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)) - 1
    numbered = ranged.withColumn("inside", inside).join(before, ["conv", "part"])
    return numbered.select("conv", (F.col("before") + F.col("inside")).alias("place"), "symbol", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation with its first turns taken from another one.

    Conversation c begins with the first h turns of c - c % 5, where h is the CRC-32 of its number
    modulo 9, and goes on with its own turns after its first h. Returns its turns and its length.
    """
    lengths = durable(turns.groupBy("conv").agg(F.count("*").alias("own")), "lengths")
    c = F.col("conv")
    givers = lengths.select(F.col("conv").alias("giver"), F.col("own").alias("given"))
    plan = lengths.select(
        "conv", "own", (F.crc32(c.cast("string").cast("binary")) % 9).alias("h"), (c - c % 5).alias("source")
    )
    plan = plan.join(givers, F.col("source") == F.col("giver"), "left")
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    plan = plan.select("conv", "h", "source", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    plan = durable(plan, "rebuilding")
    own = turns.join(plan, "conv").filter("place >= h")
    own = own.select("conv", "n", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "symbol", "size")
    heads = turns.filter("place < 8").withColumnRenamed("conv", "giver")
    lent = heads.join(plan, F.col("giver") == F.col("source")).filter("place < taken")
    return own.unionByName(lent.select("conv", "n", "place", "symbol", "size")), plan.select("conv", "n")


# --- naming, bottom-up


def _named_blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For level j the blocks of 2^j places of each conversation longer than half of that.

    Columns: conv, n, block, name, and the names ``left`` and ``right`` of its halves (from level 1).
    """
    blocks = [turns.select("conv", "n", F.col("place").alias("block"), F.col("symbol").alias("name"))]
    for level in range(levels):
        odd = F.col("block") % 2 == 1
        halves = (
            blocks[-1]
            .filter(F.col("n") > (1 << level))
            .groupBy("conv", "n", F.shiftright("block", 1).alias("block"))
            .agg(F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"))
        )
        both = F.concat("left", F.coalesce("right", F.lit(b"")))
        blocks.append(durable(halves.withColumn("name", _name(both)), f"blocks-{level + 1}"))
    return blocks


def _whole_names(blocks: list[DataFrame]) -> DataFrame:
    """The name of each conversation as a whole: that of its only block at its own level."""
    parts = [level.filter(F.col("n") <= (1 << j)).select("conv", "n", "name") for j, level in enumerate(blocks)]
    return reduce(DataFrame.unionByName, parts)


# --- cutting, top-down


def _cut(blocks: list[DataFrame], distinct: DataFrame, root: int) -> DataFrame:
    """For each place of each distinct conversation the name of the prefix before it.

    Columns: conv, n, weight, block (the place), trie (the prefix's smallest conversation), name.
    """

    def beginning(level: int) -> DataFrame:
        shortest = (1 << level) // 2
        own = distinct.filter((F.col("n") > shortest) & (F.col("n") <= (1 << level)))
        return own.select("conv", "n", "weight", F.lit(0).cast("long").alias("block"), F.lit(root).cast("long").alias("trie"), "name")

    front = beginning(len(blocks) - 1)
    for level in range(len(blocks) - 2, -1, -1):
        halves = blocks[level + 1].select("conv", "block", "left", "right")
        upper = front.drop("name").join(halves, ["conv", "block"])
        upper = upper.select("conv", "n", "weight", (F.col("block") * 2).alias("block"), "trie", F.col("left").alias("name"), "right")
        upper = upper.unionByName(beginning(level).withColumn("right", F.lit(None).cast("binary")))
        upper = durable(upper, f"upper-{level}")
        # Prefixes that several conversations share; one that is alone has its own name.
        shared = (
            upper.filter((F.col("block") + 1) * (1 << level) <= F.col("n"))
            .groupBy("trie", "block", "name")
            .agg(F.min("conv").alias("least"), F.count("*").alias("k"))
            .filter("k > 1")
        )
        lower = upper.filter(F.col("right").isNotNull()).join(shared, ["trie", "block", "name"], "left")
        lower = lower.select(
            "conv",
            "n",
            "weight",
            (F.col("block") + 1).alias("block"),
            F.coalesce("least", "conv").alias("trie"),
            F.col("right").alias("name"),
        )
        front = durable(upper.drop("right").unionByName(lower), f"front-{level}")
    return front


# --- totals, grafted upward


def _grafted(values: DataFrame, path: DataFrame, levels: int) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` over the nodes below and including each node.

    ``values``: conv, place, trie (the parent), leaves, saved. After step j a node's sums cover what
    is below it within its block of 2^(j+1) places.
    """
    for level in range(levels):
        tops = values.filter(F.col("place") % (2 << level) == (1 << level))
        grafts = tops.groupBy(
            F.col("trie").alias("at"), (F.shiftright("place", level) - 1).alias("upper")
        ).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        on = (F.col("via") == F.col("at")) & (F.shiftright("place", level) == F.col("upper"))
        more = path.join(grafts, on).groupBy("conv", "place").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
        values = values.join(more, ["conv", "place"], "left").select(
            "conv",
            "place",
            "trie",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        values = durable(values, f"totals-{level}")
    return values


# --- ids of equal conversations


def _id_hashes(distinct: DataFrame, names: DataFrame) -> DataFrame:
    """conv (of ``distinct``) and the hash over the sorted ids of all conversations equal to it."""
    alone = distinct.filter("weight = 1").select("conv", F.sha2(F.col("conv").cast("string"), 256).alias("ends"))
    several = distinct.filter("weight > 1").select(F.col("conv").alias("first"), "n", "name")
    members = names.join(several, ["n", "name"]).select("first", "conv")
    ranged = members.repartitionByRange("first", "conv").withColumn("part", F.spark_partition_id())
    ranged = durable(ranged, "equal-conversations")
    nth = F.row_number().over(Window.partitionBy("first", "part").orderBy("conv"))
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = ranged.withColumn("chunk", F.floor((nth - 1) / CHUNK)).groupBy("first", "part", "chunk").agg(ids.alias("ids"))
    # SHA-256 takes its input in order; sorted chunks pass through, none is kept.
    sorted_chunks = chunks.repartition("first").sortWithinPartitions("first", "part", "chunk").select("first", "ids")
    return alone.unionByName(sorted_chunks.mapInArrow(_hashed_streams, "conv long, ends string"))


def _hashed_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(conv: int, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv": pa.array([conv], pa.int64()), "ends": [digest.hexdigest()]})

    last, digest = None, None
    for batch in batches:
        for conv, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if conv != last:
                if digest:
                    yield row(last, digest)
                last, digest = conv, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if digest:
        yield row(last, digest)


# --- the trie


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the root included."""
    turns, lengths = rebuilt(durable(numbered_turns(conversations), "numbered"))
    turns = durable(turns, "rebuilt")
    # Three numbers: the smallest conversation, the longest and how many there are.
    root, longest, n_all = lengths.agg(F.min("conv"), F.max("n"), F.count("*")).first()
    spark = conversations.sparkSession
    if not n_all:
        kinds = ", ".join(f"{name} {'string' if name == 'ends_sha256' else 'long'}" for name in NODE)
        return spark.createDataFrame([], kinds)
    levels = max(0, longest - 1).bit_length()
    blocks = _named_blocks(turns, levels)
    names = _whole_names(blocks).unionByName(
        lengths.filter("n = 0").select("conv", "n", F.lit(b"").alias("name"))
    )
    distinct = names.groupBy("n", "name").agg(F.min("conv").alias("conv"), F.count("*").alias("weight"))
    distinct = durable(distinct, "distinct")

    places = _cut(blocks, distinct, root).withColumnRenamed("block", "place")
    grouped = places.groupBy("trie", "place", "name").agg(
        F.min("conv").alias("least"), F.sum("weight").alias("n_convs"), F.count("*").alias("k")
    )
    grouped = durable(grouped, "nodes")
    # Which node each distinct conversation passes at each place; alone on it, it is the node's own.
    shared = grouped.filter("k > 1").select("trie", "place", "name", "least")
    path = places.join(shared, ["trie", "place", "name"], "left")
    path = durable(path.select(F.col("conv").alias("via"), "place", F.coalesce("least", "conv").alias("conv")), "path")

    sizes = turns.select(F.col("conv").alias("least"), "place", "size")
    kids = grouped.groupBy(F.col("trie").alias("least"), (F.col("place") - 1).alias("place")).agg(F.count("*").alias("n_children"))
    nodes = grouped.join(sizes, ["least", "place"]).join(kids, ["least", "place"], "left")
    nodes = nodes.select(
        F.col("least").alias("conv"),
        "place",
        "trie",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    nodes = durable(nodes, "measured")
    own = nodes.select("conv", "place", "trie", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    totals = _grafted(own, path, levels)

    hashes = durable(_id_hashes(distinct, names), "ends")
    ending = distinct.filter("n > 0").select(F.col("conv").alias("via"), (F.col("n") - 1).alias("place"))
    ends = ending.join(path, ["via", "place"]).join(hashes.withColumnRenamed("conv", "via"), "via")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    below = nodes.drop("trie", "saved").join(totals, ["conv", "place"]).join(ends.select("conv", "place", "ends"), ["conv", "place"], "left")
    below = below.select(
        F.col("conv").alias("conv_id"),
        (F.col("place") + 1).alias("depth"),
        F.col("trie").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", none).alias("ends_sha256"),
    )
    turnless = distinct.filter("n = 0").join(hashes, "conv").select(F.lit(root).alias("conv_id"), "ends")
    tops = totals.filter("place = 0").agg(
        F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    top = tops.select(
        F.lit(root).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_all).cast("long").alias("n_convs"),
        "n_children",
        # A root without children is a leaf itself.
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
    )
    top = top.join(turnless, "conv_id", "left").withColumn("ends_sha256", F.coalesce("ends", none)).drop("ends")
    return below.unionByName(top)
