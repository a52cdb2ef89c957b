"""Document fingerprints: I-Match over randomised lexicon subsets.

The lexicon holds the terms whose document frequency lies in a band: terms of nearly all
texts say nothing, terms of a few texts do not survive an edit. Of a text only the
distinct terms of the lexicon count, sorted; each of several random subsets of the
lexicon keeps some of them, and each subset's terms are hashed. An edit changes the hash of
those subsets only that hold a changed term.

How much of the lexicon a subset keeps follows the number n of the text's terms: at level l
it keeps a share of 2**-l, and a text is hashed at the two levels next to log2(n), about
one term to a subset. Two texts compare at the levels they share; texts of very
different size share none. Likeness is the share of equal hashes among the subsets
that either text has terms in.

A term is the 32-bit hash of a lower-cased word. Its document frequency is exact: every task
counts its own texts, and counts are added up by ranges of terms. The lexicon is bounded
whatever the corpus: n texts with d distinct terms on average have at most d / low terms
of frequency ``low * n`` or more, so it is collected and broadcast.

For the edited texts, every text needs the one that follows it. Texts are dealt by ranges of ids,
each range also getting the text behind its end, sorted, and read as a stream.

Defined results: a NULL or empty text is empty; a text with fewer than 4 lexicon terms is
fingerprinted by all its terms (none: by the empty set); likeness of equal fingerprints
is 1; NULL ids come first; rows with equal ids follow each other by a hash of the text;
repeated rows are documents of their own; a single row follows itself; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text
from tarmac.llm.word_blocks import blocks

LOW, HIGH = 0.001, 0.1
SUBSETS = 32
FEWEST = 4
SHARD_BITS = 8

_RANDOM = np.random.default_rng(11)
_PICK = (_RANDOM.integers(0, 1 << 31, SUBSETS) * 2 + 1).astype(np.uint32)
_HASH = (_RANDOM.integers(0, 1 << 31, SUBSETS) * 2 + 1).astype(np.uint32)


def terms(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct terms of each text, sorted."""
    for _, words in blocks(column, fold=True):
        short = (words.hashes >> np.uint64(32)).astype(np.uint32)
        for a, b in zip(words.bounds[:-1], words.bounds[1:]):
            yield np.unique(short[a:b])


_COUNTS = pa.schema([("shard", pa.int32()), ("gaps", pa.binary()), ("times", pa.binary())])


def _local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies in one task: by range of terms, the gaps between terms and their counts."""
    found: list[np.ndarray] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        used, times = np.unique(np.concatenate(found), return_counts=True)
        found.clear()
        shard = used >> np.uint32(32 - SHARD_BITS)
        starts = np.flatnonzero(np.diff(shard.astype(np.int64), prepend=-1))
        rows = []
        for a, b in zip(starts, [*starts[1:], len(used)]):
            gaps = np.diff(used[a:b], prepend=used[a : a + 1]).astype(np.uint32)
            gaps[0] = used[a]
            rows.append(
                (int(shard[a]), zlib.compress(gaps.tobytes(), 1), zlib.compress(times[a:b].astype(np.uint32).tobytes(), 1))
            )
        return pa.RecordBatch.from_pydict(dict(zip(_COUNTS.names, zip(*rows))), _COUNTS)

    for batch in batches:
        for each in terms(batch.column(0)):
            if len(each):
                found.append(each)
                waiting += len(each)
        if waiting > 8_000_000:
            yield flush()
            waiting = 0
    if found:
        yield flush()


def _in_band(least: float, most: float):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for shard, gaps, times in zip(*(c.to_pylist() for c in batch.columns)):
                used = np.cumsum(np.frombuffer(zlib.decompress(gaps), np.uint32), dtype=np.uint32)
                count = np.frombuffer(zlib.decompress(times), np.uint32).astype(np.int64)
                if shard in sums:
                    old, had = sums[shard]
                    both, place = np.unique(np.concatenate([old, used]), return_inverse=True)
                    count = np.bincount(place, np.concatenate([had, count])).astype(np.int64)
                    used = both
                sums[shard] = used, count
        for used, count in sums.values():
            kept = used[(count >= least) & (count <= most)].astype(np.int64)
            yield pa.RecordBatch.from_pydict({"term": kept}, pa.schema([("term", pa.int64())]))

    return add


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """The terms of the band, sorted. Terms of a single text never count."""
    n = docs.count()
    counts = id_and_text(docs).select("text").mapInArrow(_local_counts, "shard int, gaps binary, times binary")
    band = counts.repartition(F.col("shard")).mapInArrow(_in_band(max(2, low * n), high * n), "term long")
    return np.sort(np.array([r["term"] for r in band.toLocalIterator()], np.int64).astype(np.uint32))


def fingerprint(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Level, then the subset hashes of two levels; 0 where a subset has none of the terms."""
    at = np.searchsorted(known, found)
    inside = found[known[np.minimum(at, len(known) - 1)] == found] if len(known) else found[:0]
    if len(inside) < FEWEST:
        inside = found
    n = len(inside)
    level = max(n, 1).bit_length() - 1
    out = np.zeros(1 + 2 * SUBSETS, np.uint16)
    out[0] = level
    if n:
        draw = _spread(_PICK[:, None] * inside[None, :] + _HASH[:, None])
        code = _spread(_HASH[:, None] * inside[None, :] + _PICK[:, None])
        for k in range(2):
            kept = draw <= np.uint32(0xFFFFFFFF >> (level + k))
            sums = np.where(kept, code, 0).sum(axis=1, dtype=np.uint32)
            hashed = (_spread(sums) >> np.uint32(16)).astype(np.uint16)
            out[1 + k * SUBSETS : 1 + (k + 1) * SUBSETS] = np.where(kept.any(axis=1), np.maximum(hashed, 1), 0)
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal subset hashes at the levels both have, among subsets that either has terms in."""
    if np.array_equal(a, b):
        return 1.0
    shift = int(b[0]) - int(a[0])
    if abs(shift) > 1:
        return 0.0
    x = a[1 + max(shift, 0) * SUBSETS : len(a) + min(shift, 0) * SUBSETS]
    y = b[1 + max(-shift, 0) * SUBSETS : len(b) + min(-shift, 0) * SUBSETS]
    either = (x > 0) | (y > 0)
    return float(((x == y) & either).sum() / either.sum()) if either.any() else 0.0


def spelled(print_: np.ndarray) -> str:
    return print_.astype(">u2").tobytes().hex()


_ORDER = "_range int, _guest boolean, doc_id long, text string"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _stream(known):
    """Fingerprints of sorted texts; each is held until the one behind it is seen."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def finish(rows: list[tuple]) -> pa.RecordBatch:
            pairs = [
                (a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]
            ]
            texts = [a[3] for a, _ in pairs]
            edited = [
                t[: len(t) - len(t) // 4] + b[3][: len(t) // 4] for t, (_, b) in zip(texts, pairs)
            ]
            behind = [b[3] for _, b in pairs]
            # The text behind is mostly the next pair's own.
            unique = list(dict.fromkeys([*texts, *behind]))
            known_terms = known.value
            prints = dict(zip(unique, (fingerprint(t, known_terms) for t in terms(pa.array(unique, pa.string())))))
            changed = [fingerprint(t, known_terms) for t in terms(pa.array(edited, pa.string()))]
            columns = [
                [a[2] for a, _ in pairs],
                [len(t) for t in texts],
                [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                [spelled(prints[t]) for t in texts],
                [spelled(c) for c in changed],
                [likeness(prints[t], c) for t, c in zip(texts, changed)],
                [likeness(prints[t], prints[b]) for t, b in zip(texts, behind)],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

        for batch in batches:
            rows = held + list(zip(*(c.to_pylist() for c in batch.columns)))
            held = rows[-1:]
            if len(rows) > 1:
                yield finish(rows)

    return read


def _ranges(docs: DataFrame, parts: int) -> tuple[DataFrame, list]:
    """``docs`` with the number of its range of ids; the ranges hold about as many rows each."""
    shares = [i / parts for i in range(1, parts)]
    found = docs.select(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10_000)).first()[0] if shares else []
    bounds = sorted(set(found or []))
    # Two short searches instead of one through all bounds.
    step = max(1, int(len(bounds) ** 0.5))
    coarse, rest = bounds[step - 1 :: step], bounds

    def listed(values: list) -> F.Column:
        return F.expr(f"CAST(array({', '.join(f'{int(v)}L' for v in values)}) AS array<bigint>)")

    skipped = F.size(F.filter(listed(coarse), lambda b: b <= F.col("doc_id"))) * step
    inner = F.size(F.filter(F.slice(listed(rest), skipped + 1, F.lit(step)), lambda b: b <= F.col("doc_id")))
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(skipped + inner) if bounds else F.lit(0)
    return docs.withColumn("_range", number.cast("int")), bounds


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row of ``docs``: length, fingerprint, that of the edited text, and likenesses."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(lexicon(docs, low, high))
    read = id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    dealt, _ = _ranges(read, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = F.xxhash64("text").alias("_order")
    # One row per range, so bounded by the number of ranges.
    heads = sorted(
        (r["_range"], r["head"]["doc_id"], r["head"]["_order"])
        for r in dealt.groupBy("_range").agg(F.min(F.struct("doc_id", order)).alias("head")).collect()
    )
    if not heads:
        return spark.createDataFrame([], _spark_schema())
    before = [heads[-1][0], *[h[0] for h in heads[:-1]]]
    guests = spark.createDataFrame(
        [(h[1], h[2], b) for h, b in zip(heads, before)], "_id long, _head long, _to int"
    )
    visits = dealt.withColumn("_order", order).join(
        F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_order") == F.col("_head")), "left"
    )
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    visit = F.when(
        F.col("_to").isNotNull(), F.array(own, F.struct(F.col("_to").alias("r"), F.lit(True).alias("g")))
    ).otherwise(F.array(own))
    rows = visits.select("doc_id", "text", "_order", F.explode(visit).alias("_v"))
    sorted_rows = (
        rows.select(F.col("_v.r").alias("_range"), F.col("_v.g").alias("_guest"), "doc_id", "_order", "text")
        .repartition(F.col("_range"))
        .sortWithinPartitions("_range", "_guest", "doc_id", "_order")
        .select("_range", "_guest", "doc_id", "text")
    )
    return sorted_rows.mapInArrow(_stream(known), _spark_schema())


def _spark_schema() -> str:
    return (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
