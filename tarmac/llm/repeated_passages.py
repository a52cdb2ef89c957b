"""Substring dedup: a count-min sketch keeps unrepeated windows out of the exact pass.

A window is 13 neighbouring words of one text. A word goes if a window over it has the
same words as a window of a text with a smaller id.

1. Every window is filed under the smallest hash of the runs of five words in it. Equal
   windows are filed alike, and neighbouring windows mostly share their run, so one text
   enters few of them. Each task counts, in a sparse count-min sketch, how many texts
   enter a run; the sketches are added up shard by shard into one of fixed size, whose
   counts are never too low. A window occurs in no more texts than its run.
2. Only windows whose run is estimated in two texts or more are grouped, by a 96-bit hash
   of their words, to find the smallest id. Counts end at 15: windows below that are in
   fewer than 15 texts, so their groups are small and see one shuffle with a window
   function. Windows that may be in more are first reduced to their smallest id, task by
   task, and then joined back in a join whose hot keys Spark splits.
3. The places found go back to their texts, which are cut.

The sketch has a fixed size whatever the corpus: where a corpus outgrows it, more
windows reach the exact pass, and the result stays the same. Near 30 GB of text it is
saturated, and nearly all windows do.

Defined results: a NULL or empty text has no words; a text of fewer than 13 words keeps
all; rows with a NULL id neither lose words nor make others lose any; rows with equal
ids never make each other lose words, and each is judged by its own text; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import durable
from tarmac.llm.common import id_and_text
from tarmac.llm.word_blocks import Words, blocks

WINDOW = 13
RUN = 5
# Two rows of 2**SKETCH_BITS counters of four bits: 64 MB in all, broadcast to the executors.
SKETCH_BITS = 26
SHARD_BITS = 20
FULL = 15
_FIRST, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_SALT = 77


def run_of_windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each place the smallest run hash of its window, and whether a window fits there."""
    runs, _ = words.windows(RUN)
    n, reach = len(runs), WINDOW - RUN + 1
    smallest = runs.copy()
    width = 1
    while width < reach:
        step = min(width, reach - width)
        smallest[: n - step] = np.minimum(smallest[: n - step], smallest[step:])
        width += step
    fits = np.arange(n) + WINDOW <= np.repeat(words.bounds[1:], words.counts())
    return smallest, fits


def cells(runs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The counter of each run in the two rows of the sketch."""
    # Smallest hashes are small numbers: multiplied, they spread over all counters.
    down = np.uint64(64 - bits)
    return ((runs * _FIRST) >> down).astype(np.int64), ((runs * _SECOND) >> down).astype(np.int64) + (1 << bits)


def _entered(words: Words) -> np.ndarray:
    """The runs that texts enter, once per text."""
    runs, fits = run_of_windows(words)
    row = np.repeat(np.arange(len(words.bounds) - 1), words.counts())[fits]
    runs = runs[fits]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (row[1:] != row[:-1])
    row, runs = row[new], runs[new]
    order = np.lexsort((runs, row))
    row, runs = row[order], runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (row[1:] != row[:-1])
    return runs[new]


def _partial_sketches(bits: int):
    """Sparse counts of a task, by shard: gaps between counters in use, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            used, times = np.unique(np.concatenate(found), return_counts=True)
            times = np.minimum(times, FULL).astype(np.uint8)
            shard = used >> SHARD_BITS
            starts = np.flatnonzero(np.diff(shard, prepend=-1))
            rows = []
            for a, b in zip(starts, [*starts[1:], len(used)]):
                gaps = np.diff(used[a:b] & ((1 << SHARD_BITS) - 1), prepend=0).astype(np.uint32)
                rows.append((int(shard[a]), zlib.compress(gaps.tobytes(), 1), zlib.compress(times[a:b].tobytes(), 1)))
            found.clear()
            names = ["shard", "gaps", "times"]
            return pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), _PARTIAL)

        for batch in batches:
            for _, words in blocks(batch.column(0)):
                runs = _entered(words)
                if len(runs):
                    found.extend(cells(runs, bits))
                    waiting += len(runs)
            if waiting > 1_000_000:
                yield flush()
                waiting = 0
        if found:
            yield flush()

    return count


_PARTIAL = pa.schema([("shard", pa.int32()), ("gaps", pa.binary()), ("times", pa.binary())])
_MERGED = pa.schema([("shard", pa.int32()), ("packed", pa.binary())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up partial sketches, a shard at a time in memory as full counters, and packs two to a byte."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, gaps, times in zip(*(c.to_pylist() for c in batch.columns)):
            total = sums.setdefault(shard, np.zeros(1 << SHARD_BITS, np.uint8))
            at = np.cumsum(np.frombuffer(zlib.decompress(gaps), np.uint32), dtype=np.int64)
            total[at] = np.minimum(total[at] + np.frombuffer(zlib.decompress(times), np.uint8), FULL)
    for shard, total in sums.items():
        packed = (total[::2] | total[1::2] << 4).tobytes()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "packed": [packed]}, _MERGED)


def sketch(texts: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """The merged sketch of all texts; its size depends on ``bits`` alone."""
    partial = texts.select("text").mapInArrow(_partial_sketches(bits), "shard int, gaps binary, times binary")
    merged = partial.repartition(F.col("shard")).mapInArrow(_merge, "shard int, packed binary")
    out = np.zeros(1 << bits, np.uint8)
    size = 1 << (SHARD_BITS - 1)
    for row in merged.toLocalIterator():
        out[row["shard"] * size : (row["shard"] + 1) * size] = np.frombuffer(row["packed"], np.uint8)
    return out


def estimates(counts: np.ndarray, runs: np.ndarray, bits: int) -> np.ndarray:
    first, second = ((counts[c >> 1] >> ((c & 1) << 2).astype(np.uint8)) & FULL for c in cells(runs, bits))
    return np.minimum(first, second)


_FOUND = pa.schema(
    [("w", pa.int64()), ("v", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64())]
)


def _candidates(counts, bits: int, heavy: bool):
    """Windows estimated repeated: once per text and window, with the place where it first occurs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = counts.value
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, words in blocks(batch.column(2)):
                runs, fits = run_of_windows(words)
                times = estimates(sums, runs, bits)
                at = np.flatnonzero(fits & (times >= FULL if heavy else (times >= 2) & (times < FULL)))
                if not len(at):
                    continue
                row = np.searchsorted(words.bounds, at, side="right") - 1
                w = words.runs(at, at + WINDOW).view(np.int64)
                v = words.runs(at, at + WINDOW, _SALT).astype(np.uint32).view(np.int32)
                order = np.lexsort((at, v, w, row))
                row, w, v, at = row[order], w[order], v[order], at[order]
                new = np.ones(len(w), bool)
                new[1:] = (row[1:] != row[:-1]) | (w[1:] != w[:-1]) | (v[1:] != v[:-1])
                row, w, v, at = row[new], w[new], v[new], at[new]
                place = at - words.bounds[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(v), pa.array(ids[first + row]), pa.array(tags[first + row] << 32 | place)],
                    schema=_FOUND,
                )

    return emit


def _tag() -> F.Column:
    """31 bits of the text, to tell rows with equal ids apart."""
    return F.shiftrightunsigned(F.xxhash64("text"), 33)


def repeats(texts: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, mark): first places of the windows that also begin in a text with a smaller id."""
    known = texts.where(F.col("doc_id").isNotNull())
    counts = known.sparkSession.sparkContext.broadcast(sketch(known, bits))
    read = known.select(F.col("doc_id").cast("long"), _tag().alias("tag"), "text")
    schema = "w long, v int, doc_id long, mark long"
    light = read.mapInArrow(_candidates(counts, bits, False), schema)
    heavy = read.mapInArrow(_candidates(counts, bits, True), schema)
    lowest = F.min("doc_id").over(Window.partitionBy("w", "v"))
    few = light.withColumn("lowest", lowest).where("doc_id > lowest")
    # Written out, so that the join below meets two shuffled sides and can split hot keys.
    lows = heavy.groupBy("w", "v").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
    lows = durable(lows.where("lowest < highest").select("w", "v", "lowest"), "lowest")
    many = heavy.join(lows, ["w", "v"]).where("doc_id > lowest")
    return few.select("doc_id", "mark").unionByName(many.select("doc_id", "mark"))


_CUT = pa.struct([("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])


def _cut(text: pa.Array, tag: pa.Array, marks: pa.Array) -> pa.Array:
    out = []
    tags, marks = tag.to_numpy(), marks.to_pylist()
    for first, words in blocks(text):
        window = fits = None
        for i in range(len(words.bounds) - 1):
            a, b = words.bounds[i], words.bounds[i + 1]
            mine = words.blob
            spans = zip(words.begins[a:b].tolist(), words.ends[a:b].tolist())
            gone = np.zeros(b - a, bool)
            places = [m & 0xFFFFFFFF for m in marks[first + i] or () if m >> 32 == tags[first + i]]
            if places:
                if window is None:
                    window, fits = words.windows(WINDOW)
                # The same windows may stand at further places of this text.
                same = np.flatnonzero(np.isin(window[a:b], window[a:b][places]) & fits[a:b])
                change = np.zeros(b - a + 1, np.int64)
                change[same] += 1
                change[same + WINDOW] -= 1
                gone = np.cumsum(change[:-1]) > 0
            kept = b" ".join(mine[s:e].tobytes() for (s, e), g in zip(spans, gone.tolist()) if not g)
            out.append({"kept": kept.decode(), "n_words": int(b - a), "n_removed": int(gone.sum())})
    return pa.array(out, _CUT)


def remove_repeats(docs: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) per row of ``docs``; ``kept`` has the words left, joined by one space."""
    texts = id_and_text(docs)
    marks = repeats(texts, bits).groupBy("doc_id").agg(F.collect_list("mark").alias("marks"))
    marks = marks.withColumnRenamed("doc_id", "_id")
    tagged = texts.withColumn("tag", _tag())
    joined = tagged.join(marks, tagged["doc_id"].cast("long") == marks["_id"], "left")
    cutter = F.arrow_udf(_cut, "struct<kept:string,n_words:long,n_removed:long>")
    cut = joined.select("doc_id", cutter("text", "tag", "marks").alias("cut"))
    return cut.select("doc_id", "cut.kept", "cut.n_words", "cut.n_removed")
