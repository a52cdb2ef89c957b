"""Phrases of two and three words that occur together more often than their parts would suggest.

1. Texts become blocks of word codes, each with a dictionary of its own, as a column store keeps
   them (``encoded``). A block is a few megabytes of texts of one language.
2. The dictionaries give the counts of all words. Words seen ``least`` times or more get numbers
   without gaps; rarer ones cannot be part of a phrase that is seen so often.
3. Each block gets the numbers of its words, by a join of dictionaries, not of texts. Its pairs
   and triples of numbered words are counted in counting quotient filters (``quotient_filter``), one
   per shard, and the filters of a shard are merged. Only n-grams seen ``least`` times leave this step.
4. Parts are looked up, scores taken in exact decimals, and each language's best phrases kept: first within
   ``SALTS`` parts, then among what these leave.

A word or phrase that makes up any share of the corpus is one entry per filter. Filters of a shard
together hold about ``SHARD_WORDS`` occurrences' worth of entries; the number of shards follows the
number of words. A block's words and numbers are the largest thing one task holds.

Results in odd cases: NULL texts are empty, a NULL lang counts as ``und``; texts without words add
nothing; every row counts, repeated or not; ties in the order are settled by the phrase's bytes. An
empty table has no phrases. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import durable
from tarmac.llm.common import whole
from tarmac.llm.quotient_filter import Shape, counted, merged, sharded

UNKNOWN = "und"
# Bytes of text that share one dictionary, and bytes that a task keeps for all languages.
BLOCK_BYTES = 4 << 20
KEPT_BYTES = 16 << 20
# N-grams a task keeps before it writes filters, and occurrences a shard is made for.
KEPT_GRAMS = 1 << 20
SHARD_WORDS = 1 << 19
SALTS = 64
# The scale of scores.
MILLION = 1_000_000

# A-Z to a-z, the ends of pieces to \n, tab to space.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[list(b".,;:!?\n\x0b\x0c\r")] = 10
_PLAIN[9] = 32

ENCODED = "block long, lang string, word string, code int, n long, codes binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


# --- texts to codes


def _texts_of(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    texts, langs = batch.column("text").cast(pa.string()), batch.column("lang")
    for lang in pc.unique(langs).to_pylist():
        yield lang, texts.filter(pc.equal(langs, lang))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of each word with whether it begins a piece, the words by code, and their counts."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    plain = _PLAIN[np.frombuffer(data, np.uint8)] if data else np.empty(0, np.uint8)
    folded = pa.StringArray.from_buffers(len(texts), pa.py_buffer(at.copy()), pa.py_buffer(plain))
    words = pc.ascii_split_whitespace(pc.split_pattern(folded, "\n").flatten())
    piece, flat = pc.list_parent_indices(words), words.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(full).dictionary_encode()
    piece = piece.filter(full).to_numpy()
    codes = coded.indices.to_numpy()
    begins = np.append(True, piece[1:] != piece[:-1]) if len(piece) else np.empty(0, bool)
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    return codes.astype(np.uint32) << np.uint32(1) | begins.astype(np.uint32), coded.dictionary, counts


def encoded(docs: DataFrame) -> DataFrame:
    """Blocks of codes and their dictionaries in one table.

    A block is one row with ``codes`` (twice the word's code, plus one at the beginning of a piece;
    compressed) and one row per distinct word with ``word``, ``code`` and its count ``n``.
    """
    rows = docs.select(whole(F.col("text")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    schema = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in ENCODED.split(", ")])

    def block(number: int, lang: str, parts: list[pa.Array], pack: zstandard.ZstdCompressor) -> pa.RecordBatch | None:
        codes, words, counts = word_codes(pa.concat_arrays(parts))
        if not len(codes):
            return None
        k = len(words)
        columns = {
            "block": pa.array(np.full(k + 1, number)),
            "lang": pa.array([lang] * (k + 1), pa.string()),
            "word": pa.concat_arrays([pa.nulls(1, pa.string()), words]),
            "code": pa.concat_arrays([pa.nulls(1, pa.int32()), pa.array(np.arange(k, dtype=np.int32))]),
            "n": pa.array(np.concatenate([[len(codes)], counts])),
            "codes": pa.array([pack.compress(codes.tobytes()), *[None] * k], pa.binary()),
        }
        return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        kept, sizes = defaultdict(list), defaultdict(int)
        number = TaskContext.get().partitionId() << 32

        def leave(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            del sizes[lang]
            made = block(number, lang, kept.pop(lang), pack)
            number += 1
            if made:
                yield made

        for batch in batches:
            for lang, texts in _texts_of(batch):
                kept[lang].append(texts)
                sizes[lang] += texts.nbytes
                if sizes[lang] >= BLOCK_BYTES:
                    yield from leave(lang)
            while sum(sizes.values()) >= KEPT_BYTES:
                yield from leave(max(sizes, key=sizes.get))
        for lang in list(kept):
            yield from leave(lang)

    return rows.mapInArrow(encode, ENCODED)


# --- words to numbers


def numbered_words(counts: DataFrame) -> DataFrame:
    """lang, word, f and an id from 1 without gaps; the words' rows stay where they are."""
    placed = durable(counts.withColumn("part", F.spark_partition_id()), "frequent-words")
    lower = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part of the table meets in this window.
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(lower), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))
    numbered = placed.withColumn("nth", nth).join(before, "part")
    return numbered.select("lang", "word", "f", (F.col("before") + F.col("nth")).alias("id"))


# --- counting


def _grams(codes: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Pairs and triples of numbered words within pieces."""
    inside = (codes[1:] & 1) == 0
    word = ids[codes >> np.uint32(1)]
    known = word > 0
    pairs = inside & known[1:] & known[:-1]
    yield 2, [word[:-1][pairs], word[1:][pairs]]
    triples = pairs[1:] & pairs[:-1]
    yield 3, [word[:-2][triples], word[1:-1][triples], word[2:][triples]]


def frequent_grams(blocks: DataFrame, shapes: dict[int, Shape], least: int) -> DataFrame:
    """words, x, y, z, f: pairs (z is 0) and triples of word numbers seen ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        kept, size = {words: ([], []) for words in shapes}, 0

        def leave() -> Iterator[pa.RecordBatch]:
            for words, (lefts, rests) in kept.items():
                if lefts:
                    shape = shapes[words]
                    numbers = shape.permuted(np.concatenate(lefts), np.concatenate(rests))
                    lefts.clear()
                    rests.clear()
                    made = sharded(*counted(*numbers, None, shape), shape)
                    if made:
                        yield pa.RecordBatch.from_pydict(
                            {
                                "words": pa.array([words] * len(made), pa.int32()),
                                "shard": pa.array([shard for shard, _ in made], pa.int64()),
                                "filter": pa.array([data for _, data in made], pa.binary()),
                            }
                        )

        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(unpack.decompress(batch.column("codes")[i].as_py()), np.uint32)
                entries = batch.column("entries")[i].values
                ids = np.zeros(int(codes.max() >> np.uint32(1)) + 1, np.uint64)
                ids[entries.field("code").to_numpy()] = entries.field("id").to_numpy()
                for words, gram in _grams(codes, ids):
                    left, rest = shapes[words].packed(gram)
                    kept[words][0].append(left)
                    kept[words][1].append(rest)
                    size += len(left)
                if size >= KEPT_GRAMS:
                    yield from leave()
                    size = 0
        yield from leave()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        words = key[0].as_py()
        shape = shapes[words]
        left, rest, sums = merged([value.as_py() for value in table.column("filter")], shape)
        often = sums >= least
        ids = shape.unpacked(*shape.restored(left[often], rest[often]))
        ids += [np.zeros(len(ids[0]), np.uint64)] * (3 - words)
        columns = {name: pa.array(lane.astype(np.int64)) for name, lane in zip("xyz", ids)}
        return pa.table({"words": pa.array([words] * len(ids[0]), pa.int32()), **columns, "f": pa.array(sums[often])})

    filters = blocks.mapInArrow(count, "words int, shard long, filter binary")
    return filters.groupBy("words", "shard").applyInArrow(merge, "words int, x long, y long, z long, f long")


# --- scores


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10^15; never above 1000000."""
    return F.expr(
        f"(CAST({MILLION} AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))"
        f" div (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0)))"
    )


def phrases(grams: DataFrame, words: DataFrame) -> DataFrame:
    """All candidates that no longer one takes over: lang, phrase, a, l, r, score."""
    first = words.select(F.col("id").alias("x"), "lang", F.col("word").alias("wx"), F.col("f").alias("fx"))
    second = words.select(F.col("id").alias("y"), F.col("word").alias("wy"), F.col("f").alias("fy"))
    pairs = grams.filter("words = 2").select("x", "y", F.col("f").alias("a"))
    pairs = durable(pairs.join(first, "x").join(second, "y"), "pairs")
    heads = pairs.select("x", "y", "lang", "wx", "wy", "fx", F.col("a").alias("fxy"))
    tails = pairs.select(
        F.col("x").alias("y"), F.col("y").alias("z"), F.col("wy").alias("wz"), F.col("fy").alias("fz"), F.col("a").alias("fyz")
    )
    triples = grams.filter("words = 3").select("x", "y", "z", F.col("f").alias("a"))
    triples = triples.join(heads, ["x", "y"]).join(tails, ["y", "z"])
    # Cut after the first word, and after the second; the first of equal cuts counts.
    triples = triples.withColumn("one", score("a", "fx", "fyz")).withColumn("two", score("a", "fxy", "fz"))
    early = F.col("one") <= F.col("two")
    longer = durable(
        triples.select(
            "x",
            "y",
            "z",
            "lang",
            F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"),
            "a",
            F.when(early, F.col("fx")).otherwise(F.col("fxy")).alias("l"),
            F.when(early, F.col("fyz")).otherwise(F.col("fz")).alias("r"),
            F.least("one", "two").alias("score"),
        ),
        "triples",
    )
    parts = longer.select("x", "y", "a").unionByName(longer.select(F.col("y").alias("x"), F.col("z").alias("y"), "a"))
    over = parts.groupBy("x", "y").agg(F.max("a").alias("most"))
    shorter = pairs.join(over, ["x", "y"], "left").filter("most IS NULL OR 100 * most < 50 * a")
    shorter = shorter.select(
        "lang", F.concat_ws(" ", "wx", "wy").alias("phrase"), "a", F.col("fx").alias("l"), F.col("fy").alias("r"), score("a", "fx", "fy").alias("score")
    )
    return shorter.unionByName(longer.select(shorter.columns))


def best(candidates: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language and their rank; no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    nth = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    few = salted.withColumn("nth", nth).filter(F.col("nth") <= top).drop("salt", "nth")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    table = durable(encoded(docs), "encoded")
    entries = table.filter("word IS NOT NULL").select("block", "lang", "word", "code", "n")
    totals = durable(
        table.filter("word IS NULL").groupBy("lang").agg(F.sum("n").alias("total")), "totals"
    )
    counts = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    words = durable(numbered_words(counts), "words")
    # Two numbers: how many words there are to tell apart, and how many to count.
    n_words, n_all = words.count(), totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    bits = max(1, n_words.bit_length())
    shards = min(1 << bits, n_all // SHARD_WORDS + 1)
    shapes = {k: Shape(k, bits, shards) for k in (2, 3)}
    known = entries.select("block", "lang", "word", "code").join(words.drop("f"), ["lang", "word"])
    lists = known.groupBy("block").agg(F.collect_list(F.struct("code", "id")).alias("entries"))
    blocks = table.filter("codes IS NOT NULL").select("block", "codes").join(lists, "block").select("codes", "entries")
    grams = durable(frequent_grams(blocks, shapes, least), "grams")
    ranked = best(phrases(grams, words), top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
