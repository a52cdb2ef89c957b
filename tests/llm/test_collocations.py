"""Phrases against a plain count, and the counting filter against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import collocations
from tarmac.llm.quotient_filter import Shape, counted, decode, encode, merged, sharded
from tarmac.llm.queries import op13_collocations
from tests.conftest import SF

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    chosen = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in chosen.items():
        if len(words) == 3:
            dropped |= {(lang, part) for part in (words[:2], words[1:]) if 100 * a >= 50 * counts[lang, part]}
    rows = []
    for (lang, words), a in chosen.items():
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        value, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        if (lang, words) not in dropped:
            rows.append((lang, -value, -a, " ".join(words).encode(), left, right))
    rows.sort()
    out, rank = [], Counter()
    for lang, value, a, phrase, left, right in rows:
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -value))
    return out


def found(df):
    return sorted(tuple(row[n] for n in NAMES) for row in df.collect())


def texts(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "new york", "city", "É", "é", "x\x00", " ", "\x1f", "big-apple", "q", "tok" * 40]
    ends = [" ", "\t ", ", ", ".", "\n", "\x0b", "!", " ; ", "  "]
    return [
        ("".join(draw.choice(words) + draw.choice([" ", " ", " ", *ends]) for _ in range(draw.randint(0, 60))), draw.choice(["en", "de", None, "und"]))
        for _ in range(n)
    ]


def test_phrases_equal_brute_force(spark, odd, monkeypatch):
    rows = texts(250, 1)
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("word", F.lit(1)).withColumn("block", F.lit("x"))
    assert found(collocations.collocations(df, least=3)) == sorted(brute(rows, 3))
    assert found(collocations.collocations(df, least=10, top=7)) == sorted(brute(rows, 10, 7))
    strange = [(r["text"], r["lang"]) for r in odd.collect()]
    assert found(collocations.collocations(odd, least=2)) == sorted(brute(strange, 2))


def test_no_texts_and_no_phrases(spark, docs):
    assert collocations.collocations(docs()).count() == 0
    assert collocations.collocations(docs(None, "", " \n.", "one two three")).count() == 0


def test_small_blocks_and_filters_change_nothing(spark, tmp_path):
    """Blocks of one text, filters of a few n-grams and many shards, in one process."""
    rows = texts(60, 4)
    counts = {2: Counter(), 3: Counter()}
    shapes = {k: Shape(k, 4, 9) for k in (2, 3)}
    filters = {2: {}, 3: {}}
    import pyarrow as pa

    numbers = {}
    for text, _ in rows:
        codes, words, n = collocations.word_codes(pa.array([text], pa.string()))
        assert n.sum() == len(codes)
        ids = np.array([numbers.setdefault(w, len(numbers) % 15 + 1) for w in words.to_pylist()] or [0], np.uint64)
        for k, gram in collocations._grams(codes, ids):
            counts[k].update(zip(*[lane.tolist() for lane in gram]))
            shape = shapes[k]
            for shard, data in sharded(*counted(*shape.permuted(*shape.packed(gram)), None, shape), shape):
                filters[k].setdefault(shard, []).append(data)
    for k, shape in shapes.items():
        got = {}
        for shard, parts in filters[k].items():
            left, rest, sums = merged(parts, shape)
            assert (shape.shard_of(left) == shard).all()
            ids = shape.unpacked(*shape.restored(left, rest))
            got.update({tuple(map(int, gram)): int(a) for *gram, a in zip(*ids, sums)})
        assert got == counts[k]


@settings(max_examples=60, deadline=None)
@given(
    st.integers(2, 3),
    st.integers(1, 31),
    st.integers(1, 1000),
    st.lists(st.tuples(st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1), st.integers(1, 2**40)), min_size=1, max_size=200),
)
def test_filters_keep_every_number(words, bits, shards, entries):
    shape = Shape(words, bits, min(shards, 1 << bits))
    ids = [np.array([e[i] % (1 << bits) for e in entries], np.uint64) for i in range(words)]
    numbers = shape.packed(ids)
    moved = shape.permuted(*numbers)
    back = shape.unpacked(*shape.restored(*moved))
    assert all((a == b).all() for a, b in zip(ids, back))
    want = Counter()
    for *gram, a in zip(*[lane.tolist() for lane in ids], [e[3] for e in entries]):
        want[tuple(gram)] += a
    left, rest, sums = counted(*moved, np.array([e[3] for e in entries], np.int64), shape)
    got = {}
    for shard, data in sharded(left, rest, sums, shape):
        lanes = decode(data, shape)
        assert (shape.shard_of(lanes[0]) == shard).all()
        assert encode(*lanes, shape) == data
        twice = merged([data, data], shape)
        assert (twice[2] == 2 * lanes[2]).all()
        got.update({tuple(map(int, gram)): int(a) for *gram, a in zip(*shape.unpacked(*shape.restored(*lanes[:2])), lanes[2])})
    assert got == want


def test_filters_are_smaller_than_their_numbers():
    draw = np.random.default_rng(1)
    shape = Shape(3, 19, 100)
    ids = [draw.integers(1, 1 << 19, 1_000_000).astype(np.uint64) for _ in range(3)]
    made = sharded(*counted(*shape.permuted(*shape.packed(ids)), None, shape), shape)
    assert sum(len(data) for _, data in made) < 7.2 * 1_000_000
    with pytest.raises(ValueError, match="do not fit"):
        Shape(3, 32, 1)


def test_scores_are_exact(spark):
    rows = [(10, 10, 10), (10**14, 10**14 + 1, 10**14 + 7), (3_000_000_019, 4_000_000_007, 9_999_999_967), (10, 3 * 10**14, 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", collocations.score("a", "l", "r"))
    assert [r.s for r in df.collect()] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


def test_query_equals_brute_force(spark):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op13_collocations(spark, SF)) == sorted(brute(rows))
