"""The trie of conversations against one built by hand."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tarmac.llm import prefix_trie
from tarmac.llm.queries import op12_prefix_trie
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, place long, n long, name string, conv int, ends string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "x", 3, None) for row in rows], SCHEMA)


def brute(rows, ordered=lambda part: part):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in ordered(sorted(part, key=lambda t: t[:2]))] for c, part in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder has the sign of the number, as in SQL.
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(c - rest, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        value = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += value
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node)).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def nodes(df):
    assert df.columns == prefix_trie.NODE
    return sorted(tuple(row) for row in df.collect())


def some(n, seed, most, pool=3):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "assistant", None]), draw.choice([None, "", "é", "a", "user"][: pool + 1]))
        for c in range(-n // 2, n)
        if draw.random() < 0.8
        for t in range(draw.randint(1, most))
    ]


@pytest.mark.parametrize("n, most, pool", [(40, 12, 1), (25, 40, 3)])
def test_trie_equals_brute_force(spark, n, most, pool):
    rows = some(n, most, most, pool)
    assert nodes(prefix_trie.trie(conversations(spark, rows))) == brute(rows)


def test_equal_conversations_and_one_very_long(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", "same" * t) for c in range(300) for t in range(10)]
    rows += [(1000, t, "user", f"turn {t % 5}") for t in range(700)]
    assert nodes(prefix_trie.trie(conversations(spark, rows).repartition(5))) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 1, "user", "no conversation"), (5, None, "user", "first"), (5, 0, None, None)]
    rows += [(c, 1, "user", "same") for c in (5, 5, 5, 6, 6)] + [(7, 3, "a", "bc"), (7, 4, "ab", "c")]
    rows += [(9223372036854775807, 1, "user", "x"), (-9223372036854775808, 1, "user", "x")]
    assert nodes(prefix_trie.trie(conversations(spark, rows))) == brute(rows)
    # Equal turn numbers: any order is allowed, but the same one every time.
    tied = [(c, 1, "user", text) for c in (0, 1, 2, 3, 4) for text in ("x", "y", "z", "w")]
    once = nodes(prefix_trie.trie(conversations(spark, tied)))
    assert once == nodes(prefix_trie.trie(conversations(spark, tied[::-1]).repartition(3)))


def test_no_conversations_and_only_turnless_ones(spark):
    assert prefix_trie.trie(conversations(spark, [])).count() == 0
    assert prefix_trie.trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0
    # All turns of these are replaced by those of conversations that do not exist.
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 6) if zlib.crc32(str(c).encode()) % 9 > 0]
    got = nodes(prefix_trie.trie(conversations(spark, rows)))
    assert got == brute(rows) and len(got) == 1 and got[0][5] == 1


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(op12_prefix_trie(spark, SF)) == brute(rows)
