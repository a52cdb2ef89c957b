"""Ranks, newest versions and quality checks."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarmac.operators.latest import keep_latest
from tarmac.operators.quality import Checks, failing_rows, report
from tarmac.operators.ranks import add_ranks, descending
from tarmac.plans.checks import DECLARED


def brute_ranks(values, reverse):
    def order(v):
        # NULL is below every number: first upwards, last downwards.
        low = float("-inf") if v is None else v
        return -low if reverse else low

    return [1 + sum(order(other) < order(v) for other in values) for v in values]


def test_ranks_with_one_value_on_most_rows(spark):
    values = [7.0] * 900 + [float(i) for i in range(50)] + [None] * 50
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    want = {v: 1 + sum((w is None, w or 0) > (v is None, v or 0) if v is None else w is None or w < v for w in values) for v in set(values)}
    want[None] = 1
    assert {row.v: row.up for row in add_ranks(df, {"up": F.col("v")}).select("v", "up").distinct().collect()} == want


def test_ranks_equal_brute_force(spark):
    rng = random.Random(5)
    # A third of the rows share one value.
    values = [rng.choice([7.5, rng.uniform(-50, 50), rng.randint(-3, 3) * 1.0, None]) for _ in range(300)]
    values += [7.5] * 150
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    ranked = add_ranks(df, {"up": F.col("v"), "down": descending(F.col("v"))})
    got = {row.id: (row.up, row.down) for row in ranked.collect()}
    want = list(zip(brute_ranks(values, False), brute_ranks(values, True)))
    assert got == dict(enumerate(want))
    assert ranked.schema["up"].dataType.typeName() == "long"


def test_sliced_ranks_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert add_ranks(empty, {"up": F.col("v")}).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert [row.up for row in add_ranks(nulls, {"up": F.col("v")}).collect()] == [1, 1]


def test_ranks_keep_large_whole_numbers_and_other_types_apart(spark):
    big = 1 << 60
    rows = [(big, "b", 2.0), (big + 1, "a", float("nan")), (big + 2, None, -0.0), (big + 2, "c", 0.0)]
    df = spark.createDataFrame(rows, "n long, s string, x double")
    ranks = {"n_up": F.col("n"), "n_down": descending(F.col("n")), "s_down": descending(F.col("s")), "x_up": F.col("x")}
    got = sorted((r.n, r.s or "", r.n_up, r.n_down, r.s_down, r.x_up) for r in add_ranks(df, ranks).collect())
    assert got == [
        (big, "b", 1, 4, 2, 3),
        (big + 1, "a", 2, 3, 3, 4),
        (big + 2, "", 3, 1, 4, 1),
        (big + 2, "c", 3, 1, 1, 1),
    ]


def test_ranks_read_their_rows_once_per_use(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    ranks = {f"r{i}": descending(F.col("v") * i) if i % 2 else F.col("v") + i for i in range(6)}
    counts = []
    for n in (2, 6):
        some = dict(list(ranks.items())[:n])
        plan = add_ranks(df, some)._jdf.queryExecution().executedPlan().toString()
        counts.append((plan.count("FileScan"), plan.count("Exchange"), plan.count("Subquery")))
    # More ranks read nothing more: the rows, their values, the ranges and the rows per range.
    assert counts[0] == counts[1]
    assert counts[0][0] == 4 and counts[0][2] == 0
    got = add_ranks(df, ranks).groupBy().agg(*[F.max(n).alias(n) for n in ranks], F.count("*").alias("n")).first()
    # The largest value has 14 rows, the smallest 15.
    assert (got.n, got.r0, got.r1) == (100, 87, 86)


def test_keep_latest_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v")
    )
    rows = keep_latest(df, ["k"], [F.desc("v")]).collect()
    want = {None: 2997}
    for v in range(3000):
        if v % 3:
            want[v % 7] = v
    assert {row.k: row.v for row in rows} == want


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2), (None, 2)], "k string, n int")
    checks = Checks(["k", "n"], unique=["k"], unique_together=[["k", "n"]])
    rows = report({"t": df}, {"t": checks}).collect()
    got = {(row.test, row.checked): (row.failures, row.passed) for row in rows}
    assert got == {
        ("not_null", "k"): (2, False),
        ("not_null", "n"): (0, True),
        ("unique", "k"): (1, False),
        ("unique_combination", "k,n"): (1, False),
    }
    assert [row.n for row in failing_rows(df, "k").collect()] == [2, 2]


def test_number_of_declared_checks():
    assert sum(map(len, DECLARED.values())) == 117
    assert sum(len(c.not_null) for c in DECLARED.values()) == 105
    assert sum(len(c.unique) for c in DECLARED.values()) == 11
