"""Quality rules: a decision list learned by sequential covering, applied as CASE WHEN.

Rules are conjunctions of thresholds on text statistics ("symbol_share > 0.08
AND n_words <= 900"). Each rule is grown condition by condition on one part of
the labelled rows (information gain), pruned from its end on the other part,
and kept only if it is precise there; the rows it covers are then set aside and
the next rule is learned. The list is an ordered conditional expression of
built-in functions: scoring runs inside Spark without Python.

Defined results: a NULL text is empty; an empty text has no words and fails
the base rule; NULL ids and repeated rows are judged like any other row; an
empty table gives no rows; without usable labels the list is empty and only the
base rule decides. Columns of the input other than ``text`` are never read, so
their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fresh, whole, words

WINDOW = 8
# The list is fitted on this many labelled documents at most, those with the smallest id hash.
SAMPLE_ROWS = 4000
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_capitals", "n_digits", "n_marks", "n_lines"]
FEATURES = [
    "n_words",
    "mean_word",
    "symbol_share",
    "capital_share",
    "digit_share",
    "mark_share",
    "repeat_share",
    "dup_line_share",
]


def _count(text: Column, kept: str) -> Column:
    """Characters of ``text`` in the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """Add one struct column of counts and shares per text; returns the frame and its name."""
    base = docs.columns
    names = {n: fresh(docs, f"_{n}") for n in ("words", "lines", "hashes", "sorted", "at", "stats")}
    w, ln, h, s, at, out = (F.col(names[n]) for n in ("words", "lines", "hashes", "sorted", "at", "stats"))
    whole_text = whole(F.col(text))
    step = docs.select(
        *base,
        words(F.col(text)).alias(names["words"]),
        F.filter(F.split(whole_text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(
            names["lines"]
        ),
    )
    # A 64-bit hash stands for each window; within one text it does not collide in practice.
    step = step.withColumn(
        names["hashes"],
        F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - WINDOW + 1),
                lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))),
            ),
        ),
    )
    # Only texts with a repeated window go on: their windows are sorted, and equal neighbours repeat.
    step = step.withColumn(
        names["sorted"],
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ),
    )
    step = step.withColumn(
        names["at"],
        F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["p"].cast("long"),
            )
        ),
    )
    # A window adds the words that the one before it left uncovered.
    repeated = F.aggregate(
        at,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW).cast("long"), p - a["last"])).alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )
    counted = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(whole_text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _count(whole_text, "#*$%&|<>").alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
        _count(whole_text, "A-Z").alias("n_capitals"),
        _count(whole_text, "0-9").alias("n_digits"),
        _count(whole_text, "!?").alias("n_marks"),
        F.size(ln).cast("long").alias("n_lines"),
    )
    step = step.withColumn(names["stats"], counted)
    return step.select(*base, out), names["stats"]


def features(stats: Column) -> dict[str, Column]:
    """Shares in [0, 1] and two plain sizes, none of them NULL."""

    def share(part: Column, of: Column) -> Column:
        return part / F.greatest(of, F.lit(1))

    return {
        "n_words": stats["n_words"].cast("double"),
        "mean_word": share(stats["word_chars"], stats["n_words"]),
        "symbol_share": share(stats["n_symbols"], stats["word_chars"]),
        "capital_share": share(stats["n_capitals"], stats["word_chars"]),
        "digit_share": share(stats["n_digits"], stats["word_chars"]),
        "mark_share": share(stats["n_marks"], stats["word_chars"]),
        "repeat_share": share(stats["n_repeat_words"], stats["n_words"]),
        "dup_line_share": share(stats["n_dup_lines"], stats["n_lines"]),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 20) | (100 * stats["n_repeat_words"] > 30 * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: tuple) -> bool:
        value = row[FEATURES.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds rejects, else the text is kept."""

    rules: tuple[Rule, ...] = ()

    def keeps(self, stats: Column) -> Column:
        values, verdict = features(stats), F.lit(True)
        for rule in reversed(self.rules):
            held = reduce(Column.__and__, [condition.column(values) for condition in rule])
            verdict = F.when(held, F.lit(False)).otherwise(verdict)
        return verdict

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "\nelse keep"


def _covers(rule: Rule, row: tuple) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(rows: list[tuple]) -> Condition | None:
    """The threshold with the largest information gain over ``rows`` (label last, 1 = to reject)."""
    bad = sum(r[-1] for r in rows)
    if not bad or bad == len(rows):
        return None
    before, best, found = math.log2(bad / len(rows)), 0.0, None
    for k, feature in enumerate(FEATURES):
        ordered = sorted(rows, key=lambda r: r[k])
        seen = 0
        for i in range(len(ordered) - 1):
            seen += ordered[i][-1]
            low, high = ordered[i][k], ordered[i + 1][k]
            if low == high:
                continue
            for above, p, n in ((True, bad - seen, len(rows) - i - 1), (False, seen, i + 1)):
                if p and (gain := p * (math.log2(p / n) - before)) > best:
                    # Halfway between the two values, so that neither side sits on the edge.
                    best, found = gain, Condition(feature, above, (low + high) / 2)
    return found


def _grown(rows: list[tuple]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS and (found := _best_condition(rows)):
        rule += (found,)
        rows = [r for r in rows if found.holds(r)]
    return rule


def _pruned(rule: Rule, rows: list[tuple]) -> tuple[Rule, float]:
    """The beginning of the rule that separates the other rows best, and its precision there."""

    def worth(size: int) -> float:
        covered = [r[-1] for r in rows if _covers(rule[:size], r)]
        return (sum(covered) + 0.5) / (len(covered) + 1) if covered else 0.0

    size = max(range(1, len(rule) + 1), key=lambda n: (round(worth(n), 3), -n))
    return rule[:size], worth(size)


def learn(rows: list[tuple]) -> DecisionList:
    """Sequential covering over (features..., label), label 1 = to reject."""
    rows, rules = sorted(rows), []
    while len(rules) < MAX_RULES and sum(r[-1] for r in rows) >= 4:
        grow, check = [r for i, r in enumerate(rows) if i % 3], rows[::3]
        rule = _grown(grow)
        if not rule:
            break
        rule, precision = _pruned(rule, check)
        left = [r for r in rows if not _covers(rule, r)]
        if precision < MIN_PRECISION or len(left) == len(rows):
            break
        rules.append(rule)
        rows = left
    return DecisionList(tuple(rules))


def text_key(text: Column) -> Column:
    return F.sha2(whole(text), 256)


def smallest_hashes(rows: DataFrame, most: int) -> DataFrame:
    """Of rows with doc_id and _key the ``most`` smallest by a hash of both, so from all ids; rows that tie are the same."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "_key")), "doc_id", "_key").limit(most)


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> list[tuple]:
    """Statistics of the texts of at most ``most`` labelled documents; one with two different labels is left out.

    Where ids repeat, at most 4 * ``most`` rows are read, those with the smallest hashes of id and text, so
    that they are the same in every run.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .where("_low = _high")
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(most)
        .select("doc_id", F.col("_low").alias("_label"))
    )
    # The sample is bounded by ``most``, and so is what is broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats, name = with_statistics(texts.withColumn("_key", text_key(F.col("text"))))
    values = features(F.col(name))
    read = stats.select("doc_id", "_key", *[values[f].alias(f) for f in FEATURES], (1 - F.col("_label")).alias("_bad"))
    return [tuple(r)[2:] for r in smallest_hashes(read, 4 * most).collect()]


def decision_list(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DecisionList:
    return learn(labelled_rows(docs, labels, most))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """One row per row of ``docs``: id, base counts, verdicts."""
    stats, name = with_statistics(docs.select("doc_id", "text"))
    s = F.col(name)
    failed = base_failed(s)
    return stats.select(
        "doc_id",
        *[s[c].alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        (~failed & rules.keeps(s)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    stats, name = with_statistics(docs)
    s, kept, row = F.col(name), fresh(docs, "_kept"), fresh(docs, "_row")
    verdict = stats.select(
        *docs.columns,
        (~base_failed(s) & rules.keeps(s)).alias(kept),
        F.monotonically_increasing_id().alias(row),
    )
    # Spark does not move a filter below a row number. Moved down, this one would compute the
    # statistics anew for each of its conditions.
    return verdict.where(F.col(kept) & (F.col(row) >= 0)).select(*docs.columns)
