"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams, hashed into ``BUCKETS`` indicators: runs of one to three
bytes, and runs of one to three neighbouring word pairs told apart only by whether the two
words are equal. Indicators are divided by the root of their number and scaled by the class
log-count ratio (smoothed share of texts of either class that have the n-gram),
and a linear classifier with hinge loss is fitted to the scaled indicators by dual
coordinate descent. The weights are drawn towards their mean size, as the ratio alone
is a strong classifier on few rows. The margin becomes a score in [0, 1] by a logistic
curve fitted on the same rows.

Training reads a bounded sample: at most ``most`` labelled documents, those with the smallest
hash of their id, and where ids repeat 4 * ``most`` of their rows, those with the smallest
hashes of id and text. Scoring is one pass over the texts with a fixed table of weights.

Defined results: a NULL or empty text has no n-grams and is scored by the bias; NULL
ids are never held out or trained on; a document with two different labels is not
trained on; repeated rows count as often as they occur; an empty table gives no
rows; without both labels every score is 0.5; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text, whole
from tarmac.llm.quality_rules import smallest_hashes, text_key

BUCKETS = 1 << 16
SAMPLE_ROWS = 4000
SMOOTHING = 1.0
PENALTY = 4.0
# Share of the learned weights against their mean size.
BLEND = 0.9
EPOCHS = 20
THRESHOLD = 0.3


def grams(text: bytes) -> np.ndarray:
    """The distinct buckets of a text's n-grams, ascending."""
    seen = np.zeros(BUCKETS, bool)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    # Single bytes keep buckets of their own; the others are spread by a multiplicative hash.
    seen[b] = True
    pair = b[:-1] << 8 | b[1:]
    seen[_spread(pair, 1)] = True
    seen[_spread(pair[:-1] << 8 | b[2:], 2)] = True
    words = text.split()
    same = np.fromiter(map(eq, words, words[1:]), np.uint32, max(len(words) - 1, 0))
    seen[_spread(same, 3)] = True
    double = same[:-1] << 1 | same[1:]
    seen[_spread(double, 4)] = True
    seen[_spread(double[:-1] << 1 | same[2:], 5)] = True
    return np.flatnonzero(seen)


def _spread(code: np.ndarray, size: int) -> np.ndarray:
    mixed = (code + np.uint32(size << 24)) * np.uint32(2654435761)
    return np.uint32(256) + (mixed >> np.uint32(16)) % np.uint32(BUCKETS - 256)


@dataclass(frozen=True)
class Model:
    """``weights`` per bucket, already scaled; the score is logistic(slope * margin + offset)."""

    weights: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def score(self, text: bytes) -> float:
        if self.weights is None:
            return 0.5
        margin = _margin(self.weights, grams(text)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def _margin(weights: np.ndarray, buckets: np.ndarray) -> float:
    return float(weights[buckets].sum()) / max(len(buckets), 1) ** 0.5


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """From buckets and labels 0/1 per row; the order of the rows does not matter."""
    if len(set(labels.tolist())) < 2:
        return Model()
    order = sorted(range(len(rows)), key=lambda i: (labels[i], len(rows[i]), rows[i].tobytes()))
    rows, y = [rows[i] for i in order], np.where(labels[order] == 1, 1.0, -1.0)
    counts = {s: np.full(BUCKETS, SMOOTHING) for s in (1.0, -1.0)}
    for r, s in zip(rows, y):
        counts[s][r] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    values = [ratio[r] / max(len(r), 1) ** 0.5 for r in rows]
    weights, bias = _dual_descent(rows, values, y)
    mean = np.abs(weights[weights != 0]).mean() if weights.any() else 0.0
    blended = ratio * ((1 - BLEND) * mean + BLEND * weights)
    margins = np.array([_margin(blended, r) + bias for r in rows])
    slope, offset = _logistic(margins, y)
    return Model(blended, bias, slope, offset)


def _dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss: one dual variable per row, each solved for in turn within [0, C]."""
    weights, bias = np.zeros(BUCKETS), 0.0
    norms = np.array([float(v @ v) + 1.0 for v in values])
    balance = {s: len(y) / (2 * max((y == s).sum(), 1)) for s in (1.0, -1.0)}
    most = np.array([PENALTY * balance[s] for s in y])
    alpha = np.zeros(len(y))
    draw = np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in draw.permutation(len(y)):
            r, v = rows[i], values[i]
            slack = y[i] * (float(weights[r] @ v) + bias) - 1.0
            step = min(max(alpha[i] - slack / norms[i], 0.0), most[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights[r] += step * y[i] * v
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-6:
            break
    return weights, bias


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets, on margins of unit spread."""
    scale = float(margins.std()) or 1.0
    x, n = margins / scale, {s: (y == s).sum() for s in (1.0, -1.0)}
    target = np.where(y > 0, (n[1.0] + 1) / (n[1.0] + 2), 1 / (n[-1.0] + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a / scale), float(b)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Model:
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .where("_low = _high")
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(most)
        .select("doc_id", F.col("_low").alias("label"))
    )

    @F.arrow_udf("binary")
    def buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([grams(t.encode()).astype(np.uint16).tobytes() for t in batch.to_pylist()], pa.binary())

    # The sample is bounded by ``most``, and so is what is broadcast and collected.
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id")
    read = texts.select("doc_id", text_key(F.col("text")).alias("_key"), buckets("text").alias("grams"), "label")
    found = smallest_hashes(read, 4 * most).select("grams", "label").collect()
    rows = [np.frombuffer(r["grams"], np.uint16).astype(np.int64) for r in found]
    return fit(rows, np.array([r["label"] for r in found], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(t.encode()) for t in batch.to_pylist()], pa.float64())

    return docs.select("doc_id", scored(whole(F.col("text"))).alias("score"))
