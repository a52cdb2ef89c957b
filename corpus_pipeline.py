"""The corpus pipeline: quality rules, near-dedup, secrets, mixing, tokens.

Each stage works on all that the one before kept. Between stages the documents are written
as Parquet to the shared folder and read again, so a lost executor costs a stage's work at most.

Results in odd cases: NULL and empty texts have no words and go in the first stage, and so do short ones;
rows without a doc_id are duplicates of nothing and stay; of repeated rows with one, one stays; very long texts pass whole; an empty table stays empty. Columns that
documents have beyond the usual ones pass through, unless the last stage has one of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.config import durable, prepare
from tarmac.llm import minhash, mixing, quality_rules, secret_scan, sentence_pieces
from tarmac.llm.queries import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rules = quality_rules.decision_list(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return minhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    return sentence_pieces.round_trip(docs, sentence_pieces.read_model())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_only),
    ("near duplicates", one_per_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("tokens", tokens),
]

# A learned decision list and a tokenizer are beyond SQL; ``tests/llm`` has a brute-force twin.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
