"""One query per operator on the whole given tables, thin over the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.config import durable, prepare
from tarmac.llm import (
    collocations,
    html_text,
    imatch,
    licences,
    minhash,
    mixing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    repeated_passages,
    secret_scan,
    sentence_pieces,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


ROOT = str(Path(__file__).resolve().parents[2])
# Texts are long: a batch that goes to Python ends after so many rows or bytes.
ROWS_PER_BATCH = "1000"
BYTES_PER_BATCH = str(4 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    # Workers started from another folder find this package here, if they share the disk; on a
    # cluster it is installed or shipped with the job.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.text_size(F.col("text")).alias("size"))
    mixed = mixing.plan(durable(sized, "sizes"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return quality_rules.judge(docs, quality_rules.decision_list(docs, labels))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = quality_classifier.train(docs, labels)
    return quality_classifier.score(docs, model).select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeated_passages.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").cast("long").alias("n_chars"))
    coded = sentence_pieces.round_trip(docs, sentence_pieces.read_model())
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", "n_chars", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), "restored")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))

    def number(kind: str) -> F.Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(r.kind) for r in secret_scan.BASE],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


def op11_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("url")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_fingerprints": op4_fingerprints,
    "op5_html_text": op5_html_text,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_warc_archives": op11_warc_archives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}
