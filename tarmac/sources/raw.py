"""Raw movement deliveries: one JSON document per row plus extraction stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import text
from tarmac.schemas import EXTRACT_STAMPS, PAYLOAD_KEYS, PAYLOAD_SCHEMA, RAW_SCHEMA


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The landed table."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Extractor output, one JSON document per line, taken as text."""
    return spark.read.text(folder).withColumnRenamed("value", "data")


def stream_documents(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same folder as a stream of newly arrived files."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
        .withColumnRenamed("value", "data")
    )


def stamped(documents: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """Add the extraction stamps; documents stay one text column."""
    now = F.current_timestamp() if extracted_at is None else extracted_at
    return documents.filter(F.trim("data") != "").select(
        "data",
        *[now.alias(name) for name in EXTRACT_STAMPS],
        F.lit(None).cast("timestamp").alias("_sdc_deleted_at"),
        F.lit(None).cast("long").alias("_sdc_sequence"),
        F.lit(None).cast("long").alias("_sdc_table_version"),
    )


def land(raw: DataFrame, path: str) -> None:
    """Append deliveries to the landed table."""
    raw.select(RAW_SCHEMA.names).write.mode("append").parquet(path)


def typed_view(raw: DataFrame, name: str) -> DataFrame:
    """Register the documents' fields as columns of a view; returns its rows."""
    parsed = raw.select(
        F.from_json(text.scalars_only(F.col("data")), PAYLOAD_SCHEMA).alias("document"),
        *[field for field in RAW_SCHEMA.names if field != "data"],
    )
    view = parsed.select(
        *[F.col("document")[key].alias(key) for key in PAYLOAD_KEYS],
        *[field for field in RAW_SCHEMA.names if field != "data"],
    )
    view.createOrReplaceTempView(name)
    return view
