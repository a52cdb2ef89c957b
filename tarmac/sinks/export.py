"""JSON exports: one document per table, and a manifest of what was exported.

The executors write, and every table takes the same form, ``{"metadata": ..., "data": [...]}``. A
document is a folder of part files whose bytes, one after the other, are the document: the first
record has the head before it, the others a comma, the last one the foot behind it. A small table
is one part; a table of any size is written by as many tasks as its bytes ask for, in its order.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.versions import discard, files_below

# Tables exported by default and their file names.
DEFAULT_EXPORTS = {
    "public_headline": "headline.json",
    "public_airline_breakdown": "airline_breakdown.json",
    "public_tops": "tops.json",
    "public_bucket_distribution": "bucket_distribution.json",
    "public_daily_status": "daily_status.json",
    "public_gates_analysis": "gates_analysis.json",
    "routes_metrics": "routes_metrics.json",
}
DEFAULT_PREFIX = "data"


@dataclass(frozen=True)
class Exported:
    """A written document; ``parts`` are its files below ``path`` in the order of their bytes."""

    table: str
    path: str
    records: int
    exported_at: datetime
    parts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Entry:
    """One table to export: a file name goes below the folder, a path stands for itself."""

    table: str
    file: str

    def below(self, folder: str) -> str:
        return self.file if "/" in self.file else f"{folder}/{self.file}"


def _entries(table_map: Mapping[str, str] | None, tables: str | None) -> list[Entry]:
    """From a map, else from a comma-separated list, else the defaults."""
    if table_map:
        if any(not isinstance(file, str) for file in table_map.values()):
            raise ValueError("export paths must be strings")
        return [Entry(table, file) for table, file in table_map.items()]
    if tables:
        listed = filter(None, map(str.strip, tables.split(",")))
        return [Entry(table, f"{table}.json") for table in listed]
    return [Entry(table, file) for table, file in DEFAULT_EXPORTS.items()]


def targets(
    table_map: Mapping[str, str] | None = None,
    tables: str | None = None,
    prefix: str | None = None,
    blob_path: str | None = None,
) -> dict[str, str]:
    """Table -> relative path: from a map, else a comma-separated list, else the defaults.

    A path without a folder goes below the prefix; the prefix is the given
    one, else the folder of ``blob_path``, else "data".
    """
    given = (prefix or "").strip().strip("/")
    beside = (blob_path or "").rpartition("/")[0]
    folder = given or beside or DEFAULT_PREFIX
    return {entry.table: entry.below(folder) for entry in _entries(table_map, tables)}


def _value(name: str, type_: T.DataType) -> Column:
    """Decimals become floats, instants ISO texts; the rest is JSON as it is."""
    if isinstance(type_, T.DecimalType):
        return F.col(name).cast("double").alias(name)
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        zone = "XXX" if isinstance(type_, T.TimestampType) else ""
        whole = F.date_format(name, f"yyyy-MM-dd'T'HH:mm:ss{zone}")
        exact = F.date_format(name, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}")
        text = F.when(F.date_format(name, "SSSSSS") == "000000", whole).otherwise(exact)
        return F.regexp_replace(text, "Z$", "+00:00").alias(name)
    return F.col(name)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object, NULLs included."""
    fields = F.struct(*[_value(field.name, field.dataType) for field in df.schema])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def export_table(
    df: DataFrame, table: str, path: str, source: str | None = None, raw: bool = False
) -> Exported | None:
    """Write ``{"metadata": ..., "data": [...]}``, or the bare array if ``raw``.

    An empty table writes nothing and returns None.
    """
    spark = df.sparkSession
    at = datetime.now(timezone.utc)
    rows_path = f"{path}.rows"
    # Stored with their positions, so the document keeps the table's order.
    numbered = json_rows(df).withColumn("_position", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(rows_path)
    rows = spark.read.schema(numbered.schema).parquet(rows_path)
    records, first, last = rows.agg(F.count("*"), F.min("_position"), F.max("_position")).first()
    if records == 0:
        discard(spark, rows_path)
        return None
    metadata = {"exported_at": at.isoformat(), "source": source or table, "total_records": records}
    head = "[" if raw else f'{{"metadata": {json.dumps(metadata)}, "data": ['
    foot = "]" if raw else "]}"
    before = F.when(F.col("_position") == first, head).otherwise(",")
    behind = F.when(F.col("_position") == last, foot).otherwise("")
    document = rows.select("_position", F.concat(before, "value", behind).alias("value"))
    document.orderBy("_position").select("value").write.mode("overwrite").text(path)
    discard(spark, rows_path)
    parts = sorted(name for name in files_below(spark, path) if name.startswith("part-"))
    return Exported(table, path, records, at, tuple(parts))


def _document(spark: SparkSession, text: str, path: str) -> None:
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def export_all(
    models: Mapping[str, DataFrame],
    root: str,
    paths: Mapping[str, str],
    raw_tables: str = "",
    dataset: str = "marts",
) -> list[Exported]:
    """Export each table of ``paths``; ``raw_tables`` is a comma-separated list."""
    raw = {name.strip() for name in raw_tables.split(",") if name.strip()}
    done = [
        export_table(models[table], table, f"{root}/{path}", f"{dataset}.{table}", table in raw)
        for table, path in paths.items()
    ]
    return [entry for entry in done if entry is not None]


def manifest(
    spark: SparkSession, exported: list[Exported], valid_days: int = 7, generated_at: datetime | None = None
) -> DataFrame:
    """One row per exported document: name, path, size, and until when the listing is valid."""
    at = generated_at or datetime.now(timezone.utc)
    schema = (
        "name string, path string, record_count long, exported_at timestamp,"
        " generated_at timestamp, expires_at timestamp"
    )
    until = at + timedelta(days=valid_days)
    rows = [(_name(e.path), e.path, e.records, e.exported_at, at, until) for e in exported]
    return spark.createDataFrame(rows, schema)


def _name(path: str) -> str:
    return path.rpartition("/")[2].removesuffix(".json")


def write_manifest(
    spark: SparkSession,
    exported: list[Exported],
    path: str,
    valid_days: int = 7,
    generated_at: datetime | None = None,
) -> None:
    """The listing as one JSON document; it has one entry per exported table."""
    at = generated_at or datetime.now(timezone.utc)
    listing = {
        "generated_at": at.isoformat(),
        "expires_at": (at + timedelta(days=valid_days)).isoformat(),
        "expiration_days": valid_days,
        "objects": {_name(e.path): e.path for e in exported},
    }
    _document(spark, json.dumps(listing), path)
