"""The landed table with a list of its files: which stamps each file holds."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.versions import Conflict, FileTable, Log, Version
from tarmac.schemas import RAW_SCHEMA

STAMP = "_sdc_extracted_at"
# As text, in the order of time.
FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LANDED_SCHEMA = T.StructType(
    [*RAW_SCHEMA, T.StructField("stamp", T.StringType()), T.StructField("extracted_on", T.DateType())]
)


class Landed:
    """Deliveries by the day of their extraction, within a day in the order of their stamps.

    The list of files has the first and the last stamp of each, so a run that asks for what is new opens the files that
    reach above its mark and no others; files that come late, with stamps of days long past,
    are listed like any others. Deliveries without a stamp are in files of their own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.log = Log(spark, f"{path.rstrip('/')}/_log")
        self.table = FileTable(spark, f"{path.rstrip('/')}/deliveries", LANDED_SCHEMA, "extracted_on", "stamp")

    def land(self, raw: DataFrame, tries: int = 10) -> Version:
        """Append deliveries; writers at the same time wait for nobody, whoever loses lists again."""
        at = F.col(STAMP)
        rows = raw.select(
            *RAW_SCHEMA.names, F.date_format(at, FORMAT).alias("stamp"), F.to_date(at).alias("extracted_on")
        )
        folder = self.table.write(rows, "raw")
        for _ in range(tries):
            base = self.log.read()
            coming = replace(base, number=base.number + 1, lists={self.table.name: self.table.added(base, [folder])})
            try:
                self.log.commit(coming)
                return coming
            except Conflict:
                continue
        raise Conflict(f"lost {tries} times against other writers")

    def deliveries(self, version: Version | None = None) -> DataFrame:
        return self.table.read(version or self.log.read()).select(RAW_SCHEMA.names)

    def files_since(self, mark: datetime, version: Version | None = None) -> list[str]:
        """Files that hold a stamp at or above the mark."""
        text = F.date_format(F.lit(mark), FORMAT)
        files = self.table.listed(version or self.log.read()).filter(F.col("high") >= text)
        return sorted(row.path for row in files.select("path").collect())

    def since(self, mark: datetime, version: Version | None = None) -> DataFrame:
        """Deliveries extracted at the mark or later."""
        rows = self.table.rows(self.files_since(mark, version)).select(RAW_SCHEMA.names)
        return rows.filter(F.col(STAMP) >= F.lit(mark))
