"""Settings every job takes, and the two things a session must provide."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Defaults are the values the published numbers were computed with."""

    local_timezone: str = "America/Argentina/Buenos_Aires"
    rollover_threshold_hours: int = 6
    lookback_days: int = 60
    route_window_days: int = 60
    as_of: date | None = None

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)


def prepare(spark: SparkSession) -> SparkSession:
    """Clock arithmetic assumes that instants print in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a session whose single process holds driver and executors may go
    without it; there a fresh temporary folder stands in and goes with the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "tarmac.local.folder", None
    )
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tarmac-")
    spark.conf.set("tarmac.local.folder", folder)
    _delete_at_exit(spark, folder)
    return folder


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For results that several later steps read: it cuts the lineage, the readers
    survive the loss of any executor, and the planner knows the table's size.
    The application owns the copies and deletes its folder when it ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's own part of the shared folder."""
    own = f"{shared_folder(spark)}/tarmac-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _delete_at_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


_OWN: set[str] = set()


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    _OWN.add(folder)
    atexit.register(_delete, spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session is gone already: whoever owns the shared folder clears it
        return
