"""Tables as lists of files, all of which change in one step.

A version names, for every table, the list of the files that make it up. Files are written under new
names and never changed; the version that uses them appears last, as one small document. So a reader who
holds a version sees all tables as of one batch, whatever is written meanwhile, and a run that breaks
off leaves nothing but files that no version names. A version's number can be taken once: of two
writers that began from the same version the second fails and starts again from the new one.

A list is itself a table: the file, the value of the column that the table is partitioned by and,
where the table has a key, the least and the greatest key of the file. It says which files may hold a
key, so an upsert reads and rewrites those, not whole partitions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LIST = "path string, part string, low string, high string"


class Conflict(RuntimeError):
    """Another writer committed a version first."""


def _target(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _target(spark, path)
    return files.exists(where)


def discard(spark: SparkSession, path: str) -> None:
    where, files = _target(spark, path)
    files.delete(where, True)


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder, as paths relative to it."""
    where, files = _target(spark, path)
    if not files.exists(where):
        return []
    root = files.makeQualified(where).toUri().getPath().rstrip("/")
    found, listed = [], files.listFiles(where, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toUri().getPath()[len(root) + 1 :])
    return found


@dataclass(frozen=True)
class Version:
    """The lists of all tables after a batch, and small facts that go with them."""

    number: int = 0
    batch: int | None = None
    lists: dict[str, str] = field(default_factory=dict)
    facts: dict[str, str] = field(default_factory=dict)


class Log:
    """The versions below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def numbers(self) -> list[int]:
        names = [name.removesuffix(".json") for name in files_below(self.spark, self.path) if name.endswith(".json")]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int | None = None) -> Version:
        """The last version or a given one; the empty version 0 if there is none."""
        known = self.numbers()
        if number is None:
            number = known[-1] if known else 0
        if number == 0:
            return Version()
        if number not in known:
            raise ValueError(f"there is no version {number}")
        where, files = _target(self.spark, self._at(number))
        stream = files.open(where)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def applied(self, batch: int) -> bool:
        return any(self.read(number).batch == batch for number in reversed(self.numbers()))

    def commit(self, version: Version) -> None:
        """Make a version visible; its number must be the next one."""
        text = json.dumps({"number": version.number, "batch": version.batch, "lists": version.lists, "facts": version.facts})
        draft, files = _target(self.spark, f"{self.path}/_draft-{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE
        final, _ = _target(self.spark, self._at(version.number))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        try:
            # Without leave to overwrite: whoever comes second fails here.
            context.rename(files.makeQualified(draft), files.makeQualified(final), options)
        except Exception as error:
            files.delete(draft, False)
            if self.numbers()[-1:] >= [version.number]:
                raise Conflict(f"version {version.number} was committed by another run") from error
            raise


class FileTable:
    """One table of a version: its files are in folders of their own per write.

    ``part`` is the column whose values are folders, ``key`` a text column that is sorted within them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str | None = None, key: str | None = None):
        self.spark, self.path, self.schema, self.part, self.key = spark, path, schema, part, key
        self.name = path.rpartition("/")[2]

    # --- lists

    def listed(self, version: Version) -> DataFrame:
        place = version.lists.get(self.name)
        if place is None:
            return self.spark.createDataFrame([], LIST)
        return self.spark.read.schema(LIST).parquet(f"{self.path}/{place}")

    def paths(self, version: Version, parts: Sequence | None = None) -> list[str]:
        """The files of some partitions or all; the driver needs their names to read them."""
        files = self.listed(version)
        if parts is not None:
            files = files.filter(_among(F.col("part"), parts))
        return sorted(row.path for row in files.select("path").collect())

    def holding(self, version: Version, keys: DataFrame, parts: Sequence | None = None) -> list[str]:
        """Files whose range of keys takes in one of ``keys`` (columns of the key and the partition)."""
        files = self.listed(version)
        if parts is not None:
            files = files.filter(_among(F.col("part"), parts))
        wanted = keys.select(F.col(self.part).cast("string").alias("_part"), F.col(self.key).alias("_key"))
        met = (F.col("part") == F.col("_part")) & F.col("_key").between(F.col("low"), F.col("high"))
        found = files.join(wanted, met, "left_semi").select("path")
        return sorted(row.path for row in found.collect())

    # --- rows

    def read(self, version: Version, parts: Sequence | None = None, stamp: str | None = None) -> DataFrame:
        """The rows of a version, if asked with the time their file was written as a column ``stamp``."""
        paths = self.paths(version, parts)
        return self._with(paths, stamp, "timestamp", F.col("_metadata.file_modification_time")) if stamp else self.rows(paths)

    def rows(self, paths: Sequence[str], file: str | None = None) -> DataFrame:
        """The rows of some files, if asked with the file's path as a column ``file``."""
        return self._with(paths, file, "string", F.regexp_extract("_metadata.file_path", "(load=.*)$", 1))

    def _with(self, paths: Sequence[str], name: str | None, kind: str, value: Column) -> DataFrame:
        if not paths:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(name, F.lit(None).cast(kind)) if name else empty
        # Partitions read so much smaller than whole that footers are not worth a look at the schema.
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/{path}" for path in paths])
        return rows.select(*self.schema.names, *([value.alias(name)] if name else []))

    def write(self, df: DataFrame, load: str) -> str:
        """Write rows as new files; they belong to no version yet. Returns the folder."""
        folder = f"load={load}-{uuid.uuid4().hex[:12]}"
        df = df.select(self.schema.names)
        if self.key:
            # Sorted over all tasks, so each file has a range of its own and hot partitions are split.
            df = df.repartitionByRange(self.part, self.key).sortWithinPartitions(self.part, self.key)
        elif self.part:
            # AQE splits a partition much larger than the others and puts several small ones in one task.
            df = df.hint("rebalance", self.part)
        writer = df.write
        if self.part:
            writer = writer.partitionBy(self.part)
        writer.parquet(f"{self.path}/{folder}")
        return folder

    def _list_of(self, folder: str) -> DataFrame:
        names = [f"{folder}/{name}" for name in files_below(self.spark, f"{self.path}/{folder}") if name.endswith(".parquet")]
        if self.key and names:
            keys = self.rows(names, "path").groupBy("path", F.col(self.part).cast("string").alias("part"))
            return keys.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))
        return self.spark.createDataFrame([(name, _value(name) if self.part else None, None, None) for name in names], LIST)

    # --- changes

    def added(self, version: Version, folders: Iterable[str], without: Sequence[str] = (), parts: Sequence | None = None) -> str:
        """Write the list with the files of ``folders``, without some files or all of some partitions.

        Returns its place, for ``Version.lists``.
        """
        kept = self.listed(version)
        if without:
            gone = self.spark.createDataFrame([(path,) for path in without], "path string")
            kept = kept.join(gone, "path", "left_anti")
        if parts is not None:
            kept = kept.filter(~F.coalesce(_among(F.col("part"), parts), F.lit(False)))
        for folder in folders:
            kept = kept.unionByName(self._list_of(folder))
        return self._written(kept)

    def replaced(self, folder: str) -> str:
        """A list of one write's files only."""
        return self._written(self._list_of(folder))

    def _written(self, files: DataFrame) -> str:
        place = f"lists/{uuid.uuid4().hex}"
        files.write.parquet(f"{self.path}/{place}")
        return place

    def drop_unused(self, versions: Sequence[Version]) -> int:
        """Delete the files that none of ``versions`` uses; not to be called while a batch is written."""
        places = {version.lists[self.name] for version in versions if self.name in version.lists}
        used = {path for version in versions for path in self.paths(version)}
        gone = 0
        for path in files_below(self.spark, self.path):
            if path.startswith("load=") and path.endswith(".parquet") and path not in used:
                discard(self.spark, f"{self.path}/{path}")
                gone += 1
            elif path.startswith("lists/") and "/".join(path.split("/")[:2]) not in places:
                discard(self.spark, f"{self.path}/{path}")
        return gone


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _value(path: str) -> str | None:
    """The partition's value in ``load=.../column=value/file``."""
    value = path.split("/")[-2].partition("=")[2]
    return None if value == NO_VALUE else value


def _among(column: Column, values: Sequence) -> Column:
    """Whether a text column has one of some values, NULL among them."""
    known = column.isin([str(value) for value in values if value is not None])
    return known | column.isNull() if None in values else known
