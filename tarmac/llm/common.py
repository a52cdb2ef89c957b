"""What several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but space, tab, \n, \v, \f and \r; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that no other column can clash with its own."""
    return docs.select("doc_id", whole(F.col("text")).alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) drawn from a hash of the seed and the keys: the same in every run."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)
