from pyspark.sql import types as T
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def base_rows(texts):
    return [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture
def docs(spark):
    """A documents table from texts (numbered from 0) or full rows."""

    def build(*entries):
        rows = [e if isinstance(e, tuple) else (i, e, "en", f"s{i % 3}", None) for i, e in enumerate(entries)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns named like results and helpers."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    same = " ".join(f"same{i}" for i in range(40))
    rows = [
        (1, None, None, None, None),
        (None, same, "en", "a", 1),
        (None, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", None, 7),
        (4, long, "en", "b", len(long)),
        (5, long + " end", "en", "b", len(long) + 4),
        (6, same, "en", "b", len(same)),
        (6, same, "en", "b", len(same)),
        (6, "another text under a number in use", "en", "c", 34),
        (7, same.upper(), "de", "c", len(same)),
        (8, "é ü ß 中文 😀 token = \"abcdefabcdef0123\"", "de", "c", 30),
    ]
    clashing = {
        name: kind
        for name, kind in {
            "words": T.StringType(),
            "size": T.LongType(),
            "copies": T.LongType(),
            "target": T.DoubleType(),
            "spans": T.StringType(),
            "kept": T.BooleanType(),
            "ids": T.StringType(),
            "_stats": T.StringType(),
            "_row": T.LongType(),
            "_spans": T.StringType(),
            "_all": T.StringType(),
            "component": T.LongType(),
            "tag": T.LongType(),
            "key": T.LongType(),
            "j": T.LongType(),
            "_range": T.LongType(),
            "html": T.StringType(),
        }.items()
    }
    schema = T._parse_datatype_string(SCHEMA)
    for name, kind in clashing.items():
        schema = schema.add(name, kind)
    return spark.createDataFrame([r + (None,) * len(clashing) for r in rows], schema)
