"""Text clean-up with the same edge cases as the source warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def strip(text: Column) -> Column:
    """Trim any Unicode white space; Spark's own ``trim`` removes blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def code(text: Column) -> Column:
    return F.upper(strip(text))


def filled(text: Column) -> Column:
    """The trimmed text, NULL if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def scalars_only(document: Column) -> Column:
    """The JSON object without members that are objects or arrays.

    Read as text, ``from_json`` would render such a member as JSON; here it has
    to be NULL. Two byte searches let nearly all documents pass untouched.
    """
    maybe_nested = document.contains("[") | (F.locate("{", document, 2) > 0)
    members = F.from_json(document, "map<string, variant>")

    def is_scalar(_, value: Column) -> Column:
        return ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")

    return F.when(maybe_nested, F.to_json(F.map_filter(members, is_scalar))).otherwise(document)


def strict_boolean(text: Column) -> Column:
    """Only true/false in any case; Spark's cast would take 'yes' and '1' too."""
    lowered = F.lower(text)
    return F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))
