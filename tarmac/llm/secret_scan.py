"""Secret scans through a trigram index.

For each rule a Boolean query over trigrams is derived from its regular
expression. Each block of texts (an Arrow batch) gets an inverted index of the
trigrams that the queries name, built in one pass over its bytes; the postings
are intersected and united, and only the texts left are searched with the
expression itself. A rule without mandatory trigrams searches every text. The
index lives and dies with its block, so there is nothing to shuffle and nothing
that grows with the corpus.

Spans are in code points, end exclusive. Leftmost matches of one kind do not
overlap; different kinds may. A match that fails its length rule is dropped, and the
search goes on behind it.

Defined results: a NULL or empty text has no spans; NULL ids and repeated rows
are scanned like any other row; an empty table gives no rows; further columns
are passed through by ``redact`` and not read by ``scan``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fresh, id_and_text, whole
from tarmac.llm.trigrams import Index, Query, matcher, trigram_query


@dataclass(frozen=True)
class Rule:
    """``least`` code points are demanded of group ``group`` of a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules, then formats published by their issuers.
_KEY = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
BASE = [
    Rule("assign", _KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of hex digits are maximal, so only those of 16 and more need be visited.
    Rule("hex", r"[0-9a-f]{16,}"),
]
MORE = [
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    # A scheme is short and begins where no other one goes on, so no run of letters is read twice.
    Rule("url", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,30}://[^\s/:@]+:[^\s/@]+@"),
]
RULES = BASE + MORE

SPAN = "struct<kind:string,start:long,end:long>"
# Arrow hands over so many rows at once; with long texts a block stays within some megabytes.
BLOCK_ROWS = 500


class Scanner:
    """Finds the spans of all rules in a block of texts."""

    def __init__(self, rules: list[Rule] = RULES):
        self.rules = rules
        self.queries: list[Query] = [trigram_query(r.pattern) for r in rules]
        self.patterns = [matcher(r.pattern) for r in rules]
        self.index = Index({t for q in self.queries for t in q.trigrams()})

    def candidates(self, column: pa.StringArray) -> list[np.ndarray]:
        """For each rule the rows that its trigram query leaves."""
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        blob = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.empty(0, np.uint8)
        postings = self.index.postings(blob, at.astype(np.int64) - at[0])
        return [q.rows(postings, len(column)) for q in self.queries]

    def spans(self, column: pa.StringArray) -> list[list[tuple[str, int, int]]]:
        found: dict[int, list[tuple[int, int, int]]] = {}
        texts: dict[int, str] = {}
        for k, rows in enumerate(self.candidates(column)):
            rule, search = self.rules[k], self.patterns[k].finditer
            for row in rows.tolist():
                text = texts[row] if row in texts else texts.setdefault(row, column[row].as_py())
                for m in search(text):
                    if rule.least <= len(m.group(rule.group)):
                        found.setdefault(row, []).append((m.start(), k, m.end()))
        return [
            [(self.rules[k].kind, start, end) for start, k, end in sorted(found.get(row, ()))]
            for row in range(len(column))
        ]


def with_spans(docs: DataFrame, name: str, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with the column ``name``: the spans in ``text``, by start, then in the order of the rules."""

    @F.arrow_udf(f"array<{SPAN}>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = []
            for at in range(0, len(batch), BLOCK_ROWS):
                rows += scanner.spans(batch.slice(at, BLOCK_ROWS).cast(pa.string()))
            yield pa.array([[dict(zip(("kind", "start", "end"), s)) for s in r] for r in rows], kind)

    return docs.withColumn(name, spans(whole(F.col("text"))))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) per row of ``docs``."""
    return with_spans(id_and_text(docs), "spans", rules).select("doc_id", "spans")


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by ``[SECRET]`` (overlapping ones by one), and n_chars to match."""
    name = fresh(docs, "_spans")
    found = with_spans(docs, name, rules)
    text = F.col("text")
    # Walk the spans from the left, keeping what lies between them.
    walked = F.aggregate(
        name,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(
                    a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("[SECRET]")
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    cleaned = found.withColumn("text", F.when(F.size(name) > 0, walked).otherwise(text)).drop(name)
    if "n_chars" not in docs.columns:
        return cleaned.select(*docs.columns)
    length = F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)
