"""Licence scans by sentence rules.

A text is normalised (ASCII lower case, everything but letters, digits and dots
becomes one space), with marks where a sentence ends (its sign, a blank line) and
where a single line break stands, which may wrap a sentence or end a title.
Comment signs and indentation before a line do not count, nor do the numbers of
items. Known licence sentences are found between such marks, over wrapped lines,
too. A text is then a sequence of sentence identifiers, with a gap wherever other
sentences stand in between. Licence rules are ordered sequences of identifiers:
the first rule that occurs in the sequence names its licence and uses its
sentences up, so a full licence text is not also reported as the shorter notice
it contains. All rights reserved means no licence only where none is found beside
it, as licence texts have that line below their copyright, too. The SQL twin looks
at single lines only and differs on wrapped texts, of which the given tables have
none.

Only texts with one of a few anchor words can hold a known sentence (every known
sentence has one), so all others skip the rest. Everything is a built-in
expression on one row: no shuffle, no Python.

Defined results: a NULL or empty text has no sentences and no licences; NULL ids
and repeated rows are scanned like any other row; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import id_and_text

# Known sentences in normalised form. Notices first, then the opening
# sentences of common licence texts.
SENTENCES = {
    "licensed under the apache license version 2.0": "ApacheNotice",
    "licensed under the apache license version 2.0 the license": "ApacheHeader",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheObtain",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "apache license version 2.0 january 2004": "ApacheTitle",
    "released under the mit license": "MITNotice",
    "licensed under the mit license": "MITNotice",
    "the mit license mit": "MITTitle",
    "the mit license": "MITTitle",
    "mit license": "MITTitle",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITInclude",
    "this work is licensed under the gnu general public license version 3": "GPL3Notice",
    "gnu general public license version 3 29 june 2007": "GPL3Title",
    "gnu general public license version 2 june 1991": "GPL2Title",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPLNoWarranty",
    "see the gnu general public license for more details": "GPLSee",
    "licensed under cc by nc 4.0": "CCBYNC4Notice",
    "licensed under cc by 4.0": "CCBY4Notice",
    "licensed under cc by sa 4.0": "CCBYSA4Notice",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4Notice",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "CCBYSA4Notice",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "CCBYNC4Notice",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "MPL2Notice",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "NoLicense",
    "all rights reserved no license": "NoLicense",
}

# Sentences with a part that varies, as a pattern over the normalised sentence.
PATTERNS = {
    r"^permission is hereby granted free of charge to any person obtaining a copy of this software": "MITGrant",
    r"^permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ISCGrant",
    r"^the software is provided as is without warranty of any kind": "MITNoWarranty",
    r"^this software is provided by .* as is and any express or implied warranties": "BSDNoWarranty",
    r"^neither the name .* endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    r"^this program is free software you can redistribute it and or modify it under the terms of the gnu general public license .*version 3": "GPL3Grant",
    r"^this program is free software you can redistribute it and or modify it under the terms of the gnu general public license .*version 2": "GPL2Grant",
    r"^spdx license identifier apache 2.0$": "SPDXApache2",
    r"^spdx license identifier mit$": "SPDXMIT",
    r"^spdx license identifier gpl 3.0": "SPDXGPL3",
    r"^copyright (c )?[0-9]{4}": "Copyright",
}

# Ordered rules, the more specific sequence first.
RULES = [
    ("Apache-2.0", ["ApacheHeader", "ApacheComply", "ApacheObtain"]),
    ("BSD-3-Clause", ["BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDSource", "BSDBinary"]),
    ("MIT", ["MITTitle", "Copyright", "MITGrant", "MITInclude"]),
    ("MIT", ["MITGrant", "MITInclude", "MITNoWarranty"]),
    ("MIT", ["MITGrant", "MITInclude"]),
    ("ISC", ["ISCGrant"]),
    ("GPL-3.0-or-later", ["GPL3Grant", "GPLNoWarranty"]),
    ("GPL-2.0-or-later", ["GPL2Grant", "GPLNoWarranty"]),
    ("GPL-3.0", ["GPL3Title"]),
    ("GPL-2.0", ["GPL2Title"]),
    ("GPL-3.0", ["GPL3Notice"]),
    ("Apache-2.0", ["ApacheTitle"]),
    ("Apache-2.0", ["ApacheNotice"]),
    ("Apache-2.0", ["SPDXApache2"]),
    ("MIT", ["SPDXMIT"]),
    ("MIT", ["MITNotice"]),
    ("MIT", ["MITTitle"]),
    ("GPL-3.0", ["SPDXGPL3"]),
    ("CC-BY-NC-4.0", ["CCBYNC4Notice"]),
    ("CC-BY-SA-4.0", ["CCBYSA4Notice"]),
    ("CC-BY-4.0", ["CCBY4Notice"]),
    ("MPL-2.0", ["MPL2Notice"]),
    ("Unlicense", ["Unlicense"]),
    ("none", ["NoLicense"]),
]

# Every known sentence has one of these; ``test_every_sentence_has_an_anchor`` holds them to it.
ANCHORS = ["licen", "copyright", "permission", "warrant", "redistribut", "general public", "public domain", "all rights"]

GAP = "-"

# Kinds that end with their line; the other patterns open a sentence that runs on over wrapped lines.
ONE_LINE = {"SPDXApache2", "SPDXMIT", "SPDXGPL3", "Copyright"}

# Steps from a text to its normalised form, one after the other: "|" is the end of a sentence,
# "/" a line break that may stand inside one.
NORMAL = [
    # Comment signs and indentation before a line; an item such as "1)" or "(a)" starts a sentence.
    (r"(?md)^[^a-z0-9|\n]*+(?:[0-9]{1,2}|[a-z])[)][ \t]", "|"),
    (r"(?md)^[^a-z0-9.!?;|\n]*+(?:rem|dnl)\b", ""),
    (r"(?md)^[^a-z0-9|\n]++", ""),
    # Ends of sentences, also before closing signs at the end of a line.
    (r"[.!?;]++(?=[ \t\n]|$)", "|"),
    (r"[^a-z0-9.|\n]+", " "),
    # A single line break may be a wrapped line; whatever else separates is an end.
    (r"(?<![ .|\n]) ?\n(?![ .|\n])", "/"),
    (r"(?<![ .|\n])[ .]*+[|\n][ .|\n]*+", "|"),
    (r"^[ .|\n]++|(?<![ .|])[ .|]++$", ""),
    # The numbers of items such as "1." are not sentences.
    (r"(?:^|[|/])(?:[0-9]{1,2}|[a-z])(?=[|])", ""),
]


def normalised(text: Column) -> Column:
    """A text in lower case words, with marks where sentences end and where lines break."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    out = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), upper + "\r|", lower + "\n,")
    for pattern, by in NORMAL:
        out = F.regexp_replace(out, pattern, by)
    return out


def _expressions() -> list[tuple[str, str]]:
    """(expression over normalised text, replacement) of each known sentence, the longest first.

    A sentence starts and ends where a line or sentence does, and may be wrapped anywhere between.
    """
    start, end = "(?<![^|/])", "(?![^|/])"
    out = []
    for pattern, name in PATTERNS.items():
        body = pattern.removeprefix("^").replace(".*", "[^|<]*").replace(" ", "[ /]")
        body = body.removesuffix("$") + end if body.endswith("$") else body + "[^|/<]*"
        out.append((start + body, _token(name) + ("" if name in ONE_LINE else "~")))
    for sentence in sorted(SENTENCES, key=len, reverse=True):
        # "v. 2.0" is cut behind its abbreviation.
        body = sentence.replace(". ", "\0").replace(".", "[.]").replace(" ", "[ /]").replace("\0", "[ /|]")
        out.append((start + body + end, _token(SENTENCES[sentence])))
    return out


def identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences in order, one gap wherever other sentences stand between."""
    out = normalised(text)
    for expression, by in _expressions():
        out = F.regexp_replace(out, expression, by)
    # An opened sentence goes on to its end, or to the next known one.
    out = F.regexp_replace(out, "~[^|<]*+", "")
    out = F.regexp_replace(out, "(?:^|(?<=>))[^<a-z0-9]*+[a-z0-9][^<]*+", _token(GAP))
    return F.regexp_replace(out, "(?:^|(?<=>))[^<]++", "")


def _token(name: str) -> str:
    return f"<{name}>"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, sentence_ids (with gaps), licences in order of the rules."""
    between = "[^a-z0-9]+(?:(?:rem|dnl)[^a-z0-9]+)?"
    anchored = F.col("text").rlike("(?i)" + "|".join(a.replace(" ", between) for a in ANCHORS))
    ids = id_and_text(docs).select("doc_id", F.when(anchored, identifiers(F.col("text"))).alias("_ids"))
    # At the ends, gaps say nothing.
    trimmed = F.regexp_replace(F.coalesce("_ids", F.lit("")), "^(<->)|(<->)$", "")
    ids = ids.select("doc_id", trimmed.alias("_ids"))
    rest, found = F.col("_ids"), []
    for licence, names in RULES:
        sequence = "".join(map(_token, names))
        found.append(F.when(F.contains(rest, F.lit(sequence)), F.lit(licence)))
        rest = F.replace(rest, F.lit(sequence), F.lit("<+>"))
    granted = F.array_distinct(F.array_compact(F.array(*found)))
    granted = F.when(F.size(granted) > 1, F.array_remove(granted, "none")).otherwise(granted)
    licences = F.when(F.col("_ids") == "", F.lit("")).otherwise(F.array_join(granted, ","))
    listed = F.regexp_replace(F.regexp_replace("_ids", "><", ","), "[<>]", "")
    return ids.select("doc_id", listed.alias("sentence_ids"), licences.alias("licences"))
