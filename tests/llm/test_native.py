"""Licences, mixing and quality rules."""

import hashlib
import math
import random
import re
import textwrap

from pyspark.sql import functions as F

from tarmac.llm import licences, mixing, quality_classifier, quality_rules
from tarmac.llm.licences import ANCHORS, PATTERNS, RULES, SENTENCES
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_sentence_has_an_anchor():
    for text in [*SENTENCES, *PATTERNS]:
        assert any(a in text for a in ANCHORS), text
    known = {*SENTENCES.values(), *PATTERNS.values()}
    assert all(set(names) <= known for _, names in RULES)


def test_licence_texts(docs):
    mit = (
        "MIT License\n\nCopyright (c) 2020 Some One\n\nPermission is hereby granted, free of charge, to any person "
        "obtaining a copy of this software and so on.\nThe above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    )
    texts = [
        mit,
        "Of the\nLicensed under the Apache License, Version 2.0.",
        "LICENSED UNDER CC BY-NC 4.0. And more. Released under the MIT License.",
        "a licence of no kind",
        "",
    ]
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in licences.scan(docs(*texts)).collect()}
    assert got[0] == ("MITTitle,Copyright,MITGrant,MITInclude", "MIT")
    assert got[1][1] == "Apache-2.0"
    assert got[2] == ("CCBYNC4Notice,-,MITNotice", "MIT,CC-BY-NC-4.0")
    assert got[3] == got[4] == ("", "")


# Every kind of licence line in the given documents, labelled by hand.
LABELLED = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "All rights reserved.": "none",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_licence_lines_of_given_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id IS NOT NULL")
    want = {r["doc_id"]: ",".join({LABELLED[x] for x in (r["text"] or "").split("\n") if x in LABELLED}) for r in frame.collect()}
    got = {r["doc_id"]: r["licences"] for r in licences.scan(frame).collect()}
    assert got == want
    assert {*LABELLED.values()} <= {*want.values()}


def test_reserved_rights_beside_a_licence(docs):
    texts = ["Copyright 2020 X. All rights reserved.", "(c) X\nAll rights reserved.\nLicensed under the MIT License."]
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs(*texts)).collect()}
    assert got == {0: "none", 1: "MIT"}


AS_IS = "IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES."
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
GPL_NO_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of FITNESS. See the GNU General Public License for more details."
)
BSD = [
    "Copyright (c) 2020, Some One\nAll rights reserved.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
]
# Paragraphs as their licences have them.
FULL = {
    "MIT": [
        "Copyright (c) 2020 Some One",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE " + AS_IS,
    ],
    "BSD-2-Clause": [*BSD, "THIS SOFTWARE " + AS_IS],
    "BSD-3-Clause": [
        *BSD,
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "GPL-3.0-or-later": [GPL.format(3), GPL_NO_WARRANTY],
    "GPL-2.0-or-later": [GPL.format(2), GPL_NO_WARRANTY],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def test_wrapped_licence_texts(docs):
    texts, want = [], []
    for licence, paragraphs in FULL.items():
        for width in (30, 60, 70, 80, 10_000):
            for sign in ("", "# ", " * ", "// ", "\t", ";; ", "REM "):
                for newline in ("\n", "\r\n"):
                    lines = "\n\n".join("\n".join(textwrap.fill(x, width) for x in p.split("\n")) for p in paragraphs).split("\n")
                    texts.append(newline.join(["x = 1", "", *((sign + x).rstrip() for x in lines), "", "y = 2"]))
                    want.append(licence)
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs(*texts)).collect()}
    assert {texts[i]: x for i, x in got.items() if x != want[i]} == {}


def test_lines_stay_apart(docs):
    texts = [
        "Project X\nMIT License\nCopyright 2020 X\nReleased under the MIT License\nmore text",
        "free words here\nAll rights\nreserved",
        "Licensed under the\n\nMIT License of some sort",
        "(1) Licensed under the\n    MIT License",
    ]
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in licences.scan(docs(*texts)).collect()}
    assert got == {0: ("MITTitle,Copyright,MITNotice", "MIT"), 1: ("NoLicense", "none"), 2: ("", ""), 3: ("MITNotice", "MIT")}


def test_samples_of_repeated_ids_are_the_same_in_every_run(spark):
    rows = [(k, " ".join(f"w{(k * 31 + i * 7 + j) % 97}" * (1 + j % 3) for j in range(20 + i)) + "!" * (i % 5)) for k in range(6) for i in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, quality int")
    lists, scores = [], []
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        lists.append(quality_rules.labelled_rows(frame, labels, most=5))
        model = quality_classifier.train(frame, labels, most=5)
        scores.append([model.score(t.encode()) for _, t in sorted(rows)[:5]])
    assert all(x == lists[0] for x in lists) and len(lists[0]) == 20
    assert all(x == scores[0] for x in scores) and scores[0][0] != 0.5
    # The rows taken are those with the smallest hashes.
    chosen = sorted(range(6), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:5]
    key = lambda k, t: hashlib.md5(f"{k}:{hashlib.sha256(t.encode()).hexdigest()}".encode()).hexdigest()
    order = sorted((r for r in rows if r[0] in chosen), key=lambda r: key(*r))
    kept = spark.createDataFrame(order[:20], "doc_id long, text string")
    assert quality_rules.labelled_rows(kept, labels, most=5) == lists[0]


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Hand out the budget round by round; capped sources leave."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= weight[s] * level}
        if not full:
            out |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_equal_brute_force(spark):
    draw = random.Random(3)
    for _ in range(6):
        sizes = {draw.choice(["", "é"]) + f"s{i}": draw.choice([0, 1, 5, 40, 1000, 90_000]) for i in range(draw.randint(1, 9))}
        sizes[None] = draw.randint(0, 50)
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_mix_takes_rates_and_keeps_columns(spark):
    rows = [(i, "w " * 10, "en", "hot" if i % 3 else f"s{i % 9}", 20) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sized = docs.select("doc_id", "source", mixing.text_size(F.col("text")).alias("size"))
    plan = mixing.plan(sized)
    assert sorted(map(tuple, plan.collect()), key=str) == sorted(map(tuple, mixing.plan(sized).collect()), key=str)
    sums = plan.groupBy("source", "target", "source_size").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
    for r in sums.collect():
        assert abs(r["taken"] - r["target"]) <= 0.1 * r["target"]
    assert plan.where("copies > 3 OR copies < 0").isEmpty()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in plan.where("copies > 0").collect()}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_mix_of_odd_rows(odd):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() >= 0
    assert mixing.mix(odd.limit(0)).count() == 0


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in where.values() if len(places) > 1 for i in places for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check_counts(docs):
    got = quality_rules.judge(docs, quality_rules.DecisionList()).collect()
    texts = docs.select("doc_id", "text").collect()
    found = sorted(tuple(r)[:7] + (r["kept"],) for r in map(lambda r: [-1 if x is None else x for x in r] and r, got) if r["doc_id"] is not None)
    want = []
    for r in texts:
        if r["doc_id"] is None:
            continue
        counts = brute_counts(r["text"])
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        want.append((r["doc_id"], *counts, failed, not failed))
    assert found == sorted(want)
    assert len(got) == len(texts)


def test_statistics_equal_brute_force(spark, docs, odd):
    check_counts(spark.read.parquet(f"{SF}/documents.parquet"))
    check_counts(odd)
    a = " ".join(f"w{i}" for i in range(8))
    check_counts(docs(a, f"{a} {a}", f"{a} x {a}", "o " * 100, f"q {a}\n{a}\n\n{a}", "a\nb\na\n \n\t\n"))


def test_rules_are_learned_pruned_and_ordered():
    draw = random.Random(5)
    rows = []
    for _ in range(1500):
        symbols, capitals = draw.random() * 0.2, draw.random()
        bad = symbols > 0.1 or capitals > 0.7
        rows.append((draw.randint(20, 900), 5.0, symbols, capitals, 0.0, 0.0, 0.0, 0.0, int(bad)))
    learned = quality_rules.learn(rows)
    verdicts = [not any(all(c.holds(r) for c in rule) for rule in learned.rules) for r in rows]
    assert sum(v != (r[-1] == 0) for v, r in zip(verdicts, rows)) <= 30
    assert 2 <= len(learned.rules) <= 4
    assert quality_rules.learn([]) == quality_rules.learn([r[:-1] + (0,) for r in rows]) == quality_rules.DecisionList()


def test_expression_equals_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rules = quality_rules.decision_list(docs, labels)
    stats, name = quality_rules.with_statistics(docs.select("doc_id", "text"))
    values = quality_rules.features(F.col(name))
    rows = stats.select(rules.keeps(F.col(name)).alias("kept"), *[values[f].alias(f) for f in quality_rules.FEATURES])
    for r in rows.collect():
        row = tuple(r)[1:] + (0,)
        assert r["kept"] == (not any(all(c.holds(row) for c in rule) for rule in rules.rules))




def test_keep_good_keeps_columns(odd, spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (5, 2)], "doc_id long, quality int")
    rules = quality_rules.decision_list(odd, labels)
    assert rules == quality_rules.DecisionList()
    kept = quality_rules.keep_good(odd, rules)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 6, 6, 7]  # the long texts repeat themselves
    assert quality_rules.keep_good(odd.limit(0), rules).count() == 0
    assert licences.scan(odd).count() == odd.count()
    assert licences.scan(odd.limit(0)).count() == 0
