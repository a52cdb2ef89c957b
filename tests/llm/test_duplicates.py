"""Repeated passages, near duplicates, the pipeline, the registered queries."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import TABLES, rows
from tarmac.llm import linked_groups, minhash, quality_rules, repeated_passages, sentence_pieces
from tarmac.llm.oracles import ORACLES
from tarmac.llm.queries import QUERIES
from tarmac.llm.word_blocks import blocks
from tests.conftest import SF


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


def test_ten_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()) == list(range(1, 11))


def test_words_are_cut_like_split():
    texts = ["a b  c", "", " x\ty ", "ab", "a", "b c", "é\x85 z\x1c w\n"] * 50
    for first, words in blocks(pa.array(texts)):
        for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
            found = [words.blob[s:e].tobytes() for s, e in zip(words.begins[a:b], words.ends[a:b])]
            assert found == texts[first + i].encode().split()


def brute_cut(texts):
    """[(id, text)] to [(id, n_words, n_removed, kept)], on the whole input."""
    split = [(k, (t or "").encode().split()) for k, t in texts]
    low = {}
    for k, w in split:
        for i in range(len(w) - 12) if k is not None else ():
            s = tuple(w[i : i + 13])
            low[s] = min(low.get(s, k), k)
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - 12) if k is not None else ():
            if low[tuple(w[i : i + 13])] < k:
                gone |= set(range(i, i + 13))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((k, kept, len(w), len(gone)))
    return sorted(out, key=str)


def test_passages_equal_brute_force(spark, odd):
    draw = random.Random(4)
    pool = [" ".join(draw.choice("abcdefgh") for _ in range(draw.randint(5, 40))) for _ in range(30)]
    made = [(i, "  ".join(draw.choice(pool) for _ in range(draw.randint(0, 4)))) for i in range(200)]
    made += [(1000 + i, pool[0] + " " + pool[1]) for i in range(60)]
    made += [(2000 + i, "of " * (30 + i)) for i in range(4)]
    frames = [
        spark.createDataFrame(made, "doc_id long, text string"),
        odd,
        spark.read.parquet(f"{SF}/documents.parquet"),
    ]
    for frame in frames:
        want = brute_cut([(r["doc_id"], r["text"]) for r in frame.collect()])
        for bits in (22, 20):
            got = repeated_passages.remove_repeats(frame, bits).collect()
            assert sorted((tuple(r) for r in got), key=str) == want
    assert repeated_passages.remove_repeats(odd.limit(0), 20).count() == 0


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    """With far too few counters every window reaches the exact pass; the result stays."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    full = np.full(1 << 20, 0xFF, np.uint8)
    monkeypatch.setattr(repeated_passages, "sketch", lambda texts, bits: full)
    got = repeated_passages.remove_repeats(docs, 20).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_cut([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_sketch_is_never_too_low(spark, docs):
    texts = ["one two three four five six seven eight nine ten eleven twelve thirteen fourteen"] * 20 + ["x " * 20]
    counts = repeated_passages.sketch(docs(*texts), 20)
    _, words = next(blocks(pa.array(texts[:1])))
    runs, fits = repeated_passages.run_of_windows(words)
    assert repeated_passages.estimates(counts, runs[fits], 20).tolist() == [15, 15]


def brute_groups(texts):
    sets = []
    for k, t in texts:
        w = (t or "").encode().lower().split()
        sets.append((k, {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a is not None and b is not None and x and y:
                common = len(x & y)
                if 100 * common >= 75 * (len(x) + len(y) - common):
                    parent[root(i)] = root(j)
    smallest = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            smallest[root(i)] = min(smallest.get(root(i), k), k)
    out = []
    for i, (k, s) in enumerate(sets):
        component = None if k is None else smallest[root(i)]
        out.append((k, len(s), component, component == k))
    return sorted(out, key=str)


def edited(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark, odd):
    draw = random.Random(9)
    made = []
    for g in range(12):
        words = [f"g{g}w{draw.randrange(10**5)}" for _ in range(draw.choice([6, 30, 120]))]
        for _ in range(draw.randint(2, 25)):
            # A chain of edits: neighbours link, the ends do not.
            words = edited(draw, words, draw.randint(0, max(1, len(words) // 60))).split()
            made.append((len(made) * 7 % 1000 + 1000 * (len(made) // 1000), " ".join(words)))
    shared = " ".join(f"s{i}" for i in range(60))
    made += [(5000 + i, shared + " " + " ".join(f"t{i}x{j}" for j in range(draw.randint(0, 60)))) for i in range(60)]
    for frame in (spark.createDataFrame(made, "doc_id long, text string"), spark.read.parquet(f"{SF}/documents.parquet")):
        want = brute_groups([(r["doc_id"], r["text"]) for r in frame.collect()])
        got = minhash.near_duplicates(frame).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_texts_under_one_id_link_each(spark):
    draw = random.Random(17)
    made = []
    for k in range(40):
        for at in (100, 200, 300):
            words = [f"x{draw.randrange(10**6)}" for _ in range(80)]
            # Three unlike texts under one id, each with a near copy under an id of its own, above or below.
            made += [(1000 + k, " ".join(words)), (at + k if at < 300 else 3000 + k, edited(draw, words, 1))]
    same = [f"y{i}" for i in range(80)]
    made += [(5000, " ".join(same)), (5000, edited(draw, same, 1)), (5001, edited(draw, same, 1))]
    draw.shuffle(made)
    frame = spark.createDataFrame(made, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=str)
    assert got == brute_groups(made)
    kept = [r["doc_id"] for r in minhash.keep_one(frame).collect()]
    assert sorted(kept) == sorted([100 + k for k in range(40)] + [200 + k for k in range(40)] + [1000 + k for k in range(40)] + [5000])


def test_odd_near_duplicates(odd):
    got = sorted((tuple(r) for r in minhash.near_duplicates(odd).collect()), key=str)
    assert got.count((6, 36, 6, True)) == 2 and (7, 36, 6, False) in got
    assert (None, 36, None, True) in got and (2, 0, 2, True) in got and (1, 0, 1, True) in got
    assert [r[2] for r in got if r[0] == 5] == [4]
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect())
    assert ids == [0, 0, 1, 2, 3, 4, 6, 6, 8]
    assert minhash.keep_one(odd.limit(0)).count() == minhash.near_duplicates(odd.limit(0)).count() == 0


def test_estimate_follows_similarity(spark):
    draw = np.random.default_rng(1)
    pairs = []
    for target in (0.0, 0.5, 0.75, 0.9, 1.0):
        for _ in range(40):
            common, own = draw.integers(0, 1 << 63, 400).astype(np.uint64), draw.integers(0, 1 << 63, (2, 400)).astype(np.uint64)
            n = int(round(400 * 2 * target / (1 + target)))
            x, y = (np.concatenate([common[:n], o[n:]]) for o in own)
            pairs.append((target, *[minhash.planes(minhash.minima(np.unique(s))).tolist() for s in (x, y)]))
    frame = spark.createDataFrame(pairs, "target double, a array<long>, b array<long>")
    for r in frame.groupBy("target").agg({"like": "avg"}).collect() if "like" in frame.columns else (
        frame.withColumn("like", minhash.likeness(frame["a"], frame["b"])).groupBy("target").avg("like").collect()
    ):
        assert abs(r[1] - r["target"]) < 0.03


def test_groups_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(500, 500 + i) for i in range(1, 300)] + [(9, 9), (700, 3000), (3000, 700)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["smallest"] for r in linked_groups.groups(frame).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{500 + i: 500 for i in range(300)}, 3000: 500}
    assert linked_groups.groups(frame.limit(0)).count() == 0


def test_pipeline_equals_brute_force(spark):
    """Stage by stage on the smallest tables, each stage against plain Python."""
    from tests.llm.test_native import brute_counts
    from tests.llm.test_scans import brute_base

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "secrets", "mixing", "tokens"]
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept[name] = [r.asDict() for r in docs.collect()]
        if name != "tokens":
            assert docs.columns == documents.columns
            docs = spark.createDataFrame([tuple(r.values()) for r in kept[name]], documents.schema)
    rules = quality_rules.decision_list(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    judged = {r["doc_id"]: r["kept"] for r in quality_rules.judge(documents, rules).collect()}
    for r in documents.collect():
        n, _, _, _, repeated = brute_counts(r["text"])
        if n < 20 or 100 * repeated > 30 * n:
            assert not judged[r["doc_id"]]
    good = sorted(k for k, v in judged.items() if v)
    assert sorted(r["doc_id"] for r in kept["quality rules"]) == good
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    firsts = [r[0] for r in brute_groups([(k, texts[k]) for k in good]) if r[3]]
    assert sorted(r["doc_id"] for r in kept["near duplicates"]) == sorted(firsts)
    assert sorted(r["doc_id"] for r in kept["secrets"]) == sorted(firsts)
    assert not any(brute_base(r["text"]) for r in kept["secrets"])
    clean = {r["doc_id"]: r["text"] for r in kept["secrets"]}
    for k in firsts:
        if not brute_base(texts[k]):
            assert clean[k] == texts[k]
    assert {r["doc_id"] for r in kept["mixing"]} <= set(firsts)
    coder = sentence_pieces.Coder(sentence_pieces.read_model())
    assert sorted(r["doc_id"] for r in kept["tokens"]) == sorted(r["doc_id"] for r in kept["mixing"])
    for r in kept["tokens"]:
        assert r["restored"] and coder.decode(r["ids"]) == clean[r["doc_id"]]


def test_digests(spark):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {k: (n, g, hashlib.sha256(kept.encode()).hexdigest()) for k, kept, n, g in brute_cut(list(text.items()))}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op7_repeated_passages"](spark, SF).collect()}
    assert got == want
