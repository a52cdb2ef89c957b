"""b-bit MinHash near-dedup.

1. Each text becomes a set of five-word shingles (lower-case A-Z; fewer words: all of them as
   one shingle). One pass gives the set's size, a 128-bit key of the set, 128 minima,
   32 band keys of four minima each, and the four low bits of every minimum, packed as
   bit planes. Texts with equal sets are one class from there on.
2. Classes that share a band are candidates. In each band a class is paired with the
   band's hub only, the class that shares most bands with others. Likeness comes from the
   packed bits: bit counts of the planes' differences, corrected for equal bits by chance.
3. Candidates are confirmed on the words themselves: 100 * common >= 75 * all.
4. Bands whose classes are still in several groups are then searched in full, between
   groups only, so no link between candidates is lost, and no pairs are formed inside a
   group that hangs together already. Single bits of 2048 further minima, taken for these
   classes only, tell pairs just below the similarity from pairs that reach it.

With 32 bands of four, a pair at similarity 0.75 is no candidate once in 2 * 10^5, and
less above; a pair that reaches 0.75 is estimated below 0.5 once in 10^9.

Defined results: a NULL or empty text has no shingles and links with nothing; rows with
equal sets are one group whatever their ids; of several texts under one id each links
by its own set; rows with a NULL id link with nothing, have
a NULL component and are kept; repeated rows get the same result each; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.config import durable
from tarmac.llm.common import fresh, id_and_text
from tarmac.llm.linked_groups import groups
from tarmac.llm.word_blocks import Words, blocks, mixed

SHINGLE = 5
HASHES = 128
BANDS = 32
BITS = 4
LIKELY = 0.5
# One bit each of so many more minima, for classes whose bands are searched in full. At similarity
# 0.75 their estimate has a standard deviation of 0.015, so 0.67 cuts off nothing in practice.
FINE_HASHES = 2048
FINE_LIKELY = 0.67
PERCENT = 75
_SALT = 41

_RANDOM = np.random.default_rng(97)
_TIMES = (_RANDOM.integers(0, 1 << 31, HASHES) * 2 + 1).astype(np.uint32)
_PLUS = _RANDOM.integers(0, 1 << 32, HASHES).astype(np.uint32)

_FINE_TIMES = (_RANDOM.integers(0, 1 << 31, FINE_HASHES) * 2 + 1).astype(np.uint32)
_FINE_PLUS = _RANDOM.integers(0, 1 << 32, FINE_HASHES).astype(np.uint32)

SIGNED = "struct<n_shingles:long,k1:long,k2:long,planes:array<long>,bands:array<long>>"
KEYED = "struct<n_shingles:long,k1:long,k2:long>"


def shingle_sets(words: Words) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes, fits = words.windows(SHINGLE)
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= SHINGLE:
            yield np.unique(hashes[a:b][fits[a:b]])
        elif b > a:
            yield words.runs(np.array([a]), np.array([b]))
        else:
            yield np.empty(0, np.uint64)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set; equal sets have equal keys."""
    if not len(shingles):
        return 0, 0
    n = np.uint64(len(shingles))
    keys = [mixed(np.array([mixed(shingles + np.uint64(salt)).sum() + n]))[0] for salt in (1, _SALT)]
    return tuple(int(k) for k in np.array(keys).view(np.int64))


def minima(shingles: np.ndarray, times: np.ndarray = _TIMES, plus: np.ndarray = _PLUS) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(times), 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 19) // len(times))
    for at in range(0, len(x), step):
        part = times[:, None] * x[None, at : at + step] + plus[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def fine_bits(shingles: np.ndarray) -> np.ndarray:
    """One well-mixed bit of each of the further minima, packed into longs."""
    least = minima(shingles, _FINE_TIMES, _FINE_PLUS)
    return np.packbits((least * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint8)).view(np.int64)


def planes(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima: for each bit two longs of 64 positions."""
    bits = (least[None, :] >> np.arange(BITS, dtype=np.uint32)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64).ravel()


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, -1).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        key = mixed(key * np.uint64(31) + rows[:, i])
    return key.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rows) if rows else [], pa.int64()))


def _signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    none = np.empty(0, np.int64)
    for batch in batches:
        sizes, keys, packed, bands = [], [], [], []
        for _, words in blocks(batch, fold=True):
            for shingles in shingle_sets(words):
                sizes.append(len(shingles))
                keys.append(set_key(shingles))
                least = minima(shingles) if len(shingles) else None
                packed.append(none if least is None else planes(least))
                bands.append(none if least is None else band_keys(least))
        k1, k2 = zip(*keys) if keys else ((), ())
        columns = [
            pa.array(sizes, pa.int64()),
            pa.array(k1, pa.int64()),
            pa.array(k2, pa.int64()),
            _lists(packed),
            _lists(bands),
        ]
        yield pa.StructArray.from_arrays(columns, ["n_shingles", "k1", "k2", "planes", "bands"])


def _keyed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sizes, keys = [], []
        for _, words in blocks(batch, fold=True):
            for shingles in shingle_sets(words):
                sizes.append(len(shingles))
                keys.append(set_key(shingles))
        k1, k2 = zip(*keys) if keys else ((), ())
        columns = [pa.array(x, pa.int64()) for x in (sizes, k1, k2)]
        yield pa.StructArray.from_arrays(columns, ["n_shingles", "k1", "k2"])


def _fine(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield _lists([fine_bits(s) for _, words in blocks(batch, fold=True) for s in shingle_sets(words)])


# Characters of the texts whose sets are kept for the next pairs of a batch.
KEPT_CHARS = 1 << 20


class _Sets:
    """Shingles of the last texts seen: neighbouring pairs share a text."""

    def __init__(self):
        self.kept: OrderedDict[str, frozenset] = OrderedDict()
        self.chars = 0

    def of(self, text: str) -> frozenset:
        if text in self.kept:
            self.kept.move_to_end(text)
            return self.kept[text]
        found = _set_of(text)
        self.kept[text] = found
        self.chars += len(text)
        # The last two stay, however long: they are the pair at hand.
        while self.chars > KEPT_CHARS and len(self.kept) > 2:
            self.chars -= len(self.kept.popitem(last=False)[0])
        return found


def _set_of(text: str) -> frozenset:
    words = text.encode().translate(_LOWER).split()
    if len(words) < SHINGLE:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(SHINGLE))))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def linked(a: str, b: str, percent: int = PERCENT, sets: _Sets | None = None) -> bool:
    """Whether two texts share enough of their shingles, by the words themselves."""
    sets = sets or _Sets()
    x, y = sets.of(a), sets.of(b)
    if not x or not y:
        return False
    common = len(x & y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(a: pa.Array, b: pa.Array) -> pa.Array:
    sets = _Sets()
    return pa.array([linked(x.as_py(), y.as_py(), sets=sets) for x, y in zip(a, b)], pa.bool_())


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two packed signatures."""
    differing = []
    for half in range(2):
        parts = [F.get(a, F.lit(2 * k + half)).bitwiseXOR(F.get(b, F.lit(2 * k + half))) for k in range(BITS)]
        either = parts[0]
        for p in parts[1:]:
            either = either.bitwiseOR(p)
        differing.append(F.bit_count(either))
    equal = 1 - (differing[0] + differing[1]) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def _close(a: str, b: str) -> Column:
    """Sizes that allow the similarity, and a likely estimate."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & (likeness(F.col(f"{a}.planes"), F.col(f"{b}.planes")) >= LIKELY)


def fine_likeness(a: Column, b: Column) -> Column:
    """Estimated similarity from single bits, which agree by chance half the time."""
    differing = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, c: n + c
    )
    return 1 - differing * (2.0 / FINE_HASHES)


def _first_band(a: str, b: str) -> Column:
    """Whether the band two rows meet in is the first one they share, so that a pair comes once."""
    shared = F.filter(F.col(f"{a}.bands"), lambda band, i: band == F.get(F.col(f"{b}.bands"), i))
    return F.get(shared, F.lit(0)) == F.col(f"{a}.band")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold on the texts."""
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(F.arrow_udf(_confirmed, "boolean")("a_text", "b_text")).select("a", "b")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, text) of the wanted classes, each from a row of its smallest id that has its set."""
    keys = classes.select("cid", "doc_id", "k1", "k2")
    ids = keys.join(wanted.select("cid").distinct(), "cid", "left_semi").select("doc_id").distinct()
    found = docs.join(ids, "doc_id").select("doc_id", "text", F.arrow_udf(_keyed, KEYED)("text").alias("k"))
    sure = found.select("doc_id", "text", "k.k1", "k.k2").join(keys, ["doc_id", "k1", "k2"])
    return sure.groupBy("cid").agg(F.first("text").alias("text"))


def components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, k1, k2) per row, and (k1, k2, doc_id, component, first) per class of equal sets.

    A class has its smallest id and the smallest one of its group; of each group one class is the first.
    Between, a class goes by a number of its own (cid), as one id may stand at several texts.
    """
    read = id_and_text(docs)
    signed = durable(read.select("doc_id", F.arrow_udf(_signed, SIGNED)("text").alias("s")).select("doc_id", "s.*"), "signed")
    classes = durable(
        signed.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").cast("long").alias("doc_id"),
            F.first(F.struct("n_shingles", "planes", "bands")).alias("s"),
        )
        .select("k1", "k2", "doc_id", F.monotonically_increasing_id().alias("cid"), "s.*"),
        "classes",
    )
    members = classes.select("cid", F.explode("bands").alias("band"))
    shared = durable(members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = durable(members.join(shared, "band"), "members")
    texts = durable(_texts(read, classes, members), "texts")
    facts = classes.select("cid", "n_shingles", "planes")

    # The class that shares most bands with others is the likeliest to link with them all: it is
    # the hub of its bands.
    central = durable(members.groupBy("cid").agg(F.sum("n").alias("weight")), "central")
    # Ties go by the set's key, which is the same in every run.
    weighed = members.join(central.join(classes.select("cid", "k1"), "cid"), "cid")
    hubs = weighed.groupBy("band").agg(F.max(F.struct("weight", "k1", "cid")).alias("top"))
    hubs = durable(hubs.select("band", F.col("top.cid").alias("hub")), "hubs")
    stars = members.join(hubs, "band").where("cid <> hub").select("cid", "hub").distinct()
    rated = durable(
        stars.join(facts.alias("x"), "cid")
        .join(facts.select(F.col("cid").alias("hub"), "n_shingles", "planes").alias("y"), "hub")
        .where(_close("x", "y"))
        .select(F.col("hub").alias("a"), F.col("cid").alias("b")),
        "rated",
    )
    links = durable(_links(rated, texts), "links")
    found = groups(links).select(F.col("id").alias("cid"), F.col("smallest").alias("label"))
    label = durable(found, "labels")

    # Then all pairs between groups in the bands that still hold several.
    labelled = members.join(label, "cid", "left").select("band", "cid", F.coalesce("label", "cid").alias("label"))
    several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_bands = durable(several.where("low < high").select("band"), "open")
    open_members = durable(labelled.join(open_bands, "band"), "open")
    open_texts = texts.join(open_members.select("cid").distinct(), "cid", "left_semi")
    fine = durable(open_texts.select("cid", F.arrow_udf(_fine, "array<long>")("text").alias("fine")), "fine")
    described = classes.select("cid", "n_shingles", "planes", "bands").join(fine, "cid")
    rest = durable(open_members.join(described, "cid"), "rest")
    x, y = rest.alias("x"), rest.alias("y")
    met = (F.col("x.band") == F.col("y.band")) & (F.col("x.label") < F.col("y.label"))
    alike = _close("x", "y") & (fine_likeness(F.col("x.fine"), F.col("y.fine")) >= FINE_LIKELY)
    pairs = x.join(y, met & alike & _first_band("x", "y")).select(
        F.col("x.cid").alias("a"), F.col("y.cid").alias("b")
    )
    tried = rated.unionByName(rated.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = durable(_links(durable(pairs.join(tried, ["a", "b"], "left_anti"), "pairs"), texts), "more")
    final = durable(groups(links.unionByName(more)), "final")
    named = classes.select("k1", "k2", "doc_id", "cid").join(final.withColumnRenamed("id", "cid"), "cid", "left")
    named = durable(named.select("k1", "k2", "doc_id", F.coalesce("smallest", "cid").alias("label")), "named")
    tops = named.groupBy("label").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("top"))
    first = F.struct("doc_id", "k1", "k2") == F.col("top")
    ranked = named.join(tops, "label").select("k1", "k2", "doc_id", F.col("top.doc_id").alias("component"), first.alias("first"))
    return signed.select("doc_id", "n_shingles", "k1", "k2"), durable(ranked, "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    rows, classes = components(docs)
    named = rows.join(classes.select("k1", "k2", "component"), ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, of which no group keeps another.

    Of repeated rows of a kept text one stays; texts without words and rows without an id all stay.
    """
    _, classes = components(docs)
    key, row = fresh(docs, "_set"), fresh(docs, "_all")
    keyed = docs.select(F.struct(*docs.columns).alias(row), "doc_id", F.arrow_udf(_keyed, KEYED)(F.coalesce("text", F.lit(""))).alias(key))
    apart = F.col("doc_id").isNull() | (F.col(f"{key}.n_shingles") == 0)
    firsts = classes.where("first").select("doc_id", F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    plain = keyed.where(~apart).select(row, "doc_id", F.col(f"{key}.k1").alias("_k1"), F.col(f"{key}.k2").alias("_k2"))
    kept = plain.join(firsts, ["doc_id", "_k1", "_k2"], "left_semi")
    one = kept.dropDuplicates(["doc_id", "_k1", "_k2"]).select(row)
    both = one.unionByName(keyed.where(apart).select(row))
    return both.select(*[F.col(row)[c].alias(c) for c in docs.columns])
