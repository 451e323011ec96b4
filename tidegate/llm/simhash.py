"""Near duplicates by SimHash fingerprints, joined in binary tries.

``fingerprint`` makes 64-bit SimHash values of word shingles, ``classes`` joins documents whose fingerprints differ in few
bits. ``near_duplicates`` finds documents whose shingle sets are similar: at a similarity of 0.8 fingerprints of
unrelated texts and of copies lie too close for a budget that a trie could prune well (some 10 of 64 bits differ), so it runs
the trie join within groups of documents that share the smallest shingles under a pair of random orders (one of
``BANDS`` pairs), with a wide budget, and compares the pairs that pass by the smallest ``SKETCH`` hashes of their sets. That
is exact for sets below that size. Of larger ones it decides pairs further than ``MARGIN`` from the similarity, five
standard errors; texts between which closer pairs are left meet once more with their whole sets, group by group, so that
pairs are compared where they meet and never listed. The first ``FIRST_BANDS`` pairs of orders join most copies; groups of
the other ones whose members they have all joined are left out, before any sketch is sent.

Texts are lower-cased in A-Z; words are runs of anything but the six ASCII white-space characters. A text with fewer words
than a shingle is one shingle; a wordless text has fingerprint zero.

Defined results: null and empty texts are wordless; texts of any length are read whole; repeated rows give repeated results;
an empty table gives an empty table. A null id never names a class of rows with ids, its row still gets one; texts are told
apart by two hashes of their words, so rows without an id and several texts of one id take part like any other. Only the columns named in
the results are returned, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import trie
from .bloom import Bloom, split
from .components import components
from .frames import add_columns, saved, steps

SEED = 42
#: Bits in which linked fingerprints of one text class may differ.
BUDGET = 2
#: Shingle words and similarity of near duplicates.
WORDS, SIMILARITY = 5, 0.8
#: Pairs of smallest hashes: copies of similarity 0.8 miss all with a chance of 0.36 ** BANDS.
BANDS, FIRST_BANDS = 10, 2
SKETCH = 512
#: How far from the similarity a sketch decides.
MARGIN = 5 * (SIMILARITY * (1 - SIMILARITY) / SKETCH) ** 0.5
#: Budget of the trie within a band's groups, twice what copies of similarity 0.8 differ in.
WIDE_BUDGET = 26


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes) - 1
    begins = ends - sizes + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(begins[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Signed 64-bit word whose bits are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(df: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """``df`` with ``fingerprint``, a signed 64-bit word; a column of that name is replaced."""
    field = T.StructField("fingerprint", T.LongType())
    return add_columns(
        df, text, [field], lambda texts: [[simhash(shingle_hashes(t, words)) for t in texts.to_pylist()]]
    )


def classes(prints: DataFrame, budget: int = BUDGET, leaf: int = trie.LEAF) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``prints`` (doc_id, fingerprint).

    ``component_id`` is the smallest doc_id that links of at most ``budget`` bits reach.
    """
    prints = prints.select("doc_id", "fingerprint")
    first = saved(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "prints")
    rows = first.select(F.col("fingerprint").alias("node"), F.explode(trie.blocks(F.col("fingerprint"), budget)).alias("at"))
    rows = rows.select(
        F.concat_ws("/", F.col("at.trie").cast("string"), F.col("at.root").cast("string")).alias("group"),
        "node",
        F.col("at.word").alias("word"),
        F.col("at.depth").alias("depth"),
    )
    member = saved(components(saved(trie.self_join(rows, budget, leaf), "links")), "member")
    named = first.join(member, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("print"), "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(smallest, "component").select("print", "component_id")
    return prints.join(by_print, F.col("fingerprint") == F.col("print")).select("doc_id", "fingerprint", "component_id")


def _orders() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (
        rng.integers(0, 1 << 63, 2 * BANDS).astype(np.uint64) * np.uint64(2),
        rng.integers(0, 1 << 63, 2 * BANDS).astype(np.uint64) * np.uint64(2) + np.uint64(1),
    )


def _describe(text: str, words: int) -> tuple[int, int, int, list[int], bytes]:
    """Two hashes of all words, the fingerprint of the distinct shingles, band keys, and the smallest hashes of the set."""
    h = np.unique(shingle_hashes(text, words))
    shift, factor = _orders()
    least = np.full(2 * BANDS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(h), 8192):
        mixed = (h[at : at + 8192, None] ^ shift) * factor
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * factor).min(0))
    pairs = least.reshape(BANDS, 2)
    bands = ((pairs[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ pairs[:, 1]).view(np.int64).tolist() if len(h) else []
    return *_whole_key(text), simhash(h), bands, smallest(h).tobytes()


def smallest(h: np.ndarray) -> np.ndarray:
    """Upper halves of the smallest hashes of a sorted set; the largest value stands for none."""
    return np.minimum(h[:SKETCH] >> np.uint64(32), np.uint64(0xFFFFFFFE)).astype("<u4")


def similar_pairs(t: pa.Table) -> trie.Check:
    """Tells of pairs of rows whether the sets behind their ``sketch`` have the similarity: 1, 0, or 2 if it can't tell."""
    packed = t["sketch"].to_pylist()
    none = np.uint32(0xFFFFFFFF)
    sets = np.full((len(packed), max(len(p) for p in packed) // 4), none, np.uint32)
    for row, p in enumerate(packed):
        sets[row, : len(p) // 4] = np.frombuffer(p, "<u4")
    whole = np.array([len(p) < 4 * SKETCH for p in packed])

    def tell(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.sort(np.concatenate((sets[a], sets[b]), 1), axis=1)
        again = np.zeros(both.shape, bool)
        again[:, 1:] = both[:, 1:] == both[:, :-1]
        real = both != none
        nth = np.cumsum(~again & real, axis=1)
        # The smallest hashes of the union: all of it where both sets are whole.
        exact = whole[a] & whole[b]
        counted = real & ((nth <= SKETCH) | exact[:, None])
        shared = (again & counted).sum(1)
        union = (~again & counted).sum(1)
        union = np.maximum(union, 1)
        close = ~exact & (np.abs(shared / union - SIMILARITY) <= MARGIN)
        return np.where(close, 2, shared >= SIMILARITY * union).astype(np.int8)

    return tell


def _whole_key(text: str) -> tuple[int, int]:
    """Two hashes of all words."""
    whole = xxhash.xxh3_128_intdigest(b" ".join(text.encode().lower().split()))
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    return sign(whole >> 64), sign(whole & ((1 << 64) - 1))


def same_sets(t: pa.Table) -> trie.Check:
    """As ``similar_pairs``, of rows with their whole sets; pairs that sketches leave open are compared whole."""
    sets = [np.frombuffer(p, np.uint64) for p in t["shingles"].to_pylist()]
    quick = similar_pairs(pa.table({"sketch": pa.array([smallest(h).tobytes() for h in sets], pa.binary())}))

    def tell(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        told = quick(a, b)
        for at in np.flatnonzero(told == 2).tolist():
            x, y = sets[a[at]], sets[b[at]]
            place = np.minimum(np.searchsorted(y, x), len(y) - 1)
            shared = int((y[place] == x).sum())
            told[at] = shared >= SIMILARITY * (len(x) + len(y) - shared)
        return told

    return tell


def _whole_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` (sorted hashes as bytes) of ``nodes`` (node, k1, k2); docs are ``text``."""
    # Texts of other nodes go no further.
    known = Bloom.of(nodes.select("k1"))
    keyed = docs.select("text").mapInArrow(_kept_texts(known), "k1 long, k2 long, text string")
    one = keyed.join(nodes, ["k1", "k2"]).groupBy("node").agg(F.min("text").alias("text"))
    field = T.StructField("shingles", T.BinaryType())
    sets = add_columns(one, "text", [field], lambda texts: [[np.unique(shingle_hashes(t, words)).tobytes() for t in texts.to_pylist()]])
    return sets.select("node", "shingles")


def _kept_texts(known: Bloom):
    """Texts, null as empty, whose key the filter admits, with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                texts = [t or "" for t in b.column("text").to_pylist()]
                keys = np.array([_whole_key(t) for t in texts], np.int64).reshape(-1, 2)
                some = np.flatnonzero(known.has(keys[:, 0].copy().view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some, 0]), pa.array(keys[some, 1]), pa.array([texts[i] for i in some.tolist()], pa.string())],
                    names=["k1", "k2", "text"],
                )

    return run


def _members(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``of``, the component that the links make of each."""
    member = saved(components(links.filter("b IS NOT NULL").select("a", "b")), "member")
    named = nodes.join(member.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    return saved(named.select(*nodes.columns, F.coalesce("component", "node").alias("of")), "nodes")


def _grouped(docs: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, k1, k2`` of every row of docs (doc_id, text), and ``k1, k2, first, of`` of every text.

    ``first`` is the smallest of its rows' (no id, id, hash of the text), ``of`` the near duplicates it belongs to.
    """
    fields = [
        T.StructField("k1", T.LongType()),
        T.StructField("k2", T.LongType()),
        T.StructField("fingerprint", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "text",
    )
    described = add_columns(
        rows,
        "text",
        fields,
        lambda texts: [list(c) for c in zip(*(_describe(t, WORDS) for t in texts.to_pylist()))],
    ).drop("text")
    described = saved(described, "described")
    # Fingerprint and bands follow from the words, so any row's will do.
    nodes = described.groupBy("k1", "k2").agg(
        F.min("row").alias("node"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"),
        F.min("fingerprint").alias("fingerprint"),
        F.min("bands").alias("bands"),
    )
    nodes = saved(nodes, "texts")
    sketches = _met_sketches(described, nodes)

    def rows_of(nodes: DataFrame, from_: int, to: int, *kept: str) -> DataFrame:
        banded = nodes.select("*", F.posexplode(F.slice("bands", from_ + 1, to - from_)).alias("band", "key"))
        group = F.concat_ws("/", (F.col("band") + from_).cast("string"), F.col("key").cast("string"))
        return banded.select(group.alias("group"), "node", F.col("fingerprint").alias("word"), F.lit(0).alias("depth"), *kept)

    links = saved(trie.self_join(rows_of(nodes, 0, FIRST_BANDS), WIDE_BUDGET, leaf, sketches, similar_pairs), "links")
    of = _members(links, nodes)
    more = rows_of(of, FIRST_BANDS, BANDS, "of")
    apart = more.groupBy("group").agg(F.min("of").alias("low"), F.max("of").alias("high")).filter("low < high")
    more = saved(more.join(apart.select("group"), "group").select("group", "node", "word", "depth"), "apart")
    if not more.isEmpty():
        found = saved(trie.self_join(more, WIDE_BUDGET, leaf, sketches, similar_pairs), "links")
        of = _joined(of, found.filter("b IS NOT NULL").select("a", "b"))
        links = links.unionByName(found)
    open_ = links.filter("b IS NULL").select("group", "side", F.col("a").alias("node"), "word")
    open_ = open_.join(of.select("node", "of"), "node")
    apart = open_.groupBy("group").agg(F.min("of").alias("low"), F.max("of").alias("high")).filter("low < high")
    open_ = saved(open_.join(apart.select("group"), "group").select("group", "side", "node", "word", "of"), "undecided")
    if not open_.isEmpty():
        met = nodes.join(open_.select("node").distinct(), "node").select("node", "k1", "k2")
        sets = saved(_whole_sets(docs.select("text"), met, WORDS), "sets")
        of = _joined(of, saved(trie.decide(open_, WIDE_BUDGET, sets, same_sets), "links"))
    return described.select("doc_id", "text_key", "k1", "k2"), of.select("k1", "k2", "first", "of")


def _joined(of: DataFrame, links: DataFrame) -> DataFrame:
    """``of`` with the components that more links join; only links between different ones are looked at."""
    known = of.select("node", "of")
    for end in ("a", "b"):
        links = links.join(known.select(F.col("node").alias(end), F.col("of").alias(f"of_{end}")), end)
    new = saved(links.filter("of_a <> of_b").select("of_a", "of_b").distinct(), "joins")
    if new.isEmpty():
        return of
    member = saved(components(new, "of_a", "of_b"), "member")
    named = of.join(member.withColumnRenamed("node", "n"), F.col("of") == F.col("n"), "left")
    return saved(named.select(*[c for c in of.columns if c != "of"], F.coalesce("component", "of").alias("of")), "nodes")


def _met_sketches(described: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, sketch`` of the texts that share a group with another, in any band; most texts share none."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select("band", "key")
    met = saved(banded.join(shared, ["band", "key"]).select("node").distinct(), "met")
    sketches = described.select(F.col("row").alias("node"), "sketch")
    few, _ = split(sketches, met, F.col("node"))
    return saved(few.join(met, "node"), "sketches")


def _firsts(grouped: DataFrame) -> DataFrame:
    return grouped.groupBy("of").agg(F.min("first").alias("kept"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", leaf: int = trie.LEAF) -> DataFrame:
    """``doc_id, component_id`` of every row: the smallest id among near duplicates of near duplicates, itself included."""
    rows, grouped = _grouped(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), leaf)
    named = grouped.join(_firsts(grouped), "of").select("k1", "k2", F.col("kept.doc_id").alias("component_id"))
    return rows.join(named, ["k1", "k2"]).select("doc_id", "component_id")


def judged(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", leaf: int = trie.LEAF) -> DataFrame:
    """``doc_id, text_key, keep`` of the rows of which not every one stays: near duplicates of others, and repeated rows.

    Rows with another id or text all stay; of rows with these those for which ``keep`` is true stay, once.
    """
    rows, grouped = _grouped(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), leaf)
    kept = _firsts(grouped).select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_key").alias("kept_key"))
    each = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    marked = each.join(kept, same, "left").withColumn("keep", F.col("kept_key").isNotNull())
    return marked.filter("NOT keep OR n > 1").select("doc_id", "text_key", "keep")


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", leaf: int = trie.LEAF) -> DataFrame:
    """``doc_id, text_key`` of one row for each group of near duplicates: of rows with ids the one of the smallest.

    ``text_key`` is the XXH64 of the text as Spark makes it, null as empty; rows that repeat both are one.
    """
    _, grouped = _grouped(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), leaf)
    return _firsts(grouped).select("kept.doc_id", "kept.text_key")
