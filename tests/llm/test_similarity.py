"""Near duplicates, components, benchmark passages and vectors against brute force, with hot groups split small."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.llm import bloom, decontam, embed_dedup, queries, simhash, trie
from tidegate.llm.components import components

SF_DIR = "/root/testdata/sf0.001"


def joined(nodes, pairs):
    """Smallest node that links reach, for every node."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(4)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, k) for k in range(101, 160)]
    some = [(random.randint(200, 320), random.randint(200, 320)) for _ in range(70)]
    links = chain + star + some + chain[:5] + [(500, 500), (501, None), (None, None)]
    random.shuffle(links)
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    nodes = {n for p in links for n in p if n is not None}
    assert got == joined(nodes, [p for p in links if None not in p])
    texts = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "y")], "a string, b string")
    assert dict(rows(components(texts))) == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}
    assert components(texts.limit(0)).count() == 0


@pytest.mark.parametrize("budget", [2, 10, 26])
def test_traverse_finds_all_pairs(budget):
    rng = np.random.default_rng(budget)
    words = rng.integers(0, 1 << 63, 20).astype(np.uint64)[rng.integers(0, 20, 900)]
    for _ in range(6):
        words = words ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)) * (rng.random(900) < 0.5).astype(np.uint64)
    group = np.sort(rng.integers(0, 4, 900))
    side = np.where(group == 0, 0, 1 + (rng.random(900) < 0.5))
    i, j = trie.traverse(words, side, group, budget)
    close = np.bitwise_count(words[:, None] ^ words[None]) <= budget
    close &= (group[:, None] == group[None]) & ((side[:, None] == 0) | (side[:, None] != side[None]))
    want = set(zip(*(x.tolist() for x in np.nonzero(np.triu(close, 1)))))
    got = list(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist()))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("leaf", [4, 4096])
def test_classes_of_fingerprints(spark, leaf):
    """With small leaves groups descend on tables; the classes stay the same."""
    rng = np.random.default_rng(9)
    base = rng.integers(-(1 << 62), 1 << 62, 30)
    prints = []
    for i in range(400):
        p = int(base[rng.integers(30)])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            p ^= (1 << int(b)) if b < 63 else -(1 << 63)
        prints.append((i, p))
    prints += [(400, 0), (401, 0), (402, 3), (None, 7), (403, prints[0][1])]
    got = simhash.classes(spark.createDataFrame(prints, "doc_id long, fingerprint long"), leaf=leaf).collect()
    mask = (1 << 64) - 1
    values = sorted({p for _, p in prints})
    close = [(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) & mask).bit_count() <= 2]
    of = joined(values, close)
    first = {}
    for i, p in prints:
        if i is not None:
            first[of[p]] = min(i, first.get(of[p], i))
    assert sorted(map(str, got)) == sorted(
        f"Row(doc_id={i}, fingerprint={p}, component_id={first[of[p]]})" for i, p in prints
    )


def plain_print(text, words):
    parts = [p for p in re.split(rb"[ \t-\r]+", text.encode().lower()) if p]
    shingles = [b" ".join(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {i: plain_print(t, 3) for i, t in texts.items()}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = joined(prints, pairs)
    got = queries.op8_simhash(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
    assert len(got) == len(texts)


def test_fingerprint_edge_cases(spark):
    texts = [None, "", " \t\n", "One", "one", "ONE two", "É x", "w " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fingerprint", F.lit("x"))
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprint(df, 3).collect()}
    assert got == {i: p - (1 << 64) * (p >> 63) for i, t in enumerate(texts) for p in [plain_print(t or "", 3)]}
    assert simhash.fingerprint(df.limit(0)).count() == 0


def sets_of(texts):
    return {i: set(simhash.shingle_hashes(t or "", 5).tolist()) for i, t in texts.items()}


@pytest.mark.parametrize("leaf", [6, 4096])
def test_near_duplicates(spark, leaf):
    random.seed(6)
    words = [f"w{k}" for k in range(400)]
    texts, i = {}, 0
    for _ in range(12):
        base = random.choices(words, k=120)
        for _ in range(8):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 12])):
                copy[random.randrange(120)] = random.choice(words)
            texts[i] = " ".join(copy)
            i += 1
    for t in ("", "  ", "two words", "two  WORDS", "other"):
        texts[i] = t
        i += 1
    sets = sets_of(texts)
    similar = [
        (a, b)
        for a, b in itertools.combinations(texts, 2)
        if (sets[a] or sets[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) or not (sets[a] or sets[b])
    ]
    df = spark.createDataFrame([*texts.items(), (None, texts[0]), (3, texts[3])], "doc_id long, text string")
    got = rows(simhash.near_duplicates(df.withColumn("node", F.lit(1)), leaf=leaf))
    want = joined(texts, similar)
    assert got == sorted([*want.items(), (3, want[3]), (None, want[0])], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("budget", [2, simhash.WIDE_BUDGET])
def test_equal_words_are_split(spark, budget):
    """No task gets a group of more than a leaf's rows, give or take what a hash deals unevenly."""
    rows_ = spark.createDataFrame([("g", n, 77, 0) for n in range(400)], "group string, node long, word long, depth int")

    def check(t):
        if "group" in t.column_names:
            assert max(Counter(t["group"].to_pylist()).values()) <= 80, "a group was left whole"
        lo = np.array(t["key"].to_pylist())
        return lambda a, b: np.abs(lo[a] - lo[b]) <= 1  # a chain: 0 to 199 and 201 to 400

    payload = spark.createDataFrame([(n, n + (n > 199)) for n in range(400)], "node long, key long")
    links = trie.self_join(rows_, budget, 40, payload, check)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {n: 0 if n < 200 else 200 for n in range(400)}


@pytest.mark.parametrize("leaf", [8, 4096])
def test_near_copies_of_a_long_text(spark, leaf):
    """One word changed in thousands, so that most fingerprints are equal; a text with a fifth of the words changed is none."""
    random.seed(4)
    base = [f"w{k}" for k in range(3000)]
    texts = {0: base}
    for i in range(1, 60):
        texts[i] = list(base)
        texts[i][random.randrange(3000)] = "other"
    far = list(base)
    far[:600] = [f"v{k}" for k in range(600)]
    texts[60], texts[61] = [*far], [f"u{k}" for k in range(3000)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = dict(map(tuple, simhash.near_duplicates(df, leaf=leaf).collect()))
    assert all(got[i] == 0 for i in range(60)) and got[61] == 61 and got[60] == 60


def test_long_texts_near_the_similarity(spark):
    """Pairs of 2,000 words whose true similarity lies within two standard errors of the sketch."""
    random.seed(12)
    texts = {}
    for k in range(40):
        base = [f"w{random.randrange(10**9)}" for _ in range(2000)]
        edited = list(base)
        for n in range(205 + k):  # each changed end word costs one shingle
            edited[-1 - n] = f"v{random.randrange(10**9)}"
        texts[2 * k], texts[2 * k + 1] = " ".join(base), " ".join(edited)
    sets = sets_of(texts)
    share = {i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 80, 2)}
    assert all(0.76 < x < 0.84 for x in share.values()) and {x >= 0.8 for x in share.values()} == {True, False}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = dict(map(tuple, simhash.near_duplicates(df).collect()))
    assert got == {i: i if i % 2 == 0 or share[i - 1] < 0.8 else i - 1 for i in texts}


@pytest.mark.parametrize("leaf", [40, 4096])
def test_undecided_rows_are_returned_not_their_pairs(spark, leaf):
    """600 rows of which no pair can be told at first: a row each, and the second check joins the right ones."""
    n = 600
    rows_ = spark.createDataFrame([("g", k, 77, 0) for k in range(n)], "group string, node long, word long, depth int")
    payload = spark.createDataFrame([(k, k % 7) for k in range(n)], "node long, key long")
    first = trie.self_join(rows_, 26, leaf, payload, lambda t: lambda a, b: np.full(len(a), 2, np.int8))
    left = first.select("group", "side", F.col("a").alias("node"), "word", "b")
    per_group = left.groupBy("group").agg(F.count("*").alias("k"), F.count_distinct("node").alias("nodes"), F.count("b").alias("links")).collect()
    assert all(r["k"] == r["nodes"] <= n and r["links"] == 0 for r in per_group)
    assert leaf < n or first.count() == n

    def exact(t):
        key = np.array(t["key"].to_pylist())
        return lambda a, b: (key[a] == key[b]).astype(np.int8)

    known = left.drop("b").withColumn("of", F.when(F.col("node") < 70, F.col("node") % 7).otherwise(F.col("node")))
    links = trie.decide(known, 26, payload, exact, leaf=100)
    seen = [(k, k % 7) for k in range(70)]  # what the components of the first rows stand for
    got = joined(range(n), [tuple(r) for r in links.collect()] + seen)
    assert got == {k: k % 7 for k in range(n)}


def test_texts_without_ids_and_several_texts_of_one_id(spark):
    random.seed(10)
    base = [f"w{k}" for k in range(200)]
    near = lambda k: " ".join(base[:k] + ["x"] + base[k + 1 :])
    far = " ".join(f"v{k}" for k in range(200))
    only = [f"u{k}" for k in range(100)]
    given = [
        (5, " ".join(base)), (None, near(100)), (7, near(50)), (7, far), (9, far + " more"), (None, " ".join(only)), (None, " ".join([*only, "z"])),
    ]
    df = spark.createDataFrame(given, "doc_id long, text string")
    got = rows(simhash.near_duplicates(df))
    want = [(5, 5), (None, 5), (7, 5), (7, 7), (9, 7), (None, None), (None, None)]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    keys = {(r["doc_id"], r["text_key"]) for r in simhash.representatives(df).collect()}
    of = {(r["doc_id"], r["k"]): r["text"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()}
    kept = sorted((str(i), of[i, k]) for i, k in keys)
    assert len(kept) == 3 and kept[:2] == [("5", " ".join(base)), ("7", far)] and kept[2][0] == "None"


def test_bloom_filters_miss_nothing(spark, monkeypatch):
    keys = spark.range(500).select(F.xxhash64("id").alias("h"))
    df = spark.range(3000).withColumn("text", F.lit("t"))
    for most in (1 << 27, 1024):  # a full one admits more
        monkeypatch.setattr(bloom, "MOST", most)
        some, others = bloom.split(df, keys, F.xxhash64("id"))
        admitted = {r["id"] for r in some.collect()}
        assert set(range(500)) <= admitted and admitted | {r["id"] for r in others.collect()} == set(range(3000))
        assert others.count() == 3000 - len(admitted) and (most == 1024 or len(admitted) < 520)
    some, others = bloom.split(df, keys.limit(0), F.xxhash64("id"))
    assert some.count() == 0 and others.count() == 3000


def test_joined_rows_are_not_met_again(spark):
    """Of a large group of copies only pairs with others are left."""
    rows_ = spark.createDataFrame([("g", n, 5, 0, 26, 0) for n in range(500)], "group string, node long, word long, side int, left int, depth int")
    payload = spark.createDataFrame([(n, n % 100 == 99) for n in range(500)], "node long, odd boolean")

    def check(t):
        odd = np.array(t["odd"].to_pylist())
        return lambda a, b: ~odd[a] & ~odd[b]

    left, found = trie._represented(rows_, 26, 50, payload, check)
    pairs = Counter()
    for group in {r["group"] for r in left.select("group").distinct().collect()}:
        n = Counter(r["side"] for r in left.filter(F.col("group") == group).collect())
        pairs[group] = n[0] * (n[0] - 1) // 2 + n[1] * n[2]
    assert sum(pairs.values()) == 5 * 4 // 2 + 5 * 495 and sum(f.count() for f in found) == 494


def test_matches_edited_passages(spark):
    random.seed(8)
    words = [f"w{k}" for k in range(3000)] + ["the", "of", "and", "to"] * 300
    items = {k: random.choices(words, k=random.randint(12, 60)) for k in range(30)}
    noise = lambda n: random.choices(words, k=n)
    texts, want = {}, {}
    for i in range(120):
        part = list(items[i % 30])
        kind = i // 30
        if kind == 1:  # every tenth word changed
            part[::10] = noise(len(part[::10]))
        if kind == 2:  # words left out and put in
            part = [w for k, w in enumerate(part) if k % 9] + noise(2)
        if kind < 3:
            want[i, i % 30] = (20, 20 + len(items[i % 30]))
            texts[i] = " ".join([*noise(20), *part, *noise(500)]).replace(" ", " ### ").upper()
        else:
            texts[i] = " ".join(noise(300))
    texts[900] = " ".join("the of and to the of".split() * 50)
    df = spark.createDataFrame([*texts.items(), (901, None), (902, ""), (None, " ".join(items[3])), (5, texts[5])], "doc_id long, text string")
    bench = [(k, " ".join(w)) for k, w in items.items()] + [(0, " ".join(items[0])), (50, ""), (51, None), (None, "x y z w")]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    for block_words in (decontam.BLOCK_WORDS, 300):
        got = decontam.matches(df, bench, block_words=block_words).collect()
        found = {(r["doc_id"], r["item_id"]): r for r in got}
        assert set(found) == {*want, (None, 3)} and len(got) == len(found)
        for k in range(30):
            assert found[k, k]["score"] == 1.0 and (found[k, k]["first_word"], found[k, k]["past_word"]) == want[k, k]
    assert decontam.matches(df.limit(0), bench).count() == 0 and decontam.matches(df, bench.limit(0)).count() == 0


@pytest.mark.parametrize("beside", [False, True])
def test_matches_copies_with_every_few_words_changed(spark, beside):
    random.seed(21)
    words = [f"w{k}" for k in range(3000)]
    items = {k: random.choices(words, k=random.randint(15, 59)) for k in range(30)}
    texts = {}
    for k, item in items.items():
        every = 5 + k % 3  # one edited copy of each item: other copies would hold the n-grams that it lost
        edited = [random.choice(words) if (n + 1) % every == 0 else w for n, w in enumerate(item)]
        texts[k * 10 + every] = [*random.choices(words, k=40), *edited, *random.choices(words, k=40)]
        if beside:
            texts[k * 10] = item
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = decontam.matches(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((i, i // 10) for i in texts)
    for r in got:
        text, item = texts[r["doc_id"]], items[r["item_id"]]
        assert r["score"] == round(plain_alignment(item, text) / len(item), 6)


def plain_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        step = decontam.MATCH if a[i - 1] == b[j - 1] else -decontam.EDIT
        h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] - decontam.EDIT, h[i, j - 1] - decontam.EDIT)
    return h.max()


def test_alignment_scores():
    rng = np.random.default_rng(2)
    items = [rng.integers(0, 5, rng.integers(1, 12)) for _ in range(150)]
    texts = [rng.integers(0, 5, rng.integers(1, 25)) for _ in range(150)]
    score, first, past = decontam.align(items, texts)
    assert score.tolist() == [plain_alignment(a, b) for a, b in zip(items, texts)]
    for a, b, s, lo, hi in zip(items, texts, score, first, past):
        assert s == 0 or plain_alignment(a, b[lo:hi]) == s


def test_decontamination_query(spark):
    split = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    texts = {r["doc_id"]: split(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    items = {r["item_id"]: split(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()}
    want = {(i, k) for i, t in texts.items() for k, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, "/root/testdata/sf0.01").collect()}
    assert want and got == want


def plain_links(vectors):
    n = len(vectors)
    unit = [np.array(v) / np.linalg.norm(v) for v in vectors]
    return [(a, b) for a, b in itertools.combinations(range(n), 2) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]


@pytest.mark.parametrize("leaf", [20, 2048])
def test_vectors(spark, leaf):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    vectors = [base[k % 40] + rng.normal(size=24) * rng.choice([0, 0.02, 0.05]) for k in range(260)]
    vectors += [v * 3 for v in vectors[:5]] + [rng.normal(size=7)] * 3
    vectors = [[float(np.float32(x)) for x in v] for v in vectors]
    found = plain_links(vectors)
    odd = [None, [], [0.0] * 24, [1.0, None], [float("nan")] * 24, [float("inf")] * 24]
    given = [*enumerate(vectors), *((1000 + k, v) for k, v in enumerate(odd)), (None, vectors[0])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    got = embed_dedup.links(df, leaf=leaf).collect()
    degree = np.bincount(np.array(found).ravel(), minlength=len(vectors)).tolist()
    of = joined(range(len(vectors)), found)
    twin = {0, *(x for p in found if 0 in p for x in p)}
    by_id = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert len(got) == len(given)
    right = sum(by_id[i] == (degree[i] + (i in twin), of[i], i == of[i]) for i in range(len(vectors)))
    assert right >= 0.98 * len(vectors)
    assert all(by_id[i][0] <= degree[i] + (i in twin) for i in range(len(vectors)))
    assert all(by_id[1000 + k] == (0, 1000 + k, True) for k in range(len(odd)))
    assert by_id[None] == (degree[0] + 1, of[0], False)
    assert embed_dedup.links(df.limit(0)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = embed_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(embed_dedup.hadamard(y), x)


def test_vectors_of_any_size_are_compared_as_doubles(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    near = base + rng.normal(size=16) * 0.01
    given = [(i, (v * s).tolist()) for i, (v, s) in enumerate((v, s) for s in (1.0, 1e-60, 1e60, 1e-200, 1e200) for v in (base, near))]
    given += [(20, rng.normal(size=16).tolist()), (21, [0.0] * 16), (22, [float("inf")] * 16)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.links(spark.createDataFrame(given, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (9, 0) for i in range(10)} | {20: (0, 20), 21: (0, 21), 22: (0, 22)}


def test_vector_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    found = plain_links([r["embedding"] for r in table])
    got = {r["vec_id"]: r["n_links"] for r in queries.op6_embedding_dedup(spark, "/root/testdata/sf0.01").collect()}
    degree = np.bincount(np.array(found, dtype=int).ravel(), minlength=len(table))
    assert got == {r["vec_id"]: n for r, n in zip(table, degree.tolist())}


def test_whole_groups_stay_whole():
    names = sorted(f"g{k % 7}" for k in range(100))
    batches = pa.table({"group": names, "n": list(range(100))}).to_batches(max_chunksize=9)
    parts = [t["group"].to_pylist() for t in trie.whole_groups(iter(batches), gather=20)]
    assert sum(parts, []) == names and len(parts) > 2
    assert sum(len(set(p)) for p in parts) == 7
