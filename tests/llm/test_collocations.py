"""Phrase collocations against plain counting over whole texts, and the parse against its definition."""

import random
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.oracle import compare, duck
from tidegate.llm import bloom, collocations, queries


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", lowered)]


def counted(given, size):
    f = Counter()
    for lang, text in given:
        for w in pieces(text):
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, size + 1) for i in range(len(w) - k + 1))
    return f


def plain(given, least, top, share, size):
    f = counted(given, size)
    n = Counter()
    for (lang, p), c in f.items():
        n[lang] += c if len(p) == 1 else 0
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(
            q != p and lang == other and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), b in found.items()
        ):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    at = Counter()
    ranked = []
    for r in out:
        at[r[0]] += 1
        if at[r[0]] <= top:
            ranked.append((r[0], at[r[0]], *r[1:]))
    return ranked


def texts(seed, n):
    random.seed(seed)
    words = ["the", "The", "of", "sea", "blue", "é", "x\x0by", "to", "one", "big", "ship"]
    seps = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ;: "]
    passage = "a well known passage. of several words that many texts share, Again and again"
    out = []
    for _ in range(n):
        t = "".join(random.choice(words) + random.choice(seps) for _ in range(random.randint(0, 60)))
        out.append((random.choice(["en", "d\ne", None, "und"]), t + (passage if random.random() < 0.3 else "")))
    return out


@pytest.mark.parametrize("how", [{}, {"least": 3, "top": 5, "share": 80, "modulus": 2}, {"size": 4, "modulus": 1}, {"size": 2, "least": 2}])
def test_phrases_equal_plain_counting(spark, how):
    how = {"least": 10, "top": 2000, "share": 50, "size": 3, "modulus": 16} | how
    given = texts(1, 200)
    got = collocations.mine(spark.createDataFrame(given, "lang string, text string").repartition(3), **how).collect()
    want = plain(given, how["least"], how["top"], how["share"], how["size"])
    assert [tuple(r) for r in sorted(got, key=lambda r: (r["lang"], r["rank"]))] == want and want


def test_small_steps_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GATHER", 300)
    given = texts(2, 150)
    df = spark.createDataFrame(given, "lang string, text string")
    got = collocations.mine(df, least=2, top=2).collect()  # some thousand candidates in buckets of 100
    assert [tuple(r) for r in sorted(got, key=lambda r: (r["lang"], r["rank"]))] == plain(given, 2, 2, 50, 3)
    many = [("g" if i % 3 else None, i * 7919 % 20_011, f"p{i}") for i in range(20_011)]
    ranked = collocations.first_of_groups(
        spark.createDataFrame(many, "g string, v long, p string"), "g", [F.col("v").desc()], 3, "p", len(many)
    )
    want = [(g, v, p, i + 1) for g in ("g", None) for i, (_, v, p) in enumerate(sorted((m for m in many if m[0] == g), key=lambda m: -m[1])[:3])]
    assert rows(ranked) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_chunks_overlap_and_copies_are_cut_alike():
    random.seed(4)
    passage = " ".join(f"w{random.randint(0, 99)}" for _ in range(400))
    given = [passage, "other words before " + passage, passage.upper() + "  \t after"]
    made = {row: (chunks, last) for row, chunks, last in collocations.parse(pa.array(given), 2, 8)}
    shared = Counter(c for chunks, _ in made.values() for c in set(chunks))
    assert sum(n == 3 for n in shared.values()) > 20
    for row, (chunks, last) in made.items():
        assert last == [False] * (len(chunks) - 1) + [True]
        split = [c.split(b" ") for c in chunks]
        assert all(a[-2:] == b[:2] and len(b) > 2 for a, b in zip(split, split[1:]))
        again = split[0] + [w for c in split[1:] for w in c[2:]]
        assert b" ".join(again).decode() == " ".join(given[row].lower().split())


def test_dictionary_counts_copies_once(spark):
    df = spark.createDataFrame([("en", "one two three four")] * 50 + [("de", "one two three four")], "lang string, text string")
    got = rows(collocations.dictionary(df, modulus=1_000_003).withColumn("chunk", F.col("chunk").cast("string")))
    assert got == [("de", "one two three four", True, 1), ("en", "one two three four", True, 50)]


def test_odd_rows(spark):
    long = "same words again " * 40_000
    given = [(None, None), ("en", ""), ("en", " .\n"), ("en", "one"), ("xx", long), ("xx", "Ärger, ärger\x00b"), ("xx", "q" * 100_000)]
    df = spark.createDataFrame(given, "lang string, text string")
    for c in ("rank", "chunk", "n", "phrase", "f"):
        df = df.withColumn(c, F.lit("mine"))
    got = collocations.mine(df).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: (r["lang"], r["rank"]))] == plain(given, 10, 2000, 50, 3)
    assert collocations.mine(df.limit(0)).count() == 0


def test_a_full_filter_drops_nothing(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST", 1024)
    given = texts(3, 200)
    got = collocations.mine(spark.createDataFrame(given, "lang string, text string"), least=2, size=4).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: (r["lang"], r["rank"]))] == plain(given, 2, 2000, 50, 4)


def test_scores_are_exact(spark):
    big = [(999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999), (10**14, 10**15 - 1, 10**14 + 1), (3, 7, 9)]
    df = spark.createDataFrame(big, "a long, l long, r long")
    got = [r[0] for r in df.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in big]


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert Path(sf_dir).exists()
    name = "op13_collocations"
    assert compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.SQL[name], sf_dir) is None
