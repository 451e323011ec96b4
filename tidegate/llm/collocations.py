"""Phrase collocations over prefix-free parsing.

The words of a text, with a mark wherever punctuation parts them into pieces, are cut into chunks whose ends depend on the
words alone: a window of ``SIZE - 1`` words whose hash is divisible by ``MODULUS`` ends a chunk and begins the next, so
neighbours overlap by that window and copies of a passage are cut alike wherever they stand; without such a window a chunk goes on to the end of its text. Distinct chunks are the
dictionary, how often each occurs is the parse; phrases are counted once inside each distinct chunk and weighted by its
frequency. A phrase belongs to the chunk in which it starts before the closing window, so those in an overlap count once.

A candidate is a phrase of 2 to ``SIZE`` words found often enough. Of its cuts into two parts the one of the lowest score
floor(1e6 * a * a / (l * r)) counts, in decimals of 38 digits, exact for counts below 1e15.

A phrase can be frequent only if those of one word less at its ends are. Words and pairs are counted first; of longer
phrases only those go on whose ends a Bloom filter of the frequent shorter ones admits; what it admits is counted all the
same, so it never changes a result. Tasks add up phrases of many chunks before they hand them on, and the first phrases of a language are found in buckets of phrases
before they meet.

Defined results: null and empty texts have no words; a null language is ``und`` and counts with rows so named; texts of any
length are read whole; repeated rows count each time; equal scores go by frequency, then by the phrase's bytes; an empty
table gives an empty table. Only the columns named in the result are returned, so others cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .bloom import Bloom
from .frames import buffers, fresh, saved, steps
from .words import mixed

#: Longest phrase, two words at least, and the share of windows that end a chunk.
SIZE, MODULUS = 3, 32
LEAST, TOP, SHARE = 10, 2000, 50
SPACE, BREAK = 0x20, 0x0A
#: Between language and phrase; no phrase has it, so the last one in a key counts.
BETWEEN = b"\n"
#: Bytes of distinct chunks that a task gathers before it hands them on, and of chunks whose phrases it counts together.
GATHER = 16_000_000

#: Lower case for A-Z, a break for what parts pieces, a space for a tab; fixed values of the result's definition.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[ord(c) for c in ".,;:!?\n\v\f\r"]] = BREAK
_FOLD[ord("\t")] = SPACE


def _hashes(raw: np.ndarray, starts: np.ndarray, part: np.ndarray) -> np.ndarray:
    """A hash of each word from its bytes and their places; ``part`` is where there are words."""
    place = np.arange(len(raw)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    each = mixed((raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    each[~part] = 0
    return mixed(np.add.reduceat(each, starts))


def _next(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of phrases made one word longer."""
    return mixed(h * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def parse(texts: pa.Array, window: int, modulus: int) -> Iterator[tuple[int, list[bytes], list[bool]]]:
    """For every text with words: its place, its chunks, and which of them is its last.

    Chunks hold their words, with a space between words of one piece and a line feed between pieces.
    """
    raw, at = buffers(texts)
    folded = _FOLD[raw]
    part = (folded != SPACE) & (folded != BREAK)
    if not part.any():
        return
    begin, end = part.copy(), part.copy()
    cut = at[1:-1][at[1:-1] < len(raw)]
    begin[1:] &= ~part[:-1]
    begin[cut] = part[cut]
    end[:-1] &= ~part[1:] | begin[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    n = len(starts)
    one = _hashes(folded, starts, part)
    h = one.copy()
    for k in range(1, min(window, n)):
        h[: n - k] = _next(h[: n - k], one[k:])
    trigger = h % np.uint64(modulus) == 0
    # One separator after each word.
    broken = np.concatenate(([0], np.cumsum(folded == BREAK)))
    size = ends - starts
    to = np.cumsum(size + 1)
    canon = np.empty(int(to[-1]), np.uint8)
    gap = np.ones(len(canon), bool)
    gap[to - 1] = False
    canon[gap] = folded[part]
    canon[to - 1] = np.where(broken[np.append(starts[1:], len(raw))] > broken[ends], BREAK, SPACE)
    text, first_byte, past_byte = canon.tobytes(), (to - size - 1).tolist(), (to - 1).tolist()
    rows = np.searchsorted(starts, at)
    marks = np.flatnonzero(trigger)
    for row in np.flatnonzero(np.diff(rows)).tolist():
        a, b = int(rows[row]), int(rows[row + 1])
        # A chunk begins at the text's first word and at each window that triggers, the closing one of a text excepted.
        inner = marks[np.searchsorted(marks, a + 1) : np.searchsorted(marks, b - window)].tolist()
        froms = [a, *inner]
        tos = [m + window for m in inner] + [b]
        yield row, [text[first_byte[i] : past_byte[j - 1]] for i, j in zip(froms, tos)], [False] * len(inner) + [True]


def _chunk_rows(window: int, modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bytes, bool], int] = {}
        held = 0

        def out() -> pa.RecordBatch:
            lang, chunk, last = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(chunk, pa.binary()), pa.array(last), pa.array(found.values(), pa.int64())],
                names=["lang", "chunk", "last", "n"],
            )

        for whole in batches:
            for b in steps(whole, "text"):
                langs = b.column("lang").to_pylist()
                for row, chunks, last in parse(b.column("text"), window, modulus):
                    for c, at_end in zip(chunks, last):
                        k = (langs[row], c, at_end)
                        if k in found:
                            found[k] += 1
                        else:
                            found[k] = 1
                            held += len(c) + 150
                if held > GATHER:
                    yield out()
                    found, held = {}, 0
        if found:
            yield out()

    return run


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE, modulus: int = MODULUS) -> DataFrame:
    """``lang, chunk, last, n``: distinct chunks, whether they close a text, and how often the parse has them."""
    read = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text], F.lit("")).alias("text"))
    chunks = read.mapInArrow(_chunk_rows(max(1, size - 1), modulus), "lang string, chunk binary, last boolean, n long")
    # Tasks have added up what they could; equal keys are few rows by now.
    return chunks.repartition("lang", "chunk", "last").groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))


def frequent(found: DataFrame) -> Bloom:
    """Filter of the phrases in ``key``, over hashes of their words and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [k.rsplit(BETWEEN, 1) for k in b.column("key").to_pylist()]
            h = np.array([_seed(lang) for lang, _ in keys], np.uint64)
            words = [p.split(b" ") for _, p in keys]
            n = np.array([len(w) for w in words])
            one = _bytes_hashes([w for p in words for w in p])
            first = np.cumsum(n) - n
            for k in range(int(n.max(initial=0))):
                more = np.flatnonzero(n > k)
                h[more] = _next(h[more], one[first[more] + k])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return Bloom.of(found.select("key").mapInArrow(run, "h long"))


def _seed(lang: bytes) -> int:
    return zlib.crc32(lang)


def _bytes_hashes(words: list[bytes] | pa.Array) -> np.ndarray:
    raw, at = buffers(pa.array(words, pa.binary()) if isinstance(words, list) else words)
    return _hashes(raw, at[:-1], np.ones(len(raw), bool)) if len(at) > 1 else np.zeros(0, np.uint64)


def phrases(
    chunks: list[bytes], last: np.ndarray, n: np.ndarray, sizes: range, size: int, seed: int, known: Bloom | None = None
) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """For each number of words in ``sizes``: that number, distinct phrases of all chunks, and their weighted counts.

    Of phrases longer than the first number only those whose two ends are ``known``. First comes, as 0, the count of all words.
    """
    raw = np.frombuffer(b" ".join(chunks), np.uint8)
    bounds = np.cumsum([0] + [len(c) + 1 for c in chunks])
    part = (raw != SPACE) & (raw != BREAK)
    starts = np.flatnonzero(part & ~np.append(False, part[:-1]))
    ends = np.flatnonzero(part & ~np.append(part[1:], False)) + 1
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[part].tobytes())])
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary
    rows = np.searchsorted(starts, bounds)
    chunk = np.repeat(np.arange(len(chunks)), np.diff(rows))
    # Which phrases may start at a word: not those of the closing window, unless the chunk closes its text.
    whole = np.arange(len(ids)) < (rows[1:] - np.where(last, 0, size - 1))[chunk]
    broken = np.concatenate(([0], np.cumsum(raw == BREAK)))[starts]
    weight = n[chunk]
    yield 0, pa.array([b""]), weight[whole].sum(keepdims=True)
    one = _bytes_hashes(names)[ids] if known else None
    for k in sizes:
        m = len(ids) - k + 1
        if m <= 0:
            return
        some = np.flatnonzero(whole[:m] & (chunk[:m] == chunk[k - 1 :]) & (broken[:m] == broken[k - 1 :]))
        if known:
            for shift in (0, 1):
                h = np.full(len(some), seed, np.uint64)
                for i in range(k - 1):
                    h = _next(h, one[some + shift + i])
                some = some[known.has(h)]
        if not len(some):
            continue
        key, room = ids[some], len(names)
        for i in range(1, k):
            if room >= 2**62 // len(names):  # number the shorter phrases anew, so that a key stays within 64 bits
                key, room = np.unique(key, return_inverse=True)[1], len(key)
            key, room = key * len(names) + ids[some + i], room * len(names)
        order = np.argsort(key)
        sorted_keys = key[order]
        first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
        count = np.add.reduceat(weight[some][order], first)
        at = some[order][first]
        made = [names.take(pa.array(ids[at + i])) for i in range(k)]
        yield k, made[0] if k == 1 else pc.binary_join_element_wise(*made, pa.scalar(b" ", pa.binary())), count


def _phrase_rows(sizes: range, size: int, known: Bloom | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room = 0

        def out() -> Iterator[pa.RecordBatch]:
            by_lang = defaultdict(list)
            for b in held:
                for lang, *rest in zip(*(c.to_pylist() for c in b.columns)):
                    by_lang[lang].append(rest)
            for lang, given in by_lang.items():
                chunks, last, n = zip(*given)
                name = lang.encode()
                made = phrases(list(chunks), np.array(last), np.array(n, np.int64), sizes, size, _seed(name), known)
                for k, phrase, count in made:
                    if k or not known:
                        key = pc.binary_join_element_wise(pa.scalar(name, pa.binary()), phrase, pa.scalar(BETWEEN, pa.binary()))
                        yield pa.RecordBatch.from_arrays([key, pa.array(count)], names=["key", "n"])

        for whole in batches:
            for b in steps(whole, "chunk"):
                held.append(b)
                room += b.nbytes
                if room > GATHER // 2:
                    yield from out()
                    held, room = [], 0
        yield from out()

    return run


def counts(chunks: DataFrame, least: int = LEAST, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, f`` of phrases found at least ``least`` times, and ``lang, n``: all words of a language."""
    chunks = chunks.select("lang", "chunk", "last", "n")
    levels, known, sizes = [], None, range(1, min(size, 2) + 1)
    while True:
        found = chunks.mapInArrow(_phrase_rows(sizes, size, known), "key binary, n long")
        summed = found.repartition("key").groupBy("key").agg(F.sum("n").alias("f"))
        key = F.col("key").cast("string")
        phrase = F.substring_index(key, BETWEEN.decode(), -1)
        lang = key.substr(F.lit(1), F.length(key) - F.length(phrase) - 1)
        kept = summed.filter((F.col("f") >= least) | (phrase == ""))
        named = kept.select("key", lang.alias("lang"), phrase.alias("phrase"), "f")
        words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("words")
        levels.append(saved(named.select("key", "lang", words, "phrase", "f"), "phrases"))
        longest = sizes[-1]
        if longest >= size:
            break
        known = frequent(levels[-1].filter(F.col("words") == longest))
        sizes = range(longest + 1, longest + 2)
    all_ = reduce(DataFrame.union, levels).drop("key")
    return all_.filter("words > 0"), levels[0].filter("words = 0").select("lang", F.col("f").alias("n"))


def first_of_groups(df: DataFrame, group: str, order: list[Column], k: int, key: str, rows: int) -> DataFrame:
    """The first ``k`` rows of each group, numbered in ``rank``; ``key`` tells rows of a group apart, ``rows`` is how many there are.

    Groups are first cut into buckets by a hash of the key, of some 50 ``k`` rows, and only each bucket's first rows go on,
    level by level, so that no task sorts a whole group.
    """
    nth = fresh("nth")
    buckets = math.ceil(rows / (50 * k))
    while buckets > 1:
        spread = W.partitionBy(group, F.pmod(F.xxhash64(F.lit(buckets), key), F.lit(buckets))).orderBy(*order)
        df = df.withColumn(nth, F.row_number().over(spread)).filter(F.col(nth) <= k).drop(nth)
        buckets = 0 if buckets <= 50 else math.ceil(buckets / 50)
    return df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order)).cast("long")).filter(F.col("rank") <= k)


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1e6 * a * a / (l * r)); parts are no rarer than the phrase, so it never passes 1e6."""
    whole = lambda c: c.cast("decimal(15,0)")
    over = (whole(a) * whole(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (whole(l) * whole(r)).cast("decimal(38,0)"))


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    share: int = SHARE,
    size: int = SIZE,
    modulus: int = MODULUS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases."""
    found, sizes = counts(saved(dictionary(docs, text, lang, size, modulus), "chunks", "zstd"), least, size)
    named = found.withColumn("w", F.split("phrase", " "))
    candidates = named.filter("words > 1").select("lang", "phrase", F.col("words").alias("m"), F.col("f").alias("a"), "w")
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1))).select(
        "lang", "phrase", "m", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right")
    )
    f_left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    f_right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(f_left, ["lang", "left"]).join(f_right, ["lang", "right"])
    scored = scored.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "m", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Phrases inside longer candidates, with the frequency of the most frequent one.
    inner = [
        candidates.filter(F.col("m") > n)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("m") - n + 1)))
        .select("lang", part(F.col("at"), F.lit(n)).alias("phrase"), "a")
        for n in range(2, size)
    ]
    out = lowest
    if inner:
        longer = reduce(DataFrame.union, inner).groupBy("lang", "phrase").agg(F.max("a").alias("f_longer"))
        joined = lowest.join(longer, ["lang", "phrase"], "left")
        exact = lambda c: c.cast("decimal(20,0)")
        out = joined.filter(F.col("f_longer").isNull() | (exact(F.col("f_longer")) * 100 < exact(F.col("a")) * share))
    out = saved(out.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = first_of_groups(out, "lang", order, top, "phrase", out.count())
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
