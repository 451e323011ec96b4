"""Benchmark decontamination: shared n-grams as seeds, then Smith-Waterman alignment of the passages around them.

One pass over the documents finds every n-gram of the benchmark in them and keeps the stretches of words around the finds.
Every n-gram of an item that a stretch holds is a seed, so one intact n-gram is enough, wherever the changed words lie and
whatever other documents hold. Seeds join stretches to items; each item is aligned with the words around its seeds by local
alignment (a match scores 1, a changed or skipped word costs half), and the score over the item's length is reported.
A score from ``THRESHOLD`` on marks a copy, edited or paraphrased in part; items with fewer of their words around the seeds
than that score takes are not aligned. A copy that holds no n-gram of its item whole is not found.

Words are runs of letters and digits, lower-cased. The benchmark is a query set: it meets all documents in blocks of
``BLOCK_WORDS`` words, each small enough to send to every task, and the number of blocks grows with it.

Defined results: null and empty texts match nothing, nor do items of fewer words than an n-gram unless a text holds the whole
item; long texts are read whole; repeated rows and items give one result per id; empty tables give an empty table.
Documents without an id are matched too, under a null id. Only the columns named in the result are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import saved, steps
from .words import mixed, words_of

GRAM = 4
THRESHOLD = 0.5
MATCH, EDIT = 1.0, 0.5
BLOCK_WORDS = 1_000_000
#: Rows of alignments that are computed at once, in table cells.
CELLS = 4_000_000

STRETCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("begin", T.LongType()),
        T.StructField("words", T.BinaryType()),
        T.StructField("grams", T.BinaryType()),
        T.StructField("places", T.BinaryType()),
    ]
)
MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("past_word", T.LongType()),
    ]
)


class Block:
    """Items as numbers of their own vocabulary, and their n-grams."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, np.int64)
        found = words_of(pa.array(texts, pa.string()), digits=True)
        self.rows = found.rows
        self.vocabulary, self.words = np.unique(found.whole(), return_inverse=True)
        self.size = np.diff(self.rows)
        self.gram = np.minimum(GRAM, self.size)  # an item shorter than an n-gram is one
        count = np.where(self.size > 0, self.size - self.gram + 1, 0)
        self.gram_item = np.repeat(np.arange(len(ids)), count)
        self.gram_place = np.arange(len(self.gram_item)) - np.repeat(np.cumsum(count) - count, count)
        at = self.rows[:-1][self.gram_item] + self.gram_place
        h = gram_hashes(found.whole(), at, self.gram[self.gram_item])
        self.grams, self.gram_of = np.unique(h, return_inverse=True)
        # Items of each distinct n-gram, those of n-gram g from gram_rows[g] on.
        pairs = np.unique(np.stack((self.gram_of.ravel(), self.gram_item)), axis=1)
        self.gram_items, self.gram_rows = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.grams) + 1))
        self.sizes = np.unique(self.gram[self.size > 0])
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.grams >> np.uint64(42)).astype(np.int64)] = True

    def margin(self) -> int:
        """Words around an n-gram within which its item's alignment lies: gaps cost, so no more than twice the item."""
        return 2 * int(self.size.max(initial=1))


def gram_hashes(words: np.ndarray, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Hash of the words from each place on, as many as its size."""
    out = np.zeros(len(at), np.uint64)
    size = np.broadcast_to(size, at.shape)
    for i in range(int(size.max(initial=0))):
        more = size > i
        out[more] = mixed(out[more] * np.uint64(0x9E3779B97F4A7C15) + words[at[more] + i])
    return mixed(out + size.astype(np.uint64))


def _stretches(batch: pa.RecordBatch, block: Block) -> Iterator[tuple]:
    texts = pc.fill_null(batch.column("text"), "")
    found = words_of(texts, digits=True)
    h = found.whole()
    doc = np.repeat(np.arange(len(texts)), np.diff(found.rows))
    places, grams = [], []
    for size in block.sizes.tolist():
        at = np.flatnonzero(np.arange(len(h)) + size <= found.rows[1:][doc])
        g = gram_hashes(h, at, size)
        may = block.bits[(g >> np.uint64(42)).astype(np.int64)]
        at, g = at[may], g[may]
        nth = np.minimum(np.searchsorted(block.grams, g), len(block.grams) - 1)
        hit = block.grams[nth] == g
        places.append(at[hit])
        grams.append(nth[hit])
    place, gram = np.concatenate(places), np.concatenate(grams)
    if not len(place):
        return
    order = np.argsort(place, kind="stable")
    place, gram = place[order], gram[order]
    margin = block.margin()
    low = np.maximum(found.rows[doc[place]], place - margin)
    high = np.minimum(found.rows[doc[place] + 1], place + GRAM + margin)
    apart = np.flatnonzero(np.append(True, (low[1:] > high[:-1]) | (doc[place[1:]] != doc[place[:-1]])))
    ends = np.append(apart[1:], len(place))
    ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
    for a, b in zip(apart.tolist(), ends.tolist()):
        lo, hi = int(low[a]), int(high[b - 1])
        nth = np.minimum(np.searchsorted(block.vocabulary, h[lo:hi]), len(block.vocabulary) - 1)
        known = np.where(block.vocabulary[nth] == h[lo:hi], nth, -1).astype("<i4")
        d = int(doc[place[a]])
        yield (
            ids[d], keys[d], lo - int(found.rows[d]), known.tobytes(), gram[a:b].astype("<i4").tobytes(),
            (place[a:b] - lo).astype("<i4").tobytes(),
        )


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its text: score, first and past-the-end place in the text."""
    n, m = max(map(len, items)), max(map(len, texts))
    item = np.full((len(items), n), -2, np.int64)
    text = np.full((len(texts), m), -1, np.int64)
    for k, (a, b) in enumerate(zip(items, texts)):
        item[k, : len(a)], text[k, : len(b)] = a, b
    slope = np.arange(m + 1) * EDIT
    h = np.zeros((len(items), m + 1))
    # Where the alignment that ends in a cell begins; of equal scores the one met first stays.
    origin = np.broadcast_to(np.arange(m + 1), h.shape).copy()
    best, first, past = np.zeros(len(items)), np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    for i in range(n):
        step = np.where(text == item[:, i : i + 1], MATCH, -EDIT)
        diagonal = h[:, :-1] + step
        up = h[:, 1:] - EDIT
        t = np.zeros_like(h)
        begin = np.broadcast_to(np.arange(m + 1), h.shape).copy()
        t[:, 1:] = np.maximum(0, np.maximum(diagonal, up))
        begin[:, 1:] = np.where(
            t[:, 1:] <= 0, begin[:, 1:], np.where(diagonal >= up, origin[:, :-1], origin[:, 1:])
        )
        # Skipped text words: the best cell to the left, less what the skips cost.
        raised = t + slope
        top = np.maximum.accumulate(raised, 1)
        came = np.maximum.accumulate(np.where(raised >= top, np.arange(m + 1), 0), 1)
        h = top - slope
        origin = np.take_along_axis(begin, came, 1)
        at = h.argmax(1)
        score = h[np.arange(len(h)), at]
        better = score > best
        best = np.where(better, score, best)
        first = np.where(better, origin[np.arange(len(h)), at], first)
        past = np.where(better, at, past)
    return best, first, past


def _jobs(block: Block, text: np.ndarray, grams: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Item and part of the stretch to align it with: one part around all its seeds that lie close together."""
    n = block.gram_rows[grams + 1] - block.gram_rows[grams]
    seed = np.repeat(np.arange(len(grams)), n)
    item = block.gram_items[block.gram_rows[grams][seed] + np.arange(len(seed)) - np.repeat(np.cumsum(n) - n, n)]
    order = np.lexsort((places[seed], item))
    item, place = item[order], places[seed][order].astype(np.int64)
    margin = 2 * block.size[item]
    first = np.append(True, (item[1:] != item[:-1]) | (place[1:] - place[:-1] > GRAM + 2 * margin[1:]))
    last = np.append(first[1:], True)
    lows = np.maximum(0, place - margin)[first].tolist()
    highs = np.minimum(len(text), place + GRAM + margin)[last].tolist()
    around = np.zeros(len(block.vocabulary) + 1, bool)  # the last entry is for words of no item
    for i, lo, hi in zip(item[first].tolist(), lows, highs):
        around[text[lo:hi]] = True
        around[-1] = False
        # No score exceeds the number of the item's words that stand there.
        if around[block.words[block.rows[i] : block.rows[i + 1]]].sum() * MATCH >= THRESHOLD * MATCH * block.size[i]:
            yield i, lo, hi
        around[text[lo:hi]] = False


def _aligned(batch: pa.RecordBatch, block: Block) -> list[tuple]:
    """Scores of the items that a seed joins to each stretch; parts of a stretch around far seeds are aligned apart."""
    jobs = []
    columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
    for row, (words, grams, places) in enumerate(zip(*columns[3:])):
        text = np.frombuffer(words, "<i4")
        for item, lo, hi in _jobs(block, text, np.frombuffer(grams, "<i4"), np.frombuffer(places, "<i4")):
            jobs.append((row, item, lo, text[lo:hi]))
    out: dict[tuple, tuple] = {}
    jobs.sort(key=lambda j: len(j[3]))
    at = 0
    while at < len(jobs):
        to = at
        while to < len(jobs) and (to == at or (to - at + 1) * len(jobs[to][3]) <= CELLS // 32):
            to += 1
        part = jobs[at:to]
        at = to
        score, first, past = align([block.words[block.rows[i] : block.rows[i + 1]] for _, i, _, _ in part], [t for *_, t in part])
        for (row, item, lo, _), s, a, b in zip(part, score.tolist(), first.tolist(), past.tolist()):
            share = s / (MATCH * float(block.size[item]))
            if share < THRESHOLD:
                continue
            base = columns[2][row] + lo
            k = (columns[0][row], columns[1][row], int(block.ids[item]))
            made = (round(share, 6), base + a, base + b)
            if k not in out or (-made[0], made[1]) < (-out[k][0], out[k][1]):
                out[k] = made
    return [(*k, *v) for k, v in out.items()]


def matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``doc_id, text_key, item_id, score, first_word, past_word`` of every copy of an item: the best one in each document.

    ``text_key`` is the hash of the document's text, which tells documents without an id apart.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.col(text).alias("text"),
    )
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    items = items.filter("item_id IS NOT NULL")
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n_blocks = max(1, -(-words // block_words))
    out = spark.createDataFrame([], MATCHES)
    for b in range(n_blocks):
        # One block of the query set, bounded by its words.
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).distinct().collect()
        rows.sort()
        block = Block([r[0] for r in rows], [r[1] for r in rows])
        if len(block.grams):
            out = out.union(_block_matches(read, block))
    best = F.min(F.struct((-F.col("score")).alias("low"), "first_word", "past_word"))
    out = out.groupBy("doc_id", "text_key", "item_id").agg(best.alias("best"))
    return out.select(
        "doc_id", "text_key", "item_id", (-F.col("best.low")).alias("score"), "best.first_word", "best.past_word"
    )


def _block_matches(read: DataFrame, block: Block) -> DataFrame:
    spark = read.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                made = list(_stretches(b, shared.value))
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(),) * 3 + (pa.binary(),) * 3)],
                        names=STRETCHES.names,
                    )

    stretches = saved(read.mapInArrow(find, STRETCHES), "stretches")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                made = _aligned(whole.slice(at, 2000), shared.value)
                if made:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names=MATCHES.names)

    return stretches.mapInArrow(score, MATCHES)
