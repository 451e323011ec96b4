"""Language-model scores: a log-bilinear model over word classes, trained by noise-contrastive estimation.

Tokens are words and one end of text. The probability of a token given the two before it is that of its class, from the
model, times its share of the class. The ``OUTPUTS`` classes are the end, the most frequent words, each alone, and
``SHAPES`` classes of the other words by their length and last byte. Contexts are classes as well, ``CONTEXTS`` of them:
nothing, the most frequent words, coarser shapes. The model adds a vector for either context class and takes
its product with a vector of the class to come, so that one matrix product gives the scores of all classes in all pairs of
contexts; a softmax over the classes makes them probabilities.

Everything the model learns from is counted over all training texts: words, which grow with the corpus and stay a table; and
triples of context, context and class, of which there is a fixed number however long the corpus is. Estimation against noise
from the class frequencies uses these counts as they are, the noise by its expectation, so nothing is drawn at random but
the first weights. A word has the share (c + SMOOTH) / (n + SMOOTH * (v + 1)) of its class (c: its count, n and v: all and
distinct words of the class); what is left is the share of a word not seen in training.

``HEAD`` words, the most frequent ones, go to all tasks; each is at most ``HEAD_BYTES`` long. Words beyond them meet their
counts in a join, whose rows are distinct rare words of a text. No text is shuffled.

Defined results: null and empty texts are one end; texts of any length are read whole; repeated rows get a score each, rows of
one id are rows of their own; a row for which ``training`` is null isn't learnt from; without training texts every token has
the share of an unseen one of its class, and classes are about equally likely; an empty table gives an empty table. Only the columns named in the result and those asked for are returned, so others cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import saved, steps
from .labels import Adam, sigmoid

SMOOTH = 0.1
#: Words whose counts are sent to all tasks, and the longest of them.
HEAD, HEAD_BYTES = 65_536, 64
OUTPUTS, SHAPES, CONTEXTS = 512, 64, 64
DIMENSIONS, NOISE, STEPS, RATE, SEED = 32, 10, 250, 0.05, 7
#: Distinct words that a task gathers before it hands them on.
GATHER = 200_000
#: Words that are classes of their own as outputs (beside the end) and as contexts (beside nothing).
OWN = OUTPUTS - SHAPES - 1
OWN_CONTEXTS = CONTEXTS - SHAPES // 2 - 1
END = 0


def words(text: str) -> list[bytes]:
    """A-Z lower-cased, between the six white-space characters of ASCII."""
    return text.encode().lower().split()


def shape(word: bytes) -> int:
    """Class of a word by its last byte and its length."""
    return (word[-1] & 15) * 4 + (0 if len(word) < 4 else 1 if len(word) < 7 else 2 if len(word) < 10 else 3)


@dataclass
class Head:
    """The most frequent words with their counts, most frequent first; equal ones by their bytes."""

    words: list[bytes]
    counts: np.ndarray

    def __post_init__(self):
        own = min(OWN, len(self.words))
        self.place = {w: i for i, w in enumerate(self.words)}
        shapes = np.array([shape(w) for w in self.words], np.int64).reshape(-1)
        self.output = np.where(np.arange(len(self.words)) < own, 1 + np.arange(len(self.words)), 1 + OWN + shapes)
        first = np.arange(len(self.words)) < OWN_CONTEXTS
        self.context = np.where(first, 1 + np.arange(len(self.words)), 1 + OWN_CONTEXTS + shapes // 2)

    def places(self, found: list[bytes]) -> np.ndarray:
        """Place of each word, -1 - its shape for words beyond the head."""
        get = self.place.get
        return np.array([p if (p := get(w)) is not None else -1 - shape(w) for w in found], np.int64)

    def classes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a text with words at these places: output class of every token, the end last, and the contexts one and two before."""
        out, context = np.full(len(at) + 1, END), np.zeros(len(at) + 2, np.int64)
        far = -1 - at
        if len(self.words):
            out[:-1] = np.where(at >= 0, self.output[at], 1 + OWN + far)
            context[2:] = np.where(at >= 0, self.context[at], 1 + OWN_CONTEXTS + far // 2)
        else:
            out[:-1], context[2:] = 1 + OWN + far, 1 + OWN_CONTEXTS + far // 2
        return out, context[1:], context[:-1]


@dataclass
class Model:
    """Vectors of the two contexts and of the outputs, and their biases; ``head`` and what each class holds."""

    near: np.ndarray
    far: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    head: Head
    class_tokens: np.ndarray
    class_words: np.ndarray

    def log_probabilities(self) -> np.ndarray:
        """log10 of each class after each pair of contexts (far, near); a row adds up to one."""
        context = (self.far[:, None] + self.near[None]).reshape(-1, self.near.shape[1])
        logits = context @ self.output.T + self.bias
        logits -= logits.max(1, keepdims=True)
        return (logits - np.log(np.exp(logits).sum(1, keepdims=True))) / np.log(10)

    def class_norms(self) -> np.ndarray:
        """log10 of what a smoothed count is divided by in each class of several words."""
        return np.log10(self.class_tokens + SMOOTH * (self.class_words + 1))


def contrast(counts: np.ndarray, noise: np.ndarray, params: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """By pair of contexts and output: the log odds that it is no noise, its counts, and the noise it is told from.

    A pair of contexts that occurs m times meets ``NOISE`` * m outputs from the noise, taken by their expectation.
    """
    flat = counts.reshape(-1, counts.shape[2])
    context = (params["far"][:, None] + params["near"][None]).reshape(len(flat), -1)
    s = context @ params["output"].T + params["bias"] - np.log(NOISE * noise)
    return s, flat, flat.sum(1, keepdims=True) * (NOISE * noise), context


def nce_loss(counts: np.ndarray, noise: np.ndarray, params: dict[str, np.ndarray]) -> float:
    """Loss of noise-contrastive estimation per token."""
    s, flat, drawn, _ = contrast(counts, noise, params)
    return float((flat * np.logaddexp(0, -s) + drawn * np.logaddexp(0, s)).sum() / max(float(flat.sum()), 1.0))


def nce_gradients(counts: np.ndarray, noise: np.ndarray, params: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    s, flat, drawn, context = contrast(counts, noise, params)
    p = sigmoid(s)
    g = (drawn * p - flat * (1 - p)) / max(float(flat.sum()), 1.0)
    by_context = (g @ params["output"]).reshape(*counts.shape[:2], -1)
    return {
        "far": by_context.sum(1),
        "near": by_context.sum(0),
        "output": g.T @ context,
        "bias": g.sum(0),
    }


def fit(counts: np.ndarray, steps_: int = STEPS) -> dict[str, np.ndarray]:
    """Parameters after Adam steps over the whole counts; the bias begins at the class frequencies."""
    rng = np.random.default_rng(SEED)
    start = lambda n: (rng.normal(size=(n, DIMENSIONS)) * 0.1).astype(np.float32)
    seen = counts.sum((0, 1)) + 0.5
    noise = (seen / seen.sum()).astype(np.float32)
    params = {"far": start(counts.shape[0]), "near": start(counts.shape[1]), "output": start(counts.shape[2])}
    params["bias"] = np.log(noise)
    if counts.any():
        small, adam = counts.astype(np.float32), Adam(params, RATE)
        for step in range(steps_):
            adam.rate = RATE * (1 - step / steps_)
            adam.step(nce_gradients(small, noise, params))
    return params


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.binary()), pa.array(map(shape, found), pa.int32()), pa.array(found.values(), pa.int64())],
            names=["word", "shape", "c"],
        )

    for b in batches:
        for text in b.column("text"):
            found.update(words(text.as_py() or ""))
            if len(found) > GATHER:
                yield out()
                found.clear()
    if found:
        yield out()


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, shape, c``: every word of the texts as bytes, and how often it occurs."""
    found = docs.select(docs[text].alias("text")).mapInArrow(_word_rows, "word binary, shape int, c long")
    return found.groupBy("word", "shape").agg(F.sum("c").alias("c"))


def head_of(vocab: DataFrame, size: int = HEAD) -> Head:
    """At most ``size`` words of at most ``HEAD_BYTES`` bytes."""
    top = vocab.filter(F.length("word") <= HEAD_BYTES).orderBy(F.col("c").desc(), "word").limit(size).select("word", "c").toArrow()
    return Head(top.column("word").to_pylist(), top.column("c").to_numpy().astype(np.int64))


def _triple_rows(head: Head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CONTEXTS * CONTEXTS * OUTPUTS, np.int64)
        waiting: list[np.ndarray] = []
        room = 0
        for b in batches:
            for text in b.column("text"):
                out, near, far = head.classes(head.places(words(text.as_py() or "")))
                waiting.append((far * CONTEXTS + near) * OUTPUTS + out)
                room += len(out)
                if room > 1_000_000:
                    cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
                    waiting, room = [], 0
        if waiting:
            cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
        some = np.flatnonzero(cells)
        for at in range(0, len(some), 100_000):
            part = some[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(cells[part])], names=["cell", "n"])

    return run


def train(docs: DataFrame, vocab: DataFrame, text: str = "text", head: int = HEAD) -> Model:
    """Model of the texts of ``docs``, whose words ``vocab`` counts."""
    top = head_of(vocab, head)
    read = docs.select(docs[text].alias("text"))
    triples = read.mapInArrow(_triple_rows(top), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # One row for each triple of classes at most: CONTEXTS * CONTEXTS * OUTPUTS.
    got = triples.toArrow()
    counts = np.zeros(CONTEXTS * CONTEXTS * OUTPUTS)
    counts[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    params = fit(counts.reshape(CONTEXTS, CONTEXTS, OUTPUTS))
    tokens, distinct = np.zeros(OUTPUTS), np.zeros(OUTPUTS)
    for r in vocab.groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        tokens[1 + OWN + r["shape"]], distinct[1 + OWN + r["shape"]] = r["c"], r["v"]
    for w, c in zip(top.words[:OWN], top.counts[:OWN].tolist()):
        tokens[1 + OWN + shape(w)] -= c
        distinct[1 + OWN + shape(w)] -= 1
    return Model(params["near"], params["far"], params["output"], params["bias"], top, tokens, distinct)


def _score_rows(model: Model, kept: int, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.log_probabilities().ravel()
        norms, head = model.class_norms(), model.head
        logs = np.log10(head.counts + SMOOTH)
        names = [f.name for f in schema.fields]
        for whole in batches:
            for b in steps(whole, "text"):
                n, known, sums, lm, rare = [], [], [], [], []
                for value in b.column("text"):
                    found = words(value.as_py() or "")
                    at = head.places(found)
                    out, near, far = head.classes(at)
                    held = at >= 0
                    own = float(logs[at[held]].sum())
                    several = out[:-1] > OWN
                    # Rare words add their logarithm to both sums later on.
                    inside = float(logs[at[held & several]].sum()) - float(norms[out[:-1][several]].sum())
                    n.append(len(out))
                    known.append(int(held.sum()))
                    sums.append(own)
                    lm.append(float(table[(far * CONTEXTS + near) * OUTPUTS + out].sum()) + inside)
                    rare.append(list(Counter(w for w, p in zip(found, at.tolist()) if p < 0).items()))
                made = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(sums), pa.array(lm)]
                flat = [x for r in rare for x in r]
                pairs = pa.StructArray.from_arrays(
                    [pa.array([w for w, _ in flat], pa.binary()), pa.array([k for _, k in flat], pa.int64())], names=["word", "n"]
                )
                ends = np.concatenate(([0], np.cumsum([len(r) for r in rare]))).astype(np.int32)
                made.append(pa.ListArray.from_arrays(ends, pairs))
                yield pa.RecordBatch.from_arrays([*b.columns[:kept], *made], names=names)

    return run


def score(docs: DataFrame, training: Column, keep: tuple[str, ...] = ("doc_id",), text: str = "text", head: int = HEAD) -> DataFrame:
    """``keep, training, n_tokens, n_known, train_tokens, base_score, score`` of every row; ``training`` tells which to learn from."""
    names = [*keep, "training"]
    inner = [f"kept{i}" for i in range(len(names))]
    read = docs.select(*[docs[c].alias(k) for c, k in zip(keep, inner)], F.coalesce(training, F.lit(False)).alias(inner[-1]), docs[text].alias("text"))
    learnt = read.filter(F.col(inner[-1]))
    vocab = saved(vocabulary(learnt), "vocabulary")
    totals = vocab.agg(F.count("*").alias("v"), F.sum("c").alias("c")).first()
    ends = learnt.count()
    train_tokens, distinct = (totals["c"] or 0) + ends, totals["v"] + (ends > 0)
    model = train(learnt, vocab, head=head)

    pair = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    numbers = [("n_tokens", T.LongType()), ("known", T.LongType()), ("own", T.DoubleType()), ("lm", T.DoubleType())]
    kept = [f for f in read.schema.fields if f.name != "text"]
    schema = T.StructType(
        [T.StructField("row", T.LongType())]
        + [T.StructField(f.name, f.dataType) for f in kept]
        + [T.StructField(n, t) for n, t in numbers]
        + [T.StructField("rare", T.ArrayType(pair))]
    )
    # Numbers of rows are unique; written, they are the same ever after.
    numbered = read.select(F.monotonically_increasing_id().alias("row"), *inner, "text")
    scored = saved(numbered.mapInArrow(_score_rows(model, 1 + len(kept), schema), schema), "scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    joined = rare.join(vocab.select("word", "c"), "word", "left")
    tail = joined.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("tail"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("tail_known"),
    )
    whole = scored.drop("rare").join(tail, F.col("row") == F.col("of"), "left")
    base = float(np.log10(train_tokens + SMOOTH * (distinct + 1)))
    end = float(np.log10(ends + SMOOTH))
    tail_sum = F.coalesce("tail", F.lit(0.0))
    return whole.select(
        *[F.col(k).alias(c) for c, k in zip(names, inner)],
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("own") + tail_sum + end - F.col("n_tokens") * base).alias("base_score"),
        (F.col("lm") + tail_sum).alias("score"),
    )
