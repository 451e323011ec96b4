"""Quality of texts by attention-based multiple-instance learning, trained in numpy.

A text is a bag of passages of ``PASSAGE`` words. Every passage is described by shares of its characters, words and repeats,
encoded by a small network, and weighed against the others by gated attention: a tanh layer says what a passage is, a
sigmoid gate how much that matters, and a softmax over the text's passages makes weights of both. The weighted sum of the
passages represents the text and gives its score. Only labels of whole texts are learned from; the attention finds the
passages that decide.

Defined results: a null, empty or wordless text is one passage of zeros; a text of any length is read whole; repeated rows
give repeated results; an empty table gives an empty table; without labels of both kinds every text scores as the network
begins. Input columns named like an output column are replaced, all others are kept.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import BLANK, LETTER, NUMBER, SPACE, classes
from .frames import add_columns, code_points
from .labels import Adam, sigmoid

PASSAGE = 48
SAMPLE_ROWS = 4000
EPOCHS, BATCH, RATE, LEAST_STEPS = 12, 64, 0.01, 600
ENCODED, GATES = 16, 8
DECAY = 1e-4

#: Kinds of code points whose share of a passage is a feature.
KINDS = ("letter", "upper", "digit", "white", "line", "sentence", "comma", "bar", "bang", "mark", "symbol", "control")
WORD_FEATURES = ("length", "long", "short", "capital", "repeat1", "repeat", "sentence words", "words")
FEATURES = len(KINDS) + len(WORD_FEATURES) + 1


@cache
def kinds() -> np.ndarray:
    """The kind of every code point that counts as one of ``KINDS``, as a bit."""
    base = classes()
    out = np.zeros(0x110000, np.uint16)
    bit = {k: 1 << i for i, k in enumerate(KINDS)}
    out[base == LETTER] |= bit["letter"]
    out[base == NUMBER] |= bit["digit"]
    out[(base == SPACE) | (base == BLANK)] |= bit["white"]
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k == "Lu":
            out[c] |= bit["upper"]
        elif k[0] == "S":
            out[c] |= bit["symbol"]
        elif k in ("Cc", "Co", "Cn") and out[c] == 0:
            out[c] |= bit["control"]
        elif k[0] == "P" and c not in (0x2C, 0x2E, 0x3F):
            out[c] |= bit["mark"]
    for name, chars in (("line", "\n"), ("sentence", ".?"), ("comma", ","), ("bar", "|"), ("bang", "!")):
        out[[ord(c) for c in chars]] |= bit[name]
    return out


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of all texts, and where each text's passages begin (one more entry for the end)."""
    codes, bounds, _, _ = code_points(texts)
    n_texts = len(texts)
    kind = kinds()[codes]
    white = (kind & (1 << KINDS.index("white"))) != 0
    first = ~white
    first[1:] &= white[:-1]
    at_text = bounds[:-1][bounds[:-1] < len(codes)]
    first[at_text] = ~white[at_text]
    starts = np.flatnonzero(first)
    rows = np.searchsorted(starts, bounds)
    n_words = np.diff(rows)
    count = np.maximum(1, -(-n_words // PASSAGE))
    ends = np.cumsum(count)
    total = int(ends[-1]) if n_texts else 0
    out = np.zeros((total, FEATURES), np.float32)
    out[:, -1] = 1.0
    bags = np.concatenate(([0], ends))
    if not len(starts):
        return out, bags
    # The passage of every word, then of every character: a word's white space goes with it.
    nth = np.arange(len(starts)) - np.repeat(rows[:-1], n_words)
    of_word = np.repeat(bags[:-1], n_words) + nth // PASSAGE
    edge = np.flatnonzero(np.append(True, of_word[1:] != of_word[:-1]))  # first word of each passage that has words
    here = of_word[edge]
    n = np.diff(np.append(edge, len(starts))).astype(np.float32)
    begin = starts[edge]
    last = np.append(begin[1:], len(codes))
    text_end = bounds[1:][np.searchsorted(ends, here, side="right")]
    last = np.minimum(last, text_end)
    cuts = np.stack((begin, last), 1).ravel()
    size = (last - begin).astype(np.float32)
    padded = np.append(kind, np.uint16(0))
    for i in range(len(KINDS)):
        counts = np.add.reduceat(((padded >> i) & 1).astype(np.int32), cuts)[::2]
        out[here, i] = counts / size
    # Words: end at the next white space or word.
    stop = np.flatnonzero(white | np.append(first[1:], True) | np.append(np.isin(np.arange(1, len(codes)), at_text), True))
    word_end = stop[np.searchsorted(stop, starts)]
    length = (word_end - starts + ~white[word_end]).astype(np.float32)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    begins = np.concatenate(([0], starts))
    place = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
    mixed *= (place.astype(np.uint64) << np.uint64(1)) + np.uint64(0xD6E8FEB86659FD93)
    mixed[white] = 0
    h = np.add.reduceat(mixed, starts)
    upper = ((kind[starts] >> KINDS.index("upper")) & 1).astype(np.float32)
    order = np.lexsort((h, of_word))
    seen = np.zeros(len(h), np.float32)
    seen[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (of_word[order[1:]] == of_word[order[:-1]])
    next_same = np.zeros(len(h), np.float32)
    next_same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    at = len(KINDS)
    for j, values in enumerate((length / 8, length > 12, length <= 2, upper, next_same, seen)):
        out[here, at + j] = np.add.reduceat(np.asarray(values, np.float32), edge) / n
    out[here, at + 6] = np.minimum(3.0, out[here, KINDS.index("sentence")] * size / n * 6)
    out[here, at + 7] = n / PASSAGE
    return out, bags


def _segment_softmax(x: np.ndarray, bags: np.ndarray) -> np.ndarray:
    sizes = np.diff(bags)
    top = np.repeat(np.maximum.reduceat(x, bags[:-1]), sizes)
    e = np.exp(x - top)
    return e / np.repeat(np.add.reduceat(e, bags[:-1]), sizes)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bags: np.ndarray):
        p = self.params
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["enc"] + p["enc_bias"])
        v, u = np.tanh(h @ p["what"]), sigmoid(h @ p["gate"])
        weight = _segment_softmax((v * u) @ p["pull"], bags)
        bag = np.add.reduceat(weight[:, None] * h, bags[:-1])
        return bag @ p["out"] + p["base"][0], (x, h, v, u, weight, bag)

    def gradient(self, kept, bags: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        x, h, v, u, weight, bag = kept
        sizes = np.diff(bags)
        d_bag = np.repeat(d[:, None] * p["out"], sizes, axis=0)
        d_weight = (d_bag * h).sum(1)
        mean = np.repeat(np.add.reduceat(weight * d_weight, bags[:-1]), sizes)
        d_pull = weight * (d_weight - mean)
        d_vu = d_pull[:, None] * p["pull"]
        d_v, d_u = d_vu * u * (1 - v * v), d_vu * v * u * (1 - u)
        d_h = weight[:, None] * d_bag + d_v @ p["what"].T + d_u @ p["gate"].T
        d_e = d_h * (1 - h * h)
        grads = {
            "out": bag.T @ d, "base": np.array([d.sum()]), "pull": (v * u).T @ d_pull, "what": h.T @ d_v,
            "gate": h.T @ d_u, "enc": x.T @ d_e, "enc_bias": d_e.sum(0),
        }
        return {k: g + DECAY * p[k] for k, g in grads.items()}

    def score(self, texts: pa.Array) -> np.ndarray:
        x, bags = passages(texts)
        return sigmoid(self.forward(x, bags)[0].astype(np.float64)) if len(texts) else np.zeros(0)


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> Model:
    """The network from labelled texts."""
    rng = np.random.default_rng(seed)
    params = {
        "enc": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, ENCODED)),
        "enc_bias": np.zeros(ENCODED),
        "what": rng.normal(0, 1 / np.sqrt(ENCODED), (ENCODED, GATES)),
        "gate": rng.normal(0, 1 / np.sqrt(ENCODED), (ENCODED, GATES)),
        "pull": rng.normal(0, 0.5, GATES),
        "out": rng.normal(0, 1 / np.sqrt(ENCODED), ENCODED),
        "base": np.zeros(1),
    }
    model = Model(np.zeros(FEATURES), np.ones(FEATURES), params)
    if len(set(labels.tolist())) < 2:
        return model
    made = [passages(pa.array([t]))[0].astype(np.float64) for t in texts]
    every = np.concatenate(made)
    model.mean, model.scale = every.mean(0), every.std(0) + 1e-3
    adam = Adam(params, RATE)
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            bags = np.cumsum([0, *(len(made[i]) for i in batch)])
            logit, kept = model.forward(np.concatenate([made[i] for i in batch]), bags)
            adam.step(model.gradient(kept, bags, (sigmoid(logit) - labels[batch]) / len(batch)))
    return model


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1, higher for texts likelier to be good."""
    field = T.StructField(into, T.DoubleType())
    return add_columns(df, text, [field], lambda texts: [pa.array(model.score(texts), pa.float64())])
