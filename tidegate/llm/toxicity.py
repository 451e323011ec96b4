"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Words are runs of letters, lower-cased. A word enters the network as a learned vector and the log odds of its label (word
input), and as vectors and log odds of its first and last characters (character input). The network reads windows of
``WINDOW`` words forward and backward, attention weighs its states into one vector, and that gives the window's score.
Windows overlap by half and cover the whole text; a text scores as its highest window. In training the gradient of a
text's loss goes through that window. Log odds come from the training sample with each text's own fold left out.

Defined results: a null, empty or wordless text scores as a window without words; a text of any length is read whole;
repeated rows give repeated results; an empty table gives an empty table; without labels of both kinds every text scores
as its network begins. Input columns named like an output column are replaced, all others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import add_columns
from .labels import Adam, sigmoid
from .words import words_of

#: Words in a window, and from one window's begin to the next.
WINDOW, STRIDE = 32, 16
#: Labelled rows that training reads at most.
SAMPLE_ROWS = 4000
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Rows at which the learned vectors would move as fast as the network: fewer move them less, so that a small sample isn't
#: learned by heart.
VECTOR_ROWS = 12_000
#: Training steps at least: a small sample is read more often.
LEAST_STEPS = 150
#: Weight of a toxic text in training; a missed one costs more than a wrong alarm.
POSITIVE = 1.5
HIDDEN, WORD_SIZE, CHAR_SIZE = 8, 4, 4
#: Hash buckets of log odds, and of learned vectors.
ODDS_BITS, WORD_BITS, CHAR_BITS = 18, 14, 13
#: Counted kinds of a word's hash: itself, its first 4, 6 and 8 characters, its last 4.
PREFIXES = (4, 6, 8)
KINDS = 5
SMOOTH = 2.0
FOLDS = 5
INPUT = KINDS + WORD_SIZE + CHAR_SIZE
#: Windows that are read at once.
CHUNK = 4096


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word of all texts, ``KINDS`` rows, and where each text's words begin (one more entry for the end)."""
    words = words_of(texts)
    kinds = [words.whole(), *words.edges(PREFIXES), *words.edges((4,), from_end=True)]
    return np.stack([h + np.uint64(k) for k, h in enumerate(kinds)]), words.rows


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of every window, in words, and each window's text; a text has one window at least."""
    n = np.diff(rows)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = rows[:-1][text] + nth * STRIDE
    return begin, np.minimum(WINDOW, rows[1:][text] - begin), text


@dataclass
class Model:
    odds: np.ndarray  # KINDS x buckets
    params: dict[str, np.ndarray]

    def inputs(self, hashes: np.ndarray, odds: np.ndarray | None = None) -> np.ndarray:
        """Input vector of every word, and one of zeros."""
        p = self.params
        out = np.zeros((hashes.shape[1] + 1, INPUT), np.float32)
        for k in range(KINDS):
            out[:-1, k] = self.odds[k][_bucket(hashes[k], ODDS_BITS)] if odds is None else odds[k]
        out[:-1, KINDS : KINDS + WORD_SIZE] = p["word"][_bucket(hashes[0], WORD_BITS)]
        chars = p["char"][_bucket(hashes[1], CHAR_BITS)] + p["char"][_bucket(hashes[2], CHAR_BITS)]
        out[:-1, KINDS + WORD_SIZE :] = chars + p["char"][_bucket(hashes[4], CHAR_BITS)]
        return out

    def read(self, x: np.ndarray, begin: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logit of every window; with ``keep`` also what the gradient needs."""
        p = self.params
        steps = int(size.max(initial=0))
        place = begin[:, None] + np.arange(steps)
        there = np.arange(steps) < size[:, None]
        place = np.where(there, place, len(x) - 1).T.copy()
        there = there.T[:, :, None].copy()
        states = np.zeros((max(steps, 1), len(begin), 2 * HIDDEN), np.float32)
        trace = []
        for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            given = x @ p[f"in{d}"] + p[f"bias{d}"]
            u = p[f"rec{d}"]
            h = np.zeros((len(begin), HIDDEN), np.float32)
            for t in order:
                g = given[place[t]]
                a = h @ u
                rz = sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                n = np.tanh(g[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
                new = np.where(there[t], n + z * (h - n), h)
                if keep:
                    trace.append((d, t, h, r, z, n, a[:, 2 * HIDDEN :]))
                h = new
                states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        pull = states @ p["pull"]
        if steps:
            pull = np.where(there[:, :, 0], pull, np.float32(-1e9))
            weight = np.exp(pull - pull.max(0))
            weight = np.where(there[:, :, 0], weight, np.float32(0))
            weight /= np.maximum(weight.sum(0), np.float32(1e-9))
        else:
            weight = np.zeros(pull.shape, np.float32)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        logit = pooled @ p["out"] + p["base"][0]
        return (logit, (states, weight, pooled, place, there, trace)) if keep else logit

    def gradient(self, x: np.ndarray, kept, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters, and of ``x``."""
        p = self.params
        states, weight, pooled, place, there, trace = kept
        grads = {"out": pooled.T @ d_logit, "base": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tbh,bh->tb", states, d_pooled)
        d_pull = weight * (d_weight - (weight * d_weight).sum(0))
        grads["pull"] = np.einsum("tb,tbh->h", d_pull, states)
        d_states += d_pull[:, :, None] * p["pull"]
        d_x = np.zeros_like(x)
        for d in (0, 1):
            u, w = p[f"rec{d}"], p[f"in{d}"]
            d_u, d_w, d_b = np.zeros_like(u), np.zeros_like(w), np.zeros_like(p[f"bias{d}"])
            dh = np.zeros((states.shape[1], HIDDEN), np.float32)
            for _, t, h, r, z, n, an in reversed([s for s in trace if s[0] == d]):
                dh = dh + d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
                on = there[t]
                dn = np.where(on, dh * (1 - z) * (1 - n * n), 0)
                dz = np.where(on, dh * (h - n) * z * (1 - z), 0)
                dr = dn * an * r * (1 - r)
                ga = np.concatenate((dr, dz, dn * r), 1)
                gi = np.concatenate((dr, dz, dn), 1)
                d_u += h.T @ ga
                xt = x[place[t]]
                d_w += xt.T @ gi
                d_b += gi.sum(0)
                np.add.at(d_x, place[t], gi @ w.T)
                dh = np.where(on, dh * z, dh) + ga @ u.T
            grads |= {f"rec{d}": d_u, f"in{d}": d_w, f"bias{d}": d_b}
        return grads, d_x

    def text_logits(self, x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Highest window's logit of each text, and that window's begin and size."""
        begin, size, text = windows(rows)
        logit = np.concatenate(
            [self.read(x, begin[i : i + CHUNK], size[i : i + CHUNK]) for i in range(0, len(begin), CHUNK)]
            or [np.zeros(0, np.float32)]
        )
        order = np.lexsort((logit, text))
        best = order[np.append(text[order][1:] != text[order][:-1], True)] if len(order) else order
        return logit[best], begin[best], size[best]

    def score(self, texts: pa.Array) -> np.ndarray:
        hashes, rows = word_hashes(texts)
        return sigmoid(self.text_logits(self.inputs(hashes), rows)[0].astype(np.float64))


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _log_odds(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log odds of label 1 per bucket from texts with it (bucket, label), drawn to 0 where few texts have it."""
    rate = totals / max(1.0, totals.sum())
    both = counts + SMOOTH * np.maximum(rate, 1e-3)
    return (np.log(both[..., 1] / both[..., 0]) - np.log(max(rate[1], 1e-3) / max(rate[0], 1e-3))).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """The network and its log odds from labelled texts."""
    rng = np.random.default_rng(seed)
    n_in = INPUT
    params = {
        "word": rng.normal(0, 0.05, (1 << WORD_BITS, WORD_SIZE)),
        "char": rng.normal(0, 0.05, (1 << CHAR_BITS, CHAR_SIZE)),
        "pull": rng.normal(0, 0.3, 2 * HIDDEN),
        "out": rng.normal(0, 0.5, 2 * HIDDEN),
        "base": np.array([-2.0]),
    }
    for d in (0, 1):
        params |= {
            f"in{d}": rng.normal(0, 0.4 / np.sqrt(n_in), (n_in, 3 * HIDDEN)),
            f"rec{d}": rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)),
            f"bias{d}": np.zeros(3 * HIDDEN),
        }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    counts = np.zeros((FOLDS + 1, KINDS, 1 << ODDS_BITS, 2), np.float32)  # the last: all folds
    totals = np.zeros((FOLDS + 1, 2))
    model = Model(np.zeros((KINDS, 1 << ODDS_BITS), np.float32), params)
    if len(set(labels.tolist())) < 2:
        return model
    made = [word_hashes(pa.array([t]))[0] for t in texts]
    for i, (h, y) in enumerate(zip(made, labels)):
        for k in range(KINDS):
            counts[i % FOLDS, k, np.unique(_bucket(h[k], ODDS_BITS)), y] += 1
        totals[i % FOLDS, y] += 1
    counts[FOLDS], totals[FOLDS] = counts[:FOLDS].sum(0), totals[:FOLDS].sum(0)
    others = []
    for f in range(FOLDS):
        others.append(_log_odds(counts[FOLDS] - counts[f], totals[FOLDS] - totals[f]))
    model.odds = _log_odds(counts[FOLDS], totals[FOLDS])
    del counts
    odds = [np.stack([others[i % FOLDS][k][_bucket(h[k], ODDS_BITS)] for k in range(KINDS)]) for i, h in enumerate(made)]
    del others
    share = min(1.0, len(texts) / VECTOR_ROWS)
    adam = Adam(params, RATE, {"word": share, "char": share})
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs) ** 0.5
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            h = np.concatenate([made[i] for i in batch], 1)
            rows = np.cumsum([0, *(made[i].shape[1] for i in batch)])
            x = model.inputs(h, np.concatenate([odds[i] for i in batch], 1))
            _, begin, size = model.text_logits(x, rows)
            logit, kept = model.read(x, begin, size, keep=True)
            weight = np.where(labels[batch] == 1, POSITIVE, 1.0)
            d = (weight * (sigmoid(logit) - labels[batch]) / len(batch)).astype(np.float32)
            grads, d_x = model.gradient(x, kept, d)
            d_x = d_x[:-1]
            for name, bits, kinds, part in (
                ("word", WORD_BITS, (0,), slice(KINDS, KINDS + WORD_SIZE)),
                ("char", CHAR_BITS, (1, 2, 4), slice(KINDS + WORD_SIZE, INPUT)),
            ):
                g = np.zeros_like(params[name])
                used = np.flatnonzero(np.abs(d_x).sum(1))
                for k in kinds:
                    np.add.at(g, _bucket(h[k][used], bits), d_x[used, part])
                grads[name] = g
            adam.step(grads)
    return model


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1, higher for texts likelier to be toxic."""
    field = T.StructField(into, T.DoubleType())
    return add_columns(df, text, [field], lambda texts: [pa.array(model.score(texts), pa.float64())])
