"""The models' scores against forward passes written out word by word, and passage features against plain counting."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import quality, toxicity

TEXTS = ["", " \n", "One", "Good words, and BAD ones! " * 3, "é 中文 x1 y_z 1,000 | a|b\n\nnew line. Is it? " * 9, "same same Same " * 70]


def texts(seed, n):
    random.seed(seed)
    words = ["fool", "idiot", "kind", "The", "sea", "blue,", "x1", "é", "run.", "|", "!!", "a", "verylongwordindeed"]
    return TEXTS + [" ".join(random.choices(words, k=random.randint(1, 150))) for _ in range(n)]


def sig(x):
    return 1 / (1 + math.exp(-x))


def gru(model, inputs, d):
    """States of one direction, in the order of the words."""
    p, n = model.params, toxicity.HIDDEN
    w, u, b = (p[f"{k}{d}"].astype(float) for k in ("in", "rec", "bias"))
    h, out = np.zeros(n), [None] * len(inputs)
    order = range(len(inputs)) if d == 0 else range(len(inputs) - 1, -1, -1)
    for t in order:
        g, a = inputs[t] @ w + b, h @ u
        new = np.zeros(n)
        for k in range(n):
            r, z = sig(g[k] + a[k]), sig(g[n + k] + a[n + k])
            c = math.tanh(g[2 * n + k] + r * a[2 * n + k])
            new[k] = (1 - z) * c + z * h[k]
        h = out[t] = new
    return out


def toxic_score(model, text):
    """The highest of all half-overlapping windows, each read on its own."""
    hashes, rows = toxicity.word_hashes(pa.array([text]))
    every = model.inputs(hashes)[:-1].astype(float)
    n = int(rows[-1])
    begins = [0]
    while begins[-1] + toxicity.WINDOW < n:
        begins.append(begins[-1] + toxicity.STRIDE)
    best = -math.inf
    for begin in begins:
        x = every[begin : begin + toxicity.WINDOW]
        logit = float(model.params["base"][0])
        if len(x):
            states = [np.concatenate(s) for s in zip(gru(model, x, 0), gru(model, x, 1))]
            pulls = [math.exp(float(s @ model.params["pull"])) for s in states]
            logit += sum(w / sum(pulls) * float(s @ model.params["out"]) for w, s in zip(pulls, states))
        best = max(best, logit)
    return sig(best)


def test_toxicity_equals_a_plain_forward_pass():
    given = texts(1, 40)
    model = toxicity.train(given, np.array(["idiot" in t for t in given], np.int64))
    got = model.score(pa.array(given))
    assert np.allclose(got, [toxic_score(model, t) for t in given], atol=1e-4)


def plain_passages(text):
    """Features of every passage, by counting characters and words one after the other."""
    bits = quality.kinds()
    white = 1 << quality.KINDS.index("white")
    starts = [i for i, c in enumerate(text) if not bits[ord(c)] & white and (i == 0 or bits[ord(text[i - 1])] & white)]
    out = []
    for a in range(0, max(1, len(starts)), quality.PASSAGE):
        mine = starts[a : a + quality.PASSAGE]
        row = dict.fromkeys((*quality.KINDS, *quality.WORD_FEATURES), 0.0)
        if mine:
            end = starts[a + quality.PASSAGE] if a + quality.PASSAGE < len(starts) else len(text)
            chars = text[mine[0] : end]
            for i, k in enumerate(quality.KINDS):
                row[k] = sum(bool(bits[ord(c)] >> i & 1) for c in chars) / len(chars)
            words = []
            for s in mine:
                e = s
                while e < len(text) and not bits[ord(text[e])] & white:
                    e += 1
                words.append(text[s:e])
            n = len(words)
            row["length"] = sum(map(len, words)) / 8 / n
            row["long"], row["short"] = sum(len(w) > 12 for w in words) / n, sum(len(w) <= 2 for w in words) / n
            row["capital"] = sum(bool(bits[ord(w[0])] >> quality.KINDS.index("upper") & 1) for w in words) / n
            row["repeat1"] = sum(x == y for x, y in zip(words, words[1:])) / n
            row["repeat"] = (n - len(set(words))) / n
            row["sentence words"] = min(3.0, row["sentence"] * len(chars) / n * 6)
            row["words"] = n / quality.PASSAGE
        out.append([*row.values(), 1.0])
    return out


@pytest.mark.parametrize("text", texts(2, 25))
def test_passages_equal_plain_counting(text):
    got, bags = quality.passages(pa.array(["before it", text, "after"]))
    mine = got[bags[1] : bags[2]]
    assert np.allclose(mine, np.array(plain_passages(text)), atol=1e-5)


def good_score(model, text):
    p = {k: np.asarray(v, float) for k, v in model.params.items()}
    encoded, pulls = [], []
    for row in plain_passages(text):
        x = [max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(row, model.mean, model.scale)]
        h = np.array([math.tanh(sum(a * b for a, b in zip(x, p["enc"][:, j])) + p["enc_bias"][j]) for j in range(quality.ENCODED)])
        gated = [math.tanh(float(h @ p["what"][:, g])) * sig(float(h @ p["gate"][:, g])) for g in range(quality.GATES)]
        encoded.append(h)
        pulls.append(math.exp(sum(a * b for a, b in zip(gated, p["pull"]))))
    bag = sum(w / sum(pulls) * h for w, h in zip(pulls, encoded))
    return sig(float(bag @ p["out"]) + float(p["base"][0]))


def test_quality_equals_a_plain_forward_pass():
    given = texts(3, 40)
    model = quality.train(given, np.array([len(t) % 2 for t in given], np.int64))
    assert np.allclose(model.score(pa.array(given)), [good_score(model, t) for t in given], atol=1e-4)


def test_quality_gradients():
    rng = np.random.default_rng(0)
    model = quality.train(["a"], np.array([1]))
    x, bags, d = rng.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5, 9]), rng.normal(size=3)
    _, kept = model.forward(x, bags)
    grads = model.gradient(kept, bags, d)
    for name, p in model.params.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), p.shape)
        was, values = p[at], []
        for e in (1e-5, -1e-5):
            p[at] = was + e
            values.append(float((model.forward(x, bags)[0] * d).sum()))
        p[at] = was
        assert np.isclose((values[0] - values[1]) / 2e-5, grads[name][at] - quality.DECAY * was, rtol=1e-3, atol=1e-6), name
