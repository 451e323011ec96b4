"""Scores of the language model against plain counting and a plain forward pass, and its training against differences."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import labels, lm_score, queries

SF_DIR = "/root/testdata/sf0.001"


def plain_base(texts, learnt):
    """n_tokens, n_known, base score of each text."""
    split = [lm_score.words(t or "") for t in texts]
    c = Counter(w for s, ok in zip(split, learnt) if ok for w in s)
    ends = sum(learnt)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    over = math.log10(n + 0.1 * (v + 1))
    out = []
    for s in split:
        known = sum(c[w] > 0 for w in s) + (ends > 0)
        out.append((len(s) + 1, known, n, sum(math.log10(c[w] + 0.1) - over for w in s) + math.log10(ends + 0.1) - over))
    return out


def plain_score(model, vocab, text):
    """One token after the other, with a softmax of its own."""
    found = lm_score.words(text or "")
    place = {w: i for i, w in enumerate(model.head.words)}
    output = lambda w: 1 + place[w] if place.get(w, lm_score.OWN) < lm_score.OWN else 1 + lm_score.OWN + lm_score.shape(w)

    def context(w):
        if place.get(w, lm_score.OWN_CONTEXTS) < lm_score.OWN_CONTEXTS:
            return 1 + place[w]
        return 1 + lm_score.OWN_CONTEXTS + lm_score.shape(w) // 2

    far = near = 0
    total = 0.0
    for w in [*found, None]:
        logits = model.output.astype(float) @ (model.far[far] + model.near[near]).astype(float) + model.bias
        k = lm_score.END if w is None else output(w)
        total += (logits[k] - logits.max() - math.log(np.exp(logits - logits.max()).sum())) / math.log(10)
        if k > lm_score.OWN:
            total += math.log10(vocab.get(w, 0) + 0.1) - math.log10(model.class_tokens[k] + 0.1 * (model.class_words[k] + 1))
        if w is not None:
            far, near = near, context(w)
    return total


def close(a, b):
    return abs(a - b) <= 1e-4 * max(1.0, abs(a))


@pytest.fixture(scope="module")
def whole(spark):
    return {r["doc_id"]: r for r in queries.QUERIES["op12_lm_score"](spark, SF_DIR).collect()}


def test_query_counts_all_documents(spark, whole):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("fold", labels.fold_of(F.col("doc_id"), 10)).collect()
    want = plain_base([r["text"] for r in docs], [r["fold"] != 0 for r in docs])
    assert len(whole) == len(docs)
    for r, (n, known, train, base) in zip(docs, want):
        got = whole[r["doc_id"]]
        assert (got["held_out"], got["n_tokens"], got["n_known"], got["train_tokens"]) == (r["fold"] == 0, n, known, train)
        assert close(base, got["base_score"])


def test_query_scores_equal_a_plain_forward_pass(spark, whole):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learnt = docs.filter(labels.fold_of(F.col("doc_id"), 10) != 0)
    vocab = lm_score.vocabulary(learnt)
    model = lm_score.train(learnt, vocab)
    counts = {bytes(r["word"]): r["c"] for r in vocab.collect()}
    for r in docs.collect():
        assert close(plain_score(model, counts, r["text"]), whole[r["doc_id"]]["score"])


def test_model_beats_the_base_on_held_out_texts(whole):
    held = [r for r in whole.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learnable = labels.fold_of(F.col("doc_id"), 10) != 0
    monkeypatch.setattr(lm_score, "GATHER", 50)
    wide = {r["doc_id"]: r for r in lm_score.score(docs, learnable).collect()}
    narrow = {r["doc_id"]: r for r in lm_score.score(docs, learnable, head=lm_score.OWN).collect()}
    for k, r in wide.items():
        assert close(r["score"], narrow[k]["score"]) and close(r["base_score"], narrow[k]["base_score"])
        assert r["n_known"] == narrow[k]["n_known"]


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, (lm_score.CONTEXTS, lm_score.CONTEXTS, lm_score.OUTPUTS)) * (rng.random(lm_score.OUTPUTS) < 0.2)
    params = lm_score.fit(counts.astype(float), 5)
    head = lm_score.Head([b"a", b"bc"], np.array([5, 3]))
    model = lm_score.Model(params["near"], params["far"], params["output"], params["bias"], head, np.ones(lm_score.OUTPUTS), np.ones(lm_score.OUTPUTS))
    sums = (10.0 ** model.log_probabilities()).sum(1)
    assert len(sums) == lm_score.CONTEXTS**2 and np.allclose(sums, 1, atol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    counts, noise = rng.integers(0, 9, (3, 3, 5)).astype(float), np.full(5, 0.2)
    params = {"far": rng.normal(size=(3, 4)), "near": rng.normal(size=(3, 4)), "output": rng.normal(size=(5, 4)), "bias": rng.normal(size=5)}
    grads = lm_score.nce_gradients(counts, noise, params)
    for name, p in params.items():
        for at in np.ndindex(p.shape):
            was, step = p[at], 1e-6
            p[at] = was + step
            up = lm_score.nce_loss(counts, noise, params)
            p[at] = was - step
            down = lm_score.nce_loss(counts, noise, params)
            p[at] = was
            assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-6


def test_training_learns_the_order_of_words():
    counts = np.zeros((2, 2, 4))
    counts[0, 0], counts[0, 1], counts[1, 0], counts[1, 1] = [70, 10, 10, 10], [10, 70, 10, 10], [10, 10, 70, 10], [10, 10, 10, 70]
    params = lm_score.fit(counts, 400)
    s = (params["far"][:, None] + params["near"][None]) @ params["output"].T + params["bias"]
    p = np.exp(s) / np.exp(s).sum(-1, keepdims=True)
    assert (p.argmax(-1) == [[0, 1], [2, 3]]).all()


def test_odd_rows(spark):
    long = " ".join(f"w{k % 90_000}" for k in range(200_000))
    given = [
        (1, None, True), (2, "", True), (3, " \t\n", True), (4, "One one ÉÉ", True), (4, "One one ÉÉ", True), (5, long, True),
        (6, "x" * 500 + " one", True), (None, "never seen", None), (8, "x" * 500 + " unseen", False), (9, long, False),
    ]
    df = spark.createDataFrame(given, "doc_id long, text string, learn boolean")
    for c in ("row", "kept0", "word", "tail", "n_tokens", "score"):
        df = df.withColumn(c, F.lit("mine"))
    got = lm_score.score(df, F.col("learn"), keep=("doc_id", "row")).collect()
    assert {r["row"] for r in got} == {"mine"} and len(got) == len(given)
    want = plain_base([t for _, t, _ in given], [bool(ok) for _, _, ok in given])
    key = lambda r: tuple((v is None, v or 0) for v in r)
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got), key=key)
    assert have == sorted(((g[0], *w[:3]) for g, w in zip(given, want)), key=key)
    bases = {r["doc_id"]: r["base_score"] for r in got}
    assert all(close(w[3], bases[g[0]]) for g, w in zip(given, want))
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_no_training_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (r,) = lm_score.score(df, F.lit(False)).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] < 0
    assert lm_score.score(df.limit(0), F.lit(True)).count() == 0
