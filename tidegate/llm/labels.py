"""Bounded samples of labelled texts for training, and what models share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import saved

#: Longest text in a training sample and the most of all its texts, in code points; scoring has no such bounds.
TRAIN_CHARS, TRAIN_TOTAL = 200_000, 50_000_000


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, learnable: Column, text: str = "text"
) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``rows`` labelled documents for which ``learnable`` (over doc_id) holds.

    The rows with the smallest hash of their id are taken, as many as ``TRAIN_TOTAL`` has room for, so the sample is the same
    in every run. A document counts once: of several texts of one id the smallest by its bytes is taken, of several labels
    the largest. Rows without a label and labels without a document are left out.
    """
    chosen = (
        labels.filter(learnable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).filter(F.length("text") <= TRAIN_CHARS)
    # At most ``rows`` rows of two numbers are sent to every task, and as many documents come together.
    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    once = saved(once, "sample")
    sizes = once.select("doc_id", F.length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    taken = int(np.searchsorted(np.cumsum([r["n"] for r in sizes]), TRAIN_TOTAL, side="right"))
    found = once.filter(F.col("doc_id").isin([r["doc_id"] for r in sizes[:taken]])) if taken < len(sizes) else once
    pairs = sorted((r["doc_id"], r["text"], r["label"]) for r in found.select("doc_id", "text", "label").collect())
    return [t for _, t, _ in pairs], np.array([y for _, _, y in pairs], np.int64)


class Adam:
    """Adam steps over a dict of arrays, in place; ``shares`` slows some of them."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, shares: dict[str, float] | None = None):
        self.params, self.rate, self.shares, self.t = params, rate, shares or {}, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            rate = self.rate * self.shares.get(k, 1.0) * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
            self.params[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(self.params[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5
