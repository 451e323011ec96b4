"""Vector codes against plain Lloyd rounds in Python integers."""

import math
import random

import numpy as np
import pytest

from tests.conftest import rows
from tidegate.llm import vector_codes


def plain(given, parts, entries, rounds, scale):
    """Codes and errors of (id, vector) rows, in their order, and the codebooks."""
    kept = [r for r in given if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    w = math.ceil(max((len(v) for _, v in kept), default=0) / parts)
    most = vector_codes.bound(w * parts)
    ints = [[max(-most, min(most, math.floor(x * scale))) for x in v] for _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i]))
    whole = [v + [0] * (w * parts - len(v)) for v in ints]
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in whole]
    books = [[list(cut[i][p]) for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for v in cut:
                of.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for k, xs in of.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    coded = []
    for (i, _), v in zip(kept, cut):
        found = [nearest(v[p], books[p]) for p in range(parts)]
        coded.append((i, bytes(k for _, k in found), sum(d for d, _ in found)))
    return coded, books


def check(spark, given, **how):
    how = {"parts": 8, "entries": 16, "rounds": 6, "scale": 4096} | how
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(3)
    made = vector_codes.compress(df, **how)
    coded, books = plain(given, **how)
    got = [(r["vec_id"], bytes(r["code"]), r["error"]) for r in made.vectors.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(got, key=key) == sorted(coded, key=key)
    assert made.books.tolist() == books or not coded


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_equal_plain_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, 16)) * 0.3
    given = [(i, (centers[i % 5] + rng.normal(size=16) * 0.05).tolist()) for i in range(300)]
    check(spark, given)
    check(spark, given, parts=4, entries=3, rounds=2, scale=10)


def test_ties_go_to_the_lower_entry(spark):
    random.seed(3)
    # whole numbers of a small range: many parts lie equally far from several entries
    check(spark, [(i, [float(random.randint(-2, 2)) for _ in range(8)]) for i in range(200)], scale=1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (1, None), (2, [nan] * 8), (3, [inf] + [0.0] * 7), (4, [None] + [0.5] * 7), (5, []), (6, [0.25] * 5), (7, [-0.25] * 11),
        (8, [1e60] * 8), (8, [-1e60] * 8), (8, [0.1] * 8), (8, [0.1] * 8), (None, [0.2] * 8), (None, [0.2] * 8), (9, [-1e-9] * 8),
    ]
    check(spark, given, scale=1)
    check(spark, [(1, []), (2, [])])
    check(spark, [(1, None), (2, [nan])])


def test_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(none, keep=("label",)).vectors.columns == ["vec_id", "label", "code", "error"]
    assert vector_codes.compress(none).vectors.count() == 0
    odd = spark.createDataFrame(
        [(1, [0.5] * 8, 7, "a"), (2, [0.25] * 8, None, "b")], "vec_id long, embedding array<float>, entry int, part string"
    )
    got = vector_codes.compress(odd, keep=("entry", "part")).vectors
    assert rows(got.select("vec_id", "entry", "part", "error")) == [(1, 7, "a", 0), (2, None, "b", 0)]


def test_active_entries_equal_a_full_scan():
    rng = np.random.default_rng(5)
    x = rng.integers(-9, 9, (400, 3))
    book = rng.integers(-9, 9, (7, 3))
    code, best = vector_codes.scan(x, book)
    for _ in range(5):
        moved = rng.random(7) < 0.4
        book = np.where(moved[:, None], rng.integers(-9, 9, (7, 3)), book)
        vector_codes.rescan(x, book, moved, code, best)
        full = vector_codes.scan(x, book)
        assert (code == full[0]).all() and (best == full[1]).all()
