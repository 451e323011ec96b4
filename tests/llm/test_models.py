"""Held-out accuracy and gradients of the trained models, and their edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_operators import EDGES, docs
from tidegate.llm import labels, quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.1"


def labelled(spark, label, folds, held_out):
    rows = (
        spark.read.parquet(f"{SF_DIR}/documents.parquet")
        .join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
        .orderBy("doc_id")
        .limit(2200)
        .select("doc_id", "text", label)
        .collect()
    )
    out = np.array([zlib.crc32(str(r[0]).encode()) % folds == held_out for r in rows])
    texts, y = [r[1] for r in rows], np.array([r[2] for r in rows])
    pick = lambda k: ([t for t, a in zip(texts, k) if a], y[k])
    return pick(~out), pick(out)


def test_toxicity_is_right_on_held_out_texts(spark):
    (texts, y), (others, z) = labelled(spark, "toxic", 5, 0)
    model = toxicity.train(texts, y)
    got = model.score(pa.array(others)) >= 0.5
    assert (got == z).mean() > 0.95 and got[z == 1].mean() > 0.7 and got[z == 0].mean() < 0.02
    alone = [model.score(pa.array([t]))[0] for t in others[:20]]
    assert np.allclose(alone, model.score(pa.array(others[:20])), atol=1e-5)


def test_quality_is_right_on_held_out_texts(spark):
    (texts, y), (others, z) = labelled(spark, "quality", 3, 1)
    model = quality.train(texts, y)
    assert ((model.score(pa.array(others)) >= 0.5) == z).mean() > 0.97
    alone = [model.score(pa.array([t]))[0] for t in others[:20]]
    assert np.allclose(alone, model.score(pa.array(others[:20])))


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    model = toxicity.train(["a"], np.array([1]))
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x = rng.normal(size=(41, toxicity.INPUT))
    x[-1] = 0
    begin, size, d = np.array([0, 16, 40]), np.array([20, 24, 0]), rng.normal(size=3)
    logit, kept = model.read(x, begin, size, keep=True)
    grads, d_x = model.gradient(x, kept, d)
    for name in ("in0", "rec1", "bias0", "pull", "out"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        keep = model.params[name][at]
        values = []
        for e in (1e-4, -1e-4):
            model.params[name][at] = keep + e
            values.append((model.read(x, begin, size) * d).sum())
        model.params[name][at] = keep
        assert np.isclose((values[0] - values[1]) / 2e-4, grads[name][at], rtol=2e-2, atol=1e-4), name
    assert not d_x[-1].any() or size.min() == 0


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        begin, size, text = toxicity.windows(np.array([0, n]))
        assert set(range(n)) == {i for b, s in zip(begin, size) for i in range(b, b + s)} and len(begin) >= 1
        assert (np.diff(begin) == toxicity.STRIDE).all()


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edge_cases(spark, module):
    model = module.train(["good words here", "bad words there"] * 8, np.array([0, 1] * 8))
    df = docs(spark, EDGES).withColumn("Score", F.lit("x"))
    got = {r["doc_id"]: r["score"] for r in module.score(df, model).collect()}
    assert len(got) == len(EDGES) and all(0 <= s <= 1 for s in got.values())
    assert got[0] == got[1] == got[2] and got[7] == got[8]
    assert module.score(docs(spark, []), model).count() == 0
    assert module.train([], np.zeros(0, np.int64)).score(pa.array(["x"])).shape == (1,)


def test_sample_leaves_the_held_out_fold_out(spark):
    table = docs(spark, [f"text {i}" for i in range(60)])
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    texts, y = labels.sample(table, marks, "toxic", 1000, labels.fold_of(F.col("doc_id"), 5) != 0)
    want = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 0]
    assert sorted(texts) == sorted(f"text {i}" for i in want) and len(y) == len(want)
    assert len(labels.sample(table, marks, "toxic", 7, F.lit(True))[0]) == 7
    assert labels.sample(table.limit(0), marks, "toxic", 7, F.lit(True))[0] == []


def test_copies_push_no_labelled_row_out(spark):
    """Ten thousand rows of one labelled id, two labels and two texts for others: each document counts once."""
    table = [(1, "copied")] * 10_000 + [(i, f"text {i}") for i in range(2, 8)] + [(3, "another"), (3, None)]
    docs_ = spark.createDataFrame(table, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 0) for i in range(1, 8)] + [(2, 1), (1, 0)] * 3, "doc_id long, toxic int")
    want = [("copied", 0), ("text 2", 1), ("", 0), ("text 4", 0), ("text 5", 0), ("text 6", 0), ("text 7", 0)]
    for given in (docs_, docs_.repartition(5), docs_.orderBy(F.rand(3))):
        texts, y = labels.sample(given, marks.repartition(3), "toxic", 7, F.lit(True))
        assert list(zip(texts, y.tolist())) == want


def test_sample_has_a_bound_in_characters(spark, monkeypatch):
    table = spark.createDataFrame([(i, "x" * (10 + i)) for i in range(50)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    whole = labels.sample(table, marks, "toxic", 100, F.lit(True))[0]
    monkeypatch.setattr(labels, "TRAIN_TOTAL", 500)
    some = labels.sample(table, marks, "toxic", 100, F.lit(True))[0]
    assert len(whole) == 50 and 5 < len(some) < 50 and sum(map(len, some)) <= 500
    assert some == labels.sample(table.repartition(9), marks, "toxic", 100, F.lit(True))[0]


def test_queries_mark_the_folds(spark):
    for query, folds, fold in ((queries.op3_toxicity, 5, 0), (queries.op9_quality, 3, 1)):
        got = query(spark, "/root/testdata/sf0.001").collect()
        assert len(got) == 200
        for r in got:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
            assert r["predicted"] == int(r["score"] >= 0.5)
