"""The pipeline's stages, each against a plain version on what its predecessor kept, and with odd rows."""

import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_similarity import joined, sets_of
from tidegate.llm import bpe, pii, queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage returns, by name."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        out[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == COLUMNS
            docs = spark.createDataFrame(out[name], docs.schema)
    return out


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]


def test_toxic_documents_go(spark, stages):
    given, kept = texts(stages["documents"]), texts(stages["toxicity"])
    model = queries.toxicity_model(spark, SF_DIR)
    score = dict(zip(given, model.score(pa.array(list(given.values())))))
    assert kept == {i: t for i, t in given.items() if score[i] < 0.5}


def test_one_of_each_group_stays(stages):
    given, kept = texts(stages["toxicity"]), texts(stages["near_duplicates"])
    sets = sets_of(given)

    def alike(a, b):
        return len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    similar = [(a, b) for a, b in itertools.combinations(given, 2) if alike(a, b)]
    of = joined(given, similar)
    assert kept == {i: t for i, t in given.items() if of[i] == i} and len(kept) < len(given)


def test_documents_with_passages_go(spark, stages):
    split = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [split(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    given, kept = texts(stages["near_duplicates"]), texts(stages["decontamination"])
    assert kept == {i: t for i, t in given.items() if not any(x in split(t) for x in items)}


def test_personal_data_is_masked(stages):
    given = texts(stages["decontamination"])
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in stages["personal_data"]} == {
        (i, pii.mask(t), len(pii.mask(t))) for i, t in given.items()
    }


def test_tokens(stages):
    given = texts(stages["personal_data"])
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(queries.RANKS), special_tokens={}
    )
    assert len(stages["tokens"]) == len(given)
    for r in stages["tokens"]:
        ids = np.array(library.encode_ordinary(given[r["doc_id"]]), "<u4")
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest() and r["n_tokens"] == len(ids)


def test_odd_rows_and_columns(spark):
    passage = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    long = " ".join(f"w{k}" for k in range(40_000))
    given = [
        (1, None), (2, ""), (3, "one text"), (3, "one text"), (4, "One  TEXT"), (5, "x " + passage + " y"), (None, "kept alone"),
        (None, "kept alone"), (None, passage), (6, long), (7, "write to x@y.zz"), (8, "é"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in given], "doc_id long, text string, lang string, source string, n_chars int")
    clash = [c for c in ("score", "k1", "k2", "component_id", "dropped_id", "found_id", "marked_id", "keep", "text_key", "nth", "_masked", "fingerprint", "node")]
    for c in clash:
        docs = docs.withColumn(c, F.lit("mine"))
    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = spark.createDataFrame(stage(spark, got, SF_DIR).collect(), docs.schema)
        assert got.columns == docs.columns and got.filter(" OR ".join(f"{c} <> 'mine'" for c in clash)).isEmpty()
    kept = sorted((str(r["doc_id"]), r["text"]) for r in got.collect())
    assert kept == sorted([("1", None), ("3", "one text"), ("None", "kept alone"), ("6", long), ("7", "write to <EMAIL>"), ("8", "é")])
    assert corpus_pipeline.STAGES[-1][1](spark, got, SF_DIR).count() == 6
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF_DIR)
        assert none.count() == 0
        none = spark.createDataFrame([], none.schema)


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {k.split("_")[0] for k in names if k.startswith("op")} == {f"op{n}" for n in range(1, 14)}
