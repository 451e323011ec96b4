"""Cleans the documents table in stages; each stage's result is written as Parquet and read again by the next.

Every stage returns the columns of documents, in their order and with their names, whatever other columns there are; the
last returns ids and digests. Rows are told apart by their id and text. Of each group of near duplicates one row stays, the
one of the smallest id; a row without an id only if no row of its group has one. Of rows that repeat an id and its text one
stays. Null texts count as empty and stay null; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm import bloom, decontam, pii, queries, simhash
from tidegate.llm import toxicity as toxic
from tidegate.llm.frames import fresh, saved, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below one half."""
    score = fresh("score")
    scored = toxic.score(docs, queries.toxicity_model(spark, sf_dir), into=score)
    return scored.filter(F.col(score) < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates."""
    nth, marked_id, marked_key, keep = (fresh(n) for n in ("nth", "marked_id", "marked_key", "keep"))
    marks = saved(simhash.judged(docs).toDF(marked_id, marked_key, keep), "marks")
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    # Only rows that a mark may be about are moved.
    some, others = bloom.split(docs, marks.select(F.xxhash64(marked_id, marked_key)), F.xxhash64("doc_id", key))
    same = F.col("doc_id").eqNullSafe(F.col(marked_id)) & (key == F.col(marked_key))
    found = some.join(marks, same, "left")
    repeats = W.partitionBy("doc_id", key).orderBy("doc_id")
    found = found.withColumn(nth, F.row_number().over(repeats)).filter(F.coalesce(keep, F.lit(True)) & (F.col(nth) == 1))
    return others.unionByName(found.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"))
    found = saved(found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct(), "found")
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    # Only rows that a match may be about are moved.
    some, others = bloom.split(docs, found.select(F.xxhash64("found_id", "found_key")), F.xxhash64("doc_id", key))
    same = some["doc_id"].eqNullSafe(found["found_id"]) & (key == found["found_key"])
    return others.unionByName(some.join(found, same, "left_anti"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of every text, and the digest of what they decode to."""
    return queries.bpe_digests(docs.select("doc_id", "lang", "source", "n_chars", "text"), "lang", "source", "n_chars")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL cannot express the stages; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
