import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.operators import (
    apply_events,
    apply_latest,
    bring_together,
    collapse,
    evolve_union,
    evolved_schema,
    join_by_key,
    split_transactions,
    split_unkeyed,
    to_append_only,
    wider_type,
)
from pyspark.sql import types as T

LOG = "k long, v string, pos long, seq long, op string"


def log(spark, *items):
    return spark.createDataFrame(list(items), LOG)


def test_greatest_position_wins_and_deletes_remove(spark):
    df = log(spark, (1, "a", 1, 0, "c"), (1, "b", 3, 0, "u"), (1, "x", 2, 0, "d"), (2, "c", 1, 0, "c"), (2, None, 2, 0, "d"))
    assert rows(apply_latest(df, ["k"], ["pos"])) == [(1, "b", 3, 0)]
    assert rows(collapse(df, ["k"], ["pos"]).select("k", "op")) == [(1, "u"), (2, "d")]


def test_ties(spark):
    df = log(spark, (1, "a", 5, 9, "u"), (1, None, 5, 1, "d"), (2, "old", 5, 1, "u"), (2, "new", 5, 2, "u"))
    assert rows(apply_latest(df, ["k"], ["pos"], sequence="seq").select("k", "v")) == [(2, "new")]


def test_null_keys_are_split_off(spark):
    df = log(spark, (None, "a", 1, 0, "c"), (1, "b", None, 0, "c"), (2, "c", 1, 0, "c"))
    good, bad = split_unkeyed(df, ["k"], ["pos"])
    assert rows(good.select("v")) == [("c",)]
    assert rows(bad.select("v")) == [("a",), ("b",)]
    assert rows(apply_latest(df, ["k"], ["pos"]).select("v")) == [("b",), ("c",)]
    with pytest.raises(ValueError):
        apply_latest(df, [], ["pos"])


def test_random_logs_against_brute_force(spark):
    rng = random.Random(7)
    items = [(rng.choice([0, 0, 0, rng.randrange(50)]), str(i), i, 0, rng.choice("cuud")) for i in range(500)]
    state = {}
    for k, v, _, _, op in items:
        state.pop(k, None) if op == "d" else state.update({k: v})
    rng.shuffle(items)
    got = rows(apply_latest(log(spark, *items).repartition(5), ["k"], ["pos"]).select("k", "v"))
    assert got == sorted(state.items(), key=lambda r: (str(r[0]), str(r[1])))


def test_append_only(spark):
    df = log(spark, (1, "a", 1, 0, "r"), (1, "b", 2, 0, "u"), (1, None, 3, 0, "d"))
    assert rows(to_append_only(df).select("v")) == [("a",), ("b",)]


def test_key_change(spark):
    row = "struct<k: long, v: string>"
    df = spark.createDataFrame(
        [
            ("c", None, (1, "a"), (1,)),
            ("u", (1, "a"), (2, "a"), (2,)),
            ("u", (2, "a"), (2, "b"), (3,)),
            ("u", None, (3, "no before"), (4,)),
        ],
        f"op string, before {row}, after {row}, order_key struct<lsn: long>",
    )
    assert rows(apply_events(df, ["k"])) == [(2, "b"), (3, "no before")]


def _skewed(spark):
    # one key holds a third of the rows
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"), F.col("id")
    )


@pytest.mark.parametrize("rows_per_task", [7, 100, 10**6])
def test_join_splits_hot_keys_exactly(spark, rows_per_task):
    df = _skewed(spark)
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    some = sizes.filter("k = -1 OR k > 50")
    kept = join_by_key(df, some, ["k"], "n", ["id"], "left_semi", rows_per_task)
    assert rows(kept) == rows(df.filter("k = -1 OR k > 50"))
    joined = join_by_key(df, some, ["k"], "n", ["id"], rows_per_task=rows_per_task)
    assert rows(joined) == rows(df.join(some, "k", "left"))


def test_hot_key_is_spread(spark, out):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    try:
        bring_together(_skewed(spark).repartition(8), ["k"]).write.parquet(out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(out)
    assert rows(stored) == rows(_skewed(spark))
    files = {r.k: r.n for r in stored.groupBy("k").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).collect()}
    assert files[-1] > 1
    assert max(n for k, n in files.items() if k != -1) <= files[-1]


@pytest.mark.parametrize("rows_per_task", [5, 10**6])
def test_transactions(spark, rows_per_task):
    df = _skewed(spark).withColumnRenamed("k", "txid")
    declared = df.groupBy("txid").agg((F.count("*") + F.when(F.col("txid") % 2 == 0, 1).otherwise(0)).alias("n"))
    declared = declared.filter("txid <> 7")
    done, carried = split_transactions(df, "txid", declared, "n", ["id"], rows_per_task)
    whole = "txid % 2 <> 0 AND txid <> 7"
    assert rows(done) == rows(df.filter(whole))
    assert rows(carried) == rows(df.filter(f"NOT ({whole})"))


@pytest.mark.parametrize(
    "a, b, c",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.FloatType(), T.IntegerType(), T.DoubleType()),
        (T.FloatType(), T.LongType(), T.StringType()),
        (T.DoubleType(), T.DecimalType(10, 2), T.StringType()),
        (T.LongType(), T.DecimalType(38, 30), T.StringType()),
        (T.DecimalType(10, 2), T.IntegerType(), T.DecimalType(12, 2)),
        (T.DecimalType(10, 2), T.DecimalType(12, 6), T.DecimalType(14, 6)),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.StringType(), T.IntegerType(), T.StringType()),
    ],
)
def test_wider_types(a, b, c):
    assert wider_type(a, b) == c == wider_type(b, a)


def test_evolving_batches(spark):
    old = spark.createDataFrame([(1, "a", 1)], "id int, gone string, n int")
    new = spark.createDataFrame([(2**40, 5.5, "x")], "id long, n double, extra string")
    assert evolved_schema(old.schema, new.schema).simpleString() == "struct<id:bigint,gone:string,n:double,extra:string>"
    assert rows(evolve_union(old, new)) == [(1, "a", 1.0, None), (2**40, None, 5.5, "x")]
