"""Keyed lake tables: buckets, pruned reads, versions, schemas that change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_path
from ..sinks import LakeTable
from ..sinks.lake import read_partitions
from ..sources import KafkaSource
from ..topic import Topic
from . import fixtures as fx
from .fixtures import load
from .registry import LATEST_EVENTS, query

#: The log in three batches whose order is not the order of the changes, as event types of each.
KINDS = (("click", "purchase"), ("error",), ("signup", "view"))
_BATCH = "CASE WHEN event_type IN ('click', 'purchase') THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END"


def _table(spark: SparkSession) -> LakeTable:
    return LakeTable(spark, work_path(spark, "lake"), ["user_id"], ["ts", "event_id"])


def _batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    changes = fx.change_log(spark, sf_dir)
    known = [k for kinds in KINDS[:2] for k in kinds]
    return [changes.filter(F.col("event_type").isin(*kinds)) for kinds in KINDS[:2]] + [changes.filter(~F.col("event_type").isin(*known))]


@query(f"""
    SELECT event_id, ts, user_id, event_type, value, props, 0::BIGINT AS moved FROM ({LATEST_EVENTS})
    UNION ALL SELECT -1, NULL, -1, 'click', NULL, NULL, 0
""")
def lake_bucket_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second fold rewrites the bucket of one new key; ``moved`` counts files of other buckets that it touched."""
    table = _table(spark)
    for i, batch in enumerate(_batches(spark, sf_dir)):
        table.append_batch(batch, i)
    table.compact()
    before = table.files()
    schema = fx.change_log(spark, sf_dir).schema
    late = {"event_id": -1, "user_id": -1, "event_type": "click", "op": "u"}
    one = load(spark, sf_dir, "events").agg(F.max("ts").alias("latest")).select(
        *[F.lit(late.get(f.name)).cast(f.dataType).alias(f.name) if f.name != "ts" else F.col("latest").alias("ts") for f in schema]
    )
    table.append_batch(one, 3)
    table.compact()
    touched = {b for b, files in table.files().items() if files != before.get(b)}
    moved = max(0, len(touched) - 1)
    rows = table.read()
    rows = rows.withColumn("ts", F.when(F.col("event_id") >= 0, F.col("ts")))
    return rows.withColumn("moved", F.lit(moved).cast("long"))


@query(f"SELECT user_id FROM ({LATEST_EVENTS})")
def lake_read_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of a table with a base and later batches: keys, order and operation are all that is read."""
    table = _table(spark)
    first, *others = _batches(spark, sf_dir)
    table.append_batch(first, 0)
    table.compact()
    for i, batch in enumerate(others, 1):
        table.append_batch(batch, i)
    return table.read(columns=["user_id"])


_AS_OF = "UNION ALL".join(
    f"""
    SELECT {v} AS version, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {_BATCH} <= {v})
    WHERE rn = 1 AND event_type <> 'error'
    """
    for v in range(3)
)


@query(_AS_OF)
def lake_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state at every batch, read after folds between them and an expiration that keeps all versions."""
    table = _table(spark)
    versions = []
    for i, batch in enumerate(_batches(spark, sf_dir)):
        table.append_batch(batch, i)
        versions.append(table.versions()[-1])
        table.compact()
    table.expire(before=versions[0])
    states = [
        table.read(as_of=v).agg(F.lit(i).alias("version"), F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))
        for i, v in enumerate(versions)
    ]
    return reduce(DataFrame.unionByName, states)


@query("""
    SELECT user_id, CASE WHEN event_type IN ('click', 'purchase') THEN CAST(event_id AS VARCHAR)
                         WHEN event_type = 'error' THEN CAST(event_id + 4294967296 AS VARCHAR) ELSE 'e' || event_id END AS label,
        CASE WHEN event_type NOT IN ('click', 'purchase', 'error') THEN value END AS added
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def lake_widened_compacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that goes from INT to BIGINT to text, one that is added and one that is dropped, with folds between."""
    table = LakeTable(spark, work_path(spark, "lake"), ["user_id"], ["ts", "event_id"])
    first, second, third = _batches(spark, sf_dir)
    common = ["user_id", "ts", "event_id", F.lit("u").alias("op")]
    table.append_batch(first.select(*common, F.col("event_id").cast("int").alias("label"), F.lit(1).alias("dropped")), 0)
    table.append_batch(second.select(*common, (F.col("event_id") + 2**32).alias("label")), 1)
    table.compact()
    table.append_batch(third.select(*common, F.concat(F.lit("e"), "event_id").alias("label"), F.col("value").alias("added")), 2)
    table.compact()
    table.expire()
    return table.read().select("user_id", "label", "added")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || o_custkey END AS customer,
        CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders
""")
def stored_topic_evolves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored topic whose declared columns change: a number becomes text, a column is added."""
    path = work_path(spark, "stored")
    source = KafkaSource("broker:9092", "app.orders", format="PLAIN", encode="JSON")
    orders = load(spark, sf_dir, "orders")
    old = Topic(source, {"o_orderkey": "BIGINT", "customer": "BIGINT"})
    new = Topic(source, {"o_orderkey": "BIGINT", "customer": "VARCHAR", "status": "VARCHAR"})
    even = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_custkey").alias("customer"))
    odd = orders.filter("o_orderkey % 2 = 1").select(
        "o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")
    )
    for i, (topic, rows) in enumerate([(old, even), (new, odd), (new, odd)]):
        feed = rows.select(F.to_json(F.struct("*")).cast("binary").alias("value"))
        topic.store(feed, min(i, 1), path)  # the second batch comes twice
    return read_partitions(spark, f"{path}/{new.table_name}")
