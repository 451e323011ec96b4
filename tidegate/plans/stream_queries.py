"""Streams run to the end of what is there; the result equals the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import flatten_events
from ..session import work_path
from ..sinks import FileSink, LakeTable, read_files, stream_files
from ..sources import PostgresSource, decode_changes, read_recorded
from ..streaming import (
    Measure,
    dedupe_stream,
    fan_out_stream,
    fold_rollup,
    read_rollup,
    rollup_parts,
    rollup_to_lake,
    stream_rollup,
    stream_to_lake,
    stream_transactions_to_lake,
)
from . import fixtures as fx
from .fixtures import EVENT_COLUMNS, load
from .registry import LATEST_EVENTS, query


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # the brackets make it a pattern, which a file stream accepts for a single file as for a folder
    pattern = f"{sf_dir}/[{table[0]}]{table[1:]}.parquet"
    return spark.readStream.schema(load(spark, sf_dir, table).schema).parquet(pattern)


def _finish(run: StreamingQuery) -> None:
    run.awaitTermination()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_parquet_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of Parquet files, streamed to Parquet files."""
    stream = _stream(spark, sf_dir, "orders")
    sink = FileSink(work_path(spark, "feed"))
    _finish(stream_files(stream, sink, work_path(spark, "cp")))
    return read_files(spark, sink, stream.schema)


@query(LATEST_EVENTS)
def stream_apply_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change stream kept at its latest state."""
    op = F.when(F.col("event_type") == "error", F.lit("d")).otherwise(F.lit("u"))
    table = LakeTable(spark, work_path(spark, "stream"), ["user_id"], ["ts", "event_id"])
    _finish(stream_to_lake(_stream(spark, sf_dir, "events").withColumn("op", op), table, work_path(spark, "cp")))
    return table.read()


@query(LATEST_EVENTS)
def stream_cdc_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded Debezium messages, streamed in several batches, decoded, collapsed and upserted."""
    log = work_path(spark, "log")
    fx.debezium_log(spark, sf_dir).repartition(6, "offset").write.parquet(log)

    def decode(batch: DataFrame) -> DataFrame:
        events = decode_changes(batch, PostgresSource("app"), EVENT_COLUMNS)
        flat = flatten_events(events.filter("_error IS NULL"))
        bad = events.filter("_error IS NOT NULL").select("_raw", "_error")
        return flat.unionByName(bad, allowMissingColumns=True)

    table = LakeTable(spark, work_path(spark, "stream"), ["user_id"], ["_order"], op="_op")
    stream = read_recorded(spark, log, streaming=True, max_files=3)
    _finish(stream_to_lake(stream, table, work_path(spark, "cp"), decode, reject_path=work_path(spark, "rejects")))
    return table.read().drop("_order")


@query("""
    SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket_start, count(*) AS event_count, max(value) AS max_value
    FROM events GROUP BY ALL
""")
def stream_rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per user and hour, upserted as they change."""
    rolled = stream_rollup(
        _stream(spark, sf_dir, "events"),
        ["user_id"],
        "ts",
        "1 hour",
        "1 day",
        [F.count(F.lit(1)).alias("event_count"), F.max("value").alias("max_value")],
    )
    table = LakeTable(spark, work_path(spark, "rollup"), ["user_id", "bucket_start"], ["version"])
    _finish(rollup_to_lake(rolled, table, work_path(spark, "cp")))
    return table.read().drop("version")


@query("""
    SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket_start, count(*) AS event_count, max(value) AS max_value,
        min(event_id) AS first_id FROM events GROUP BY ALL
""")
def stream_rollup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a feed whose batches go back in time, days behind any watermark; a fold lies between."""
    measures = [
        Measure("event_count", F.count(F.lit(1)), F.sum),
        Measure("max_value", F.max("value"), F.max),
        Measure("first_id", F.min("event_id"), F.min),
    ]
    log = work_path(spark, "late")
    events = load(spark, sf_dir, "events")
    events.repartitionByRange(6, F.col("ts").desc()).write.parquet(log)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(log)
    path, checkpoint = work_path(spark, "rollup"), work_path(spark, "cp")
    _finish(rollup_parts(stream, path, ["user_id"], "ts", "1 hour", measures, checkpoint))
    fold_rollup(spark, path, ["user_id"], measures)
    return read_rollup(spark, path, ["user_id"], measures)


@query("SELECT event_id, user_id, ts FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    events = _stream(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    once = dedupe_stream(twice, ["event_id"], "ts", "1 day")
    sink = FileSink(work_path(spark, "dedupe"))
    _finish(stream_files(once, sink, work_path(spark, "cp")))
    stored = read_files(spark, sink, once.schema)
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
    SELECT 'orders' AS "table", count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
    UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
""")
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream of several tables to a target per table."""
    log = work_path(spark, "multi")
    fx.multi_feed(spark, sf_dir).write.parquet(log)
    stream = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
    targets = {
        ("sales", "orders"): LakeTable(spark, work_path(spark, "orders"), ["pk"], ["order_key"]),
        ("stock", "part"): LakeTable(spark, work_path(spark, "part"), ["pk"], ["order_key"]),
    }
    _finish(fan_out_stream(stream, {n: t.append_batch for n, t in targets.items()}, work_path(spark, "cp")))
    parts = [
        t.read().agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.sum("order_key").alias("key_sum"))
        for (_, name), t in targets.items()
    ]
    return parts[0].unionByName(parts[1])


@query("""
    SELECT l_orderkey AS txid, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                                     ORDER BY l_quantity DESC, l_extendedprice DESC) AS rn
        FROM lineitem WHERE l_orderkey % 10 <> 0
    ) WHERE rn = 1
""")
def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions whose rows and markers come in different batches; every tenth stays open."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("txid"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    extra = F.when(F.col("txid") % 10 == 0, 1).otherwise(0)
    markers = lines.groupBy("txid").agg((F.count(F.lit(1)) + F.max(extra)).alias("events"))
    rows = lines.withColumn("op", F.lit("u")).withColumn("events", F.lit(None).cast("long"))
    log = work_path(spark, "tx")
    feed = rows.unionByName(markers, allowMissingColumns=True)
    feed.repartition(4, "l_partkey").write.parquet(log)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(log)
    key = ["txid", "l_linenumber", "l_partkey", "l_suppkey"]
    table = LakeTable(spark, work_path(spark, "tx-lake"), key, ["l_quantity", "l_extendedprice"])
    _finish(
        stream_transactions_to_lake(
            stream, table, work_path(spark, "cp"), work_path(spark, "carry"), "txid", "events", key[1:]
        )
    )
    return table.read()
