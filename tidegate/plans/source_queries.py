"""Sources: splits, scans, decoders, captured tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import to_micros
from ..operators.changes import apply_events, apply_latest, collapse, flatten_events, snapshot_then_log as with_snapshot
from ..operators.changes import split_key_changes, split_transactions
from ..operators.documents import assembled, path_changes
from ..operators.evolve import evolve_union
from ..operators.skew import ROWS_PER_PIECE
from ..sinks.fanout import fan_out, fan_out_table
from ..sinks.lake import read_partitions
from ..sources import (
    KafkaSource,
    MongoSource,
    MySqlSource,
    PostgresSource,
    SqlServerSource,
    accepted,
    after_offsets,
    current_documents,
    current_rows,
    decode_changes,
    end_offsets,
    from_timestamp,
    header_value,
    metadata_columns,
    plan_even_splits,
    with_metadata,
)
from ..sources import decode
from ..sources.backfill import uneven_predicates
from ..sources.cdc import DOCUMENT_COLUMNS
from ..connect import CapturedTable, Ingest
from ..operators.selection import ColumnSelection, TableColumns, TableSelector
from ..session import work_path
from ..topic import Topic
from . import fixtures as fx
from .fixtures import EVENT_COLUMNS, load
from .registry import LATEST_EVENTS, query


@query("""
    WITH s AS (
        SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS n FROM orders
    ), w AS (SELECT lo, CAST(ceil((hi - lo + 1) / CAST(n AS DOUBLE)) AS BIGINT) AS width FROM s)
    SELECT CAST((o_orderkey - lo) // width AS INTEGER) AS split, count(*) AS split_rows,
           min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders, w GROUP BY 1
""")
def backfill_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each even snapshot split."""
    orders = load(spark, sf_dir, "orders")
    plan = plan_even_splits(orders, "o_orderkey", rows_per_split=1000)
    return orders.groupBy(plan.split_of().alias("split")).agg(
        F.count(F.lit(1)).alias("split_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


def _order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later changes of every seventh order: finished ones are deleted, the rest get status X."""
    orders = load(spark, sf_dir, "orders").filter("o_orderkey % 7 = 0")
    op = F.when(F.col("o_orderstatus") == "F", F.lit("d")).otherwise(F.lit("u"))
    return orders.withColumns(
        {"op": op, "lsn": F.col("o_orderkey") + 1, "o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )


@query("""
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderstatus = 'F')
""")
def snapshot_then_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing orders, then the changes that came after the snapshot."""
    changes = with_snapshot(load(spark, sf_dir, "orders"), _order_log(spark, sf_dir), {"lsn": 0})
    return apply_latest(changes, ["o_orderkey"], ["lsn"]).drop("lsn")


@query("""
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 7 = 0 AND o_orderstatus <> 'F'
""")
def log_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table with the snapshot switched off."""
    changes = with_snapshot(load(spark, sf_dir, "orders"), _order_log(spark, sf_dir), {"lsn": 0}, snapshot_rows=False)
    return apply_latest(changes, ["o_orderkey"], ["lsn"]).drop("lsn")


@query(LATEST_EVENTS)
def cdc_postgres_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by log position."""
    return current_rows(fx.debezium_log(spark, sf_dir), PostgresSource("app"), EVENT_COLUMNS, ["user_id"])


@query(f"SELECT * REPLACE (ts - INTERVAL 9 HOUR AS ts) FROM ({LATEST_EVENTS})")
def cdc_mysql_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by binlog file and position; DATETIME values are Tokyo wall-clock times."""
    file = F.format_string("mysql-bin.%06d", F.floor(F.col("event_id") / 1000) + 1)
    source = fx.position("app", None, "events", file=file, pos=F.col("event_id") % 1000)
    log = fx.debezium_log(spark, sf_dir, source)
    return current_rows(log, MySqlSource("app", server_time_zone="Asia/Tokyo"), EVENT_COLUMNS, ["user_id"])


@query(LATEST_EVENTS)
def cdc_sqlserver_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by commit and change sequence numbers, which are text."""
    commit = F.format_string("%08x:%08x:0001", F.floor(F.col("event_id") / 16), F.col("event_id") % 16)
    change = F.format_string("%08x:%08x:0002", F.floor(F.col("event_id") / 16), F.col("event_id") % 16)
    source = fx.position("app", "dbo", "events", commit_lsn=commit, change_lsn=change)
    log = fx.debezium_log(spark, sf_dir, source)
    return current_rows(log, SqlServerSource("app"), EVENT_COLUMNS, ["user_id"])


@query(f"SELECT CAST(user_id AS VARCHAR) AS _id, props AS payload FROM ({LATEST_EVENTS})")
def cdc_mongo_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as id and payload; deletes carry only the id."""
    return current_documents(fx.document_log(spark, sf_dir), MongoSource("app"))


@query("""
    SELECT 'sales' AS source_schema, 'orders' AS source_table, count(*) AS changes, count(*) AS live_rows,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
    UNION ALL SELECT 'sales', 'customer', count(*), count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
    UNION ALL SELECT 'stock', 'part', count(*), count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
    UNION ALL SELECT 'stock', 'supplier', count(*), count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
    UNION ALL SELECT 'web', 'events', count(*), count(*), CAST(sum(event_id) AS BIGINT) FROM events
""")
def cdc_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass splits the feed by table; each table is then read from its own partition."""
    path = work_path(spark, "fan-out")
    fan_out(fx.multi_feed(spark, sf_dir), path)
    out = None
    for schema, table, key in fx.FEED_TABLES:
        columns = load(spark, sf_dir, table).select(F.col(key).cast("long")).schema
        rows = fan_out_table(spark, path, schema, table, columns)
        live = apply_latest(rows.withColumn("n", F.lit(1)), ["pk"], ["order_key"])
        one = live.agg(
            F.lit(schema).alias("source_schema"),
            F.lit(table).alias("source_table"),
            F.sum("n").alias("changes"),
            F.count(F.lit(1)).alias("live_rows"),
            F.sum(key).alias("key_sum"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE l_orderkey % 10 <> 0
""")
def tx_complete_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of transactions that arrived whole; every tenth transaction declares one event more than came."""
    lines = load(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "txid")
    lines = lines.select("txid", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    extra = F.when(F.col("txid") % 10 == 0, 1).otherwise(0)
    markers = lines.groupBy("txid").agg((F.count(F.lit(1)) + F.max(extra)).alias("events"))
    done, _ = split_transactions(lines, "txid", markers, "events", ["l_partkey", "l_suppkey", "l_linenumber"])
    return done.withColumnRenamed("txid", "l_orderkey")


@query("""
    SELECT event_id, user_id, CAST(user_id % 4 AS INTEGER) AS kafka_partition FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'
""")
def scan_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages stamped at or after a start time."""
    feed = from_timestamp(fx.kafka_log(spark, sf_dir), millis=1_705_752_000_000)
    rows = decode.decode_json(feed, EVENT_COLUMNS, metadata_columns(partition=True))
    return accepted(rows).select("event_id", "user_id", "kafka_partition")


@query("""
    WITH e AS (SELECT user_id % 4 AS p, max(event_id) AS last FROM events WHERE event_type = 'signup' GROUP BY 1)
    SELECT event_id, event_type FROM events JOIN e ON user_id % 4 = p WHERE event_id > last
""")
def scan_after_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages past the end of each partition as it was when the last signup had been read."""
    feed = fx.kafka_log(spark, sf_dir)
    read_before = feed.filter(header_value("event_type") == "signup")
    rows = decode.decode_json(after_offsets(feed, end_offsets(read_before)), EVENT_COLUMNS)
    return accepted(rows).select("event_id", "event_type")


@query("""
    SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain JSON messages to typed columns, with a nested JSON column parsed in turn."""
    rows = accepted(decode.decode_json(fx.kafka_log(spark, sf_dir), EVENT_COLUMNS))
    return rows.withColumn("k", F.from_json("props", "k int")["k"]).drop("props")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def decode_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV messages with a delimiter of their own."""
    part = load(spark, sf_dir, "part")
    feed = part.select(F.to_csv(F.struct(*part.columns), {"sep": ";"}).cast("binary").alias("value"))
    columns = {
        "p_partkey": "BIGINT",
        "p_name": "VARCHAR",
        "p_brand": "VARCHAR",
        "p_type": "VARCHAR",
        "p_size": "INT",
        "p_retailprice": "DOUBLE",
    }
    return accepted(decode.decode_csv(feed, columns, delimiter=";"))


@query("SELECT doc_id AS kafka_offset, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS digest FROM documents")
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as one binary column."""
    feed = load(spark, sf_dir, "documents").select(
        F.col("text").cast("binary").alias("value"), F.col("doc_id").alias("offset")
    )
    rows = decode.decode_bytes(feed, "id", metadata_columns(offset=True))
    return rows.select("kafka_offset", F.octet_length("id").cast("long").alias("bytes"), F.md5("id").alias("digest"))


_CHANGES_SQL = """
    SELECT CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, event_id, ts, user_id, event_type, value, props,
"""


@query(_CHANGES_SQL + "ts AS commit_ts, 'app' AS db, 'public' AS schema_name, event_id // 10 AS txid FROM events")
def decode_debezium(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debezium envelopes to typed changes."""
    events = accepted(decode_changes(fx.debezium_log(spark, sf_dir), PostgresSource("app"), EVENT_COLUMNS))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("_image")
    commit = F.col("commit_ts").cast("timestamp_ntz").alias("commit_ts")
    flat = events.select("op", image, commit, "db", F.col("schema").alias("schema_name"), "txid")
    return flat.select("op", "_image.*", "commit_ts", "db", "schema_name", "txid")


@query(_CHANGES_SQL + "CASE WHEN event_type = 'error' THEN value ELSE value - 1 END AS old_value, event_id // 10 AS txid FROM events")
def decode_maxwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maxwell envelopes: the before image is the row overlaid with the changed columns' old values."""
    events = accepted(decode.decode_maxwell(fx.maxwell_log(spark, sf_dir), EVENT_COLUMNS))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("_image")
    flat = events.select("op", image, F.col("before.value").alias("old_value"), "txid")
    return flat.select("op", "_image.*", "old_value", "txid")


@query(_CHANGES_SQL + "event_id AS message_offset FROM events")
def decode_canal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canal envelopes: arrays of text rows, cast to the declared types."""
    events = accepted(decode.decode_canal(fx.canal_log(spark, sf_dir), EVENT_COLUMNS))
    flat = flatten_events(events)
    return flat.withColumn("message_offset", F.col("_order.offset")).withColumnRenamed("_op", "op").drop("_order")


@query(LATEST_EVENTS)
def kafka_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value per message key; a message without a value deletes its key."""
    rows = accepted(decode.decode_upsert(fx.upsert_log(spark, sf_dir), EVENT_COLUMNS))
    return apply_latest(rows, ["rw_key"], ["_offset"], op="_op").drop("rw_key", "_offset")


@query("SELECT event_id AS kafka_offset, user_id AS key_user_id FROM events")
def decode_key_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key decoded apart from the value."""
    key = decode.decode_key({"user_id": "BIGINT"})["user_id"].alias("key_user_id")
    return fx.kafka_log(spark, sf_dir).select(*metadata_columns(offset=True), key)


@query("""
    SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_origin FROM part
    UNION ALL
    SELECT p_partkey + 1000000, NULL, p_partkey * 3000000000 + p_size, 'origin ' || p_brand FROM part
""")
def schema_evolve_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch brings a new column, a wider type, and lacks a column."""
    part = load(spark, sf_dir, "part")
    old = part.select("p_partkey", "p_name", "p_size")
    new = part.select(
        (F.col("p_partkey") + 1_000_000).alias("p_partkey"),
        (F.col("p_partkey") * F.lit(3_000_000_000) + F.col("p_size")).alias("p_size"),
        F.concat(F.lit("origin "), "p_brand").alias("p_origin"),
    )
    return evolve_union(old, new)


@query("""
    SELECT '{"user_id":' || user_id || '}' AS kafka_key, event_id AS kafka_offset,
           CAST(user_id % 4 AS INTEGER) AS kafka_partition, ts AS kafka_timestamp, 2 AS kafka_headers,
           CAST(json_object('event_id', event_id, 'ts', epoch_us(ts), 'user_id', user_id, 'event_type', event_type,
                            'value', value, 'props', props) AS VARCHAR) AS kafka_payload
    FROM events
""")
def kafka_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All message metadata next to the row."""
    columns = metadata_columns(key=True, offset=True, partition=True, timestamp=True, headers=True, payload=True)
    feed = fx.kafka_log(spark, sf_dir).select(*columns)
    return feed.select(
        F.col("kafka_key").cast("string").alias("kafka_key"),
        "kafka_offset",
        "kafka_partition",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        F.size("kafka_headers").alias("kafka_headers"),
        "kafka_payload",
    )


@query("""
    SELECT event_id AS kafka_offset, event_type, value AS weight, CAST(NULL AS INTEGER) AS absent FROM events
""")
def header_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single typed headers; one that is absent is null."""
    wanted = {"event_type": "VARCHAR", "weight": "DOUBLE", "absent": "INT"}
    return fx.kafka_log(spark, sf_dir).select(*metadata_columns(offset=True, header_fields=wanted))


@query("""
    SELECT 'app' AS database_name, 'public' AS schema_name, 'events' AS table_name, count(*) AS changes FROM events
    UNION ALL SELECT 'app', NULL, 'profiles', count(*) FROM events
""")
def cdc_metadata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes per database, schema and table, from the envelopes' own metadata."""
    rows = accepted(decode_changes(fx.debezium_log(spark, sf_dir), PostgresSource("app"), EVENT_COLUMNS))
    docs = accepted(
        decode_changes(fx.document_log(spark, sf_dir), MongoSource("app"), {"_id": "VARCHAR", "payload": "VARCHAR"})
    )
    names = ("database", "schema", "table")
    tagged = with_metadata(rows, *names).unionByName(with_metadata(docs, *names), allowMissingColumns=True)
    return tagged.groupBy("database_name", "schema_name", "table_name").agg(F.count(F.lit(1)).alias("changes"))


@query("""
    SELECT kind, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
    FROM events, (VALUES ('stored'), ('view')) AS k(kind) GROUP BY 1, 2
""")
def stored_equals_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same question to a stored table and to a view over the feed."""
    feed = fx.kafka_log(spark, sf_dir)
    topic = Topic(KafkaSource("broker:9092", "app.user-events"), EVENT_COLUMNS, name="tidegate_feed_view")
    path = work_path(spark, "stored")
    topic.store(feed, 0, path)
    topic.view(feed)
    topic.stored(feed, path).createOrReplaceTempView("tidegate_feed_table")
    ask = "SELECT '{0}' AS kind, event_type, count(*) AS n, sum(event_id) AS id_sum FROM {1} GROUP BY event_type"
    stored = spark.sql(ask.format("stored", "tidegate_feed_table"))
    return stored.unionByName(spark.sql(ask.format("view", "tidegate_feed_view")))


@query("""
    SELECT user_id, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM (
            SELECT user_id, event_id, event_type IN ('error', 'signup') AS gone FROM events
            UNION ALL SELECT user_id + 100000, event_id, false FROM events WHERE event_type = 'signup'
        )
    ) WHERE rn = 1 AND NOT gone
""")
def pk_change_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State when every signup moves its user to a new key."""
    return apply_events(_moving_events(spark, sf_dir), ["user_id"]).select("user_id", "event_id")


def _moving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    row = F.struct("user_id", "event_id")
    moved = F.struct((F.col("user_id") + 100_000).alias("user_id"), F.col("event_id"))
    error, signup = F.col("event_type") == "error", F.col("event_type") == "signup"
    return events.select(
        F.when(error, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        row.alias("before"),
        F.when(signup, moved).when(~error, row).alias("after"),
        F.struct(F.col("event_id").alias("lsn")).alias("order_key"),
        F.timestamp_micros(to_micros(F.col("ts"))).alias("commit_ts"),
        F.lit("app").alias("db"),
        F.lit("public").alias("schema"),
        F.lit("events").alias("table"),
        F.col("event_id").alias("txid"),
    )


@query("""
    SELECT CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, user_id, event_id FROM events
    WHERE event_type <> 'signup'
    UNION ALL SELECT 'd', user_id, event_id FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'c', user_id + 100000, event_id FROM events WHERE event_type = 'signup'
""")
def pk_change_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update of the key as a delete and an insert."""
    flat = flatten_events(split_key_changes(_moving_events(spark, sf_dir), ["user_id"]))
    return flat.select(F.col("_op").alias("op"), "user_id", "event_id")


@query("""
    SELECT 'clean_orders' AS target, o_orderkey AS id, o_orderstatus AS label,
           CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DOUBLE) AS amount
    FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderstatus = 'F')
    UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal FROM customer
""")
def ingest_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole database feed: table selection, column selection, renaming, snapshot and changes, to lake tables."""
    orders = CapturedTable(
        "sales",
        "orders",
        fx.ORDER_COLUMNS,
        ("o_orderkey",),
        TableColumns(
            "orders",
            (ColumnSelection("o_orderkey", primary_key=True), ColumnSelection("o_orderstatus"), ColumnSelection("o_totalprice")),
            target_table="clean_orders",
        ),
    )
    customers = CapturedTable(
        "sales", "customer", {"c_custkey": "BIGINT", "c_name": "VARCHAR", "c_acctbal": "DOUBLE"}, ("c_custkey",)
    )
    ingest = Ingest(
        spark,
        PostgresSource("app"),
        (orders, customers),
        work_path(spark, "database"),
        TableSelector(include=("sales.*",), exclude=("*_backup",)),
    )
    ingest.deliver(fx.captured_log(spark, sf_dir), 0)
    ingest.maintain()
    kept = ingest.read(orders).select(
        F.lit("clean_orders").alias("target"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("label"),
        F.col("o_totalprice").alias("amount"),
    )
    people = ingest.read(customers).select(
        F.lit("customer").alias("target"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("label"),
        F.col("c_acctbal").alias("amount"),
    )
    return kept.unionByName(people)


@query(LATEST_EVENTS)
def stored_changes_equal_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed topic stored in two batches and the same topic as a view: rows both have."""
    feed = fx.upsert_log(spark, sf_dir)
    topic = Topic(
        KafkaSource("broker:9092", "app.user-state", format="UPSERT"),
        EVENT_COLUMNS,
        primary_key=("user_id",),
        key_columns={"user_id": "BIGINT"},
    )
    path = work_path(spark, "stored")
    clicks = header_value("event_type").isin("click", "error")
    topic.store(feed.filter(clicks), 0, path)
    topic.store(feed.filter(~clicks), 1, path)
    return topic.stored(feed, path).intersect(topic.rows(feed))


def _transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as changes with their transaction, one for each order, and the END message of each.

    Every tenth transaction stays open, every 13th has all its messages twice, every 17th order's lines name none.
    """
    found = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    lines = found.dropDuplicates()
    counts = lines.filter("l_orderkey % 10 <> 0").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    # Dealt while they are numbers: few megabytes of them make gigabytes of messages, which a task sorts by part.
    pieces = max(-(-found.count() // ROWS_PER_PIECE), spark.sparkContext.defaultParallelism)
    numbers = lines.withColumn("n", F.lit(None).cast("long")).unionByName(counts, allowMissingColumns=True)
    numbers = numbers.repartition(pieces, "l_orderkey", "l_linenumber", "n")
    tx = F.when(F.col("l_orderkey") % 17 != 0, F.concat(F.lit("tx"), F.col("l_orderkey").cast("string")))
    row = F.struct("l_orderkey", "l_linenumber", F.lit("x").alias("label"))
    source = F.struct(F.lit("sales").alias("schema"), F.lit("lineitem").alias("table"), F.col("l_orderkey").alias("lsn"))
    about = F.struct(tx.alias("id"), F.col("l_linenumber").alias("total_order"))
    change = F.struct(F.lit("c").alias("op"), row.alias("after"), source.alias("source"), about.alias("transaction"))
    counted = F.array(
        F.struct(F.lit("sales.lineitem").alias("data_collection"), F.col("n").alias("event_count")),
        F.struct(F.lit("sales.others").alias("data_collection"), F.lit(5).cast("long").alias("event_count")),
    )
    ended = F.concat(F.lit("tx"), F.col("l_orderkey").cast("string"))
    end = F.struct(F.lit("END").alias("status"), ended.alias("id"), (F.col("n") + 5).alias("event_count"), counted.alias("data_collections"))
    feed = numbers.select("l_orderkey", F.when(F.col("n").isNull(), F.to_json(change)).otherwise(F.to_json(end)).alias("value"))
    twice = F.when(F.col("l_orderkey") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    copies = feed.select("l_orderkey", F.col("value").cast("binary").alias("value"), F.explode(twice).alias("copy"))
    return copies.withColumn("key", F.lit(None).cast("binary"))


@query("""
    WITH lines AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    SELECT CASE WHEN l_orderkey % 17 = 0 THEN 'rejected' WHEN l_orderkey % 10 = 0 THEN 'waiting' ELSE 'delivered' END AS outcome,
        count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
    FROM lines WHERE NOT (l_orderkey % 17 = 0 AND l_orderkey % 13 = 0) GROUP BY 1
""")
def ingest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transactional source in batches that cut through transactions; one batch is replayed, a fold lies between."""
    table = CapturedTable("sales", "lineitem", {"l_orderkey": "BIGINT", "l_linenumber": "INT", "label": "VARCHAR"}, ("l_orderkey", "l_linenumber"))
    home = work_path(spark, "tx")
    ingest = Ingest(spark, PostgresSource("app", transactional=True), (table,), home)
    feed = _transaction_feed(spark, sf_dir).filter("NOT (l_orderkey % 17 = 0 AND copy = 2)")
    feed = feed.filter("NOT (l_orderkey % 17 = 0 AND l_orderkey % 13 = 0)")
    log = work_path(spark, "log")
    feed.withColumn("part", F.pmod(F.xxhash64("value", "copy"), F.lit(3))).drop("l_orderkey", "copy").write.partitionBy("part").parquet(log)
    for i in (0, 1, 1, 2):
        ingest.deliver(spark.read.parquet(f"{log}/part={i}"), i)
        if i == 1:
            ingest.maintain()
    rows = ingest.read(table).agg(F.lit("delivered").alias("outcome"), F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))
    opened = ingest.open_transactions().filter("_events IS NULL")
    number = F.substring("_tx", 3, 20).cast("long")
    waiting = opened.agg(F.lit("waiting").alias("outcome"), F.sum("rows").alias("n"), F.sum(number * F.col("rows")).alias("key_sum"))
    kept = read_partitions(spark, f"{home}/_transactions/rejects")
    lost = F.get_json_object(F.unbase64(F.get_json_object("raw", "$.value")).cast("string"), "$.after.l_orderkey").cast("long")
    rejects = kept.agg(F.lit("rejected").alias("outcome"), F.count("*").alias("n"), F.sum(lost).alias("key_sum"))
    return rows.unionByName(waiting).unionByName(rejects)


@query("""
    SELECT 'p' || (p_partkey % 20) AS target, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS key_sum, 'app' AS database_name FROM part GROUP BY 1
""")
def ingest_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty tables of equal columns, decoded together and written by one write; the batch comes twice."""
    names = [f"p{i}" for i in range(20)]
    tables = tuple(CapturedTable("stock", n, {"p_partkey": "BIGINT", "p_name": "VARCHAR"}, ("p_partkey",)) for n in names)
    ingest = Ingest(spark, PostgresSource("app", tables="stock.*"), tables, work_path(spark, "many"), metadata=("database", "timestamp"))
    part = load(spark, sf_dir, "part")
    which = F.concat(F.lit("p"), (F.col("p_partkey") % 20).cast("string"))
    source = F.struct(F.lit("app").alias("db"), F.lit("stock").alias("schema"), which.alias("table"), F.lit(1).alias("lsn"), F.lit(1).alias("ts_us"))
    message = F.to_json(F.struct(F.lit("c").alias("op"), F.struct("p_partkey", "p_name").alias("after"), source.alias("source")))
    feed = part.select(message.cast("binary").alias("value"))
    ingest.deliver(feed, 0)
    ingest.deliver(feed, 0)
    parts = [
        ingest.read(t).groupBy("database_name").agg(F.lit(t.target).alias("target"), F.count("*").alias("n"), F.sum("p_partkey").alias("key_sum"))
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders
""")
def ingest_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only later messages have is added; a source that may not change its schema leaves it out."""
    table = CapturedTable("sales", "orders", {"o_orderkey": "BIGINT", "o_orderstatus": "VARCHAR"}, ("o_orderkey",))
    orders = load(spark, sf_dir, "orders")

    def feed(rows: DataFrame, *more: Column) -> DataFrame:
        source = F.struct(F.lit("sales").alias("schema"), F.lit("orders").alias("table"), F.lit(1).alias("lsn"))
        after = F.struct("o_orderkey", "o_orderstatus", *more)
        return rows.select(F.to_json(F.struct(F.lit("c").alias("op"), after.alias("after"), source.alias("source"))).cast("binary").alias("value"))

    old, new = feed(orders.filter("o_orderkey % 2 = 0")), feed(orders.filter("o_orderkey % 2 = 1"), F.col("o_custkey").alias("customer"))
    read = {}
    for grows in (True, False):
        ingest = Ingest(spark, PostgresSource("app", auto_schema_change=grows), (table,), work_path(spark, "schema"))
        ingest.deliver(old, 0)
        ingest.deliver(new, 1)
        read[grows] = ingest.read(table)
    fixed = read[False].select("o_orderkey", F.lit(read[False].columns == ["o_orderkey", "o_orderstatus"]).alias("as_declared"))
    return read[True].join(fixed.filter("as_declared"), "o_orderkey").drop("as_declared")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 2")
def snapshot_chunks_meet_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read in chunks while it changes: each chunk has rows that the log changes or deletes before it ends.

    The snapshot is of old rows; the log, which goes on during every chunk, gives a third their status and deletes another.
    """
    orders = load(spark, sf_dir, "orders")
    table = CapturedTable("sales", "orders", {"o_orderkey": "BIGINT", "o_orderstatus": "VARCHAR"}, ("o_orderkey",))
    source = lambda lsn: F.struct(F.lit("sales").alias("schema"), F.lit("orders").alias("table"), lsn.alias("lsn"))
    row = F.struct("o_orderkey", "o_orderstatus")
    # Log positions: the change of an order of chunk c lies between c * 1000 and (c + 1) * 1000.
    chunk = F.pmod(F.xxhash64("o_orderkey"), F.lit(4))
    lsn = chunk * 1000 + 1 + F.col("o_orderkey") % 998
    gone = F.col("o_orderkey") % 3 == 2
    changed = orders.filter("o_orderkey % 3 > 0")
    log = changed.select(
        lsn.alias("lsn"),
        F.to_json(
            F.struct(F.when(gone, "d").otherwise("u").alias("op"), F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), source(lsn).alias("source"))
        ).cast("binary").alias("value"),
    )
    status = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise(F.lit("?"))
    stale = orders.withColumn("chunk", chunk).select("chunk", "o_orderkey", status.alias("o_orderstatus"))
    ingest = Ingest(spark, PostgresSource("app"), (table,), work_path(spark, "chunks"))
    now = [0]

    def position() -> dict[str, int]:  # the log goes on while a chunk is read
        at = {"lsn": (now[0] // 2 + now[0] % 2) * 1000, "txId": 0}
        now[0] += 1
        return at

    def between(low: dict, high: dict) -> DataFrame:
        return log.filter((F.col("lsn") > low["lsn"]) & (F.col("lsn") <= high["lsn"])).select("value")

    ingest.load(table, [f"chunk = {c}" for c in range(4)], lambda c: stale.filter(c).drop("chunk"), position, between)
    ingest.deliver(log.select("value"), 0, "stream")
    return ingest.read(table)


@query("SELECT 1::BIGINT AS times, count(*) AS n, true AS small FROM events")
def backfill_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of a key of which one value has a third of the rows and null a tenth: every row is in one, none is large."""
    events = load(spark, sf_dir, "events")
    skewed = F.when(F.col("event_id") % 10 == 9, None).when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    rows = events.select(skewed.alias("k"), F.col("event_id").alias("s"))
    per_split = max(50, rows.count() // 20)
    predicates = uneven_predicates(rows, "k", per_split, "s")
    taken = rows.select("s", F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]).alias("in"))
    taken = taken.select("s", F.array_compact("in").alias("in"))
    sizes = taken.select(F.explode("in").alias("split")).groupBy("split").agg(F.count("*").alias("n"))
    small = sizes.agg((F.max("n") <= 2 * per_split).alias("small"))
    found = taken.groupBy(F.size("in").cast("long").alias("times")).agg(F.count("*").alias("n"))
    return found.withColumn("small", small.scalar())


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of orders as documents: whole ones as JSON text, then patches of some, deletes of others, out of order."""
    orders = load(spark, sf_dir, "orders")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    doc = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("_id"),
            F.struct(F.col("o_orderstatus").alias("code"), F.lit(True).alias("old")).alias("status"),
            F.array(F.lit(1), F.lit(2), F.lit(3)).alias("lines"),
            F.col("o_custkey").alias("customer"),
        )
    )
    key = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"))).cast("binary").alias("key")

    def envelope(rows: DataFrame, op: str, order: int, after: Column | None = None, **patch: Column) -> DataFrame:
        source = F.struct(F.lit("app").alias("db"), F.lit("orders").alias("collection"), F.lit(order).alias("ts_us"), F.lit(0).alias("ord"))
        body = [F.lit(op).alias("op"), source.alias("source")]
        body += [after.alias("after")] if after is not None else []
        body += [F.struct(*[c.alias(n) for n, c in patch.items()]).alias("updateDescription")] if patch else []
        return rows.select(key, F.to_json(F.struct(*body)).cast("binary").alias("value"))

    whole = envelope(orders, "c", 1, doc)
    even = orders.filter("o_orderkey % 2 = 0")
    first = envelope(even, "u", 2, updatedFields=F.lit('{"status.code":"X","lines.3":4,"added":{"a":[1]}}'))
    second = envelope(
        orders.filter("o_orderkey % 4 = 0"), "u", 3,
        updatedFields=F.concat(F.lit('{"status.code":'), q(F.concat(F.lit("Z"), F.col("o_orderkey").cast("string"))), F.lit("}")),
        removedFields=F.array(F.lit("status.old"), F.lit("customer")),
        truncatedArrays=F.array(F.struct(F.lit("lines").alias("field"), F.lit(1).alias("size"))),
    )
    gone = envelope(orders.filter("o_orderkey % 9 = 0"), "d", 4)
    return second.unionByName(gone).unionByName(first).unionByName(whole)


_PATCHED = """
    SELECT CAST(o_orderkey AS VARCHAR) AS _id,
        CASE WHEN o_orderkey % 4 = 0 THEN 'Z' || o_orderkey WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS code,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'true' END AS old,
        CASE WHEN o_orderkey % 4 = 0 THEN '[1]' WHEN o_orderkey % 2 = 0 THEN '[1,2,3,4]' ELSE '[1,2,3]' END AS lines,
        CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
        CASE WHEN o_orderkey % 2 = 0 THEN '{"a":[1]}' END AS added
    FROM orders WHERE o_orderkey % 9 <> 0
"""
_FIELDS = {"code": "$.status.code", "old": "$.status.old", "lines": "$.lines", "customer": "$.customer", "added": "$.added"}


def _fields(documents: DataFrame) -> DataFrame:
    return documents.select("_id", *[F.get_json_object("payload", p).alias(n) for n, p in _FIELDS.items()])


@query(_PATCHED)
def cdc_mongo_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents put together from whole ones, patches and deletes that come in the wrong order."""
    events = accepted(decode.decode_documents(_order_documents(spark, sf_dir)))
    changes = collapse(path_changes(events), ["_id", "path"], ["_order"], op="_op")
    return _fields(assembled(changes))


@query(_PATCHED)
def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same collection ingested in batches that cut through each document's changes, with a fold between."""
    collection = CapturedTable("app", "orders", DOCUMENT_COLUMNS, ("_id",))
    ingest = Ingest(spark, MongoSource("app"), (collection,), work_path(spark, "documents"))
    log = work_path(spark, "log")
    _order_documents(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3))).write.parquet(log)
    for i in range(3):
        ingest.deliver(spark.read.parquet(log).filter(F.col("part") == i).drop("part"), i)
        if i == 1:
            ingest.maintain()
    return _fields(ingest.read(collection))


@query("""
    SELECT event_id, ts, CAST(ts AS DATE) AS day, date_trunc('second', ts) - INTERVAL 2 HOUR AS seen, CAST(ts AS DATE) AS days
    FROM events
""")
def decode_json_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain JSON messages whose times are ISO text and whose dates are text or days."""
    columns = {"event_id": "BIGINT", "ts": "TIMESTAMP", "day": "DATE", "seen": "TIMESTAMPTZ", "days": "DATE"}
    rows = accepted(decode.decode_json(fx.iso_log(spark, sf_dir), columns))
    return rows.withColumn("seen", F.col("seen").cast("timestamp_ntz"))


@query("""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1 MILLISECOND AS placed,
        CAST(o_orderdate AS DATE) AS "day", o_orderkey AS committed_ms FROM orders
""")
def cdc_mysql_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped envelopes with times in milliseconds and a commit time in ``ts_ms``."""
    columns = {"o_orderkey": "BIGINT", "placed": "TIMESTAMP", "day": "DATE"}
    events = accepted(decode_changes(fx.millis_log(spark, sf_dir), MySqlSource("app", time_unit="millis"), columns))
    return events.select("after.*", F.unix_millis("commit_ts").alias("committed_ms"))


@query("""
    SELECT CASE o_orderkey % 13 WHEN 0 THEN 'no table named' WHEN 1 THEN 'null key' WHEN 2 THEN 'null order key'
        WHEN 3 THEN 'malformed JSON' WHEN 4 THEN 'table not declared' WHEN 5 THEN 'cast failed: placed' ELSE 'delivered' END AS outcome,
        count(*) AS messages FROM orders GROUP BY 1
""")
def ingest_accounts_for_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of a faulty feed is delivered or rejected with its reason; the batch is delivered twice."""
    table = CapturedTable(
        "sales", "orders", {"o_orderkey": "BIGINT", "o_orderstatus": "VARCHAR(1)", "placed": "TIMESTAMP"}, ("o_orderkey",)
    )
    home = work_path(spark, "accounts")
    ingest = Ingest(spark, PostgresSource("app"), (table,), home)
    feed = fx.faulty_log(spark, sf_dir)
    ingest.deliver(feed, 0)
    ingest.deliver(feed, 0)
    rejects = [read_partitions(spark, f"{home}/_rejects/{name}").select("error") for name in ("orders", "_unplaced")]
    outcomes = ingest.read(table).select(F.lit("delivered").alias("outcome")).union(rejects[0]).union(rejects[1])
    return outcomes.groupBy("outcome").agg(F.count("*").alias("messages"))
