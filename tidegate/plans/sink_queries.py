"""Sinks: what was written is read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.typemap import struct_of
from ..operators.changes import apply_latest
from ..session import work_path
from ..sinks import (
    FileSink,
    LakeSink,
    LakeTable,
    SearchSink,
    append_table,
    bulk_docs,
    deliver_tables,
    encode_debezium as debezium_envelopes,
    encode_upsert as upsert_messages,
    jdbc,
    number_batches,
    pack_requests,
    prepare,
    read_files,
    route,
    split_unknown_fields,
    upsert_table,
    write_files,
)
from ..sources import PostgresSource, accepted, decode_changes, decode_upsert
from . import fixtures as fx
from .fixtures import EVENT_COLUMNS, load
from .registry import LATEST_EVENTS, query

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _round_trip(spark: SparkSession, sf_dir: str, encode: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    sink = FileSink(work_path(spark, f"sink-{encode.lower()}"), encode=encode)
    write_files(events, sink)
    return read_files(spark, sink, struct_of(EVENT_COLUMNS))


@query(_EVENTS)
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "PARQUET")


@query(_EVENTS)
def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds survive the text."""
    return _round_trip(spark, sf_dir, "JSON")


@query(_EVENTS)
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds, quotes and commas survive the text."""
    return _round_trip(spark, sf_dir, "CSV")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole multi-line texts through CSV."""
    documents = load(spark, sf_dir, "documents")
    sink = FileSink(work_path(spark, "sink-texts"), encode="CSV", options={"multiLine": "true"})
    write_files(documents, sink)
    return read_files(spark, sink, documents.schema)


@query("""
    SELECT '{"user_id":' || user_id || '}' AS key, event_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events
""")
def encode_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed messages; a delete has no value."""
    changes = fx.change_log(spark, sf_dir)
    messages = upsert_messages(changes.withColumn("user_id", F.col("user_id")), ["user_id"])
    # the deletes' ids come from the change itself, a message without a value has none
    sent = messages.filter("value IS NOT NULL").select(
        "key",
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("value", "$.value").cast("double").alias("value"),
    )
    deletes = changes.filter("op = 'd'").select("event_id", "user_id", "op")
    keys = upsert_messages(deletes, ["event_id", "user_id"])
    gone = keys.select(
        F.concat(F.lit('{"user_id":'), F.get_json_object("key", "$.user_id"), F.lit("}")).alias("key"),
        F.get_json_object("key", "$.event_id").cast("long").alias("event_id"),
        F.col("value").cast("double").alias("value"),
    )
    return sent.unionByName(gone)


@query("""
    SELECT CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, event_id, ts, user_id, event_type, value, props
    FROM events
""")
def encode_debezium(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output envelopes decode to the changes they were made from."""
    feed = debezium_envelopes(fx.change_log(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    events = accepted(decode_changes(feed, PostgresSource("app"), EVENT_COLUMNS))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("_image")
    return events.select("op", image).select("op", "_image.*")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_type <> 'error'")
def sink_jdbc_append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows an append to a database sends."""
    return jdbc.append_rows(fx.change_log(spark, sf_dir))


@query("""
    SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
""")
def sink_jdbc_upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows an upsert stages in the database: one per key, deletes included."""
    return jdbc.upsert_rows(fx.change_log(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query(_EVENTS + " WHERE event_type <> 'error'")
def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = LakeSink(work_path(spark, "lake"), "app", "events")
    append_table(fx.change_log(spark, sf_dir), sink)
    return spark.read.parquet(sink.path)


def _batches(changes: DataFrame) -> list[DataFrame]:
    """The whole log as three batches in an order that is not the order of the changes."""
    kinds = (["click", "purchase"], ["error"], ["signup", "view"])
    known = [k for group in kinds for k in group]
    return [changes.filter(F.col("event_type").isin(*g)) for g in kinds] + [
        changes.filter(~F.col("event_type").isin(*known))
    ]


def _filled(spark: SparkSession, sf_dir: str, replay: bool = False) -> LakeTable:
    table = LakeTable(spark, work_path(spark, "lake"), ["user_id"], ["ts", "event_id"])
    batches = _batches(fx.change_log(spark, sf_dir))
    for i, batch in enumerate(batches):
        table.append_batch(batch, i)
    if replay:
        table.append_batch(batches[1], 1)
        table.append_batch(batches[2], 2)
    return table


@query(LATEST_EVENTS)
def lake_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserted batches that arrive out of order, read as the latest state."""
    sink = LakeSink(
        work_path(spark, "warehouse"), "app", "users", data_type="upsert", primary_key="user_id"
    )
    for i, batch in enumerate(_batches(fx.change_log(spark, sf_dir))):
        upsert_table(batch, sink, ["ts", "event_id"], i)
    return LakeTable(spark, sink.path, sink.keys, ["ts", "event_id"]).read()


_STORED = """
    SELECT 'state' AS part, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ({latest})
    UNION ALL
    SELECT 'stored', count(*), CAST(sum(event_id) AS BIGINT) FROM (
        SELECT max(event_id) AS event_id FROM events
        GROUP BY user_id, CASE WHEN event_type IN ('click', 'purchase') THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END)
"""


@query(_STORED.format(latest=LATEST_EVENTS))
def lake_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches delivered twice leave the same stored rows and the same state."""
    table = _filled(spark, sf_dir, replay=True)

    def summary(part: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))

    return summary("state", table.read()).unionByName(summary("stored", table.changes()))


@query(LATEST_EVENTS)
def compact_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _filled(spark, sf_dir)
    table.compact()
    return table.read()


@query(LATEST_EVENTS)
def expire_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded batches are dropped, then one more batch arrives late and must not win."""
    table = _filled(spark, sf_dir)
    table.compact()
    table.expire()
    table.append_batch(_batches(fx.change_log(spark, sf_dir))[0], 10)
    table.compact()
    table.expire(keep_batches=1)
    return table.read()


@query(LATEST_EVENTS)
def lake_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot, a stream and the stream restarted all count their batches from 0; a compaction lies between."""
    table = LakeTable(spark, work_path(spark, "lake"), ["user_id"], ["ts", "event_id"])
    first, *others, last = _batches(fx.change_log(spark, sf_dir))
    table.append_batch(first, 0, "snapshot")
    for i, batch in enumerate(others):
        table.append_batch(batch, i, "stream")
    table.compact()
    table.append_batch(last, 0, "restarted")
    table.append_batch(others[0], 0, "stream")
    table.expire()
    return table.read()


_LINE_ID = "l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"
_LINE_KEY = "l_orderkey,l_linenumber,l_partkey,l_suppkey"
_LINE_FIELDS = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"]


def _line_sink(**kwargs) -> SearchSink:
    return SearchSink("https://search:9200", "lines", primary_key=_LINE_KEY, delimiter="|", **kwargs)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("l_returnflag") == "R", F.lit("d")).otherwise(F.lit("u"))
    return load(spark, sf_dir, "lineitem").withColumn("op", op)


@query(f"""
    SELECT 'lines' AS _index, {_LINE_ID} AS _id, CAST(l_orderkey AS VARCHAR) AS routing,
           CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'index' END AS action,
           CASE WHEN l_returnflag <> 'R' THEN CAST(json_object('l_orderkey', l_orderkey, 'l_partkey', l_partkey,
               'l_quantity', l_quantity, 'l_returnflag', l_returnflag, 'l_shipdate', epoch_us(l_shipdate)) AS VARCHAR)
           END AS source
    FROM lineitem
""")
def es_bulk_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk documents of order lines; returned lines are deleted."""
    sink = _line_sink(routing_column="l_orderkey")
    return bulk_docs(_lines(spark, sf_dir), sink, fields=_LINE_FIELDS)


@query("SELECT event_type AS _index, count(*) AS docs FROM events GROUP BY 1")
def es_dynamic_index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index named by a column."""
    sink = SearchSink("https://search:9200", index_column="event_type", primary_key="event_id")
    docs = bulk_docs(load(spark, sf_dir, "events"), sink)
    return docs.groupBy("_index").agg(F.count(F.lit(1)).alias("docs"))


@query(f"SELECT {_LINE_ID} AS _id FROM lineitem")
def es_doc_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk_docs(_lines(spark, sf_dir), _line_sink()).select("_id")


@query("""
    SELECT CAST(user_id AS VARCHAR) AS routing, count(*) AS docs, count(DISTINCT event_id) AS ids FROM events GROUP BY 1
""")
def es_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents brought together by routing value."""
    sink = SearchSink("https://search:9200", "events", primary_key="event_id", routing_column="user_id")
    docs = route(bulk_docs(load(spark, sf_dir, "events"), sink))
    return docs.groupBy("routing").agg(F.count(F.lit(1)).alias("docs"), F.count_distinct("_id").alias("ids"))


@query("""
    WITH n AS (SELECT CAST(ceil(count(*) / 1000.0) AS BIGINT) AS lanes FROM events),
    l AS (SELECT event_id, CAST(event_id % lanes AS INTEGER) AS lane FROM events, n)
    SELECT event_id, lane,
           CAST((row_number() OVER (PARTITION BY lane ORDER BY event_id) - 1) // 300 AS INTEGER) AS batch
    FROM l
""")
def es_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed request numbers of at most 300 documents, in lanes of about 1,000 rows."""
    events = load(spark, sf_dir, "events").select("event_id")
    return number_batches(events, "event_id", max_docs=300, rows_per_lane=1000, lane=F.col("event_id"))


@query("""
    SELECT CASE WHEN event_id % 7 = 0 THEN 'null document id' WHEN props IS NOT NULL THEN 'unknown fields: props' ELSE 'sent' END AS outcome,
        count(*) AS docs FROM events GROUP BY 1
    UNION ALL SELECT CASE WHEN event_id % 7 = 0 THEN 'null document id, changing' ELSE 'sent, changing' END, count(*) FROM events GROUP BY 1
""")
def es_strict_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a value in a field that the index doesn't have are rejected, unless the sink changes its schema."""
    events = load(spark, sf_dir, "events")
    events = events.withColumn("doc", F.when(F.col("event_id") % 7 != 0, F.col("event_id")))
    fields = ["doc", "event_id", "ts", "user_id", "event_type", "value"]

    def outcomes(change: bool, label: str) -> DataFrame:
        sink = SearchSink("https://search:9200", "events", primary_key="doc", auto_schema_change=change)
        docs, rejects = prepare(events, sink, fields=fields)
        whole = F.get_json_object("source", "$.user_id").isNotNull()
        sent = docs.filter(whole & (F.get_json_object("source", "$.props").isNull() | F.lit(change)))
        named = sent.select(F.lit("sent").alias("outcome")).union(rejects.select("error"))
        return named.groupBy(F.concat("outcome", F.lit(label)).alias("outcome")).agg(F.count("*").alias("docs"))

    return outcomes(False, "").unionByName(outcomes(True, ", changing"))


@query("""
    SELECT CAST(user_id AS VARCHAR) AS _id, event_id AS version, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
""")
def es_changes_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches out of order, with replays: the actions' versions leave the last change of every id in the index."""
    sink = SearchSink("https://search:9200", "users", primary_key="user_id")
    batches = _batches(fx.change_log(spark, sf_dir))
    sent = [prepare(b, sink, order_by=["event_id"], version="event_id")[0] for b in [*batches, batches[0]]]
    everything = reduce(DataFrame.unionByName, sent)
    # What an index does that refuses versions below the last one it has seen for an id.
    kept = everything.groupBy("_id").agg(
        F.max("version").alias("version"), F.max_by("action", "version").alias("action"), F.max_by("source", "version").alias("source")
    )
    kept = kept.filter("action = 'index'")
    return kept.select("_id", "version", F.get_json_object("source", "$.event_type").alias("event_type"))


@query(f"""
    WITH d AS (
        SELECT l_returnflag = 'R' AS gone, json_object('_index', 'lines', '_id', {_LINE_ID}) AS target,
               json_object('l_orderkey', l_orderkey, 'l_partkey', l_partkey, 'l_quantity', l_quantity,
                           'l_returnflag', l_returnflag, 'l_shipdate', epoch_us(l_shipdate)) AS source
        FROM lineitem)
    SELECT count(*) AS docs,
           CAST(sum(strlen(CAST(target AS VARCHAR)) + CASE WHEN gone THEN 12 ELSE 12 + strlen(CAST(source AS VARCHAR)) END) AS BIGINT) AS bytes,
           0::BIGINT AS too_many, 0::BIGINT AS too_big, 0::BIGINT AS wrong_size FROM d
""")
def es_request_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed requests hold every document and keep both limits."""
    docs = bulk_docs(_lines(spark, sf_dir), _line_sink(), fields=_LINE_FIELDS)
    requests = pack_requests(docs, max_docs=500, max_kb=64)
    return requests.agg(
        F.sum("docs").alias("docs"),
        F.sum("bytes").alias("bytes"),
        F.count_if(F.col("docs") > 500).alias("too_many"),
        F.count_if(F.col("bytes") > 64 * 1024).alias("too_big"),
        F.count_if(F.octet_length("body") != F.col("bytes")).alias("wrong_size"),
    )


@query("""
    SELECT event_id, CASE WHEN event_type = 'signup' THEN 'referrer' END AS unknown_fields FROM events
""")
def es_strict_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With schema change off, documents with undeclared fields are rejected and the fields named."""
    events = load(spark, sf_dir, "events")
    extra = F.when(F.col("event_type") == "signup", F.lit("x"))
    feed = events.select(
        "event_id", F.to_json(F.struct("event_id", "value", extra.alias("referrer"))).alias("value")
    )
    good, bad = split_unknown_fields(feed, ["event_id", "value"])
    return good.select("event_id", F.lit(None).cast("string").alias("unknown_fields")).unionByName(
        bad.select("event_id", "unknown_fields")
    )


@query("""
    SELECT 'lake' AS sink, 'orders' AS "table", count(*) AS "rows", true AS ok FROM orders
    UNION ALL SELECT 'lake', 'big_customers', count(*), true FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT 'lake', 'no_such_table', 0, false
    UNION ALL SELECT 'lake', 'part', count(*), true FROM part
""")
def sink_fan_out_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables to one sink; the one that fails is reported and the rest are delivered."""
    root = work_path(spark, "fan-out-sink")
    load(spark, sf_dir, "customer").createOrReplaceTempView("tidegate_customer")
    result = deliver_tables(
        spark,
        "lake",
        lambda rows, name: append_table(rows, LakeSink(root, "app", name)),
        tables=["no_such_table"],
        queries={"big_customers": "SELECT * FROM tidegate_customer WHERE c_acctbal > 5000"},
        frames={t: load(spark, sf_dir, t) for t in ("orders", "part")},
    )
    return result.select("sink", "table", "rows", "ok")


@query("SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1")
def sink_from_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink whose rows come from a SELECT."""
    load(spark, sf_dir, "events").createOrReplaceTempView("tidegate_events")
    sink = LakeSink(work_path(spark, "select-sink"), "app", "big_events")
    text = "SELECT event_type, count(*) AS n FROM tidegate_events WHERE value > 50 GROUP BY event_type"
    deliver_tables(spark, "lake", lambda rows, _: append_table(rows, sink), queries={"big_events": text})
    return spark.read.parquet(sink.path)


@query(LATEST_EVENTS)
def upsert_messages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded keyed messages, decoded and applied, give the current state."""
    changes = fx.change_log(spark, sf_dir)
    # the message's place in the topic is its event id
    row = upsert_messages(changes.withColumn("message", F.col("event_id")), ["user_id", "message"])
    feed = row.select(
        F.to_json(F.struct(F.get_json_object("key", "$.user_id").cast("long").alias("user_id"))).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.get_json_object("key", "$.message").cast("long").alias("offset"),
    )
    rows = accepted(decode_upsert(feed, EVENT_COLUMNS, {"user_id": "BIGINT"}))
    return apply_latest(rows, ["user_id"], ["_offset"], op="_op").drop("rw_key", "_offset")


