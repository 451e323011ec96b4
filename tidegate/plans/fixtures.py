"""Change logs derived from the given tables. Everything is an expression over the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import to_micros
from ..sinks.encode import wire_row

EVENT_COLUMNS = {
    "event_id": "BIGINT",
    "ts": "TIMESTAMP",
    "user_id": "BIGINT",
    "event_type": "VARCHAR",
    "value": "DOUBLE",
    "props": "VARCHAR",
}
ORDER_COLUMNS = {
    "o_orderkey": "BIGINT",
    "o_custkey": "BIGINT",
    "o_orderstatus": "VARCHAR",
    "o_totalprice": "DOUBLE",
    "o_orderdate": "TIMESTAMP",
    "o_orderpriority": "VARCHAR",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as changes of one row per user: an ``error`` event deletes it, any other replaces it."""
    op = F.when(F.col("event_type") == "error", F.lit("d")).otherwise(F.lit("u"))
    return load(spark, sf_dir, "events").withColumn("op", op)


def _messages(df: DataFrame, topic: str) -> DataFrame:
    """Rows with ``key, value, partition, offset, ts`` and one header as feed messages."""
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.array(
            F.struct(F.lit("event_type").alias("key"), F.col("event_type").cast("binary").alias("value")),
            F.struct(F.lit("weight").alias("key"), F.col("value_of").cast("string").cast("binary").alias("value")),
        ).alias("headers"),
    )


def _as_messages(events: DataFrame, value: Column, topic: str) -> DataFrame:
    # event_id rises with ts, so it serves as the offset; a log's offsets rise but may leave gaps
    return _messages(
        events.select(
            F.to_json(F.struct("user_id")).alias("key"),
            value.alias("value"),
            (F.col("user_id") % 4).alias("partition"),
            F.col("event_id").alias("offset"),
            "ts",
            "event_type",
            F.col("value").alias("value_of"),
        ),
        topic,
    )


def kafka_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as JSON messages keyed by user."""
    events = load(spark, sf_dir, "events")
    return _as_messages(events, F.to_json(wire_row(events)), "app.user-events")


def upsert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``change_log`` as keyed messages; a delete has no value."""
    changes = change_log(spark, sf_dir)
    value = F.when(F.col("op") != "d", F.to_json(wire_row(changes, list(EVENT_COLUMNS))))
    return _as_messages(changes, value, "app.user-state")


def debezium_log(spark: SparkSession, sf_dir: str, source: Column | None = None) -> DataFrame:
    """``change_log`` in Debezium envelopes; ``source`` is the database's position block."""
    changes = change_log(spark, sf_dir)
    if source is None:
        source = position("app", "public", "events", lsn=F.col("event_id"), txId=F.floor(F.col("event_id") / 10))
    row = wire_row(changes, list(EVENT_COLUMNS))
    envelope = F.struct(
        "op",
        F.when(F.col("op") == "d", row).alias("before"),
        F.when(F.col("op") != "d", row).alias("after"),
        source.alias("source"),
    )
    return _as_messages(changes, F.to_json(envelope), "app.public.events")


def position(db: str, schema: str | None, table: str, **fields: Column) -> Column:
    named = [F.lit(db).alias("db"), F.lit(table).alias("table"), to_micros(F.col("ts")).alias("ts_us")]
    if schema:
        named.append(F.lit(schema).alias("schema"))
    return F.struct(*named, *[c.alias(n) for n, c in fields.items()])


def maxwell_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``change_log`` in Maxwell envelopes; updates carry the old value of ``value``."""
    changes = change_log(spark, sf_dir)
    envelope = F.struct(
        F.lit("app").alias("database"),
        F.lit("events").alias("table"),
        F.when(F.col("op") == "d", F.lit("delete")).otherwise(F.lit("update")).alias("type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        F.floor(F.col("event_id") / 10).alias("xid"),
        wire_row(changes, list(EVENT_COLUMNS)).alias("data"),
        F.when(F.col("op") != "d", F.struct((F.col("value") - 1).alias("value"))).alias("old"),
    )
    return _as_messages(changes, F.to_json(envelope), "maxwell")


def canal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``change_log`` in Canal envelopes: one-row arrays of text values."""
    changes = change_log(spark, sf_dir)
    text = F.struct(
        *[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS if c != "ts"],
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )
    envelope = F.struct(
        F.array(text).alias("data"),
        F.lit("app").alias("database"),
        F.lit("events").alias("table"),
        F.when(F.col("op") == "d", F.lit("DELETE")).otherwise(F.lit("UPDATE")).alias("type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("es"),
        F.lit(False).alias("isDdl"),
    )
    return _as_messages(changes, F.to_json(envelope), "canal")


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` as documents of one collection per event type; every user's latest document is current."""
    changes = change_log(spark, sf_dir)
    doc = F.struct(F.col("user_id").cast("string").alias("_id"), F.col("props").alias("payload"))
    key = F.struct(F.col("user_id").cast("string").alias("_id"))
    source = F.struct(
        F.lit("app").alias("db"),
        F.lit("profiles").alias("collection"),
        to_micros(F.col("ts")).alias("ts_us"),
        F.col("event_id").alias("ord"),
    )
    envelope = F.struct(
        "op",
        F.when(F.col("op") == "d", key).alias("before"),
        F.when(F.col("op") != "d", doc).alias("after"),
        source.alias("source"),
    )
    return _as_messages(changes, F.to_json(envelope), "app.profiles")


# schema, table, key column
FEED_TABLES = (
    ("sales", "orders", "o_orderkey"),
    ("sales", "customer", "c_custkey"),
    ("stock", "part", "p_partkey"),
    ("stock", "supplier", "s_suppkey"),
    ("web", "events", "event_id"),
)


def multi_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables as one feed: ``schema, table, pk, order_key, op, after``."""

    def one(schema: str, table: str, key: str) -> DataFrame:
        df = load(spark, sf_dir, table)
        return df.select(
            F.lit(schema).alias("schema"),
            F.lit(table).alias("table"),
            F.col(key).cast("string").alias("pk"),
            F.col(key).cast("long").alias("order_key"),
            F.lit("c").alias("op"),
            F.to_json(wire_row(df)).alias("after"),
        )

    return reduce(DataFrame.unionByName, [one(*t) for t in FEED_TABLES])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as change-feed text."""
    return df.select(
        *[
            (
                F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if t.startswith("timestamp") else F.col(c).cast("string")
            ).alias(c)
            for c, t in df.dtypes
        ]
    )


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with missing names, shared keys, missing keys and numbers that are none."""
    k = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        F.when(k % 97 == 0, F.lit(None)).when(k % 10 == 3, k - 1).otherwise(k).cast("long").alias("c_custkey"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )



def captured_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers as one feed of Debezium envelopes: a snapshot of each, then changes of every seventh order."""
    orders = load(spark, sf_dir, "orders")
    customers = load(spark, sf_dir, "customer")
    later = orders.filter("o_orderkey % 7 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    done = F.when(F.col("o_orderstatus") == "F", F.lit("d")).otherwise(F.lit("u"))

    def envelopes(df: DataFrame, table: str, key: str, op: Column, lsn: Column) -> DataFrame:
        row = wire_row(df)
        source = F.struct(
            F.lit("app").alias("db"), F.lit("sales").alias("schema"), F.lit(table).alias("table"), lsn.alias("lsn"),
            F.col(key).cast("long").alias("txId"),
        )
        envelope = F.struct(
            op.alias("op"),
            F.when(op == "d", row).alias("before"),
            F.when(op != "d", row).alias("after"),
            source.alias("source"),
        )
        return df.select(F.to_json(F.struct(key)).cast("binary").alias("key"), F.to_json(envelope).cast("binary").alias("value"))

    start = F.lit(0).cast("long")
    return (
        envelopes(orders, "orders", "o_orderkey", F.lit("r"), start)
        .unionByName(envelopes(customers, "customer", "c_custkey", F.lit("r"), start))
        .unionByName(envelopes(later, "orders", "o_orderkey", done, F.col("o_orderkey") + 1))
    )


def iso_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as plain JSON messages with ISO times and dates, written out field by field."""
    events = load(spark, sf_dir, "events")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    text = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"ts":'), quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit(',"day":'), quoted(F.date_format("ts", "yyyy-MM-dd")),
        F.lit(',"seen":'), quoted(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))),
        F.lit(',"days":'), F.date_diff(F.to_date("ts"), F.lit("1970-01-01")).cast("string"),
        F.lit("}"),
    )
    return events.select(text.cast("binary").alias("value"))


def millis_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as wrapped MySQL envelopes: times in milliseconds, dates as days, ``ts_ms`` only."""
    orders = load(spark, sf_dir, "orders")
    day = F.date_diff(F.to_date("o_orderdate"), F.lit("1970-01-01"))
    row = F.format_string(
        '{"o_orderkey":%d,"placed":%d,"day":%d}', F.col("o_orderkey"), day.cast("long") * 86_400_000 + 1, day
    )
    text = F.format_string(
        '{"schema":{"type":"struct"},"payload":{"op":"c","before":null,"after":%s,"ts_ms":5,"source":{"db":"app","table":"orders",'
        '"file":"bin.000001","pos":%d,"ts_ms":%d}}}',
        row,
        F.col("o_orderkey"),
        F.col("o_orderkey"),
    )
    return orders.select(text.cast("binary").alias("value"))


def faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as envelopes, some of which no table can take, by the order key's residue modulo 13."""
    orders = load(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 13
    envelope = F.format_string(
        '{"op":"c","after":{"o_orderkey":%s,"o_orderstatus":"%s","placed":"%s"},"source":{"db":"app","schema":"sales","table":"%s","lsn":%s,"txId":%s}}',
        F.when(kind == 1, "null").otherwise(F.col("o_orderkey").cast("string")),
        F.col("o_orderstatus"),
        F.when(kind == 5, "yesterday").otherwise("2024-05-06T07:08:09"),
        F.when(kind == 4, "unknown").otherwise("orders"),
        F.when(kind == 2, "null").otherwise(F.col("o_orderkey").cast("string")),
        F.when(kind == 2, "null").otherwise("1"),
    )
    text = F.when(kind == 0, "not an envelope").when(kind == 3, F.concat(envelope, envelope)).otherwise(envelope)
    return orders.select(text.cast("binary").alias("value"))
